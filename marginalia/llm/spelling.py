"""Spelling variants of the corpus vocabulary by FM-index search schemes.

Two words are near if they differ by one inserted, deleted or replaced code
point.  The search scheme for one error has two searches: match one half
exactly, then extend across the other with the error in it.  They run in
opposite directions, so each needs the suffix-rank intervals of one index
only: the first half is searched in the index of the reversed words, the second
half in that of the words as they are.  A word ends at delimiters, so a match
is a whole word.

A word can only be met through a half that it has itself, so words go to a group
by the hash of length and half, and each group holds the index of its words.
Crowded halves are dealt in blocks of words against blocks of queries.  No pair
of words leaves a group, only the number of near words and the best of them.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import stored, table

#: Fixed by the contract: code points of a run, those of a word, occurrences, deletions, and how much more frequent a form is.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, DELETE, TIMES = 7, 2, 31, 10
#: Index words of a group on average and of a block of a crowded half, and queries of such a block.
GROUP, BLOCK, ASKED = 4096, 4096, 1 << 15
#: Queries that are searched at once.
AT_ONCE = 8192


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n`` of ``docs(doc_id, text)``: lower-cased runs of letters, some with one letter deleted by hash.

    Null text has no run; a null id counts as empty in the hash.
    """
    # A run below the least length can't become a word, and a match of so many letters from the left is a whole run.
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"))
    lowered = runs.select("doc_id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = lowered.withColumn("h", F.crc32(F.encode(named, "UTF-8")))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % DELETE == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


class Text:
    """Words as one array of code points."""

    def __init__(self, words: list[str]) -> None:
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.size) - self.size
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes in order, by doubling the compared prefix."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.zeros(len(text), np.int64)
        after[: max(0, len(text) - width)] = rank[width:] + 1
        key = rank * (len(text) + 1) + after
        order = np.argsort(key, kind="stable")
        step = np.r_[0, np.cumsum(np.diff(key[order]) != 0)]
        rank = np.empty_like(rank)
        rank[order] = step
        if step[-1] == len(text) - 1:
            return order
        width *= 2


class Index:
    """FM-index of delimited words.  Symbol 0 is the delimiter."""

    def __init__(self, words: list[str]) -> None:
        held = Text(words)
        self.alphabet = np.unique(held.points)
        text = np.zeros(len(held.points) + len(words) + 1, np.int64)
        place = np.arange(len(held.points)) + np.repeat(np.arange(len(words)), held.size) + 1
        text[place] = np.searchsorted(self.alphabet, held.points) + 1
        self.order = _suffix_order(text)
        self.before = text[self.order - 1]  # the last symbol, a delimiter, is before the first
        self.n = len(text)
        by = np.argsort(self.before, kind="stable")
        #: Rows by (symbol before them, row): how many are below a key is the rank after that symbol is put in front.
        self.keys = self.before[by] * (self.n + 1) + by
        self.delimiters = np.flatnonzero(text == 0)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points, -1 for those that no word has."""
        if not len(self.alphabet):
            return np.full(len(points), -1)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 1, -1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals with ``symbol`` put in front of what they match; empty for -1."""
        base = symbol * (self.n + 1)
        low, high = np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)
        return low, np.where(symbol < 0, low, high)

    def choices(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which interval can be extended by which letter: (place of the interval, symbol)."""
        few = high - low <= len(self.alphabet)
        at, size = np.flatnonzero(few), (high - low)[few]
        row = np.repeat(low[few] - np.cumsum(size) + size, size) + np.arange(size.sum())
        near = np.unique(np.repeat(at, size) * (len(self.alphabet) + 1) + self.before[row])
        wide = np.flatnonzero(~few)
        place = np.r_[near // (len(self.alphabet) + 1), np.repeat(wide, len(self.alphabet))]
        symbol = np.r_[near % (len(self.alphabet) + 1), np.tile(np.arange(1, len(self.alphabet) + 1), len(wide))]
        return place[symbol > 0], symbol[symbol > 0]

    def words(self, low: np.ndarray) -> np.ndarray:
        """Numbers of the words whose delimiter is at these ranks."""
        return np.searchsorted(self.delimiters, self.order[low])

    def near(self, queries: list[str], exact: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word): words of ``length`` one error away from a query, whose last ``exact`` letters are equal.

        The length says which error it is: a letter more, a letter less, or
        another letter.
        """
        text = Text(queries)
        letter = self.symbols(text.points)
        more = length - text.size
        q = np.arange(len(queries))
        low, high = np.zeros(len(q), np.int64), np.full(len(q), len(self.delimiters))
        for t in range(int(exact.max(initial=0))):
            on = exact[q] > t
            if not on.any():
                break
            at = text.start[q] + text.size[q] - 1 - t
            low[on], high[on] = self.extend(letter[at[on]], low[on], high[on])
            some = low < high
            q, low, high = q[some], low[some], high[some]
        left = text.size[q] - exact[q]  # letters of the query still ahead
        clean = np.ones(len(q), bool)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(q):
            # Whole matches, with the error behind them.
            done = ~clean & (left == 0)
            if done.any():
                a, b = self.extend(np.zeros(done.sum(), np.int64), low[done], high[done])
                found.append((q[done][a < b], self.words(a[a < b])))
            some = clean | (left > 0)
            q, low, high, left, clean = q[some], low[some], high[some], left[some], clean[some]
            nexts = []
            # One letter more in the word, or another one.
            for kind, spent in ((1, 0), (0, 1)):
                own = np.flatnonzero(clean & (more[q] == kind) & (left >= spent))
                at, symbol = self.choices(low[own], high[own])
                at = own[at]
                if spent:
                    other = symbol != letter[text.start[q[at]] + left[at] - 1]
                    at, symbol = at[other], symbol[other]
                a, b = self.extend(symbol, low[at], high[at])
                nexts.append((q[at], a, b, left[at] - spent, np.zeros(len(at), bool)))
            own = np.flatnonzero(clean & (more[q] == -1) & (left > 0))
            nexts.append((q[own], low[own], high[own], left[own] - 1, np.zeros(len(own), bool)))
            own = np.flatnonzero(left > 0)
            a, b = self.extend(letter[text.start[q[own]] + left[own] - 1], low[own], high[own])
            nexts.append((q[own], a, b, left[own] - 1, clean[own]))
            q, low, high, left, clean = (np.concatenate(c) for c in zip(*nexts, strict=True))
            some = low < high
            q, low, high, left, clean = q[some], low[some], high[some], left[some], clean[some]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pairs = np.unique(np.concatenate([a for a, _ in found]) * max(self.n, 1) + np.concatenate([b for _, b in found]))
        return pairs // max(self.n, 1), pairs % max(self.n, 1)


BEST = "word string, n_near bigint, best_n bigint, best string"
_BEST = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _best_of(index: pa.Table, asked: pa.Table) -> pa.Table:
    """Per query of a group: the number of its near words here, and the most frequent of them."""
    out: list[tuple] = []
    for side in (0, 1):
        mine = index.filter(pc.equal(index["side"], side)).sort_by("word")  # code-point order decides ties
        some = asked.filter(pc.equal(asked["side"], side))
        if not len(mine) or not len(some):
            continue
        words, counts = mine["word"].to_pylist(), mine["n"].to_numpy()
        held = Index(words if side else [w[::-1] for w in words])
        queries, sizes = some["word"].to_pylist(), some["m"].to_numpy().astype(np.int64)
        for a in range(0, len(queries), AT_ONCE):
            part, m = queries[a: a + AT_ONCE], sizes[a: a + AT_ONCE]
            q, w = held.near(part if side else [x[::-1] for x in part], m - m // 2 if side else m // 2, m)
            if side:  # the other search has those whose first half is equal as well
                own = [part[i][: m[i] // 2] != words[j][: m[i] // 2] for i, j in zip(q, w, strict=True)]
                q, w = q[own], w[own]
            if not len(q):
                continue
            order = np.lexsort((w, -counts[w], q))
            q, w = q[order], w[order]
            first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
            for i, size in zip(first, np.diff(np.r_[first, len(q)]), strict=True):
                out.append((part[q[i]], int(size), int(counts[w[i]]), words[w[i]]))
    return pa.table([list(c) for c in zip(*out, strict=True)] if out else [[], [], [], []], schema=_BEST)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` for the words of ``words(word, n)`` that have a near one.

    ``best`` is the near word of largest ``n``, ties by code point.  Words are
    taken as distinct; the empty word is near none.
    """
    half = F.floor(F.col("m") / 2).cast("int")
    key = F.xxhash64("side", "m", "half")

    def halves(df: DataFrame) -> DataFrame:
        both = df.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        cut = F.when(F.col("side") == 0, F.substring("word", F.lit(1), half)).otherwise(
            F.substring("word", F.length("word") - F.col("m") + half + 1, F.length("word")))
        return both.withColumn("half", cut).withColumn("key", key).drop("half")

    kept = words.filter(F.length("word") > 0)
    index = halves(kept.withColumn("m", F.length("word"))).select("key", "side", "word", "n")
    lengths = F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.length("word") + d)
    asked = halves(kept.select("word", F.explode(lengths).alias("m")).filter("m > 0")).select("key", "side", "word", "m")
    # Halves that many words or queries share get blocks of their own.
    sizes = index.select("key", F.lit(1).alias("i"), F.lit(0).alias("q")).unionAll(
        asked.select("key", F.lit(0).alias("i"), F.lit(1).alias("q"))).groupBy("key").agg(F.sum("i").alias("i"), F.sum("q").alias("q"))
    # A query that meets no other word of its half ends here.
    met = stored(sizes.filter("i > 0 AND q > 1"), "met")
    total = met.agg(F.sum("i")).first()[0] or 0
    crowded = (F.col("i") > BLOCK) | (F.col("q") > ASKED)
    n = max(1, -(-total // GROUP))
    dealt = met.select(
        F.col("key").alias("k"), F.when(crowded, F.col("key")).otherwise(F.pmod("key", F.lit(n))).alias("bucket"), crowded.alias("own"),
        F.when(crowded, F.ceil(F.col("i") / BLOCK)).otherwise(1).cast("int").alias("rows"),
        F.when(crowded, F.ceil(F.col("q") / ASKED)).otherwise(1).cast("int").alias("columns"))

    def placed(df: DataFrame, mine: str, other: str) -> DataFrame:
        """Every row in its block, once for each block of the other side."""
        joined = df.join(dealt, df["key"] == dealt["k"])
        return joined.withColumn(mine[0], F.pmod(F.xxhash64("word"), F.col(mine)).cast("int")).withColumn(
            other[0], F.explode(F.sequence(F.lit(0), F.col(other) - 1)))

    by = ["own", "bucket", "r", "c"]
    left = placed(index, "rows", "columns").select(*by, "side", "word", "n")
    right = placed(asked, "columns", "rows").select(*by, "side", "word", "m")
    a, b = (df.toDF(*df.columns) for df in (left, right))
    found = a.groupBy(*by).cogroup(b.groupBy(*by)).applyInArrow(lambda x, y: _best_of(x, y), BEST)
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("f")).select(
        "word", "n_near", (-F.col("f.n")).alias("best_n"), F.col("f.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms(word, form)``: where following forms ends.  Each pass doubles the steps that are taken."""
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if reached.join(ahead, "root", "left_semi").isEmpty():
            return reached
        reached = stored(reached.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def grouped(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per word of ``words(word, n)``.

    The form of a word is its most frequent near word, if ``times`` as frequent
    or more; the root is the end of the forms, so it names a group of variants.
    """
    near = stored(words.join(near_words(words), "word", "left"), "near")
    has = F.col("best_n") >= times * F.col("n")
    judged = near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                         F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n"))
    roots = _roots(judged.filter("form IS NOT NULL").select("word", "form"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame) -> DataFrame:
    """``grouped`` over the ``vocabulary`` of ``docs``; other columns are ignored, repeated rows count as often as they occur."""
    return grouped(stored(vocabulary(docs), "words"))


def op13(spark: SparkSession, folder: str) -> DataFrame:
    return variants(table(spark, folder, "documents").select("doc_id", "text"))


# Near words in SQL: of equal length, they agree without the letter at one place; else one is the other without a letter.
SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, i: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, translate(run, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295], list_transform(
      regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM runs, crc_table),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
      ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word),
judged AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
    CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
steps(word, root, depth) AS (
  SELECT word, word, 0 FROM judged
  UNION ALL SELECT s.word, j.form, s.depth + 1 FROM steps s JOIN judged j ON j.word = s.root WHERE j.form IS NOT NULL)
SELECT j.word, j.form, s.root, j.n, CAST(j.n_near AS BIGINT) AS n_near, j.form_n
FROM judged j JOIN (SELECT word, arg_max(root, depth) AS root FROM steps GROUP BY word) s ON s.word = j.word
"""
