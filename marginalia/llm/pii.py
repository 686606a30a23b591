"""Personal data in texts: base kinds by pattern, further identifiers by bootstrapped context.

Tokens that hold a base span are seed entities.  The two words before a token
are its lexical pattern.  Over the graph of patterns and instances, a pattern
is as good as its instances and an instance as good as its best pattern, in
rounds; identifiers behind a high-confidence pattern get spans of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import let
from .common import BLOCK, matches, stored

#: Fixed patterns of the base kinds, as they are told.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"

#: The same matches in time linear in the text: runs are entered at their start or behind a match, and not given back.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Chains of fewer than 13 digits fail anyway, and no part of them holds more.
_CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IP_VALID = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"

_SPACE = r"\x20\x09-\x0D"
#: Words with a digit or an at sign.
TOKEN = rf"[^{_SPACE}]*[0-9@][^{_SPACE}]*"
_TOKEN = rf"(?<![^{_SPACE}])[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+"
_EDGE = "^[^A-Za-z0-9+@]+"
_TAIL = "[^A-Za-z0-9]+$"
#: The last two words, whatever their length; starts at words only, which keeps it linear.
_BEFORE = rf"(?<![^{_SPACE}])[^{_SPACE}]++[{_SPACE}]++[^{_SPACE}]++[{_SPACE}]*+$"
_SQL_BEFORE = rf"[^{_SPACE}]+[{_SPACE}]+[^{_SPACE}]+[{_SPACE}]*$"

ROUNDS = 3
#: Scores are whole millionths, so that sums don't depend on their order.
UNIT = 1_000_000
CONFIDENT = 600_000
#: Weight of unknown instances that every pattern starts with.
PRIOR = 2
#: Digits that an identifier without an at sign has at least.
DIGITS = 5


def _luhn(digits: Column) -> Column:
    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    each = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)), worth)
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """(rank, start, end) of the base kinds, by kind, then start."""
    tests = {
        "email": lambda m: F.lit(True), "ip": lambda m: m.rlike(_IP_VALID),
        "card": lambda m: F.length(_digits(m)).between(13, 19) & _luhn(_digits(m)),
        "phone": lambda m: F.length(_digits(m)).between(9, 15)}

    def kept(rank: int, kind: str, pattern: str) -> Column:
        good = F.filter(matches(text, pattern), lambda m: tests[kind](m["match"]))
        return F.transform(good, lambda m: F.struct(
            F.lit(rank).alias("rank"), m["start"].alias("start"), (m["start"] + F.length(m["match"])).cast("bigint").alias("end")))

    found = [kept(r, *x) for r, x in enumerate(zip(KINDS, (_EMAIL, _IP, _CARD, PHONE), strict=True))]
    return F.concat(*found)


def _tokens(text: Column, base: Column) -> Column:
    """(start, end, token, pattern, seed) of the words that may be identifiers."""

    def one(m: Column) -> Column:
        return let(F.regexp_replace(m["match"], _EDGE, ""), lambda led: let(F.regexp_replace(led, _TAIL, ""), lambda token: F.struct(
            (m["start"] + F.length(m["match"]) - F.length(led)).cast("bigint").alias("start"),
            (m["start"] + F.length(m["match"]) - F.length(led) + F.length(token)).cast("bigint").alias("end"),
            token.alias("token"),
            F.rtrim(F.lower(F.regexp_replace(
                F.regexp_extract(F.concat(F.lit("# # "), m["before"]), _BEFORE, 0), f"[{_SPACE}]+", " "))
            ).alias("pattern"))))

    def marked(tokens: Column) -> Column:
        """Tokens are held against the base spans of their block only."""
        cut = F.transform(F.sequence(F.lit(1), F.ceil(F.size(tokens) / BLOCK).cast("int")),
                          lambda b: F.slice(tokens, (b - 1) * BLOCK + 1, BLOCK))
        within = lambda part: F.filter(base, lambda b: (
            b["start"] < F.element_at(part, -1)["end"]) & (b["end"] > F.element_at(part, 1)["start"]))
        return F.flatten(F.transform(cut, lambda part: let(within(part), lambda near: F.transform(part, lambda t: t.withField(
            "seed", F.exists(near, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))))))

    kind = "array<struct<start:bigint,end:bigint,token:string,pattern:string,seed:boolean>>"
    some = F.filter(F.transform(matches(text, _TOKEN), one), lambda t: F.length(t["token"]) > 0)
    return let(some, lambda tokens: F.when(F.size(tokens) > 0, marked(tokens)).otherwise(F.array())).cast(kind)


def _identifier(token: Column) -> Column:
    return (F.length(_digits(token)) >= DIGITS) | F.contains(token, F.lit("@"))


def pattern_scores(edges: DataFrame, rounds: int = ROUNDS, confident: int = CONFIDENT) -> DataFrame:
    """``pattern, score`` in millionths for ``edges(pattern, token, seed)``, distinct by pattern and token.

    Seeds score 1.  A pattern scores the sum of its instances' scores by their
    number and a prior; another instance scores what its best confident pattern
    does.  Every step is a combined sum or maximum and a join on a key that AQE
    may split, and is written.
    """
    scored = edges.withColumn("value", F.when(F.col("seed"), F.lit(UNIT)).otherwise(0).cast("bigint"))
    patterns = None
    for at in range(rounds):
        patterns = stored(scored.groupBy("pattern").agg(F.sum("value").alias("sum"), F.count("*").alias("n")).select(
            "pattern", F.floor(F.col("sum") / (F.col("n") + PRIOR)).cast("bigint").alias("score")).filter("score > 0"), "patterns")
        if at == rounds - 1:
            break
        best = edges.join(patterns.filter(F.col("score") >= confident), "pattern").filter("NOT seed").groupBy("token").agg(
            F.max("score").alias("best"))
        scored = edges.join(best, "token", "left").withColumn(
            "value", F.when(F.col("seed"), F.lit(UNIT)).otherwise(F.coalesce("best", F.lit(0))).cast("bigint"))
    return patterns


def _listed(found: Column) -> Column:
    names = F.array(*map(F.lit, (*KINDS, CONTEXT)))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(docs: DataFrame, rounds: int = ROUNDS, confident: int = CONFIDENT) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context`` per row of ``docs(doc_id, text)``.

    ``spans`` holds the base spans and ``context`` spans of further
    identifiers: words with five digits or an at sign that overlap no base span
    and follow a confident pattern.  A token that is a seed anywhere is a seed
    behind every pattern.  Null text is empty; the digest of no span is that of
    the empty string; repeated rows are each returned, and count once in the
    scores; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", text.alias("text"), base_spans(text).alias("base")).select(
        "doc_id", "base", _tokens(F.col("text"), F.col("base")).alias("tokens"))
    rows = stored(found.withColumn("row", F.monotonically_increasing_id()), "pii")
    uses = rows.filter(F.size("tokens") > 0).select("row", F.explode("tokens").alias("t")).select("row", "t.*")
    seen = uses.groupBy("pattern", "token").agg(F.max("seed").alias("seed"))
    known = seen.groupBy("token").agg(F.max("seed").alias("known"))
    edges = stored(seen.join(known, "token").select("pattern", "token", F.col("known").alias("seed")), "edges")
    good = pattern_scores(edges, rounds, confident).filter(F.col("score") >= confident).select("pattern")
    added = uses.filter(~F.col("seed") & _identifier(F.col("token"))).join(good, "pattern").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct(F.lit(len(KINDS)).alias("rank"), "start", "end"))).alias("added"))
    none = F.array().cast("array<struct<rank:int,start:bigint,end:bigint>>")
    met = rows.select("row", "doc_id", "base").join(added, "row", "left").withColumn("added", F.coalesce("added", none))
    count = lambda r: F.size(F.filter("base", lambda s: s["rank"] == r)).cast("bigint")
    return met.select(
        "doc_id", *[count(r).alias(f"n_{k}") for r, k in enumerate(KINDS)],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("bigint").alias("n_context"))


def op8(spark: SparkSession, folder: str) -> DataFrame:
    return scanned(spark.read.parquet(f"{folder}/documents.parquet"))


def _sql_found(kind: str, pattern: str) -> str:
    return f"""
  SELECT row, '{kind}' AS kind, m AS match,
    CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda g: len(g))), 0)
      + coalesce(list_sum(list_transform(found[1:i - 1], lambda g: len(g))), 0) AS BIGINT) AS start, gaps[i] AS before
  FROM (SELECT row, found, gaps, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS m
    FROM (SELECT row, regexp_extract_all(text, '{pattern}') AS found,
      regexp_split_to_array(text, '{pattern}') AS gaps FROM docs) WHERE len(found) > 0)"""


def _sql_patterns(name: str, scored: str) -> str:
    return f"""{name} AS (
  SELECT pattern, score FROM (
    SELECT pattern, CAST(floor(sum(value) / (count(*) + {PRIOR})) AS BIGINT) AS score FROM {scored} GROUP BY pattern) WHERE score > 0),"""


def _sql_rounds() -> str:
    out = f"scored0 AS (SELECT pattern, token, seed, CASE WHEN seed THEN {UNIT} ELSE 0 END AS value FROM edges),\n"
    for at in range(ROUNDS):
        out += _sql_patterns(f"patterns{at}", f"scored{at}") + "\n"
        if at < ROUNDS - 1:
            out += f"""scored{at + 1} AS (
  SELECT e.pattern, e.token, e.seed, CASE WHEN e.seed THEN {UNIT} ELSE coalesce(b.best, 0) END AS value
  FROM edges e LEFT JOIN (
    SELECT token, max(score) AS best FROM edges JOIN patterns{at} USING (pattern)
    WHERE NOT seed AND score >= {CONFIDENT} GROUP BY token) b USING (token)),
"""
    return out


SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
raw AS ({_sql_found("email", EMAIL)} UNION ALL {_sql_found("ip", IP)} UNION ALL {_sql_found("card", CARD)}
  UNION ALL {_sql_found("phone", PHONE)}),
numbered AS (
  SELECT *, start + len(match) AS stop, regexp_replace(match, '[^0-9]', '', 'g') AS digits,
    list_position(['email', 'ip', 'card', 'phone'], kind) - 1 AS rank FROM raw),
base AS (
  SELECT row, kind, rank, start, stop FROM numbered WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(match, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0
    WHEN 'phone' THEN len(digits) BETWEEN 9 AND 15
    ELSE len(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, len(digits) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN CAST(reverse(digits)[i] AS INT)
        ELSE CAST(reverse(digits)[i] AS INT) * 2 - CASE WHEN CAST(reverse(digits)[i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0 END),
words AS ({_sql_found("word", TOKEN)}),
led AS (SELECT *, regexp_replace(match, '{_EDGE}', '') AS led FROM words),
trimmed AS (
  SELECT row, start + len(match) - len(led) AS start, regexp_replace(led, '{_TAIL}', '') AS token,
    rtrim(lower(regexp_replace(regexp_extract('# # ' || before, '{_SQL_BEFORE}'), '[{_SPACE}]+', ' ', 'g'))) AS pattern
  FROM led),
uses AS (
  SELECT t.*, t.start + len(token) AS stop, EXISTS (
    SELECT 1 FROM base b WHERE b.row = t.row AND b.start < t.start + len(token) AND t.start < b.stop) AS seed
  FROM trimmed t WHERE len(token) > 0),
known AS (SELECT token, bool_or(seed) AS seed FROM uses GROUP BY token),
edges AS (SELECT DISTINCT u.pattern, u.token, k.seed FROM uses u JOIN known k USING (token)),
{_sql_rounds()}
added AS (
  SELECT row, '{CONTEXT}' AS kind, {len(KINDS)} AS rank, start, stop FROM uses JOIN patterns{ROUNDS - 1} USING (pattern)
  WHERE NOT seed AND score >= {CONFIDENT} AND (len(regexp_replace(token, '[^0-9]', '', 'g')) >= {DIGITS} OR contains(token, '@'))),
every AS (SELECT * FROM base UNION ALL SELECT * FROM added),
listed AS (
  SELECT row, count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip, count(*) FILTER (rank = 2) AS n_card,
    count(*) FILTER (rank = 3) AS n_phone, count(*) FILTER (rank = 4) AS n_context,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY rank, start) AS spans,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY rank, start) FILTER (rank < 4) AS base
  FROM every GROUP BY row)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_context, 0) AS n_context
FROM docs LEFT JOIN listed USING (row)
"""
