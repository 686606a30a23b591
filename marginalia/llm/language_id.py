"""Language of a text, word first with backoff.

A word seen in training is scored by its log frequency in each language.  An
unseen word falls back to its character n-grams, from the longest length down
to the first at which one is known, and is scored by their mean.  A text is
scored by the mean over its words of which any unit is known.  Every text with a
letter gets a language; one without any known unit gets the most frequent, with
the confidence of a guess.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from .common import released, stored

LENGTHS = (4, 3, 2, 1)
#: Labelled rows per language that the model is fitted on; all when there are fewer.
ROWS = 2_000
#: Languages that are learned, those with most labelled rows.
LANGUAGES = 200
#: Words and n-grams kept of each language, and cells (units by languages) of the tables of words and of n-grams,
#: which bound the model with many languages.  All other words back off.
WORDS, GRAMS, CELLS = 25_000, 15_000, 24_000_000
UNDETERMINED = "und"
#: Words of evidence after which more of them don't raise the confidence.
EVIDENCE = 20
#: A text of which a smaller share of the words has a known unit is not accepted.  All words of the held-out rows of sf0.1 have one.
SHARE = 0.5
#: A text is accepted with a confidence of so many times that of a blind guess, 1 / languages.  One word that training saw
#: once, in one language alone, has 4/3 or more; the least of the 3 358 held-out rows with letters of sf0.1 is 3.8 (0.948 of
#: 4 languages), of all rows of sf0.001 1.6 (0.400).
MARGIN = 1.25

_WORD = re.compile(r"[^\W\d_]+")
_FLUSH = 200_000
#: Words that a task remembers with the score they backed off to.
CACHE = 100_000


def words(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    found = _WORD.findall((text or "").lower())
    return [w for w in found if w.isalpha()] or [v for w in found if (v := "".join(c for c in w if c.isalpha()))]


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of the word with its borders."""
    edged = f" {word} "
    return [g for i in range(len(edged) - n + 1) if (g := edged[i: i + n]) != " "]


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of words and n-grams by language, summed within the task, handed on before they grow large."""
    held: dict[str, Counter] = {}

    def frame() -> pd.DataFrame:
        rows = []
        for lang, counted in held.items():
            parts: Counter = Counter()
            for word, n in counted.items():
                rows.append((lang, 0, word, n))
                for length in LENGTHS:
                    for g in grams(word, length):
                        parts[length, g] += n
            rows += [(lang, length, g, n) for (length, g), n in parts.items()]
        return pd.DataFrame(rows, columns=["lang", "kind", "unit", "n"])

    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"], strict=True):
            held.setdefault(lang, Counter()).update(words(text))
            if sum(map(len, held.values())) > _FLUSH:
                yield frame()
                held.clear()
    if held:
        yield frame()


class Model:
    """Log frequencies of units per language.  Nothing in it changes after it is made."""

    def __init__(self, counts: pa.Table) -> None:
        """``counts(lang, kind, unit, n)``, kind 0 for words, else the length of the n-gram."""
        frame = counts.to_pandas()
        self.langs = sorted(set(frame["lang"]))
        at = frame["lang"].map({lang: i for i, lang in enumerate(self.langs)}).to_numpy()
        self.rows: dict[int, dict[str, int]] = {}
        self.scores: dict[int, np.ndarray] = {}
        for kind in (0, *LENGTHS):
            some = (frame["kind"] == kind).to_numpy()
            places, names = pd.factorize(frame["unit"][some])
            table = np.zeros((len(names), len(self.langs)))
            np.add.at(table, (places, at[some].astype(np.int64)), frame["n"][some].to_numpy())
            # A unit that a language lacks scores the same in all of them, below what any unit scores.
            totals = np.maximum(table.sum(axis=0), 1)
            if kind == 0 and self.langs:
                self.largest = int(table.sum(axis=0).argmax())
            seen = np.log(np.maximum(table, 1) / totals)
            self.rows[kind] = {u: i for i, u in enumerate(names)}
            self.scores[kind] = np.where(table > 0, seen, np.log(0.5 / totals.max(initial=1))).astype(np.float32)

    def backed_off(self, word: str) -> np.ndarray | None:
        """Mean score of the longest known n-grams of a word, or None where none is known."""
        for n in LENGTHS:
            rows = self.rows[n]
            seen = [rows[g] for g in grams(word, n) if g in rows]
            if seen:
                return self.scores[n][seen].mean(axis=0)
        return None


class Scorer:
    """A model, and the words that have backed off so far."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, model.rows[0]
        # Rows of words: the known ones, then those that backed off, as far as they have room.
        self.base = len(self.known)
        self.table = np.concatenate([model.scores[0], np.zeros((CACHE, len(model.langs)), np.float32)])
        self.at: dict[str, int] = {}
        self.next = self.base

    def _row(self, word: str) -> int:
        if (row := self.known.get(word)) is not None:
            return row
        found = self.model.backed_off(word)
        if found is None:
            row = -1
        else:
            row, self.next = self.next, self.next + 1
            self.table[row] = found
        self.at[word] = row
        return row

    def word(self, word: str) -> np.ndarray | None:
        row = self.at.get(word)
        row = self._row(word) if row is None else row
        return None if row < 0 else self.table[row]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, confidence, and the share of the words of which a unit is known; ``und``, 0 and 0 without a letter or a model."""
        counted = Counter(words(text))
        langs = self.model.langs
        if not counted or not langs:
            return UNDETERMINED, 0.0, 0.0
        if self.next + len(counted) > len(self.table) or len(self.at) > 2 * CACHE:
            self.at, self.next = {}, self.base
            if self.base + len(counted) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((len(counted), len(langs)), np.float32)])
        get = self.at.get
        rows = np.array([self._row(w) if (r := get(w)) is None else r for w in counted])
        weights = np.fromiter(counted.values(), np.float64, len(counted))
        total = weights.sum()
        weights, rows = weights[rows >= 0], rows[rows >= 0]
        if not len(rows):
            return langs[self.model.largest], 1.0 / len(langs), 0.0
        mean = weights @ self.table[rows] / weights.sum()
        best = int(mean.argmax())
        odds = np.exp((mean - mean[best]) * min(weights.sum(), EVIDENCE))
        return langs[best], float(1.0 / odds.sum()), float(weights.sum() / total)


def fit(
    labelled: DataFrame, rows: int = ROWS, most_words: int = WORDS, most_grams: int = GRAMS, most_langs: int = LANGUAGES, cells: int = CELLS,
) -> Model:
    """A model from ``labelled(doc_id, text, lang)``, fitted on at most about ``rows`` rows per language.

    The ``most_langs`` languages with most rows are learned, ties by code
    point.  Rows are chosen by a hash of id and text, so reruns agree.  Each
    language keeps its own most frequent units, ties by code point: as many as
    are asked for, or as leave both tables within ``cells``; those are what the
    driver gets.  Rows without language or text are left out; without any row
    the model knows no language and every prediction is ``und``.
    """
    usable = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_langs).collect()
    # One row per learned language, which most_langs bounds.
    shares = labelled.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, rows / r["n"])) for r in sizes], "learned string, share double")
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = usable.join(F.broadcast(shares), F.col("lang") == F.col("learned")).filter(place < F.col("share"))
    counts = chosen.select("text", "lang").mapInPandas(released(_counts), "lang string, kind int, unit string, n bigint")
    units = stored(counts.groupBy("lang", "kind", "unit").agg(F.sum("n").alias("n")), "units")
    rank = F.row_number().over(W.partitionBy("lang", "is_word").orderBy(F.desc("n"), "unit", "kind"))
    room = cells // max(1, len(sizes)) ** 2
    quota = F.when(F.col("is_word"), min(most_words, room)).otherwise(min(most_grams, room))
    ranked = units.withColumn("is_word", F.col("kind") == 0).withColumn("rank", rank).filter(F.col("rank") <= quota)
    listed = units.join(ranked.select("kind", "unit").distinct(), ["kind", "unit"], "left_semi")
    return Model(listed.select("lang", "kind", "unit", "n").toArrow())


PREDICTED = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("known", DoubleType())])


def predictor(spark: SparkSession, model: Model):
    """A column function over texts that gives ``lang_pred``, ``score`` and ``known``, the share of known words."""
    shared = spark.sparkContext.broadcast(pickle.dumps(model))

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def run(batches):
            scorer = Scorer(pickle.loads(shared.value))  # a worker keeps the bytes only
            for texts in batches:
                yield pd.DataFrame([scorer.predict(t) for t in texts], columns=["lang_pred", "score", "known"])

        return released(run)(batches)

    return F.pandas_udf(predict, PREDICTED)


def identified(docs: DataFrame, labelled: DataFrame, name: str = "language", **options) -> DataFrame:
    """``docs`` with a struct ``name(lang_pred, score, known)``; only ``text`` is an input of it.

    Null texts and texts without a letter are ``und`` with 0, all others get a
    learned language; ties go to the first by code point; repeated rows are
    rows of their own; an empty table gives no row; a column of that name is
    replaced, others stay.
    """
    model = fit(labelled, **options)
    return docs.withColumn(name, predictor(docs.sparkSession, model)(F.col("text")))


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def accepted(docs: DataFrame, margin: float = MARGIN, share: float = SHARE, **options) -> DataFrame:
    """The rows of ``docs`` whose language is told, with all their columns and no other.

    It is told where ``share`` of the words or more have a known unit and the
    confidence is ``margin`` times that of a blind guess or more, or 1.  Null
    texts and texts without a letter go; repeated rows are judged alike; an
    empty table gives no row.  The model learns from the labels of rows that
    aren't held out.
    """
    model = fit(docs.filter(~held_out()), **options)
    least = min(1.0, margin / max(1, len(model.langs)))
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def told(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def run(batches):
            scorer = Scorer(pickle.loads(shared.value))
            for texts in batches:
                found = [scorer.predict(t) for t in texts]
                yield pd.Series([lang != UNDETERMINED and known >= share and score >= least for lang, score, known in found], dtype=bool)

        return released(run)(batches)

    return docs.filter(F.pandas_udf(told, BooleanType())(F.col("text")))


def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Null ids count as not held out; null texts and texts without letters are ``und`` with score 0."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    found = identified(docs.select("doc_id", "text"), docs.filter(~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")
