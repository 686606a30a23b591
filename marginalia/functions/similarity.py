"""Set similarities as column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .patterns import WORD
from .text import let, normalize_content


def word_set(c: Column) -> Column:
    """Distinct lowered words."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(f"[{WORD}]+"), F.lit(0)))


def lowered_set(items: Column) -> Column:
    return F.array_distinct(F.transform(items, F.lower))


def space_word_set(normalised: Column) -> Column:
    """Distinct lowered words of a normalised text, between whose words stands one space each."""
    return F.array_distinct(F.filter(F.split(F.lower(normalised), " ", -1), lambda w: w != ""))


def _grams(text: str) -> np.ndarray:
    """Distinct character 3-grams of a text, each as one number of three code points."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.unique(c[:-2] << 42 | c[1:-1] << 21 | c[2:]) if len(c) > 2 else c[:0]


@F.pandas_udf(StructType([StructField(c, IntegerType()) for c in ("shared", "left", "right")]))
def gram_counts(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """How many distinct character 3-grams two texts share and have; a missing text has no counts."""
    def count(x: str | None, y: str | None) -> tuple:
        if x is None or y is None:
            return None, None, None
        left, right = _grams(x), _grams(y)
        return len(np.intersect1d(left, right, assume_unique=True)), len(left), len(right)

    return pd.DataFrame([count(x, y) for x, y in zip(a, b)], columns=["shared", "left", "right"], dtype="Int32")


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two sets; 0.0 where either is empty."""
    def score(x: Column, y: Column) -> Column:
        return let(F.size(F.array_intersect(x, y)), lambda n: ratio_of_counts(n, F.size(x), F.size(y)))

    return let(a, lambda x: let(b, lambda y: score(x, y)))


def ratio_of_counts(shared: Column, left: Column, right: Column) -> Column:
    """Jaccard from an overlap count and two set sizes."""
    return F.when((left == 0) | (right == 0), F.lit(0.0)).otherwise(
        shared / (left + right - shared)
    )


def string_similarity(a: Column, b: Column) -> Column:
    return jaccard(word_set(a), word_set(b))


def list_similarity(a: Column, b: Column) -> Column:
    return jaccard(lowered_set(a), lowered_set(b))


def size_similarity(a: Column, b: Column) -> Column:
    """Closeness of two lengths."""
    longest = F.greatest(a, b)
    return F.when(longest == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.least(F.abs(a - b) / longest, F.lit(1.0))
    )


def weighted_document_score(name: Column, summary: Column, heads: Column, size: Column) -> Column:
    """The four weighted parts, summed in this order (thresholds are compared exactly)."""
    return name * 0.20 + summary * 0.40 + heads * 0.30 + size * 0.10


def weighted_content_score(words: Column, grams: Column) -> Column:
    return words * 0.4 + grams * 0.6


def content_similarity(a: Column, b: Column) -> Column:
    """Shares of words and of character 3-grams of two texts, whose spaces count as one each."""
    # Arrow tasks count the grams, so this is no expression for the inside of a lambda.
    grams = gram_counts(F.lower(normalize_content(a)), F.lower(normalize_content(b)))

    def unequal(na: Column, nb: Column, g: Column) -> Column:
        return let(jaccard(space_word_set(na), space_word_set(nb)), lambda words: F.when(
            (g["left"] == 0) | (g["right"] == 0), words
        ).otherwise(weighted_content_score(words, ratio_of_counts(g["shared"], g["left"], g["right"]))))

    texts = F.struct(normalize_content(a).alias("a"), normalize_content(b).alias("b"), grams.alias("g"))
    return let(texts, lambda t: (
        F.when((a == "") | (b == ""), F.lit(0.0))
        .when(t["a"] == t["b"], F.lit(1.0))
        .when((t["a"] == "") | (t["b"] == ""), F.lit(0.0))
        .otherwise(unequal(t["a"], t["b"], t["g"]))))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0), lambda s, x: s + x,
    )


def cosine(a: Column, b: Column) -> Column:
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms)
