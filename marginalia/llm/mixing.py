"""Mixing sources to target weights by hash thresholds.

Every document has a fixed hash.  Words are summed by source and hash bucket;
within a source the buckets are taken in order until its budget is met, and
only the bucket in which the budget falls is summed again, finer.  What remains
is one threshold per source and a filter: nothing is sorted, and a larger
budget always holds the documents of a smaller one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..operators.numbering import running_number
from .common import stored

#: Bits of the hash: so many levels of so many bits each.
LEVELS, BITS = 3, 12
WEIGHTS = (1, 2, 3)
MOST = 3

_WORDS = r"[^\x20\x09-\x0D]+"


def size(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("bigint")


def place(doc_id: Column, text: Column) -> Column:
    """Place of a document in its source: 36 bits of a hash of id and text, so only identical rows share one."""
    digits = F.substring(F.md5(F.concat_ws("|", doc_id.cast("string"), text)), 1, LEVELS * BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, weight``: weights repeat over the sources by code point, null last."""
    ranked = running_number(sources.select("source", F.col("source").isNull().alias("_null")), ["_null", "source"], name="_k")
    return ranked.select(
        "source", F.element_at(F.array(*map(F.lit, weights)), ((F.col("_k") - 1) % len(weights) + 1).cast("int")).alias("weight"))


def targets(sizes: DataFrame, weights: DataFrame, share: float = 1.0, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` for ``sizes(source, source_size)`` and ``weights(source, weight)``.

    The budget, ``share`` of all words, is dealt by weight; no target exceeds
    ``most`` times its source, and the excess goes to the others by weight.
    The level w * t of the others rises until it settles; per step the driver
    sees two sums and a count.  A source without words has target 0.
    """
    weighted = stored(
        sizes.join(weights.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(
            "source", "source_size", F.col("weight").cast("double").alias("weight"),
            (most * F.col("source_size")).alias("most")), "weighted")
    budget = share * (weighted.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        above = F.col("most") > F.col("weight") * level
        held, open_weight, now = weighted.agg(
            F.coalesce(F.sum(F.when(~above, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(above, F.col("weight"))), F.lit(0.0)), F.count_if(~above)).first()
        if now == full or not open_weight:
            break
        level, full = (budget - held) / open_weight, now
    return weighted.select(
        "source", "source_size", F.least("most", F.col("weight") * level).cast("double").alias("target"))


def thresholds(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """``source, source_size, target, whole, bound`` for ``sized(source, size, place)``.

    A document is taken ``whole`` times, and once more if its place is below
    ``bound``.  The bound is where the source's words come nearest to the rest
    of its target.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    asked = wanted.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # base: places before the bucket in question; before: words there; after: with the bucket.
    found = asked.select("source", "rest", F.lit(0).cast("bigint").alias("base"), F.lit(0).cast("bigint").alias("before"),
                         F.col("source_size").alias("after"))
    for level in range(1, LEVELS + 1):
        width = 1 << BITS * (LEVELS - level)
        at = found.select(F.col("source").alias("_s"), "rest", "base", F.col("before").alias("_before"))
        inside = F.col("place").between(F.col("base"), F.col("base") + (width << BITS) - 1)
        sums = sized.join(at, F.col("source").eqNullSafe(F.col("_s"))).filter(inside).groupBy(
            "source", F.floor(F.col("place") / width).alias("bucket")).agg(
            F.sum("size").alias("n"), F.first("rest").alias("rest"), F.first("_before").alias("_before"))
        # At most 2^BITS buckets per source.
        order = W.partitionBy("source").orderBy("bucket")
        after = F.col("_before") + F.sum("n").over(order)
        last = F.lead("bucket").over(order).isNull()
        reached = sums.select("source", "rest", "bucket", "n", after.alias("after"), last.alias("last")).filter(
            (F.col("after") >= F.col("rest")) | F.col("last"))
        found = stored(reached.groupBy("source").agg(F.min(F.struct("bucket", "n", "after", "rest")).alias("b")).select(
            "source", "b.rest", (F.col("b.bucket") * width).alias("base"), (F.col("b.after") - F.col("b.n")).alias("before"),
            "b.after"), "boundary")
    nearer = (F.col("after") - F.col("rest")) < (F.col("rest") - F.col("before"))
    bounds = found.select(F.col("source").alias("_s"), (F.col("base") + F.when(nearer, 1).otherwise(0)).alias("bound"))
    return asked.join(bounds, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("bound", F.lit(0)).cast("bigint").alias("bound"))


def plan_mixture(docs: DataFrame, weights: DataFrame | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Sizes and places of ``docs(doc_id, text, source)``, written once, and the thresholds of its sources."""
    sized = stored(docs.select(
        "doc_id", "source", size(F.col("text")).alias("size"), place(F.col("doc_id"), F.col("text")).alias("place")), "sized")
    sizes = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    wanted = stored(targets(sizes, cyclic_weights(sizes) if weights is None else weights, **options), "targets")
    return sized, stored(thresholds(sized, wanted), "thresholds")


def _copies() -> Column:
    return F.col("whole") + F.when(F.col("place") < F.col("bound"), 1).otherwise(0)


def mixture(docs: DataFrame, weights: DataFrame | None = None, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` per row of ``docs(doc_id, text, source)``.

    Null text has size 0 and is never taken; null is a source of its own;
    identical rows share one decision; an empty table gives no rows.  Other
    columns are ignored.  Reruns agree.  Options: ``share``, ``most``.
    """
    sized, bounds = plan_mixture(docs, weights, **options)
    met = sized.join(bounds.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    return met.select("doc_id", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken"))


def mixed(docs: DataFrame, weights: DataFrame | None = None, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns."""
    _, bounds = plan_mixture(docs, weights, **options)
    b = bounds.select(F.col("source").alias("_s"), "whole", "bound")
    met = docs.select(F.struct(*docs.columns).alias("_row"), F.col("source").alias("_source"), place(
        F.col("doc_id"), F.col("text")).alias("place")).join(b, F.col("_source").eqNullSafe(F.col("_s")))
    copies = F.when(size(F.col("_row.text")) > 0, _copies()).otherwise(0).cast("int")
    return met.select("_row", F.explode(F.array_repeat(F.lit(0), copies))).select("_row.*")


def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return mixture(docs).withColumn("target", F.round("target", 6))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), text)), 1, 9) AS BIGINT) AS place
  FROM documents),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS DOUBLE) AS w
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, 3.0 * source_size AS most, 3.0 * source_size / w AS ratio,
    sum(source_size) OVER () AS budget FROM sizes),
running AS (
  SELECT *, row_number() OVER (ORDER BY ratio, source) AS k,
    coalesce(sum(most) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
    sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_w
  FROM ranked),
level AS (SELECT arg_min((budget - held) / open_w, k) AS t FROM running WHERE ratio > (budget - held) / open_w),
asked AS (
  SELECT source, source_size, least(most, w * coalesce((SELECT t FROM level), 0)) AS target FROM ranked),
rest AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM asked),
places AS (
  SELECT source, place, sum(sum(size)) OVER (PARTITION BY source ORDER BY place) AS after, sum(size) AS n
  FROM sized GROUP BY source, place),
crossed AS (
  SELECT p.source, arg_min(p.place, p.place) AS place, arg_min(p.after, p.place) AS after, arg_min(p.n, p.place) AS n,
    any_value(r.target - r.whole * r.source_size) AS rest
  FROM places p JOIN rest r ON p.source IS NOT DISTINCT FROM r.source
  WHERE p.after >= r.target - r.whole * r.source_size GROUP BY p.source),
bounds AS (
  SELECT source, place + CASE WHEN after - rest < rest - (after - n) THEN 1 ELSE 0 END AS bound FROM crossed)
SELECT s.doc_id, s.size, r.source_size, round(r.target, 6) AS target,
  CAST(s.size * (r.whole + CASE WHEN s.place < coalesce(b.bound, 0) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized s JOIN rest r ON s.source IS NOT DISTINCT FROM r.source
LEFT JOIN bounds b ON s.source IS NOT DISTINCT FROM b.source
"""
