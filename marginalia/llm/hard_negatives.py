"""Hard negatives by integer inner product, with coordinate pruning in length buckets.

Rows lie in buckets of bounded size, by label and then by length.  A bucket
holds its vectors, their lengths, and for every coordinate its rows sorted by
the value of the unit vector.  An anchor that asks a bucket for scores of at
least some limit asks for a cosine of at least the limit over both lengths.
That bounds the value of each coordinate to a feasible range; the ranges of the
anchor's largest coordinates, its focus, are runs of the sorted lists, and the
rows in all of them are verified exactly.

The limit is what the anchor has found in one bucket before, so the result is
exact and the limit only saves work.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..operators.numbering import running_number
from .common import stored, table
from .vectors import finite

#: Rows of a bucket, and anchors that a group of work asks it for.
BUCKET, ANCHORS = 1 << 13, 1 << 13
#: Coordinates of an anchor whose feasible ranges are intersected.
FOCUS = 4
POSITIVES, NEGATIVES = 5, 10
#: Scores beyond this, either way, count as this, so that their multiples stay within 64 bits.
MOST = 10**18
_SLACK = 1e-9


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the integer rows of both sides, held to ``MOST``."""
    top = [int(np.abs(x).max(initial=0)) for x in (a, b)]
    if top[0] * top[1] * max(a.shape[1], 1) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -MOST, MOST).astype(np.int64)


class Bucket(NamedTuple):
    """Rows of one length of vector: numbers, ids, labels, components, lengths, and rows by value of each coordinate."""

    rid: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    v: np.ndarray
    length: np.ndarray
    lists: np.ndarray

    COLUMNS = "bucket bigint, d int, rid binary, vec_id binary, label binary, v binary, kind string, lists binary"

    @classmethod
    def read(cls, row: dict) -> Bucket:
        rid, vec_id, label = (np.frombuffer(row[c], np.int64) for c in ("rid", "vec_id", "label"))
        v = np.frombuffer(row["v"], row["kind"]).reshape(len(rid), row["d"]).astype(np.int64)
        length = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
        return cls(rid, vec_id, label, v, length, np.frombuffer(row["lists"], np.uint16).reshape(row["d"], len(rid)))

    def feasible(self, q: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Rows that each anchor must verify: (anchor, row), never without one that scores ``limit`` or more."""
        size = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        unit = self.v / np.where(self.length > 0, self.length, 1)[:, None]
        out = np.ones((len(q), len(self.rid)), bool)
        for i in np.flatnonzero(limit > 0):
            reach = size[i] * self.length.max(initial=0)
            if limit[i] > reach * (1 + _SLACK):
                out[i] = False
                continue
            out[i] = self.length * size[i] * (1 + _SLACK) >= limit[i]
            least = min(1.0, limit[i] / reach)
            direction = q[i] / size[i]
            runs = []
            for f in np.argsort(-np.abs(direction), kind="stable")[:FOCUS]:
                x, side = direction[f], np.sqrt(max(0.0, (1 - least**2) * (1 - direction[f] ** 2)))
                low = -1.0 if -x >= least else least * x - side
                high = 1.0 if x >= least else least * x + side
                by_value = unit[self.lists[f], f]
                runs.append((f, *np.searchsorted(by_value, (low - _SLACK, high + _SLACK))))
            for f, a, b in sorted(runs, key=lambda r: r[2] - r[1]):
                if b - a < len(self.rid):
                    inside = np.zeros(len(self.rid), bool)
                    inside[self.lists[f][a:b]] = True
                    out[i] &= inside
        return out


def _bucket(rows: pa.Table) -> pa.Table:
    schema = pa.schema([("bucket", pa.int64()), ("d", pa.int32()), ("rid", pa.binary()), ("vec_id", pa.binary()),
                        ("label", pa.binary()), ("v", pa.binary()), ("kind", pa.string()), ("lists", pa.binary())])
    d = rows["d"][0].as_py()
    order = np.argsort(rows["rid"].to_numpy())
    v = rows["v"].combine_chunks().flatten().to_numpy().reshape(len(rows), d)[order]
    top = int(np.abs(v).max(initial=0))
    kind = next((k for k in ("<i2", "<i4") if top <= np.iinfo(k).max), "<i8")
    length = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
    unit = v / np.where(length > 0, length, 1)[:, None]
    packed = [rows[c].to_numpy()[order].astype(np.int64).tobytes() for c in ("rid", "vec_id", "label")]
    lists = np.argsort(unit, axis=0, kind="stable").T.astype(np.uint16)
    return pa.table([[rows["bucket"][0].as_py()], [d], *[[p] for p in packed], [v.astype(kind).tobytes()], [kind],
                     [np.ascontiguousarray(lists).tobytes()]], schema=schema)


FOUND = "arid bigint, want int, score bigint, vec_id bigint, rid bigint"


def _finder(most: int, same: bool):
    def find(asked: pa.Table, held: pa.Table) -> pa.Table:
        """The first ``most`` rows of a bucket for each anchor and range of scores it wants."""
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        if len(asked) and len(held):
            bucket = Bucket.read(held.slice(0, 1).to_pylist()[0])
            arid, label = asked["arid"].to_numpy(), asked["label"].to_numpy()
            q = asked["v"].combine_chunks().flatten().to_numpy().reshape(len(asked), -1)
            lows, highs = asked["lows"].to_pylist(), asked["highs"].to_pylist()
            limit = np.array([min(x) for x in lows], np.int64)
            for a in range(0, len(asked), 512):
                some = slice(a, a + 512)
                good = bucket.feasible(q[some], limit[some])
                good &= (label[some, None] == bucket.label[None, :]) == same
                good &= arid[some, None] != bucket.rid[None, :]
                at = np.flatnonzero(good.any(axis=0))
                scores = dots(q[some], bucket.v[at])
                for i in range(len(scores)):
                    mine = at[good[i, at]]
                    score = scores[i, good[i, at]]
                    for want, (low, high) in enumerate(zip(lows[a + i], highs[a + i], strict=True)):
                        inside = np.flatnonzero((score >= low) & (score <= high))
                        if len(inside) > most:
                            inside = inside[score[inside] >= np.partition(score[inside], -most)[-most]]
                        first = inside[np.lexsort((bucket.vec_id[mine[inside]], -score[inside]))[:most]]
                        for column, values in zip(out, (
                                np.full(len(first), arid[a + i]), np.full(len(first), want, np.int32), score[first],
                                bucket.vec_id[mine[first]], bucket.rid[mine[first]]), strict=True):
                            column.append(values)
        names = [n.split()[0] for n in FOUND.split(", ")]
        return pa.table({
            n: pa.array(np.concatenate(c) if c else [], pa.int32() if n == "want" else pa.int64()) for n, c in zip(names, out, strict=True)})

    return find


def _search(pairs: DataFrame, buckets: DataFrame, n_anchors: int, most: int, same: bool) -> DataFrame:
    """The first ``most`` of each anchor and wanted range, over ``pairs`` of an anchor and a bucket that it asks."""
    by = ["bucket", "d", "part"]
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("arid"), F.lit(-(-n_anchors // ANCHORS))))
    asked = dealt.select(*by).distinct().join(buckets, ["bucket", "d"])
    left, right = (df.toDF(*df.columns) for df in (dealt.select(*by, "arid", "label", "v", "lows", "highs"), asked))
    find = _finder(most, same)
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(lambda a, b: find(a, b), FOUND)
    rank = F.row_number().over(W.partitionBy("arid", "want").orderBy(F.desc("score"), "vec_id", "rid"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= most)


def _raised(anchors: DataFrame, found: DataFrame, most: int) -> DataFrame:
    """Anchors with their lower limits raised to the last of ``most`` scores already found."""
    last = found.groupBy("arid", "want").agg(F.count("*").alias("n"), F.min("score").alias("low")).filter(F.col("n") >= most)
    by_anchor = last.groupBy("arid").agg(F.map_from_entries(F.collect_list(F.struct("want", "low"))).alias("seen"))
    raised = F.transform("lows", lambda low, i: F.greatest(low, F.coalesce(F.try_element_at("seen", i), low)))
    return anchors.join(by_anchor, "arid", "left").withColumn("lows", raised).drop("seen")


def hard_negatives(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low_pct: int = 30, high_pct: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors of ``rows``.

    ``rows(vec_id, label, v, anchor)``: integer vectors; other columns are
    ignored.  Positives are an anchor's first other rows of its label by score,
    ties by smaller id; for each of them, the first rows of other labels whose
    score lies between ``low_pct`` and ``high_pct`` hundredths of its own.
    Rows with a null in any of the columns take no part, vectors of different
    length never meet, and repeated rows are rows of their own.
    """
    good = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND anchor IS NOT NULL").select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.col("v").cast("array<bigint>").alias("v"), "anchor", F.size("v").alias("d"),
        F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x).alias("length2"))
    numbered = running_number(good, ["d", "label", "length2", "vec_id"], (), "rid")
    placed = stored(numbered.withColumn("bucket", F.floor((F.col("rid") - 1) / BUCKET)), "placed")
    buckets = stored(placed.groupBy("bucket", "d").applyInArrow(lambda t: _bucket(t), Bucket.COLUMNS), "buckets")
    about = stored(placed.groupBy("bucket", "d").agg(
        F.max("length2").alias("longest2"), F.min("label").alias("least"), F.max("label").alias("greatest")), "about")
    anchors = stored(placed.filter("anchor").select(F.col("rid").alias("arid"), F.col("vec_id").alias("anchor_id"), "d", "label", "v", "length2"), "anchors")
    size = anchors.agg(F.count("*"), F.max("arid")).first()[0]
    last = about.agg(F.max("bucket")).first()[0]
    if not size:
        return rows.sparkSession.createDataFrame([], HARD)

    homes = placed.groupBy("d", "label").agg(F.min("bucket").alias("first_home"), F.max("bucket").alias("last_home"))
    wide = anchors.join(homes, ["d", "label"]).withColumns({
        "lows": F.array(F.lit(-MOST).cast("bigint")), "highs": F.array(F.lit(MOST).cast("bigint"))})
    seed = _search(wide.withColumn("bucket", F.col("last_home")), buckets, size, positives, True)
    asked = _raised(wide, stored(seed, "seed"), positives).withColumn("bucket", F.explode(F.sequence("first_home", "last_home")))
    near = stored(_search(asked, buckets, size, positives, True).select(
        "arid", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    def part(pct: int, up: bool) -> Column:
        """``pct`` hundredths of the score, rounded to the inside of the range, in whole numbers."""
        whole, rest = F.expr("positive_score div 100"), F.col("positive_score") % 100
        scaled = rest * (-pct if up else pct)
        floored = (scaled - F.pmod(scaled, F.lit(100))) / 100
        return whole * pct + (-floored if up else floored).cast("bigint")

    ranged = near.withColumns({"low": part(low_pct, True), "high": part(high_pct, False)}).filter("low <= high")
    wants = ranged.groupBy("arid").agg(F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("w"))
    ready = anchors.join(wants, "arid").select(
        "arid", "d", "label", "v", "length2", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"), F.col("w.place").alias("places"))
    # One bucket, drawn by hash, raises the limits before all others are asked.
    seeded = ready.withColumn("bucket", F.pmod(F.xxhash64("arid"), F.lit(last + 1)))
    seed = stored(_search(seeded, buckets, size, negatives, False), "seed")
    raised = _raised(ready, seed, negatives)
    every = raised.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint")))).join(about, ["bucket", "d"])
    reach = F.sqrt(F.col("length2") * F.col("longest2")) * (1 + _SLACK)
    asked = every.filter((reach >= F.array_min("lows")) & ((F.col("least") < F.col("label")) | (F.col("greatest") > F.col("label"))))
    found = _search(asked, buckets, size, negatives, False)
    named = found.join(ready.select("arid", "places"), "arid").withColumn("place", F.element_at("places", F.col("want") + 1))
    return named.join(near, ["arid", "place"]).join(anchors.select("arid", "anchor_id"), "arid").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


HARD = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """Rows of ``vectors(vec_id, embedding, label)`` as ``hard_negatives`` takes them: components in 256ths, noise in the labels."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.filter(finite(F.col("embedding"))).select(
        "vec_id", label.alias("label"), v.alias("v"), (F.col("vec_id") % 100 == 0).alias("anchor"))


def op12(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives(whole_numbers(table(spark, folder, "embeddings")))


SQL = """
WITH whole AS (
  SELECT row_number() OVER () AS rid, CAST(vec_id AS BIGINT) AS vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, b.rid, b.vec_id, a.label = b.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda x: x[1] * x[2])), 0) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.rid <> b.rid AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id, rid) AS place FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id, rid) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.arid, p.place ORDER BY n.score DESC, n.vec_id, n.rid) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.arid = p.arid AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.arid, p.place ORDER BY n.score DESC, n.vec_id, n.rid) <= 10
"""
