"""Near-duplicate vectors by iterative quantisation.

A rotation is learned on a bounded sample so that the signs of the rotated
vectors are balanced bits that lose little.  The bits are cut into keys of a
multi-index Hamming table; vectors that share a key are ranked by the cosine of
the original vectors, in double precision.

A bucket holds ids and codes only and is compared in blocks; a pair that shares
several keys counts at the first of them.  Vectors are fetched for those that
have a partner within the Hamming radius, and a task hands on sums and the
smallest vector tied to each, never the pairs.  Equal vectors are one class.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import stored
from .components import components

#: Vectors that the rotations are fitted on.
SAMPLE = 10_000
#: Mean size of a bucket, which sets the bits of a key from the number of vectors.
BUCKET = 64
#: Chance that a pair exactly at the limit shares no key, which sets the number of keys.
MISS = 1e-6
#: Learned rotations; further ones are drawn, as few vectors teach the same one again.
LEARNED = 64
#: Rotations after which a fit that still misses more gives up with an error.
MOST_ROTATIONS = 4096
STEPS = 30
#: Vectors of a bucket that one row of work compares at once.
CHUNK = 256


def rotation(sample: np.ndarray, seed: int, steps: int = STEPS) -> np.ndarray:
    """Orthogonal matrix (components x bits) that brings centred ``sample`` near the corners of a cube."""
    d = sample.shape[1]
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    if len(sample) < 2:
        return turn
    axes = np.linalg.svd(sample[:4 * d] if len(sample) < 4 * d else np.cov(sample, rowvar=False), full_matrices=True)[2].T
    v = sample @ axes
    for _ in range(steps):
        b = np.where(v @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(b.T @ v)
        turn = (left @ right).T
    return axes @ turn


class Coder:
    """Rotations, centre and cuts of the keys, for vectors of one length."""

    def __init__(self, sample: np.ndarray, n: int, limit: float, d: int) -> None:
        self.bits = max(4, min(48, math.ceil(math.log2(max(n, 2) / BUCKET))))
        rng = np.random.default_rng(7)
        base = _unit(sample) if len(sample) else _unit(rng.standard_normal((256, d)))
        self.centre = base.mean(axis=0) if len(sample) else np.zeros(d)
        centred, base = base - self.centre, base[:2000]
        # Partners exactly at the limit: how often do they share a key, and how far are their codes apart?
        side = rng.standard_normal(base.shape)
        side -= (side * base).sum(axis=1, keepdims=True) * base
        norm = np.linalg.norm(side, axis=1, keepdims=True)
        partner = limit * base + math.sqrt(1 - limit * limit) * side / np.where(norm > 0, norm, 1)
        self.matrices: list[np.ndarray] = []
        while True:
            if len(self.matrices) >= MOST_ROTATIONS:
                raise ValueError(f"{MOST_ROTATIONS} rotations of {d} components still miss pairs at {limit}")
            self.matrices.append(rotation(centred, len(self.matrices), STEPS if len(self.matrices) < LEARNED else 0))
            differ = self.signs(base) != self.signs(partner)
            shared = ~self.cut(differ).any(axis=2)
            if shared.any(axis=1).all() and np.prod(1 - shared.mean(axis=0)) <= MISS:
                break
        apart = differ.sum(axis=1)
        self.radius = math.ceil(apart.mean() + 6 * apart.std() + 1)

    def signs(self, unit: np.ndarray) -> np.ndarray:
        return np.concatenate([(unit - self.centre) @ m >= 0 for m in self.matrices], axis=1)

    def cut(self, bits: np.ndarray) -> np.ndarray:
        """Bits as (row, key, bit); what is left over at the end is in no key."""
        width = min(self.bits, bits.shape[1])
        n = bits.shape[1] // width
        return bits[:, : n * width].reshape(len(bits), n, width)

    def codes(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whole codes as words, and keys."""
        signs = self.signs(unit)
        cut = self.cut(signs)
        keys = cut.astype(np.int64) @ (np.int64(1) << np.arange(cut.shape[2], dtype=np.int64))
        return np.packbits(np.pad(signs, ((0, 0), (0, -signs.shape[1] % 64))), axis=1).view(np.int64), keys

    def near(self, left: np.ndarray, right: np.ndarray, key_no: int) -> np.ndarray:
        """Pairs of codes within the radius whose first shared key is ``key_no``."""
        n = sum(m.shape[1] for m in self.matrices)
        apart = np.zeros((len(left), len(right)), np.uint16)
        for w in range(left.shape[1]):
            apart += np.bitwise_count(left[:, w, None] ^ right[None, :, w])
        near = apart <= self.radius
        if key_no and near.any():
            bits = [np.unpackbits(x.copy().view(np.uint8), axis=1, count=n) for x in (left, right)]
            width = min(self.bits, n)
            for k in range(key_no):
                one, other = (np.packbits(b[:, k * width: (k + 1) * width], axis=1) for b in bits)
                same = np.ones_like(near)
                for i in range(one.shape[1]):
                    same &= one[:, i, None] == other[None, :, i]
                near &= ~same
        return near


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(classes: DataFrame, limit: float, sample: int = SAMPLE) -> dict[int, Coder]:
    """A coder per length of vector, from at most about ``sample`` vectors chosen by hash.

    Vectors of a length without one in the sample get random rotations.
    """
    sizes = {r["d"]: r["n"] for r in classes.groupBy("d").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("h1", "h2"), F.lit(1 << 30)) / float(1 << 30)
    rows = classes.filter(place < sample / max(sum(sizes.values()), 1)).limit(2 * sample).select("d", "v").collect()
    return {d: Coder(np.array([r["v"] for r in rows if r["d"] == d], np.float64).reshape(-1, d), size, limit, d)
            for d, size in sizes.items()}


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _roots(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id tied to each row and column of a block of links."""
    top = np.iinfo(np.int64).max
    while True:
        new_right = np.minimum(right, np.where(hit, left[:, None], top).min(axis=0))
        new_left = np.minimum(left, np.where(hit, new_right[None, :], top).min(axis=1))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def near_vectors(vectors: DataFrame, limit: float = 0.95, sample: int = SAMPLE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors(vec_id, embedding)``.

    Rows with a cosine of ``limit`` or more are linked; the keys miss a pair
    just at the limit with a chance of about ``MISS``, closer pairs less.
    Null, empty and zero vectors and such with a null or non-finite component
    link with nothing; vectors of different length never link; repeated rows
    are rows of their own that link; null ids count as links but name no
    component.  Other columns are ignored.
    """
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", F.when(_usable(v), F.col("embedding")).alias("v")).withColumns({
        "h1": F.when(F.col("v").isNotNull(), F.xxhash64("v")), "h2": F.when(F.col("v").isNotNull(), F.xxhash64("v", F.lit(1)))})
    classes = stored(
        rows.filter("v IS NOT NULL").groupBy("h1", "h2").agg(
            F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("v").alias("v")
        ).withColumn("cid", F.monotonically_increasing_id()).withColumn("d", F.size("v")), "classes")
    coders = vectors.sparkSession.sparkContext.broadcast(fit(classes, limit, sample))

    def coded(batches):
        for batch in batches:
            for d, part in batch.groupby("d"):
                codes, keys = coders.value[int(d)].codes(_unit(np.stack(part["v"]).astype(np.float64)))
                yield pd.DataFrame({"cid": part["cid"].to_numpy(), "d": d, "code": list(codes), "key": list(keys)})

    codes = stored(classes.select("cid", "d", "v").mapInPandas(
        coded, "cid bigint, d int, code array<bigint>, key array<bigint>"), "codes")
    bucket = ["d", "key_no", "key"]
    entries = codes.select("cid", "d", "code", F.posexplode("key").alias("key_no", "key"))
    # A large bucket is dealt in chunks by hash; every pair of its chunks is one row of work.
    large = stored(entries.groupBy(*bucket).agg(F.count("*").alias("size")).filter(F.col("size") > CHUNK).select(
        *bucket, F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")), "large")
    chunk = F.coalesce(F.pmod(F.xxhash64("cid"), F.col("chunks").cast("bigint")), F.lit(0)).cast("int")
    dealt = entries.join(large, bucket, "left").withColumn("chunk", chunk).groupBy(*bucket, "chunks", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("cid", "code"))).alias("held")).select(
        *bucket, "chunks", "chunk", F.col("held.cid").alias("cids"), F.flatten("held.code").alias("codes"))
    dealt = stored(dealt.filter("chunks IS NOT NULL OR size(cids) > 1"), "dealt")
    none = F.lit(None).cast("array<bigint>")
    alone = dealt.select(*bucket, F.col("chunk").alias("i"), F.col("chunk").alias("j"), "cids", "codes",
                         none.alias("cids_j"), none.alias("codes_j"))
    many = dealt.filter("chunks IS NOT NULL")
    first = many.filter("chunk > 0").select(
        *bucket, F.col("chunk").alias("i"), "cids", "codes", F.explode(F.sequence(F.lit(0), F.col("chunk") - 1)).alias("j"))
    second = many.select(*bucket, F.col("chunk").alias("j"), F.col("cids").alias("cids_j"), F.col("codes").alias("codes_j"))
    work = alone.unionByName(first.join(second, [*bucket, "j"]).select(alone.columns))

    def found(batches):
        """Ids with a partner within the radius, by block and side."""
        for batch in batches:
            for r in batch.itertuples():
                coder = coders.value[r.d]
                left, a = np.asarray(r.cids), np.asarray(r.codes).reshape(len(r.cids), -1)
                same = r.i == r.j
                right, b = (left, a) if same else (np.asarray(r.cids_j), np.asarray(r.codes_j).reshape(len(r.cids_j), -1))
                near = coder.near(a, b, r.key_no)
                if same:
                    np.fill_diagonal(near, False)
                if near.any():
                    ids = [left[near.any(axis=1)], right[near.any(axis=0)][: 0 if same else None]]
                    both = np.concatenate(ids)
                    yield pd.DataFrame({
                        "d": r.d, "key_no": r.key_no, "key": r.key, "i": r.i, "j": r.j,
                        "side": np.repeat([0, 1], [len(x) for x in ids]), "cid": both})

    block = [*bucket, "i", "j"]
    wanted = stored(work.mapInPandas(found, "d int, key_no int, key bigint, i int, j int, side int, cid bigint"), "wanted", 256)
    held = F.struct("side", "cid", "copies", "code", F.col("v").cast("array<double>").alias("v"))
    blocks = wanted.join(classes.select("cid", "copies", "v"), "cid").join(codes.select("cid", "code"), "cid").groupBy(*block).agg(
        F.sort_array(F.collect_list(held)).alias("h")).select(
        *block, *[F.col(f"h.{c}") for c in ("side", "cid", "copies")], *[F.flatten(f"h.{c}").alias(c) for c in ("code", "v")])

    def ranked(batches):
        """Links by the original vectors: summed, and the smallest id tied to each."""
        for batch in batches:
            for r in batch.itertuples():
                side, n = np.asarray(r.side), len(r.side)
                code, unit = np.asarray(r.code).reshape(n, -1), _unit(np.asarray(r.v).reshape(n, -1))
                same = r.i == r.j
                a, b = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))
                hit = coders.value[r.d].near(code[a], code[b], r.key_no) & (unit[a] @ unit[b].T >= limit)
                if same:
                    np.fill_diagonal(hit, False)
                if not hit.any():
                    continue
                cid, copies = np.asarray(r.cid), np.asarray(r.copies)
                roots = _roots(hit, cid[a], cid[b])
                sides = [(a, hit @ copies[b], roots[0]), *([] if same else [(b, hit.T @ copies[a], roots[1])])]
                for at, links, root in sides:
                    some = links > 0
                    yield pd.DataFrame({"cid": cid[at][some], "n": links[some], "root": root[some]})

    hits = stored(blocks.mapInPandas(ranked, "cid bigint, n bigint, root bigint"), "hits", 64)

    sums = hits.groupBy("cid").agg(F.sum("n").alias("n"))
    roots = components(hits.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    grouped = roots.union(roots.select("root", "root").distinct())
    least = grouped.join(classes.select("cid", "least"), F.col("node") == F.col("cid")).groupBy("root").agg(
        F.min("least").alias("component_id"))
    of_class = grouped.join(least, "root").select(F.col("node").alias("cid"), "component_id")
    known = classes.select("cid", "h1", "h2", "copies", "least").join(sums, "cid", "left").join(of_class, "cid", "left").select(
        "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"))
    out = rows.select("vec_id", "h1", "h2").join(known, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))


def op7(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


SQL = """
WITH RECURSIVE clean AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL
      OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0 THEN CAST(embedding AS DOUBLE[]) END AS v
  FROM embeddings),
links AS (
  SELECT a.row AS a, b.row AS b, b.vec_id FROM clean a JOIN clean b ON a.row <> b.row AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach(row, other) AS (
  SELECT row, row FROM clean
  UNION SELECT reach.row, links.b FROM reach JOIN links ON links.a = reach.other),
least AS (SELECT r.row, min(c.vec_id) AS component_id FROM reach r JOIN clean c ON c.row = r.other GROUP BY r.row)
SELECT c.vec_id, (SELECT count(*) FROM links l WHERE l.a = c.row) AS n_links, component_id, c.vec_id = component_id AS kept
FROM clean c JOIN least USING (row)
"""
