"""MinHash near-duplicates with odd sketches.

A document is the set of its five-word shingles.  Signatures of MinHash
samples are cut into bands for candidates, and folded into a parity bitmap, the
odd sketch, whose XOR population count estimates high similarities; only
candidates that pass the estimate are confirmed on the full sets.

Equal sets are one class, so copies cost one row.  Within a bucket every class
is first compared with one centre, drawn anew for each bucket, which joins most
groups at the cost of their size.  What then still lies in several components
of one bucket is compared across components, in blocks: a task gets the
sketches of two chunks, then the sets of those that may link, and hands on only
which components are tied.  So no link between two classes that share a bucket
is lost, and no pairs within a group are made as rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType

from .common import TEXTS, stored
from .components import components

WORDS = 5
BANDS, ROWS = 24, 5
SKETCH_BITS = 512
#: Classes of a bucket that one row of work compares at once, and their shingles; a larger set is a row of its own.
CHUNK, CHUNK_SHINGLES = 128, 2_000_000
#: Cells of a table of (class, shingle) up to which a block is counted as a matrix.
CELLS = 32_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX
    return (h ^ (h >> np.uint64(29))) * _ODD


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer than five words make one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(h))], np.uint64)
    out = np.zeros(len(h) - WORDS + 1, np.uint64)
    for i in range(WORDS):
        out = _mixed(out + h[i: len(h) - WORDS + 1 + i])
    return np.unique(out)


def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return rng.integers(1, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, np.uint64)


def samples(shingles: np.ndarray, n: int) -> np.ndarray:
    """MinHash values under n multiply-and-add functions, taken on the mixed upper half."""
    mult, add = _factors(n)
    out = np.empty(n, np.uint64)
    for i in range(n):
        out[i] = (shingles * mult[i] + add[i]).min()
    return out


def odd_sketch(values: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmap: every (position, sample) flips one bit."""
    at = _mixed(values + np.arange(len(values), dtype=np.uint64) * _ODD) % np.uint64(bits)
    parity = np.bincount(at.astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def sketch_limit(similarity: float, n: int, bits: int = SKETCH_BITS) -> int:
    """Largest XOR population count of a pair at ``similarity``, six standard deviations above its mean.

    A sample differs with probability 1 - J and then flips two bits; of d
    flips bits/2 * (1 - exp(-2d/bits)) stay odd.
    """
    differ = n * (1 - similarity) + 6 * math.sqrt(n * similarity * (1 - similarity))
    odd = bits / 2 * (1 - math.exp(-4 * differ / bits))
    return math.ceil(odd + 3 * math.sqrt(max(odd, 1) * 0.25))


def _signer(bands: int, rows: int):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, *row in zip(batch["text"], batch["doc_id"], batch["known"], batch["rk"], strict=True):
                s = shingle_set(text)
                if not len(s):
                    out.append((*row, 0, 0, 0, None, None))
                    continue
                digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                values = samples(s, bands * rows)
                keys = [xxhash.xxh3_64_intdigest(v.tobytes(), seed=b) for b, v in enumerate(values.reshape(bands, rows))]
                out.append((*row, len(s), digest[0], digest[1],
                            np.array(keys, np.uint64).view(np.int64), odd_sketch(values)))
            yield pd.DataFrame(out, columns=["doc_id", "known", "rk", "n_shingles", "h1", "h2", "keys", "sketch"])

    return sign


SIGNED = "doc_id bigint, known boolean, rk bigint, n_shingles bigint, h1 bigint, h2 bigint, keys array<bigint>, sketch array<bigint>"


def _differing(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda s, x: s + x)


@F.pandas_udf(LongType())
def _common(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([
        len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
        for x, y in zip(left, right, strict=True)], dtype="int64")


class Side(NamedTuple):
    """Classes of one chunk: sizes, roots, sketches, band keys."""

    n: np.ndarray
    root: np.ndarray
    sketch: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, n, root, sketch, keys) -> Side:
        return cls(np.asarray(n), np.asarray(root), np.asarray(sketch).reshape(len(n), -1), np.asarray(keys).reshape(len(n), -1))


def _may_link(a: Side, b: Side, key: int, similarity_pct: int, limit: int) -> np.ndarray:
    """Pairs of different components that sizes and sketches allow and whose first shared band is this one."""
    sizes = 100 * np.minimum(a.n[:, None], b.n[None, :]) >= similarity_pct * np.maximum(a.n[:, None], b.n[None, :])
    near = sizes & (a.root[:, None] != b.root[None, :])
    if not near.any():
        return near
    apart = np.zeros(near.shape, np.uint16)
    for w in range(a.sketch.shape[1]):
        apart += np.bitwise_count(a.sketch[:, w, None] ^ b.sketch[None, :, w])
    near &= apart <= limit
    band = int(np.flatnonzero(a.keys[0] == key)[0])
    for k in range(band):
        near &= a.keys[:, k, None] != b.keys[None, :, k]
    return near


def _intersections(left: list[np.ndarray], right: list[np.ndarray], near: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs in ``near``."""
    names, at = np.unique(np.concatenate(left + right), return_inverse=True)
    if len(names) * (len(left) + len(right)) <= CELLS:
        table = np.zeros((len(left) + len(right), len(names)), np.float32)
        table[np.repeat(np.arange(len(table)), [len(x) for x in left + right]), at] = 1
        return (table[: len(left)] @ table[len(left):].T).astype(np.int64)
    out = np.zeros(near.shape, np.int64)
    for i, j in zip(*np.nonzero(near), strict=True):
        out[i, j] = len(np.intersect1d(left[i], right[j], assume_unique=True))
    return out


def _tied(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest root tied to each row and column of a block of links."""
    top = np.iinfo(np.int64).max
    while True:
        new_right = np.minimum(right, np.where(hit, left[:, None], top).min(axis=0))
        new_left = np.minimum(left, np.where(hit, new_right[None, :], top).min(axis=1))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"cid": batch["cid"], "shingles": [shingle_set(t).tobytes() for t in batch["text"]]})


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs(doc_id, text)``.

    Options: ``similarity_pct`` (85), ``bands`` and ``rows`` of the signature.
    Documents are linked when 100 * intersection >= similarity_pct * union of
    their shingle sets.  The number of bands finds a pair at 0.85 with
    probability 1 - 8e-7.  Other columns of ``docs`` are ignored.  Null or
    blank texts have no shingle, link with nothing and stay; equal sets always
    link; the smallest ``doc_id`` of a component is kept, and of repeated rows
    with that id every one; rows without id are kept unless linked with one that has an id.
    """
    return _judged(docs, **options).select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, similarity_pct: int = 85, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The result with ``rk``, a hash of id and text that finds a row again."""
    raw = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rk"))
    # A null among integers would make pandas turn them into floats.
    flagged = raw.select(
        F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), "text", "rk")
    some = F.col("n_shingles") > 0
    signed = stored(flagged.mapInPandas(_signer(bands, rows), SIGNED).select(
        F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "rk", "n_shingles", F.when(some, F.col("h1")).alias("h1"),
        F.when(some, F.col("h2")).alias("h2"), "keys", "sketch"), "signed", TEXTS)
    classes = stored(
        signed.filter("n_shingles > 0").groupBy("h1", "h2").agg(
            F.min("doc_id").alias("least"), F.min("rk").alias("rk"), F.min("n_shingles").alias("n"),
            F.first("keys").alias("keys"), F.first("sketch").alias("sketch")
        ).withColumn("cid", F.monotonically_increasing_id()), "classes")

    n_samples = bands * rows
    limit = sketch_limit(similarity_pct / 100, n_samples)
    placed = classes.select("cid", "n", F.explode(F.slice("keys", 1, bands)).alias("key"))

    def beside_hub(pairs: DataFrame, held: DataFrame, column: str) -> DataFrame:
        """``pairs(hub, cid, part)`` with ``column`` of both; that of a hub goes to each of its parts, so none is a hot key."""
        hubs = pairs.select("hub", "part").distinct().join(held.select(F.col("cid").alias("hub"), F.col(column).alias("left")), "hub")
        return pairs.join(held.select("cid", F.col(column).alias("right")), "cid").join(hubs, ["hub", "part"])

    def sizes_fit(n: str, m: str) -> Column:
        return 100 * F.least(n, m) >= similarity_pct * F.greatest(n, m)

    def shingles_of(ids: DataFrame) -> DataFrame:
        """Full sets, made anew from the texts, for these classes only."""
        wanted = stored(classes.select("cid", "rk").join(ids, "cid", "left_semi"), "wanted")
        # The same plan at every size: the texts go to the candidates by shuffle.
        met = raw.select("rk", "text").join(wanted.hint("merge"), "rk").dropDuplicates(["cid"]).select("cid", "text")
        return stored(met.mapInPandas(_sets, "cid bigint, shingles binary"), "sets", 1000)

    # Every class against the centre of each of its buckets.
    buckets = placed.groupBy("key").agg(
        F.count("*").alias("size"), F.sum("n").alias("shingles"), F.min(F.struct(F.xxhash64("cid", "key").alias("h"), "cid", "n")).alias("hub")
    ).filter("size > 1").select("key", F.col("hub.cid").alias("hub"), F.col("hub.n").alias("hub_n"), F.greatest(
        F.ceil(F.col("size") / CHUNK), F.ceil(F.col("shingles") / CHUNK_SHINGLES)).alias("parts"))
    stars = placed.join(buckets, "key").filter((F.col("cid") != F.col("hub")) & sizes_fit("n", "hub_n")).groupBy("hub", "cid").agg(
        F.max(F.pmod(F.xxhash64("cid"), "parts")).alias("part"))
    near = stored(beside_hub(stars, classes, "sketch").filter(_differing(F.col("left"), F.col("right")) <= limit).select("hub", "cid", "part"), "stars")
    sets = shingles_of(near.select(F.explode(F.array("hub", "cid")).alias("cid")).distinct())
    counted = beside_hub(near, sets, "shingles").select(
        F.col("hub").alias("a"), F.col("cid").alias("b"), (F.octet_length("left") / 8).cast("bigint").alias("n"),
        (F.octet_length("right") / 8).cast("bigint").alias("m"), _common("left", "right").alias("c"))
    links = stored(counted.filter(
        100 * F.col("c") >= similarity_pct * (F.col("n") + F.col("m") - F.col("c"))).select("a", "b"), "links", 500)
    roots = components(links)

    # What several components of one bucket still hold, across components.
    rooted = stored(classes.join(roots, classes["cid"] == roots["node"], "left").select(
        "cid", "n", "keys", "sketch", F.coalesce("root", "cid").alias("root")), "rooted")
    spread = rooted.select("cid", "root", "n", F.explode("keys").alias("key"))
    several = spread.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    left = stored(spread.join(several, "key"), "left")
    # A component that is large in a bucket has chunks of its own, which aren't compared with each other.
    per_root = left.groupBy("key", "root").agg(F.count("*").alias("size"), F.sum("n").alias("shingles")).withColumn(
        "own", F.when(F.col("size") >= CHUNK, F.col("root")).otherwise(-1))
    chunks = per_root.groupBy("key", "own").agg(F.greatest(
        F.ceil(F.sum("size") / CHUNK), F.ceil(F.sum("shingles") / CHUNK_SHINGLES)).alias("chunks"))
    labels = per_root.select("key", "root", "own").join(chunks, ["key", "own"])
    parts = ("cid", "n", "root", "sketch", "keys")
    held = left.join(labels, ["key", "root"]).select("key", "cid", "own", F.pmod(F.xxhash64("cid", "key"), "chunks").alias("c")).join(
        rooted, "cid").groupBy("key", "own", "c").agg(F.sort_array(F.collect_list(F.struct(*parts))).alias("h")).select(
        "key", "own", "c", *[F.col(f"h.{c}") for c in parts[:3]], *[F.flatten(f"h.{c}").alias(c) for c in parts[3:]])
    held = stored(held, "held")
    # Which chunks meet is told by their numbers; their rows then go to one pair of chunks each.
    named = held.select("key", "own", "c", F.size("cid").alias("held"))
    met = named.join(named.select("key", F.col("own").alias("own_j"), F.col("c").alias("c_j")), "key").filter(
        "own > own_j OR (own = -1 AND own_j = -1 AND (c > c_j OR (c = c_j AND held > 1)))").drop("held")
    other = held.select("key", *[F.col(c).alias(f"{c}_j") for c in ("own", "c", *parts)])
    work = met.join(held, ["key", "own", "c"]).join(other, ["key", "own_j", "c_j"])

    def candidates(batches):
        for batch in batches:
            for r in batch.itertuples():
                same = r.own == r.own_j and r.c == r.c_j
                a = Side.of(r.n, r.root, r.sketch, r.keys)
                hit = _may_link(a, a if same else Side.of(r.n_j, r.root_j, r.sketch_j, r.keys_j), r.key, similarity_pct, limit)
                if hit.any():
                    ids = [np.asarray(r.cid)[hit.any(axis=1)], np.asarray(r.cid_j)[hit.any(axis=0)][: 0 if same else None]]
                    yield pd.DataFrame({
                        "key": r.key, "own": r.own, "c": r.c, "own_j": r.own_j, "c_j": r.c_j,
                        "side": np.repeat([0, 1], [len(x) for x in ids]), "cid": np.concatenate(ids)})

    block = ("key", "own", "c", "own_j", "c_j")
    asked = stored(work.mapInPandas(
        candidates, "key bigint, own bigint, c bigint, own_j bigint, c_j bigint, side int, cid bigint"), "asked", 64)
    missing = stored(asked.select("cid").distinct().join(sets.select("cid"), "cid", "left_anti"), "missing")
    every = sets if missing.isEmpty() else sets.unionByName(shingles_of(missing))
    member = F.struct("side", *parts, "shingles")
    blocks = asked.join(rooted, "cid").join(every, "cid").groupBy(*block).agg(
        F.sort_array(F.collect_list(member)).alias("h")).select(
        *block, *[F.col(f"h.{c}") for c in ("side", "n", "root", "shingles")], *[F.flatten(f"h.{c}").alias(c) for c in ("sketch", "keys")])

    def ties(batches):
        for batch in batches:
            for r in batch.itertuples():
                side, whole = np.asarray(r.side), Side.of(r.n, r.root, r.sketch, r.keys)
                same = r.own == r.own_j and r.c == r.c_j
                at = [np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))]
                a, b = (Side(*[x[i] for x in whole]) for i in at)
                near = _may_link(a, b, r.key, similarity_pct, limit)
                sets_a, sets_b = ([np.frombuffer(r.shingles[i], np.uint64) for i in ids] for ids in at)
                common = _intersections(sets_a, sets_b, near)
                hit = near & (100 * common >= similarity_pct * (a.n[:, None] + b.n[None, :] - common))
                if hit.any():
                    tied = _tied(hit, a.root, b.root)
                    yield pd.DataFrame({"a": np.concatenate([a.root, b.root]), "b": np.concatenate(tied)})

    more = stored(blocks.mapInPandas(ties, "a bigint, b bigint").filter("a <> b").distinct(), "ties", 16)
    if not more.isEmpty():
        tied = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(tied.union(more))

    # The smallest document of each component, then of each row.
    grouped = roots.select("node", "root").union(roots.select("root", "root").distinct())
    least = grouped.join(classes.select("cid", "least"), F.col("node") == F.col("cid")).groupBy("root").agg(
        F.min("least").alias("component_id"))
    of_class = grouped.join(least, "root").select("node", "component_id")
    known = classes.join(of_class, classes["cid"] == of_class["node"], "left").select(
        "h1", "h2", F.coalesce("component_id", "least").alias("component_id"))
    out = signed.select("doc_id", "rk", "n_shingles", "h1", "h2").join(known, ["h1", "h2"], "left").select(
        "doc_id", "rk", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, all columns kept.

    Repeated rows of a kept document (same id) give one row; rows without id
    that link with no other id all stay, and so do null and empty texts; an
    empty table gives no row.  Options: those of ``near_duplicates``.
    """
    judged = stored(_judged(docs, **options).select("doc_id", "rk", "kept"), "judged")
    # All columns of a row in one, so that none of them clashes with those used here.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("doc_id", "text").alias("rk"), F.col("doc_id").alias("id"))
    stay = rows.join(judged.filter("NOT kept").select("rk").distinct(), "rk", "left_anti")
    again = judged.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    again = stored(again.select(F.col("doc_id").alias("id")), "again")
    if again.isEmpty():
        return stay.select("row.*")
    once = stay.join(again, "id", "left_semi").dropDuplicates(["id"])
    return stay.join(again, "id", "left_anti").select("row.*").unionByName(once.select("row.*"))


def op4(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
