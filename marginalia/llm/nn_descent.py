"""Approximate nearest neighbours by inner product: a neighbour graph by NN-descent, queries by greedy search of it.

Equal vectors are one node.  Vectors of one length whose norms lie within a
factor of two form a space; in it a vector is lifted by one component to the
unit sphere, which makes the largest inner product the smallest angle.  The
graph starts from random blocks (rows that share the signs of a few random
projections) and is improved in rounds: around every node its neighbours, in
both directions, are joined with their codes and compared with each other, and
each keeps the nearest it has met.  A round is a row of Spark joins over edges;
nodes come in tiles of consecutive numbers, so that one code is sent to a tile
once, however many of its nodes ask for it.

A query starts at its own node, where it has one, and at the nearest of a few
pivots.  In each step the nearest nodes it has not opened yet are sent to the
tiles that hold their neighbours, which answer with what is nearer than the
worst of its beam.  The last beam is ranked by the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..operators.numbering import running_number
from .common import release, stored, table
from .vectors import inner_product, norm, usable

#: Neighbours of a node in the graph, and how many nearest nodes that name it as theirs a search also follows.
NEIGHBOURS, BACKWARD = 32, 64
#: Random blockings of the start, mean rows of a block, and nearest rows that each hands on.
TREES, LEAF, PER_TREE = 12, 512, 8
#: Rounds end with this share of new edges, or after this many.
SETTLED, ROUNDS = 0.1, 2
#: Nodes of a tile; edges into one node, and opened nodes of one tile, that a group of work holds.
TILE, HUB, LOAD = 1 << 13, 1024, 1 << 15
#: Nodes of a beam, nodes opened in a step, pivots of a space, and those a query starts from.
BEAM, STEP, PIVOTS, ENTRIES = 200, 128, 256, 4
#: Vectors that the medians of the projections are fitted on.
SAMPLE = 10_000
_SPACE = 40
#: Below every inner product of unit vectors.
_LOW = -2.0

NEIGHBOUR_ROWS = "query_id bigint, rank int, vec_id bigint, score double"


class Space:
    """Vectors of one length and a range of norms, lifted to the unit sphere; cuts of the random blocks."""

    def __init__(self, d: int, top: float, n: int, sample: np.ndarray) -> None:
        self.d, self.top = d, top
        bits = 0 if n <= LEAF else min(40, math.ceil(math.log2(n / LEAF)))
        rng = np.random.default_rng(d)
        draw = [rng.standard_normal((d + 1, max(d + 1, bits))) for _ in range(TREES)]
        self.turns = [np.linalg.qr(x)[0][:, :bits] if bits <= d + 1 else x[:, :bits] for x in draw]
        lifted = self.lifted(sample) if len(sample) else np.zeros((1, d + 1))
        self.cuts = [np.median(lifted @ turn, axis=0) for turn in self.turns]

    def lifted(self, v: np.ndarray) -> np.ndarray:
        x = v / self.top
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))
        return np.concatenate([x, rest[:, None]], axis=1)

    def keys(self, lifted: np.ndarray) -> np.ndarray:
        """One block number per tree."""
        return np.stack([
            (lifted @ turn > cut) @ (np.int64(1) << np.arange(turn.shape[1], dtype=np.int64))
            for turn, cut in zip(self.turns, self.cuts, strict=True)], axis=1).astype(np.int64)


def coded(unit: np.ndarray) -> list[bytes]:
    """Unit vectors as bytes: the largest component as a float, then each component on a scale of it."""
    scale = np.abs(unit).max(axis=1).astype("<f4")
    steps = np.rint(unit / scale[:, None] * 127).astype(np.int8)
    return [s.tobytes() + row.tobytes() for s, row in zip(scale, steps, strict=True)]


def decoded(codes: list[bytes] | bytes, n: int | None = None) -> np.ndarray:
    """The vectors of codes of one length, as a list or as ``n`` of them in a row."""
    joined = b"".join(codes) if n is None else codes
    raw = np.frombuffer(joined, np.int8).reshape(len(codes) if n is None else n, -1)
    return raw[:, 4:].astype(np.float32) * (raw[:, :4].copy().view("<f4") / np.float32(127))


def _query_codes(v: np.ndarray) -> list[bytes]:
    unit = v / np.abs(v).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    return coded(np.concatenate([unit, np.zeros((len(v), 1))], axis=1))


def _nearest(of: np.ndarray, other: np.ndarray, sim: np.ndarray, most: int, name: str = "a") -> pa.Table:
    """Per value of ``of`` one row with the ``most`` nearest others, nearest first."""
    order = np.lexsort((other, -sim, of))
    of = of[order]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
    place = np.arange(len(of)) - np.repeat(first, np.diff(np.r_[first, len(of)]))
    kept = order[place < most]
    starts = pa.array(np.r_[0, np.cumsum(np.minimum(np.diff(np.r_[first, len(of)]), most))].astype(np.int32))
    return pa.table({
        name: pa.array(of[first], pa.int64()), "b": pa.ListArray.from_arrays(starts, pa.array(other[kept], pa.int64())),
        "sim": pa.ListArray.from_arrays(starts, pa.array(sim[kept], pa.float32()))})


def _none(name: str = "a") -> pa.Table:
    return _nearest(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32), 0, name)


LISTS = "a bigint, b array<bigint>, sim array<float>"


def _leaf(group: pa.Table) -> pa.Table:
    """The nearest rows of each row of a block; all of them where a space has no other block."""
    ids, x = group["cid"].to_numpy(), decoded(group["code"].to_pylist())
    most = min(NEIGHBOURS if len(ids) <= LEAF else PER_TREE, len(ids) - 1)
    if most < 1:
        return _none()
    sim = x @ x.T
    np.fill_diagonal(sim, _LOW)
    at = np.argpartition(-sim, most - 1, axis=1)[:, :most]
    return _nearest(np.repeat(ids, most), ids[at].ravel(), np.take_along_axis(sim, at, 1).ravel(), most)


def _met(edges: pa.Table, nodes: pa.Table) -> pa.Table:
    """What the neighbours of the centres of one tile find in each other.

    ``edges(centre, v, new)``, ``nodes(v, code, least)``: pairs of which one is
    a new neighbour and that beat the worst neighbour of one side.
    """
    if not len(edges):
        return _none()
    ids, where = np.unique(nodes["v"].to_numpy(), return_index=True)
    x, least = decoded(nodes["code"].to_pylist())[where], nodes["least"].to_numpy()[where]
    order = np.argsort(edges["centre"].to_numpy(), kind="stable")
    at, new = np.searchsorted(ids, edges["v"].to_numpy()[order]), edges["new"].to_numpy()[order]
    centre = edges["centre"].to_numpy()[order]
    first = np.flatnonzero(np.r_[True, centre[1:] != centre[:-1]])
    sizes = np.diff(np.r_[first, len(centre)])
    units = np.argsort(sizes, kind="stable")
    found, sims, done = [], [], 0
    while done < len(units):
        # The units come by size, so a run of them is a block with little padding.
        largest = int(sizes[units[min(done + 255, len(units) - 1)]])
        some = units[done: done + min(256, max(1, 2_000_000 // largest ** 2))]
        done += len(some)
        width = int(sizes[some].max())
        real = np.arange(width) < sizes[some][:, None]
        place = np.where(real, first[some][:, None] + np.arange(width), 0)
        idx, fresh = at[place], new[place] & real
        sim = x[idx] @ x[idx].transpose(0, 2, 1)
        good = real[:, :, None] & real[:, None, :] & (idx[:, :, None] != idx[:, None, :])
        good &= (fresh[:, :, None] | fresh[:, None, :]) & (sim > least[idx][:, :, None])
        u, i, j = np.nonzero(good)
        pair, kept = np.unique(idx[u, i].astype(np.int64) * len(ids) + idx[u, j], return_index=True)
        found.append(pair)
        sims.append(sim[u, i, j][kept])
    pair, kept = np.unique(np.concatenate(found), return_index=True)
    return _nearest(ids[pair // len(ids)], ids[pair % len(ids)], np.concatenate(sims)[kept], NEIGHBOURS)


TILES = "tile bigint, centres binary, starts binary, neighbours binary, ids binary, codes binary"


def _packed(edges: pa.Table, nodes: pa.Table) -> pa.Table:
    """One tile of the index: its nodes, where their neighbours begin, the neighbours, and the codes of those."""
    schema = pa.schema([(n.split()[0], pa.int64() if n.endswith("bigint") else pa.binary()) for n in TILES.split(", ")])
    if not len(edges):
        return schema.empty_table()
    ids, where = np.unique(nodes["v"].to_numpy(), return_index=True)
    codes = nodes["code"].to_pylist()
    centre, v = edges["centre"].to_numpy(), edges["v"].to_numpy()
    order = np.lexsort((v, centre))
    centre, v = centre[order], v[order]
    first = np.flatnonzero(np.r_[True, centre[1:] != centre[:-1]])
    return pa.table([
        [edges["tile"][0].as_py()], [centre[first].tobytes()], [np.r_[first, len(centre)].astype(np.int64).tobytes()],
        [np.searchsorted(ids, v).astype(np.int32).tobytes()], [ids.tobytes()], [b"".join([codes[i] for i in where])]], schema=schema)


def _opened(asked: pa.Table, tiles: pa.Table) -> pa.Table:
    """Neighbours of the opened nodes of one tile that beat the worst of a query's beam."""
    if not len(asked) or not len(tiles):
        return _none("q")
    tile = {name: tiles[name][0].as_py() for name in ("centres", "starts", "neighbours", "ids", "codes")}
    centres, starts = np.frombuffer(tile["centres"], np.int64), np.frombuffer(tile["starts"], np.int64)
    names, ids = np.frombuffer(tile["neighbours"], np.int32), np.frombuffer(tile["ids"], np.int64)
    x = decoded(tile["codes"], len(ids))
    who, first, asker = np.unique(asked["q"].to_numpy(), return_index=True, return_inverse=True)
    y = decoded(asked["code"].take(first).to_pylist())
    least, node = asked["least"].to_numpy()[first], asked["node"].to_numpy()
    at = np.minimum(np.searchsorted(centres, node), len(centres) - 1)
    held = np.where(centres[at] == node, starts[at + 1] - starts[at], 0)
    place = np.repeat(starts[at] - np.cumsum(held) + held, held) + np.arange(held.sum())
    seen = np.zeros((min(len(who), max(1, (1 << 26) // len(ids))), len(ids)), bool)
    parts = []
    pairs = np.repeat(asker, held), names[place]
    order = np.argsort(pairs[0], kind="stable")
    a, b = pairs[0][order], pairs[1][order]
    for lo in range(0, len(who), len(seen)):
        some = slice(*np.searchsorted(a, (lo, lo + len(seen))))
        seen[:] = False
        seen[a[some] - lo, b[some]] = True
        p, q = np.nonzero(seen)
        sim = np.empty(len(p), np.float32)
        for i in range(0, len(p), 1 << 18):
            part = slice(i, i + (1 << 18))
            sim[part] = np.einsum("ij,ij->i", y[p[part] + lo], x[q[part]])
        good = sim > least[p + lo]
        parts.append((who[p[good] + lo], ids[q[good]], sim[good]))
    return _nearest(*[np.concatenate(c) for c in zip(*parts, strict=True)], BEAM, "q")


def _merged(old: DataFrame, lists: DataFrame, most: int) -> DataFrame:
    """Edges with the lists added: the nearest of each node, known ones no longer new."""
    more = lists.repartition("a").select("a", F.explode(F.arrays_zip("b", "sim")).alias("e"))
    edges = more.select("a", F.col("e.b").alias("b"), F.col("e.sim").alias("sim"), F.lit(True).alias("new"))
    if old is not None:
        edges = edges.unionByName(old.withColumn("new", F.lit(False)).repartition("a"))
    best = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    rank = F.row_number().over(W.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= most).drop("rank")


def _worst(edges: DataFrame) -> DataFrame:
    full = F.count("*") >= NEIGHBOURS
    return edges.groupBy("a").agg(F.when(full, F.min("sim")).otherwise(_LOW).cast("float").alias("least"))


def _tiled(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges in both directions by tile of their centre, and the codes each tile needs.

    The edges into one node may be many; such a node gets groups of its own,
    and each of them all that it points to.
    """
    hubs = edges.groupBy("b").agg(F.count("*").alias("n")).filter(F.col("n") > HUB).select(
        F.col("b").alias("centre"), F.ceil(F.col("n") / HUB).cast("int").alias("parts"))
    tile = F.shiftright("centre", int(math.log2(TILE)))
    ahead = edges.select(F.col("a").alias("centre"), F.col("b").alias("v"), "new").join(hubs, "centre", "left").withColumn(
        "part", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))))
    behind = edges.select(F.col("b").alias("centre"), F.col("a").alias("v"), "new").join(hubs, "centre", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"), F.lit(-1)))
    place = F.when(F.col("parts").isNull(), tile).otherwise(F.col("centre"))
    both = ahead.unionByName(behind).select(place.alias("tile"), "part", "centre", "v", "new")
    asked = both.select("tile", "part", "v").distinct()
    return both, asked.join(nodes, asked["v"] == nodes["a"]).select("tile", "part", "v", "code", "least")


def _together(left: DataFrame, right: DataFrame, by: list[str], work, schema: str) -> DataFrame:
    """Both sides of each group, as Arrow tables, to ``work``."""
    a, b = (df.toDF(*df.columns) for df in (left, right))  # columns of their own, where both come from one table
    return a.groupBy(*by).cogroup(b.groupBy(*by)).applyInArrow(lambda x, y: work(x, y), schema)


class Index(NamedTuple):
    """A searchable graph: what ``search`` needs, all but the spaces as written tables."""

    spaces: list[Space]
    pivots: dict[int, tuple[np.ndarray, np.ndarray]]
    vectors: DataFrame
    members: DataFrame
    nodes: DataFrame
    edges: DataFrame
    tiles: DataFrame


def _rows(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding")
    good = vectors.filter(F.col("vec_id").isNotNull() & usable(v)).select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))
    return good.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64("v", F.lit(1))})


def _fit(vectors: DataFrame, sample: int) -> tuple[dict[tuple[int, int], int], list[Space]]:
    """Numbers of the spaces and the spaces; the driver gets one row for each, and at most about ``sample`` vectors."""
    sizes = vectors.groupBy("d", "shell").agg(F.count("*").alias("n"), F.max("norm").alias("top")).orderBy("d", "shell").collect()
    total = sum(r["n"] for r in sizes)
    place = F.pmod(F.xxhash64("h1", "h2"), F.lit(1 << 30)) / float(1 << 30)
    chosen = vectors.filter(place < sample / max(total, 1)).limit(2 * sample).select("d", "shell", "v").collect()
    held: dict = {}
    for r in chosen:
        held.setdefault((r["d"], r["shell"]), []).append(r["v"])
    known = [(r["d"], r["shell"]) for r in sizes]
    return {key: i for i, key in enumerate(known)}, [
        Space(r["d"], r["top"], r["n"], np.array(held.get(key, []), np.float64).reshape(-1, r["d"]))
        for key, r in zip(known, sizes, strict=True)]


def index(vectors: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS, settled: float = SETTLED) -> Index | None:
    """A neighbour graph of ``vectors(vec_id, embedding)``; None where no row takes part.

    Rows without id, and null, empty and zero vectors and such with a null or
    non-finite component take no part; rows that repeat id and vector are one;
    other columns are ignored.  Every other row is a node or a copy of one.
    """
    spark = vectors.sparkSession
    members = stored(_rows(vectors).distinct().withColumn("d", F.size("v")), "members")
    unique = stored(members.groupBy("h1", "h2").agg(F.first("v").alias("v")).withColumns({
        "d": F.size("v"), "norm": norm(F.col("v"))}).withColumn("shell", F.floor(F.log2("norm") + 0.5).cast("int")), "unique")
    numbers, spaces = _fit(unique, sample)
    if not spaces:
        return None
    shared = spark.sparkContext.broadcast((numbers, spaces))

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers, spaces = shared.value
        for batch in batches:
            for key, part in batch.groupby(["d", "shell"]):
                at = numbers[int(key[0]), int(key[1])]
                lifted = spaces[at].lifted(np.stack(part["v"]).astype(np.float64))
                keys = spaces[at].keys(lifted)
                yield pd.DataFrame({"space": at, "h1": part["h1"].to_numpy(), "h2": part["h2"].to_numpy(),
                                    "key": keys[:, 0], "code": coded(lifted), "keys": list(keys)})

    rows = unique.select("h1", "h2", "d", "shell", "v").mapInPandas(
        code, "space int, h1 bigint, h2 bigint, key bigint, code binary, keys array<bigint>")
    # Neighbours in number tend to be near, which keeps what a tile asks for together.
    numbered = running_number(rows, ["key", "h1", "h2"], ["space"], "n")
    cid = F.shiftleft(F.col("space").cast("bigint"), _SPACE) + F.col("n") - 1
    nodes = stored(numbered.select(cid.alias("cid"), "space", "h1", "h2", "code", "keys"), "nodes")

    block = ["space", "tree", "key"]
    entries = nodes.select("cid", "space", "code", F.posexplode("keys").alias("tree", "key"))
    # A crowded block is dealt by hash, anew in every tree.
    large = entries.groupBy(*block).agg(F.count("*").alias("n")).filter(F.col("n") > 2 * LEAF).select(
        *block, F.ceil(F.col("n") / LEAF).alias("parts"))
    dealt = entries.join(large, block, "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("cid", "tree"), "parts"), F.lit(0)))
    start = dealt.groupBy(*block, "part").applyInArrow(lambda group: _leaf(group), LISTS)
    edges = stored(_merged(None, start, NEIGHBOURS), "edges")
    for _ in range(rounds):
        marks = edges.agg(F.count("*"), F.sum(F.col("new").cast("int"))).first()
        if not marks[0] or marks[1] <= settled * marks[0]:
            break
        known = nodes.select(F.col("cid").alias("a"), "code").join(_worst(edges), "a")
        both, codes = _tiled(edges, known)
        lists = _together(both, codes, ["tile", "part"], _met, LISTS)
        better = stored(_merged(edges.select("a", "b", "sim"), lists, NEIGHBOURS), "edges")
        release(edges)
        edges = better
    backward = edges.withColumn("rank", F.row_number().over(W.partitionBy("b").orderBy(F.desc("sim"), "a")))
    both = edges.select(F.col("a").alias("centre"), F.col("b").alias("v")).union(
        backward.filter(F.col("rank") <= BACKWARD).select("b", "a")).distinct().withColumn(
        "tile", F.shiftright("centre", int(math.log2(TILE))))
    asked = both.select("tile", "v").distinct()
    codes = asked.join(nodes, F.col("v") == F.col("cid")).select("tile", "v", "code")
    tiles = stored(_together(both, codes, ["tile"], _packed, TILES), "tiles")
    place = F.pmod(F.xxhash64("cid", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    pivots = {}
    sizes = {r["space"]: r["n"] for r in nodes.groupBy("space").agg(F.count("*").alias("n")).collect()}
    for at, n in sizes.items():
        some = nodes.filter((F.col("space") == at) & (place < PIVOTS / n)).limit(2 * PIVOTS).select("cid", "code").collect()
        pivots[at] = (np.array([r["cid"] for r in some], np.int64), decoded([bytes(r["code"]) for r in some])
                      if some else np.zeros((0, spaces[at].d + 1), np.float32))
    shared.destroy()
    return Index(spaces, pivots, unique.select("h1", "h2", "v"), members.select("vec_id", "h1", "h2"),
                 nodes.select("cid", "space", "h1", "h2"), edges, tiles)


def search(index: Index, queries: DataFrame, k: int, own: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row of ``queries(vec_id, embedding)``.

    Nearness is the inner product in double precision, ties go to the smaller
    ``vec_id``.  Without ``own``, a row with the id and vector of the query is
    no candidate of it.  Queries that take no part (see ``index``) have no row.
    """
    spark = queries.sparkSession
    asked = stored(_rows(queries).distinct().withColumn("q", F.monotonically_increasing_id()), "queries")
    shared = spark.sparkContext.broadcast((index.spaces, index.pivots))

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spaces, pivots = shared.value
        for batch in batches:
            for d, part in batch.groupby(batch["v"].map(len)):
                codes = _query_codes(np.stack(part["v"]).astype(np.float64))
                unit = decoded(codes)
                nodes, sims = [[] for _ in codes], [[] for _ in codes]
                for at, space in enumerate(spaces):
                    ids, x = pivots.get(at, ((), ()))
                    if space.d != d or not len(ids):
                        continue
                    sim = unit @ x.T
                    best = np.argsort(-sim, axis=1)[:, :ENTRIES]
                    for i, chosen in enumerate(best):
                        nodes[i] += ids[chosen].tolist()
                        sims[i] += sim[i, chosen].tolist()
                yield pd.DataFrame({"q": part["q"].to_numpy(), "code": codes, "b": nodes, "sim": sims})

    started = stored(asked.select("q", "v").mapInPandas(start, "q bigint, code binary, b array<bigint>, sim array<float>"), "started")
    codes = started.select("q", "code")
    pivots = started.select("q", F.explode(F.arrays_zip("b", "sim")).alias("e")).select("q", F.col("e.b").alias("node"), F.col("e.sim").alias("sim"))
    home = asked.join(index.nodes, ["h1", "h2"]).select("q", F.col("cid").alias("node"), F.lit(2.0).cast("float").alias("sim"))
    space = F.shiftright("node", _SPACE)
    per = W.partitionBy("q", "space")

    def ranked(beam: DataFrame) -> DataFrame:
        """The best of each query and space; those to open now are marked."""
        best = beam.repartition("q").groupBy("q", "node").agg(F.max("sim").alias("sim"), F.min("open").alias("open")).withColumn("space", space)
        best = best.withColumn("place", F.row_number().over(per.orderBy(F.desc("sim"), "node"))).filter(F.col("place") <= BEAM)
        least = F.when(F.count("*").over(per) >= BEAM, F.min("sim").over(per)).otherwise(_LOW).cast("float")
        turn = F.row_number().over(per.orderBy(F.desc("open"), F.desc("sim"), "node"))
        return best.withColumns({"least": least, "take": F.col("open") & (turn <= STEP)})

    beam = stored(ranked(pivots.unionByName(home).withColumn("open", F.lit(True))), "beam")
    while True:
        opened = beam.filter("take").select("q", "node", "least", F.shiftright("node", int(math.log2(TILE))).alias("tile"))
        loads = stored(opened.groupBy("tile").agg(F.ceil(F.count("*") / LOAD).cast("int").alias("parts")), "loads")
        if loads.isEmpty():
            break
        part = F.pmod(F.xxhash64("q"), F.col("parts")).cast("int")
        left = opened.join(loads, "tile").withColumn("part", part).join(codes, "q").select("tile", "part", "q", "node", "least", "code")
        right = index.tiles.join(loads, "tile").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        found = _together(left, right, ["tile", "part"], _opened, "q bigint, b array<bigint>, sim array<float>")
        more = found.select("q", F.explode(F.arrays_zip("b", "sim")).alias("e")).select(
            "q", F.col("e.b").alias("node"), F.col("e.sim").alias("sim"), F.lit(True).alias("open"))
        old = beam.select("q", "node", "sim", (F.col("open") & ~F.col("take")).alias("open"))
        after = stored(ranked(old.unionByName(more)), "beam")
        release(beam, loads)
        beam = after
    shared.destroy()
    # The first of the beam by the original vectors; of equal vectors as many ids as an answer can hold.
    near = beam.filter(F.col("place") <= 2 * k + 8).select("q", F.col("node").alias("cid"))
    original = index.nodes.join(index.vectors, ["h1", "h2"]).select("cid", "h1", "h2", "v")
    met = near.join(original, "cid").join(asked.select("q", "vec_id", F.col("v").alias("w"), F.col("h1").alias("q1"), F.col("h2").alias("q2")), "q")
    scored = met.select("q", F.col("vec_id").alias("query_id"), "h1", "h2", "q1", "q2", inner_product(F.col("w"), F.col("v")).alias("score"))
    copy = F.row_number().over(W.partitionBy("h1", "h2").orderBy("vec_id"))
    named = index.members.withColumn("copy", copy).filter(F.col("copy") <= k + 1).select("h1", "h2", "vec_id")
    out = scored.join(named, ["h1", "h2"])
    if not own:
        out = out.filter(~((F.col("vec_id") == F.col("query_id")) & (F.col("h1") == F.col("q1")) & (F.col("h2") == F.col("q2"))))
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, **options) -> DataFrame:
    """``search`` in an ``index`` of ``vectors``; no row where the index is empty."""
    made = index(vectors, **options)
    if made is None:
        return vectors.sparkSession.createDataFrame([], NEIGHBOUR_ROWS)
    return search(made, queries, k)


def op11(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"))


#: The exact search.  The operator is exact by construction up to ``LEAF`` different vectors, where its graph holds all neighbours.
SQL = """
WITH clean AS (
  SELECT DISTINCT CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]), lambda a, b: a + b) AS score
  FROM clean q JOIN clean c ON len(q.v) = len(c.v) AND (q.vec_id <> c.vec_id OR q.v <> c.v)
  WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
