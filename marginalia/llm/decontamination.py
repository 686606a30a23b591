"""Benchmark items in documents, within an edit budget.

An item of m characters with k allowed edits is split into k + 1 pieces; where
it occurs with at most k edits, at least one piece occurs unchanged.  All
pieces are looked up in one pass (Aho-Corasick), and the places they point to
are verified with Myers' bit-parallel distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType

from .common import released

EDIT_RATE = 0.06
#: Long items are matched whole and by overlapping parts of this many characters, so that a quoted part counts.
UNIT = 128
#: Items with fewer characters count at word borders only, where their budget is 0 or 1.
LEAST = 20
#: Characters of items that one pass over the documents looks for.
BLOCK_CHARS = 8_000_000
#: Windows that a task remembers with their distance, and their characters.
KNOWN, KNOWN_CHARS = 20_000, 4_000_000

_OTHER = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    """Lower case, letters and digits, other characters as one space."""
    return _OTHER.sub(" ", (text or "").lower()).strip()


def units(item: str) -> list[str]:
    """The item itself, then the parts of a long one, overlapping by half."""
    if len(item) <= UNIT:
        return [item]
    starts = [*range(0, len(item) - UNIT, UNIT // 2), len(item) - UNIT]
    return [item, *(item[s: s + UNIT] for s in starts)]


def pieces(unit: str, budget: int) -> list[tuple[int, str]]:
    """Budget + 1 pieces of nearly equal length, with their offsets."""
    n = budget + 1
    cuts = [len(unit) * i // n for i in range(n + 1)]
    return [(a, unit[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern(NamedTuple):
    item: int
    text: str
    budget: int
    masks: dict[str, int]
    #: 1 for what ``parts`` counts, 0 for the whole of an item that has parts.
    part: int


def pattern(item: int, text: str, budget: int, part: int = 1) -> Pattern:
    masks: dict[str, int] = {}
    for i, c in enumerate(text):
        masks[c] = masks.get(c, 0) | 1 << i
    return Pattern(item, text, budget, masks, part)


def distance_within(p: Pattern, text: str) -> int:
    """Smallest edit distance between the pattern and any part of ``text`` (Myers, one word of any width)."""
    m = len(p.text)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    get = p.masks.get
    for c in text:
        x = get(c, 0) | minus
        zero = (((x & plus) + plus) ^ plus) | x
        down = plus & zero
        up = minus | (full & ~(plus | zero))
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best = score
        up = (up << 1) & full
        minus = up & zero
        plus = ((down << 1) & full) | (full & ~(up | zero))
    return best


class Finder:
    """Finds a block of items in texts."""

    def __init__(self, items: list[str], rate: float = EDIT_RATE) -> None:
        import ahocorasick

        self.patterns: list[Pattern] = []
        where: dict[str, list[tuple[int, int]]] = {}
        for at, item in enumerate(map(normal, items)):
            if not item:
                continue
            for unit in units(item):
                budget = int(rate * len(unit))
                unit = f" {unit} " if len(item) < LEAST else unit
                p = pattern(at, unit, budget, int(len(unit) <= UNIT))
                for offset, piece in pieces(unit, p.budget):
                    where.setdefault(piece, []).append((len(self.patterns), offset))
                self.patterns.append(p)
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.empty = not where
        if where:
            self.automaton.make_automaton()
        self.known: dict[tuple[int, str], int] = {}
        self.known_chars = 0

    def find(self, text: str | None) -> dict[int, tuple[int, int]]:
        """Least distance and number of parts found, by item."""
        if self.empty or not text:
            return {}
        plain = f" {normal(text)} "  # short items reach from border to border
        starts: dict[int, list[int]] = {}
        for end, (size, places) in self.automaton.iter(plain):
            for at, offset in places:
                starts.setdefault(at, []).append(end - size + 1 - offset)
        found: dict[int, tuple[int, int]] = {}
        for at, places in starts.items():
            p = self.patterns[at]
            best = p.budget + 1
            # Starts within the budget of each other are one window.
            places.sort()
            first = last = places[0]
            for start in [*places[1:], None]:
                if start is not None and start - last <= 2 * p.budget + 1:
                    last = start
                    continue
                window = plain[max(0, first - p.budget): last + len(p.text) + p.budget]
                best = min(best, self._distance(at, p, window))
                first = last = start
            if best <= p.budget:
                d, n = found.get(p.item, (best, 0))
                found[p.item] = (min(d, best), n + p.part)
        return found

    def _distance(self, at: int, p: Pattern, window: str) -> int:
        if p.text in window:
            return 0
        known = self.known.get((at, window))
        if known is None:
            if len(self.known) >= KNOWN or self.known_chars + len(window) > KNOWN_CHARS:
                self.known.clear()
                self.known_chars = 0
            self.known_chars += len(window)
            known = self.known[at, window] = distance_within(p, window)
        return known


class _Block(NamedTuple):
    """Items of one pass; every task builds the automaton and drops it at its end."""

    shared: Broadcast
    rate: float

    def finder(self) -> Finder:
        return Finder([text for _, text in self.shared.value], self.rate)


def _blocks(items: DataFrame, rate: float) -> Iterator[_Block]:
    """Items in blocks of bounded size, each broadcast for one pass over the documents."""
    plain = items.filter("text IS NOT NULL").select("item_id", "text")
    chars = plain.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + chars // BLOCK_CHARS
    for b in range(n):
        rows = plain.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        yield _Block(items.sparkSession.sparkContext.broadcast([tuple(r) for r in rows]), rate)


def contaminated(docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """``doc_id, item_id, distance, parts``: the items found in ``docs(doc_id, text)``, one row per row and item.

    ``items(item_id, text)`` are a stated query set; each block of bounded
    size is one pass over the documents, which stay where they are.  Null and
    empty texts and items, and items without letters and digits, match
    nothing; items under 20 characters match whole words only; equal
    items and repeated documents are each reported; null ids are carried.
    An item counts when it is found whole within its own budget, or, if long,
    a part of it within the part's budget; ``distance`` is the least of these.
    ``parts`` counts the parts of a long item that were found, 0 when only the
    whole was, and is 1 for other items.
    """
    out = None
    for block in _blocks(items, rate):

        def search(batches, block=block):
            finder, names = block.finder(), block.shared.value
            for batch in batches:
                rows = [
                    (doc_id if known else None, names[at][0], d, n)
                    for doc_id, known, text in zip(batch["doc_id"], batch["known"], batch["text"], strict=True)
                    for at, (d, n) in sorted(finder.find(text).items())]
                yield pd.DataFrame({
                    "doc_id": pd.array([r[0] for r in rows], "Int64"), "item_id": pd.array([r[1] for r in rows], "Int64"),
                    "distance": [r[2] for r in rows], "parts": [r[3] for r in rows]})

        flagged = docs.select(
            F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), "text")
        part = flagged.mapInPandas(released(search), "doc_id bigint, item_id bigint, distance bigint, parts bigint")
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns and no other.

    Null and empty texts stay; repeated rows are judged alike; without items,
    all stay; an empty table gives no row.
    """
    for block in _blocks(items, rate):
        docs = docs.filter(~_hit(block)(F.col("text")))
    return docs


def _hit(block: _Block):
    """A column function that tells whether a text holds an item of the block."""

    def hit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def run(batches):
            finder = block.finder()
            for texts in batches:
                yield pd.Series([bool(finder.find(t)) for t in texts], dtype=bool)

        return released(run)(batches)

    return F.pandas_udf(hit, BooleanType())


def op6(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
