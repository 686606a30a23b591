"""Token ids in patched frame-of-reference blocks.

A file holds segments of whole documents in ascending order of id.  A segment's
payload is: magic, block size, number of ids and blocks, the byte offset of
every block, then the blocks.  A block subtracts its minimum, packs the rest at
the width that holds a given percentile of them, and stores the upper bits of
the others in an exception list, so a few large ids don't widen the block.

Segments are rows of Parquet files: they can be split, read by any reader that
Spark has, and are committed by Spark, so a lost executor leaves no half file.
"""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..sources.sinks import scratch_path
from .common import TEXTS, arrow_rows, released, stored

MAGIC = b"PFR1"
BLOCK = 4096
PERCENTILE = 0.9
#: Ids after which a segment ends with its document.
SEGMENT = 1 << 18
#: Bytes of text of a task: the more, the more of its words it has met before.
PART = 32 << 20
#: Segments that a Python worker decodes at once.
SEGMENTS = 4
#: Distinct pieces a task remembers.
CACHE = 500_000

_HEAD = struct.Struct("<4sIQI")
_BLOCK_HEAD = struct.Struct("<IIIB")

SEGMENT_SCHEMA = (
    "part int, segment int, before bigint, n_ids bigint, doc_ids array<bigint>, sizes array<bigint>, payload binary")


def _packed(values: np.ndarray, width: int) -> bytes:
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width], axis=None, bitorder="little").tobytes()


def _unpacked(data: np.ndarray, n: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint32)
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(data[: -(-n * width // 8)], count=n * width, bitorder="little").reshape(n, width)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)


def pack(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """Payload of ids (unsigned 32-bit), decoded by ``unpack``."""
    ids = np.asarray(ids, np.uint32)
    blocks = []
    for at in range(0, len(ids), block):
        part = ids[at: at + block]
        base = int(part.min())
        rest = part - np.uint32(base)
        width = int(np.partition(rest, k)[k]).bit_length() if (k := int(percentile * (len(rest) - 1))) >= 0 else 0
        outside = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
        low = rest & np.uint32((1 << width) - 1)
        blocks.append(
            _BLOCK_HEAD.pack(base, len(part), len(outside), width) + outside.astype("<u4").tobytes()
            + (rest[outside] >> np.uint32(width)).astype("<u4").tobytes() + (_packed(low, width) if width else b""))
    sizes = np.array([len(b) for b in blocks], np.uint64)
    first = _HEAD.size + 8 * len(blocks)
    index = first + np.cumsum(sizes) - sizes if len(blocks) else sizes
    return _HEAD.pack(MAGIC, block, len(ids), len(blocks)) + index.astype("<u8").tobytes() + b"".join(blocks)


def block_starts(payload: bytes) -> np.ndarray:
    magic, _, _, n_blocks = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a block payload")
    return np.frombuffer(payload, "<u8", n_blocks, _HEAD.size)


def unpack(payload: bytes, first: int = 0, n: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``first + n`` (default: all); reads only the blocks that hold them."""
    starts = block_starts(payload)
    _, block, total, _ = _HEAD.unpack_from(payload)
    end = total if n is None else min(total, first + n)
    if end <= first:
        return np.empty(0, np.uint32)
    raw, out = np.frombuffer(payload, np.uint8), []
    for b in range(first // block, (end - 1) // block + 1):
        at = int(starts[b])
        base, size, n_out, width = _BLOCK_HEAD.unpack_from(payload, at)
        at += _BLOCK_HEAD.size
        outside = np.frombuffer(payload, "<u4", n_out, at)
        high = np.frombuffer(payload, "<u4", n_out, at + 4 * n_out)
        values = _unpacked(raw[at + 8 * n_out:], size, width)
        values[outside] |= high << np.uint32(width)
        out.append(values + np.uint32(base))
    whole = np.concatenate(out)
    return whole[first % block: first % block + end - first]


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Pieces(dict):
    """Ids of pieces as bytes; what is asked for the first time is encoded."""

    LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
    WORD = re.compile(rf"( ?[{LETTERS}]++)([^\s\w]*)")
    SIGNS = string.punctuation.replace("_", "")

    def __init__(self, tokenizer) -> None:
        from tokenizers import pre_tokenizers

        self.tokenizer, self.tokenize = tokenizer, tokenizer.model.tokenize
        alphabet = sorted(pre_tokenizers.ByteLevel.alphabet())
        plain = {ord(c) for c in alphabet if ord(c) < 256}
        hidden = [b for b in range(256) if b not in plain]
        self.shown = dict(zip(hidden, [c for c in alphabet if ord(c) >= 256], strict=True))
        self.space = self.shown[ord(" ")]

    def __missing__(self, piece: str) -> bytes:
        word = piece[1:] if piece[0] == " " else piece
        known = None
        if word.isascii():
            if word.isalpha():
                known = self._word(word if word is piece else self.space + word)
            elif (core := word.rstrip(self.SIGNS)).isalpha():
                at = len(core) - len(word)
                known = self[piece[:at]] + self[piece[at:]]
        elif found := self.WORD.fullmatch(piece):
            letters, signs = found.groups()
            known = self._word(letters.encode().decode("latin1").translate(self.shown)) if not signs else self[letters] + self[signs]
        if known is None:
            known = _bytes(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        self[piece] = known
        return known

    def _word(self, shown: str) -> bytes:
        """A run of letters is one unit of the model."""
        return _bytes([x.id for x in self.tokenize(shown)])


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The vocabulary, which a worker loads once; it doesn't grow."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of whole texts, the same as the tokenizers library gives, each distinct piece encoded once.

    A byte-level pre-tokenizer never joins a character with white space behind
    it, nor a letter with a sign, so a text is the row of its pieces.  Texts
    that hold the string of an added token, or rare white space, go to the
    library as they are.
    """

    PIECE = re.compile(r"\s*\S+|\s+")
    #: White space other than spaces and line ends, and the mark that the fast cut uses.
    OTHER_SPACE = re.compile("[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\x00]")
    #: White space for Python but not for the pre-tokenizer.
    UNSURE = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str) -> None:
        from tokenizers import pre_tokenizers

        self.tokenizer = _tokenizer(path)
        kind = self.tokenizer.pre_tokenizer
        self.by_piece = (
            isinstance(kind, pre_tokenizers.ByteLevel) and not kind.add_prefix_space and kind.use_regex
            and self.tokenizer.normalizer is None)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = Pieces(self.tokenizer) if self.by_piece else {}

    def _plain(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _cut(self, text: str) -> list[str]:
        if self.OTHER_SPACE.search(text) or "  " in text.replace("\n", " "):
            return self.PIECE.findall(text)
        # A space belongs to what follows, a line end is a piece.
        return [p for p in text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00") if p]

    def encode(self, text: str) -> np.ndarray:
        if not self.by_piece or self.UNSURE.search(text) or any(t in text for t in self.added):
            found = self._plain(text)
        else:
            if len(self.pieces) > CACHE:
                self.pieces.clear()
            found = b"".join(map(self.pieces.__getitem__, self._cut(text)))
        return np.frombuffer(found, np.uint32)


def _writer(path: str, end_id: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), Encoder(path)
        end, segment, before = np.array([end_id], np.uint32), 0, 0
        names: list = []
        docs: list[np.ndarray] = []
        held = 0

        def row() -> pd.DataFrame:
            return pd.DataFrame([{
                "part": part, "segment": segment, "before": before, "n_ids": held, "doc_ids": names,
                "sizes": [len(d) for d in docs], "payload": pack(np.concatenate(docs))}])

        for batch in batches:
            for x, known, text in zip(batch["doc_id"], batch["known"], batch["text"], strict=True):
                found = encoder.encode(text)
                names.append(int(x) if known else None)
                docs.append(np.concatenate((found, end)))
                held += len(found) + 1
                if held >= SEGMENT:
                    yield row()
                    segment, before = segment + 1, before + held
                    names, docs, held = [], [], 0
        if docs:
            yield row()

    return write


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Write the ids of ``docs(doc_id, text)`` in ascending order of id below ``path``.

    Parts are ranges of (id, a hash of the text), so that many rows of one id
    spread over parts, and order by part is the order of ids; rows without id
    come first.  Null text is empty and gives the end id alone.  Repeated rows
    are each written.
    """
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    placed = plain.repartitionByRange(1 + size // PART, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    # A null among integers would make pandas turn them into floats.
    flagged = placed.select(
        F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), "text")
    with arrow_rows(docs.sparkSession, TEXTS):
        flagged.mapInPandas(released(_writer(tokenizer, end_id)), SEGMENT_SCHEMA).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``first``, the number of ids in all segments before."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # One row per task that wrote, so the segments themselves stay where they are.
    return segments.join(F.broadcast(offsets), "part").withColumn("first", F.col("offset") + F.col("before"))


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            ids = unpack(row.payload).astype("<u4")
            sizes = np.asarray(row.sizes, np.int64)
            starts = np.cumsum(sizes) - sizes
            yield pd.DataFrame({
                "doc_id": pd.array([None if pd.isna(x) else int(x) for x in row.doc_ids], "Int64"),
                "start": starts + row.first, "n_tokens": sizes,
                "ids_crc32": [zlib.crc32(ids[a: a + n].tobytes()) for a, n in zip(starts, sizes, strict=True)]})


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the files alone."""
    return read_segments(spark, path).select("first", "doc_ids", "sizes", "payload").mapInPandas(
        released(_decode), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` per document, from the files."""

    def ids(batches):
        for batch in batches:
            for row in batch.itertuples():
                sizes = np.asarray(row.sizes, np.int64)
                starts = np.cumsum(sizes) - sizes
                yield pd.DataFrame({
                    "doc_id": pd.array([None if pd.isna(x) else int(x) for x in row.doc_ids], "Int64"),
                    "start": starts + row.first,
                    "ids": np.split(unpack(row.payload).astype(np.int64), starts[1:])})

    return read_segments(spark, path).select("first", "doc_ids", "sizes", "payload").mapInPandas(
        released(ids), "doc_id bigint, start bigint, ids array<bigint>")


def encoded(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write ``docs`` with the 50k byte-level vocabulary and read the digests back.

    Null text is empty and gives the end id alone; rows without id come first;
    repeated rows are each written; an empty table gives no row; only
    ``doc_id`` and ``text`` are read.
    """
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return stored(read_digests(spark, path), "digests", SEGMENTS)


def op10(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(spark, spark.read.parquet(f"{folder}/documents.parquet"))
