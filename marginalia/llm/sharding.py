"""Rendezvous hashing of record keys over weighted shards.

A key scores every shard with -ln(u) / weight, u a hash of key and shard, and
goes to the lowest.  A further shard takes rows only into itself; a changed
weight moves rows only from or to its shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.numbering import running_number

SHARDS = 24
LAW = "key"


def record_key(doc_id: Column, text: Column) -> Column:
    """The id as text; rows without id are keyed by their text."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard; ties go to the lowest.  Shards of weight 0 get nothing."""
    scored = []
    for shard, weight in enumerate(weights):
        if weight < 0:
            raise ValueError("a weight is negative")
        if weight:
            digits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, 13), 16, 10).cast("double")
            scored.append(F.struct((-F.log((digits + 1) / float(1 << 52)) / float(weight)).alias("s"), F.lit(shard).alias("n")))
    if not scored:
        raise ValueError("no shard has a weight")
    return F.array_min(F.array(*scored))["n"].cast("int")


def assigned(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown: Sequence[float] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row of ``docs(doc_id, text)``.

    ``grown``: weights after the change, by default one more shard of weight
    1.  Slots count from 0 within a shard by id (null first), check sum and
    size; they come from range partitions and offsets, so no shard meets in one
    task, and identical rows spread too.  Null text has no bytes and the check
    sum of the empty text; repeated rows get a slot each.
    """
    text = F.coalesce("text", F.lit(""))
    key = record_key(F.col("doc_id"), F.col("text"))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit(LAW).alias("law"), shard_of(key, weights).alias("shard"),
        shard_of(key, [*weights, 1.0] if grown is None else grown).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_tie"))
    numbered = running_number(rows, ["doc_id", "text_crc32", "size", "_tie"], ["shard"], "slot")
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", (F.col("slot") - 1).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * SHARDS) -> None:
    """Write ``docs`` with all columns, one folder per shard, rows in order of id within a file.

    Each shard is dealt over several ranges of ids, so its size has no bound in a task.
    """
    shard = shard_of(record_key(F.col("doc_id"), F.col("text")), weights)
    placed = docs.withColumn("shard", shard).repartitionByRange("shard", "doc_id", F.xxhash64("text"))
    placed.sortWithinPartitions("shard", "doc_id").write.partitionBy("shard").parquet(path)


def op9(spark: SparkSession, folder: str) -> DataFrame:
    return assigned(spark.read.parquet(f"{folder}/documents.parquet"))


def _sql_shard(shards: int) -> str:
    return f"""(SELECT arg_min(n, s) FROM (SELECT n, -ln((CAST(CAST('0x' || substr(md5(key || ':' || n), 1, 13) AS BIGINT) AS DOUBLE)
      + 1) / 4503599627370496.0) AS s FROM range({shards}) t(n)))"""


# CRC-32 has no function in DuckDB: its table is made by the rule, and the bytes are folded over it.
SQL = f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, i: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (
  SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, ''))) + 8 AS size,
    coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, ''))) AS key
  FROM documents),
summed AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(
      regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS text_crc32
  FROM keyed, crc_table),
placed AS (
  SELECT *, {_sql_shard(SHARDS)} AS shard, {_sql_shard(SHARDS + 1)} AS grown_shard FROM summed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS BIGINT) AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard
FROM placed
"""
