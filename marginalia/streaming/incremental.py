"""Incremental input: a folder read as a file stream that remembers what it has seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def text_stream(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """Whole text files (path, text) as they arrive."""
    return (
        spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).load(folder)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def run_once(stream: DataFrame, out: str, state: str) -> None:
    """Process everything new, append it to Parquet and stop; ``state`` is the stream's own ledger."""
    (stream.writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination())
