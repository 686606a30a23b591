"""Outputs: Parquet tables as the record, JSON / CSV / Markdown exports beside them."""

from __future__ import annotations

import atexit
import gc
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

INVENTORY_COLUMNS = (
    "relative_path", "prefixed_path", "size_bytes", "mtime_iso", "ext", "category", "raw_text", "raw_json", "ocr_status",
)

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_batches = threading.Lock()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder of the cluster, removed when the driver's Python ends."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    root = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    atexit.register(remove_path, spark, path)
    return path


def filesystem(folder: str):
    """The filesystem of a folder and its path there; every executor must reach it."""
    from pyarrow import fs

    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``scratch_path``, if it and the session still exist."""
    context = spark.sparkContext
    if context._jsc is None:  # the session has ended
        return
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Plans that run inside hand ``rows`` rows at once to Python workers."""
    with _batches:  # one at a time, or a session that runs several queries would keep what another one set
        before = spark.conf.get(ARROW_ROWS)
        try:
            spark.conf.set(ARROW_ROWS, str(rows))
            yield
        finally:
            spark.conf.set(ARROW_ROWS, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a compressed table below the checkpoint folder, for rows that hold texts.

    A checkpoint would write them as they are in memory, and read all columns again each time.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*frames: DataFrame) -> None:
    """Drop tables of ``stored`` that nothing reads any more, and let Spark clean the shuffles behind them.

    Spark removes the files of a shuffle once its plan is collected in the
    driver, which a driver with room in its heap would put off for long.
    """
    for df in frames:
        remove_path(df.sparkSession, df._scratch)
    gc.collect()
    frames[0].sparkSession.sparkContext._jvm.System.gc()


def write_structured_json(records: DataFrame, path: str) -> None:
    """One nested JSON object per document."""
    records.write.mode("overwrite").json(path)


def write_inventory_csv(rows: DataFrame, path: str) -> None:
    rows.select(*INVENTORY_COLUMNS).write.mode("overwrite").csv(path, header=True)


def write_documents(docs: DataFrame, path: str) -> None:
    """Documents as Parquet by category.  A task writes a range of paths, so a large
    category is written by many tasks, and a task writes few files."""
    docs.repartitionByRange("category", "path").write.mode("overwrite").partitionBy("category").parquet(path)


def append_ledger(outcomes: DataFrame, path: str, run_id: Column) -> None:
    """Append the outcomes of a run; rewriting a run replaces only its own partition."""
    (outcomes.withColumn("run_id", run_id).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))


def missing_keys(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    return wanted.join(cache.select("key"), "key", "left_anti")


def embedding_cache(wanted: DataFrame, cache: DataFrame, compute) -> DataFrame:
    """Vectors of all wanted keys: cached ones as they are, missing ones by ``compute``.

    ``compute`` maps pandas batches (key, text) to (key, vector) and runs only
    over the keys the cache does not have.
    """
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            yield compute(batch)

    fresh = missing_keys(wanted, cache).select("key", "text").mapInPandas(run, "key bigint, vector array<float>")
    kept = cache.join(wanted.select("key"), "key", "left_semi").select("key", "vector")
    return kept.withColumn("hit", F.lit(True)).unionByName(fresh.withColumn("hit", F.lit(False)))
