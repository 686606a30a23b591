"""What the operators of this subpackage share: tables, scratch tables, and positions of matches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import let
from ..sources.sinks import arrow_rows, release, scratch_path  # noqa: F401  (release: for the operators)

#: Matches of one document are numbered in blocks of this many, so that positions cost no quadratic work.
BLOCK = 256
#: Texts that a Python worker gets at once; Spark's 10 000 would be all texts of a task, held by both sides of the worker's stream.
TEXTS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Cut the lineage with a written table in the shared folder.

    Lost executors lose nothing of it, columns are pruned on reading, and its
    size is known to the planner, which broadcasts it only below the limit of
    the session.  ``batch``: rows that a Python worker gets at once, for rows
    that hold many values.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if batch:
        with arrow_rows(spark, batch):
            df.write.parquet(path)
    else:
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for the batches of a task, after which the worker gives its memory back.

    Spark reuses workers, and what one holds on to would be missing in all
    later stages.
    """

    def work(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return work


def letters(word: str) -> str:
    """A pattern for ``word`` with ASCII letters in either case, the same in every regex dialect."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


def running_sum(values: Column) -> Column:
    """Sum of the elements before each element of an array of longs, linear but for blocks."""
    total = lambda part: F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def placed(blocks: Column) -> Column:
        return let(F.transform(blocks, total), lambda sums: F.flatten(F.transform(blocks, lambda part, b: let(
            total(F.slice(sums, 1, b)), lambda before: F.transform(part, lambda _, i: before + total(F.slice(part, 1, i)))))))

    n_blocks = F.ceil(F.size(values) / BLOCK).cast("int")
    cut = F.transform(F.sequence(F.lit(1), n_blocks), lambda b: F.slice(values, (b - 1) * BLOCK + 1, BLOCK))
    return F.when(F.size(values) == 0, F.array().cast("array<bigint>")).otherwise(let(cut, placed))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array of (start, match, before), in code points.

    ``before`` is the text between the match before and this one.  ``pattern``
    must not match the empty string.  Null text has no match.
    """
    kind = "array<struct<start:bigint,match:string,before:string>>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = let(found, lambda m: F.zip_with(m, F.slice(F.split(text, pattern, -1), 1, F.size(m)), lambda x, gap: F.struct(
        x.alias("match"), gap.alias("before"))))

    def placed(pairs: Column) -> Column:
        steps = F.transform(pairs, lambda p: (F.length(p["match"]) + F.length(p["before"])).cast("bigint"))
        return F.zip_with(pairs, let(steps, running_sum), lambda p, s: F.struct(
            (s + F.length(p["before"])).alias("start"), p["match"].alias("match"), p["before"].alias("before")))

    return F.when(text.rlike(pattern), let(both, placed)).otherwise(F.array()).cast(kind)
