"""Running numbers, unique names, chapter groups and gaps.

A group may hold a third of all rows, so a window partitioned by the group
alone would put it on one task.  ``running_number`` orders by range partition
instead and adds the counts of the partitions before.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import pad, strip
from ..session import ensure_checkpoint_dir


def running_number(
    df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "number"
) -> DataFrame:
    """Number the rows of each group from 1 by ``order`` (a total order).

    The rows are range-partitioned by (group, order) and written once
    (checkpoint), so that both the counts and the rows see the same
    partitions after a lost executor.  The offsets table has one row per
    partition and group in it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [*group, *order]
    placed = (
        df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33)).checkpoint()
    )
    counts = placed.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(offsets, same).select(
        *df.columns, (F.col("_at") - F.col("_first") + 1 + F.col("_offset")).alias(name))


def running_total(
    df: DataFrame, order: Sequence[str], group: Sequence[str], value: str, name: str = "total"
) -> DataFrame:
    """Sum of ``value`` over the rows of each group up to the row itself, by ``order`` (a total order).

    As ``running_number``: sums within range partitions, plus the sums of the
    partitions before.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [*group, *order]
    placed = (
        df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
        .withColumn("_part", F.shiftright(F.monotonically_increasing_id(), 33)).checkpoint()
    )
    sums = placed.groupBy("_part", *group).agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    within = W.partitionBy("_part", *group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    summed = placed.withColumn("_within", F.sum(value).over(within))
    return summed.join(offsets, same).select(*df.columns, (F.col("_within") + F.col("_offset")).alias(name))


def _takers(group: pd.DataFrame) -> pd.DataFrame:
    """Which literal names ``stem_k`` come before the stem's own rows reach the number k.

    ``before`` rows of the stem come earlier, ``free`` numbers up to k are
    neither taken nor lost; of those, names that took a smaller number earlier
    are missing.
    """
    at: list[int] = []
    out = []
    for row in group.sort_values("k").itertuples():
        takes = row.before < row.free - bisect_left(at, row.turn)
        if takes:
            insort(at, row.turn)
        out.append((row.child, takes))
    return pd.DataFrame(out, columns=["base", "takes"])


def unique_names(rows: DataFrame, existing: DataFrame, order: Sequence[str]) -> DataFrame:
    """First free of ``name``, ``name_2``, ``name_3`` … in order; blank is ``document``.

    The k-th row of a name takes its k-th free number, the bare name being 1.
    Numbers are taken by existing names, and by rows literally named like that
    which come before the number is reached; otherwise the row of that name has
    lost its bare name.  Taken numbers are ranges without gaps between them, so
    how many of them lie below the k-th free one is a running total over both.
    Literal names only meet those of their stem, from the shortest stem on:
    one pass for each length of a chain of such names, none without them.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    base = F.when(strip(F.coalesce("name", F.lit(""))) == "", "document").otherwise(strip(F.col("name")))
    numbered = running_number(rows.select(F.struct(*rows.columns).alias("row"), *order, base.alias("base")), order, ["base"], "k").checkpoint()
    firsts = numbered.filter("k = 1").select("base", F.struct(*order).alias("first_at")).checkpoint()
    stem, number = F.regexp_extract("base", r"^(.*)_[1-9][0-9]*$", 1), F.regexp_extract("base", r"_([1-9][0-9]*)$", 1).try_cast("bigint")

    def as_numbers(names: DataFrame) -> DataFrame:
        """A name is number 1 of itself and number j of its stem; only those that rows are named after."""
        own = names.select("base", F.lit(1).cast("bigint").alias("j"))
        of_stem = names.filter((stem != "") & (number >= 2)).select(stem.alias("base"), number.alias("j"))
        return own.unionByName(of_stem).distinct().join(firsts.select("base"), "base", "left_semi")

    taken = as_numbers(existing.select(F.col("name").alias("base")).distinct()).checkpoint()
    # Literal names whose stem is a name of other rows, and that don't exist yet.
    children = firsts.filter((stem != "") & (number >= 2)).select(
        F.col("base").alias("child"), stem.alias("base"), number.alias("j"), "first_at").join(firsts.select("base"), "base", "left_semi").join(
        taken.filter("j = 1").select(F.col("base").alias("child")), "child", "left_anti").checkpoint()
    lost = None
    if not children.isEmpty():
        lost = _lost(numbered, children, taken, order).checkpoint()
        won = children.join(lost.filter("takes").select(F.col("base").alias("child")), "child", "left_semi").select("base", "j")
        bare = lost.filter("NOT takes").select("base", F.lit(1).cast("bigint").alias("j"))
        taken = taken.unionByName(won).unionByName(bare).distinct().checkpoint()
    ranked = running_number(taken, ["j"], ["base"], "r")
    # A taken number with f free ones below it comes before the row f + 1.
    marks = ranked.select("base", (F.col("j") - F.col("r") + 1).alias("at"), F.lit(0).alias("is_row"), "j", F.lit(None).cast(numbered.schema["row"].dataType).alias("row"))
    wanted = numbered.select("base", F.col("k").alias("at"), F.lit(1).alias("is_row"), F.lit(0).cast("bigint").alias("j"), "row")
    counted = running_total(marks.unionByName(wanted).withColumn("taken", 1 - F.col("is_row")), ["at", "is_row", "j"], ["base"], "taken", "below")
    n = F.col("at") + F.col("below")
    name = F.when(n == 1, F.col("base")).otherwise(F.concat("base", F.lit("_"), n.cast("string")))
    return counted.filter("is_row = 1").select("row.*", name.alias("unique_name"))


def _lost(numbered: DataFrame, children: DataFrame, taken: DataFrame, order: Sequence[str]) -> DataFrame:
    """(base, takes) of the literal names: whether each still gets its bare name."""
    rows = numbered.select("base", F.struct(*order).alias("at"), F.lit(None).cast("string").alias("child"), F.lit(1).alias("one"))
    turns = children.select("base", F.col("first_at").alias("at"), "child", F.lit(0).alias("one"))
    before = running_total(rows.join(children.select("base").distinct(), "base", "left_semi").unionByName(turns), ["at", "child"], ["base"], "one", "before").filter(
        "child IS NOT NULL").select("child", "before")
    turn = running_number(children, ["first_at"], ["base"], "turn").select("child", "turn")
    marks = taken.join(children.select("base").distinct(), "base", "left_semi").select("base", "j", F.lit(None).cast("string").alias("child"), F.lit(1).alias("one"))
    below = running_total(marks.unionByName(children.select("base", "j", "child", F.lit(0).alias("one"))), ["j", "child"], ["base"], "one", "below").filter(
        "child IS NOT NULL").select("child", "below")
    todo = children.select("child", "base", F.col("j").alias("k")).join(before, "child").join(turn, "child").join(below, "child").checkpoint()
    done = None
    while True:
        # Names whose stem is settled: it is no such name itself, or was told in the pass before.
        open_names = todo.select(F.col("child").alias("base"))
        ready = todo.join(open_names, "base", "left_anti")
        if done is not None:
            ready = ready.join(done.filter("NOT takes").select("base", F.lit(1).alias("gone")), "base", "left")
        else:
            ready = ready.withColumn("gone", F.lit(0))
        free = (F.col("k") - F.col("below") - F.coalesce("gone", F.lit(0))).alias("free")
        told = ready.select("base", "child", "k", "before", "turn", free).groupBy("base").applyInPandas(
            lambda g: _takers(g), "base string, takes boolean").checkpoint()
        done = told if done is None else done.unionByName(told).checkpoint()
        todo = todo.join(told.select(F.col("base").alias("child")), "child", "left_anti").checkpoint()
        if todo.isEmpty():
            return done


def max_file_numbers(base: DataFrame) -> DataFrame:
    """Largest leading ``NN_`` of the file names per category."""
    number = F.regexp_extract(F.substring_index("path", "/", -1), "^([0-9]+)_", 1).try_cast("bigint")
    return base.groupBy("category").agg(F.coalesce(F.max(number), F.lit(0)).alias("max_number"))


def next_file_numbers(base: DataFrame, planned: DataFrame, order: Sequence[str]) -> DataFrame:
    """Numbers and names of planned files ``(category, name)`` behind those of the base."""
    numbered = running_number(planned, order, ["category"], "k")
    clean = F.regexp_replace("name", "^[0-9]+_", "")
    return numbered.join(max_file_numbers(base), "category", "left").withColumn(
        "number", F.coalesce("max_number", F.lit(0)) + F.col("k")
    ).select(*planned.columns, "number", F.concat(pad(F.col("number"), 2), F.lit("_"), clean).alias("file_name"))


def fallback_groups(total: Column, limit: int = 50, size: int = 30) -> Column:
    """Groups of chapters of a long document: (group_no, name, chapter_range); one whole group otherwise."""
    n_groups = F.ceil(total / size).cast("int")
    grouped = F.transform(F.sequence(F.lit(1), F.greatest(n_groups, F.lit(1))), lambda g: F.struct(
        g.alias("group_no"), F.concat(F.lit("セクション"), g.cast("string")).alias("name"),
        F.concat(pad((g - 1) * size + 1, 3), F.lit("-"), pad(F.least(g * size, total), 3)).alias("chapter_range")))
    whole = F.array(F.struct(
        F.lit(1).alias("group_no"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("chapter_range")))
    return F.when(total > limit, grouped).otherwise(whole)


def missing_chapters(chapters: DataFrame, used: DataFrame) -> DataFrame:
    """Chapters ``(doc_id, chapter_no, …)`` that no plan row ``(doc_id, chapter_no)`` uses."""
    return chapters.join(used.select("doc_id", "chapter_no").distinct(), ["doc_id", "chapter_no"], "left_anti")


def fill_missing(missing: DataFrame, batch: int = 15, title_width: int = 15) -> DataFrame:
    """Missing chapters in batches as extra files, titled by their first chapter up to a display width; ``first_title`` is whole.

    The window runs within one document, whose chapters came from one row.
    """
    w = W.partitionBy("doc_id").orderBy("chapter_no")
    batched = missing.withColumn("batch_no", F.floor((F.row_number().over(w) - 1) / batch))
    return batched.groupBy("doc_id", "batch_no").agg(
        F.min_by("clean_title", "chapter_no").alias("first_title"), F.count("*").alias("n_chapters"),
        F.min("chapter_no").alias("first_no"), F.max("chapter_no").alias("last_no"),
    ).withColumn("title", F.concat(F.substring("first_title", 1, title_width), F.lit(" 他")))


def missing_ranges(missing: DataFrame) -> DataFrame:
    """Consecutive missing numbers collapsed to ranges (gaps and islands within a document)."""
    w = W.partitionBy("doc_id").orderBy("chapter_no")
    return missing.withColumn("island", F.col("chapter_no") - F.row_number().over(w)).groupBy("doc_id", "island").agg(
        F.min("chapter_no").alias("first_no"), F.max("chapter_no").alias("last_no")
    ).select("doc_id", "first_no", "last_no", F.concat(
        F.lit("補完_"), pad(F.col("first_no"), 3), F.lit("-"), pad(F.col("last_no"), 3)).alias("name"))


def dedupe_images(images: DataFrame) -> DataFrame:
    """First image per content within a document; empty data dropped.  An arg-min, combined map-side."""
    return images.filter("data IS NOT NULL AND octet_length(data) > 0").groupBy("doc_id", F.md5("data").alias("hash")).agg(
        F.min_by(F.struct("pos", "filename"), "pos").alias("first")).select("doc_id", "hash", "first.*")


def sequence_ids(outputs: DataFrame, order: Sequence[str]) -> DataFrame:
    """``m001`` … over all outputs."""
    return running_number(outputs, order, (), "seq").withColumn("id", F.concat(F.lit("m"), pad(F.col("seq"), 3)))


def current_failures(outcomes: DataFrame) -> DataFrame:
    """The newest outcome of each file decides; only failures stay.

    ``outcomes(path, at, status, error, category)``.
    """
    last = outcomes.groupBy("path").agg(F.max_by(F.struct("status", "error", "category"), F.col("at")).alias("o"))
    return last.select("path", "o.*").filter("status = 'failed'").drop("status")
