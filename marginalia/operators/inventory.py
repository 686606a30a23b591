"""Joins and aggregates over file tables: inventory, ledgers, statistics, glossary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import strip
from .classify import STATUSES, categorize_file


def skip_processed(docs: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """What the ledger does not have yet, decided before any content is read."""
    return docs.join(ledger.select(key).distinct(), key, "left_anti")


def retry_failed(listing: DataFrame, failed: DataFrame) -> DataFrame:
    return listing.join(failed.select("path").distinct(), "path", "left_semi")


def inventory(
    files: DataFrame, texts: DataFrame, originals: DataFrame, ocr: DataFrame, excluded: DataFrame, prefix: str
) -> DataFrame:
    """Each file with its category, flags, OCR status and time of change: ``files(path, stem_path, ext, size_bytes, modified, has_password)``.

    All four side tables are lists of paths that grow with the files, so none
    is forced to broadcast; AQE does it where the measured size allows.
    """
    def flag(paths: DataFrame, key: str, name: str) -> DataFrame:
        return paths.select(F.col("path").alias(key)).distinct().withColumn(name, F.lit(True))

    joined = (
        files.withColumn("text_path", F.concat("stem_path", F.lit(".txt")))
        .withColumn("prefixed_path", F.concat(F.lit(prefix + "/"), "path"))
        .join(flag(texts, "text_path", "t"), "text_path", "left")
        .join(flag(originals, "path", "j1"), "path", "left")
        .join(flag(originals, "prefixed_path", "j2"), "prefixed_path", "left")
        .join(flag(ocr, "path", "o"), "path", "left")
        .join(flag(excluded, "path", "x"), "path", "left")
    )
    raw_text, raw_json = F.col("t").isNotNull(), F.col("j1").isNotNull() | F.col("j2").isNotNull()
    category = categorize_file(
        F.substring_index("path", "/", -1), F.col("ext"), F.col("has_password"), F.col("o").isNotNull(), raw_text)
    return joined.select(
        F.col("path").alias("relative_path"), "prefixed_path", "size_bytes",
        F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ss").alias("mtime_iso"), "ext", category.alias("category"),
        raw_text.alias("raw_text"), raw_json.alias("raw_json"), F.col("x").isNotNull().alias("is_excluded"),
    ).withColumn("ocr_status", F.when(F.col("category") == "requires_ocr", F.when(F.col("raw_json"), "done")
                 .when(F.col("is_excluded"), "excluded").otherwise("pending")).otherwise("")).drop("is_excluded")


def inventory_summary(rows: DataFrame, failed: DataFrame) -> DataFrame:
    """Counts per category and the totals, as (item, n)."""
    totals = rows.agg(
        F.count("*").alias("total"), F.count_if("raw_text").alias("raw_text"), F.count_if("raw_json").alias("raw_json"))
    items = totals.unpivot([], ["total", "raw_text", "raw_json"], "item", "n")
    per = rows.groupBy(F.concat(F.lit("category:"), "category").alias("item")).agg(F.count("*").alias("n"))
    return items.unionByName(per).unionByName(failed.agg(F.lit("failed").alias("item"), F.count("*").alias("n")))


def category_stats(base: DataFrame) -> DataFrame:
    """Files and characters per category, with a total row (category NULL)."""
    return base.rollup("category").agg(
        F.count("*").alias("n_files"), F.sum(F.length("text")).alias("n_chars"))


def glossary(terms: DataFrame, *order: str) -> DataFrame:
    """One row per term: the longest description (first on ties), review flag only if none clears it.

    Both are aggregates that combine map-side; a term of a third of all rows is
    reduced before the shuffle.
    """
    named = terms.withColumn("term", strip(F.col("term"))).filter("term <> ''")
    size = F.length(F.coalesce("description", F.lit("")))
    rank = F.struct(size.alias("len"), *[(-F.col(c)).alias(c) for c in order])
    return named.groupBy("term").agg(
        F.max_by("description", rank).alias("description"), F.min(F.coalesce("flag", F.lit(1))).alias("flag"))


def action_summary(actions: DataFrame) -> DataFrame:
    """Counts of create, update (with partial) and skip; the excluded apart; zero-filled."""
    kind = F.when(F.col("is_excluded"), "excluded").when(
        F.col("action") == "partial", "update").otherwise(F.col("action"))
    counted = actions.agg(*[F.count_if(kind == k).alias(k) for k in ("create", "update", "skip", "excluded")])
    return counted.unpivot([], ["create", "update", "skip", "excluded"], "action", "n")


def run_statistics(results: DataFrame, total: int | None = None) -> DataFrame:
    """One row of counts, shares and the mean time; ``processed`` counts distinct files."""
    counts = results.agg(
        F.count_distinct("path").alias("files"), F.count("*").alias("n"),
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES], F.round(F.avg("seconds"), 2).alias("mean_seconds"))
    accounted = F.col("success") + F.col("requires_ocr") + F.col("failed")
    out = counts.withColumn("total", F.col("n")).withColumn("processed", F.greatest("files", accounted)).withColumn(
        "skipped", F.greatest(F.col("processed") - accounted, F.lit(0)))
    share = {f"{s}_pct": F.when(F.col("total") > 0, F.col(s) / F.col("total") * 100).otherwise(0.0) for s in STATUSES}
    return out.withColumns(share).drop("n", "files")


def plan_statistics(plan: DataFrame) -> DataFrame:
    """Counts over plan rows ``(category, file, n_sources, is_split)``."""
    return plan.agg(
        F.count_distinct("category").alias("categories"), F.count("*").alias("files"),
        F.count_if("is_split").alias("split_files"), F.count_if(F.col("n_sources") > 1).alias("merged_files"))


def merge_size_gate(sources: DataFrame, limit: int = 80_000) -> DataFrame:
    """Per output: joined size of its sources and whether they are only concatenated."""
    return sources.groupBy("output").agg(
        F.sum(F.length("text")).alias("n_chars"), F.count("*").alias("n_sources")
    ).withColumn("mode", F.when(F.col("n_chars") > limit, "concatenate").otherwise("rewrite"))


def split_over_limit(sources: DataFrame, limit: int = 80_000) -> DataFrame:
    """An output over the limit with several sources becomes one output per source.

    The decision table has one row per output; joining it back keeps hot
    outputs splittable by AQE.
    """
    gate = merge_size_gate(sources, limit).select("output", "n_chars", "n_sources")
    over = (F.col("n_chars") > limit) & (F.col("n_sources") > 1)
    return sources.select("output", "source").join(gate, "output").select(
        F.when(over, F.concat("output", F.lit("/"), "source")).otherwise(F.col("output")).alias("output"), "source")
