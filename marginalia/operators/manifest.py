"""Page manifests: pending pages, duplicates, checks, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from .numbering import running_number
from .structure import decode_deep_link

BAD_VERDICTS = ("WHITE_BOX", "EMPTY", "TINY")


def pending_pages(pages: DataFrame, order: Sequence[str], retry: bool = False, limit: int | None = None) -> DataFrame:
    """Pages still to fetch with a running number from 1; ``limit`` is the caller's batch size."""
    wanted = pages.filter(F.col("status") == "retry" if retry else ~F.col("status").eqNullSafe("done"))
    numbered = running_number(wanted, order, (), "seq")
    return numbered if limit is None else numbered.filter(F.col("seq") <= limit)


def dedupe_pages(links: DataFrame, order: str) -> DataFrame:
    """First link per (section, page); links of another section or without page id are dropped."""
    decoded = links.withColumn("w", decode_deep_link(F.col("deep_link"))).select(*links.columns, "w.*")
    right = F.col("section_name").isNull() | (F.col("section_name") == F.col("section"))
    return decoded.filter(right & F.col("page_guid").isNotNull()).groupBy("section", "page_guid").agg(
        F.min_by(F.struct(order, "page_title", "section_guid", "deep_link"), order).alias("p")
    ).select("section", "page_guid", "p.*")


def manifest_and_files(done: DataFrame, files: DataFrame) -> DataFrame:
    """Done pages, and files the manifest does not know by name."""
    name = F.substring_index("pdf_path", "/", -1)
    known = done.select("section", "title", "pdf_path", name.alias("pdf_name"))
    extra = files.select("pdf_path", name.alias("pdf_name")).join(known.select("pdf_name").distinct(), "pdf_name", "left_anti")
    title = F.regexp_replace("pdf_name", r"\.[^.]*$", "")
    return known.unionByName(extra.select(F.lit("").alias("section"), title.alias("title"), "pdf_path", "pdf_name"))


def mark_retry(pages: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Done pages with a bad file become ``retry``."""
    bad = verdicts.filter(F.col("verdict").isin(*BAD_VERDICTS)).select(
        F.substring_index("pdf_path", "/", -1).alias("pdf_name"), F.lit(True).alias("bad")).distinct()
    named = pages.withColumn("pdf_name", F.substring_index("pdf_path", "/", -1))
    marked = F.col("bad") & (F.col("status") == "done")
    return named.join(bad, "pdf_name", "left").withColumn(
        "status", F.when(marked, "retry").otherwise(F.col("status"))).select(*pages.columns)


def nest_sections(pages: DataFrame, order: str, per_chunk: int = 10_000) -> DataFrame:
    """Pages back to nested section rows; a very large section comes in several chunks,
    so that no task holds a section whole."""
    numbered = running_number(pages, [order], ["section"], "page_no")
    chunk = F.floor((F.col("page_no") - 1) / per_chunk)
    fields = [c for c in pages.columns if c != "section"]
    return numbered.withColumn("chunk", chunk).groupBy("section", "chunk").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("page_no", F.struct(*fields).alias("page")))),
                    lambda r: r["page"]).alias("pages"))


def verdict_summary(verdicts: DataFrame) -> DataFrame:
    """Counts per verdict, and the share of bad ones (a missing file counts as an error)."""
    v = F.col("verdict")
    kinds = ("CLEAN", "WHITE_BOX", "EMPTY", "TINY")
    out = verdicts.agg(
        F.count("*").alias("total"), *[F.count_if(v == k).alias(k.lower()) for k in kinds],
        F.count_if(v.isin("MISSING", "ERROR")).alias("error"))
    bad = F.col("white_box") + F.col("empty") + F.col("tiny") + F.col("error")
    return out.withColumn("bad", bad).withColumn(
        "bad_pct", F.when(F.col("total") > 0, F.col("bad") / F.col("total") * 100).otherwise(0.0))


def sample_pages(done: DataFrame, sizes: DataFrame, order: str, n: int = 5) -> DataFrame:
    """The middle page of each section, then the smallest and the largest files, each file once.

    The middle needs a number per section (hot sections are numbered by range
    partition); the extremes are two top-n sorts.
    """
    numbered = running_number(done, [order], ["section"], "k")
    counts = done.groupBy("section").agg(F.count("*").alias("n_pages"))
    middle = numbered.join(counts, "section").filter(F.col("k") == F.floor(F.col("n_pages") / 2) + 1).select(
        "pdf_path", F.lit("sample").alias("label"), F.lit(0).alias("priority"))
    smallest = sizes.orderBy("size_kb", "pdf_path").limit(n).select(
        "pdf_path", F.lit("smallest").alias("label"), F.lit(1).alias("priority"))
    largest = sizes.orderBy(F.desc("size_kb"), F.desc("pdf_path")).limit(n).select(
        "pdf_path", F.lit("largest").alias("label"), F.lit(2).alias("priority"))
    return middle.unionByName(smallest).unionByName(largest).groupBy("pdf_path").agg(
        F.min_by("label", "priority").alias("label"))
