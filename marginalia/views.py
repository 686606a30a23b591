"""Input tables of the registered queries, derived by Spark from the given tables.

Every view covers its whole source table; the same rules are spelled for
DuckDB in ``catalog/sqlviews.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .functions.text import anchor, let, lines

PAGE_OFFSET = 1_000_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan over as many partitions as the session asks for; by default they stay where they are.

    Only a session over small test files, which one task would read, sets ``marginalia.scan.partitions``.
    """
    wanted = df.sparkSession.conf.get("marginalia.scan.partitions", None)
    return df.repartition(int(wanted)) if wanted else df


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "lang", "source", "text")


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw pages as plain documents: one line per paragraph."""
    pages = table(spark, folder, "pages")
    return pages.select(
        (F.col("page_id") + PAGE_OFFSET).alias("doc_id"),
        F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"),
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("source"),
        F.array_join(
            F.regexp_extract_all("html", F.lit("<p>([^<]+)"), F.lit(1)), "\n"
        ).alias("text"),
    )


def _head(line: Column) -> Column:
    return F.array_join(F.slice(F.split(line, " ", -1), 1, 3), " ")


def _s(c: Column) -> Column:
    return c.cast("string")


def _markdown_lines(text: Column, doc_id: Column, n_docs: Column, revised: bool) -> Column:
    lit, cat, arr = F.lit, F.concat, F.array
    none = F.array().cast("array<string>")

    def dropped(divisor: int, kept: Column, lost: Column = none) -> Column:
        return F.when(doc_id % divisor == 0, lost).otherwise(kept) if revised else kept

    def one(all_lines: Column, line: Column, idx: Column) -> Column:
        i = idx + 1
        r = (i + doc_id) % 7
        w = _head(line)
        other = (doc_id * 7 + i) % (n_docs + 40)
        back = _head(F.get(all_lines, idx - 4))
        self_link = F.when(
            i >= 5, cat(lit("#"), anchor(cat(_s(i - 4), lit(". "), back)))
        ).otherwise(lit("#none"))
        tail = F.when(doc_id % 11 == 0, lit(" (rev)")).otherwise(lit("")) if revised else lit("")
        # Some revised documents rename one or all sections, and some add one or many.
        renamed = (doc_id % 13 == 0) | ((doc_id % 5 == 0) & i.between(29, 35))
        number = cat(_s(i), F.when(renamed, lit("b. ")).otherwise(lit(". "))) if revised else cat(_s(i), lit(". "))
        added = doc_id % 17 == 0
        fresh = cat(lit("### Neu "), _s(i))
        business = F.when(doc_id % 23 == 0, lit("見積業務、")).otherwise(lit(""))
        # Lines that a revision may leave out.
        furniture = F.when(doc_id % 19 == 0, arr(
            lit("![表紙](images/img_2.png)"), cat(lit("作成日：2024-01-01 "), w), cat(lit("図の説明："), w))).otherwise(none)
        table_row = arr(cat(lit("| "), _s(i), lit(" | "), _s(F.length(line)), lit(" |")))
        table_head = arr(lit("| a | b |"), lit("|---|---|"))
        return (
            F.when(i == 1, F.concat(arr(
                cat(lit("# "), w), lit(""), lit("## サマリー"), cat(lit("- "), business, line), lit(""),
                lit("---"), lit(""), lit("## 目次"), lit(""), lit("---"), lit("")), none if revised else furniture))
            .when(r == 0, arr(F.when(added, fresh).otherwise(cat(lit("### "), number, w)) if revised else cat(lit("### "), number, w), line))
            .when(r == 1, dropped(3, arr(F.when(added & (i % 2 == 0), fresh).otherwise(
                cat(lit("#### "), _s(i), lit(".1 "), w)) if revised else cat(lit("#### "), _s(i), lit(".1 "), w), line), arr(line)))
            .when(r == 2, F.concat(
                table_head,
                F.when(i % 2 == 1, dropped(5, table_row)).otherwise(table_row)))
            .when(r == 3, dropped(2, arr(cat(lit("> "), line))))
            .when((r == 4) & (i % 3 == 0), arr(cat(lit("["), w, lit("]("), self_link, lit(")"))))
            .when((r == 4) & (i % 3 == 1), arr(
                cat(lit("["), w, lit("](doc_"), _s(other), lit(".md#no-such)"))))
            .when(r == 4, arr(cat(lit("["), w, lit("](doc_"), _s(other), lit(".md)"))))
            .when(r == 5, arr(cat(lit("!["), w, lit("](images/img_"), _s(i), lit(".png)"))))
            .otherwise(F.when((doc_id % 5 == 1) & i.between(15, 21), arr(fresh, line)).otherwise(arr(cat(line, tail))) if revised else arr(cat(line, tail)))
        )

    built = let(
        lines(text), lambda all_lines: F.flatten(
            F.transform(all_lines, lambda line, idx: one(all_lines, line, idx)))
    )
    if not revised:
        return built
    return let(built, lambda b: F.when(
        doc_id % 7 == 0, F.slice(b, 1, F.floor(F.size(b) / 2).cast("int"))
    ).otherwise(b))


def _category(lang: Column) -> Column:
    return (
        F.when(lang == "de", "01_de").when(lang == "en", "02_en")
        .when(lang == "es", "03_es").when(lang == "fr", "04_fr").otherwise("05_other")
    )


def markdown(docs: DataFrame, revised: bool = False) -> DataFrame:
    n_docs = docs.agg((F.max("doc_id") + 1).alias("n_docs")).scalar()
    name = F.concat("source", F.lit("-"), _s(F.col("doc_id")))
    category = _category(F.col("lang"))
    return docs.withColumn("n_docs", n_docs).select(
        "doc_id", "lang", "source",
        name.alias("name"),
        category.alias("category"),
        F.concat(F.lit("doc_"), _s(F.col("doc_id")), F.lit(".md")).alias("path"),
        F.concat(
            category, F.lit("/"), F.format_string("%02d", F.col("doc_id") % 12),
            F.lit("_"), name, F.lit(".md"),
        ).alias("kb_path"),
        F.array_join(
            _markdown_lines(F.col("text"), F.col("doc_id"), F.col("n_docs"), revised), "\n"
        ).alias("text"),
    )


def md_docs(spark: SparkSession, folder: str) -> DataFrame:
    return markdown(documents(spark, folder))


def md_docs_v2(spark: SparkSession, folder: str) -> DataFrame:
    return markdown(documents(spark, folder), revised=True)


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """Each document before and after: (doc_id, name, before, after)."""
    docs = documents(spark, folder)
    n_docs = docs.agg((F.max("doc_id") + 1).alias("n_docs")).scalar()
    text, key, n = F.col("text"), F.col("doc_id"), F.col("n_docs")
    return docs.withColumn("n_docs", n_docs).select(
        "doc_id",
        F.concat("source", F.lit("-"), _s(key)).alias("name"),
        F.array_join(_markdown_lines(text, key, n, False), "\n").alias("before"),
        F.array_join(_markdown_lines(text, key, n, True), "\n").alias("after"),
    )


def page_docs(spark: SparkSession, folder: str) -> DataFrame:
    return markdown(page_texts(spark, folder))


def incoming_docs(spark: SparkSession, folder: str) -> DataFrame:
    """New documents: the revised version of every document, and every page."""
    return md_docs_v2(spark, folder).unionByName(page_docs(spark, folder))


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """Image files of the base: even numbers up to the longest document."""
    longest = documents(spark, folder).agg(F.max(F.size(lines(F.col("text")))).alias("n"))
    return longest.select(
        F.explode(F.sequence(F.lit(2), F.greatest(F.col("n"), F.lit(2)), F.lit(2))).alias("i")
    ).select(F.concat(F.lit("images/img_"), _s(F.col("i")), F.lit(".png")).alias("path"))


EXTENSIONS = (
    ".pdf", ".xlsx", ".xls", ".xlsm", ".docx", ".doc", ".pptx", ".ppt", ".png", ".JPG", ".zip", ".txt",
)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """A file listing: pages as files with an extension by page number."""
    k = F.col("page_id")
    ext = F.array(*[F.lit(e) for e in EXTENSIONS])[(k % len(EXTENSIONS)).cast("int")]
    stem = F.concat(F.when(k % 25 == 0, F.lit("~$")).otherwise(F.lit("")), F.lit("file_"), _s(k))
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    base = F.concat(host, F.lit("/"), stem)
    return table(spark, folder, "pages").select(
        "page_id",
        F.concat(base, ext).alias("path"),
        base.alias("stem_path"),
        F.lower(ext).alias("ext"),
        F.octet_length("html").cast("bigint").alias("size_bytes"),
        F.timestamp_seconds(F.lit(1_704_067_200) + k * 61).alias("modified"),
        (k % 3 == 0).alias("has_text"),
        (k % 5 == 0).alias("in_ocr_list"),
        (k % 4 == 0).alias("has_json"),
        (k % 10 == 0).alias("in_excluded_list"),
        (k % 17 == 0).alias("has_password"),
    )


def dealt(docs: DataFrame, size: int = 16 << 20) -> DataFrame:
    """Documents dealt over tasks of about ``size`` bytes of text, so that a task can sort all words of its texts in memory."""
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return docs.repartition(max(1, -(-n_bytes // size)), "doc_id")


def _words(docs: DataFrame) -> DataFrame:
    words = F.split("text", " ", -1)
    return docs.select("doc_id", words.alias("w"), F.size(words).alias("n"))


def _term_list() -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.col("n")),
        lambda i: F.struct(
            F.lower(F.get(F.col("w"), i - 1)).alias("term"),
            F.array_join(F.slice(F.col("w"), i + 1, F.lit(5)), " ").alias("description"),
        ),
    )


def _flag() -> Column:
    return F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0).alias("flag")


def term_lists(docs: DataFrame) -> DataFrame:
    """The terms of a document in order: each word with the five words behind it."""
    return _words(docs).select("doc_id", _term_list().alias("terms"), _flag())


def terms(spark: SparkSession, folder: str) -> DataFrame:
    """Term rows; aggregates that keep a text sort them before they combine, so the documents are dealt."""
    docs = dealt(documents(spark, folder).select("doc_id", "text"))
    return _words(docs).select("doc_id", F.posexplode(_term_list()).alias("pos", "t")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "t.term", "t.description", _flag())


def converter_results(spark: SparkSession, folder: str) -> DataFrame:
    """Raw converter outcomes: status by event type, text NULL / blank / present."""
    k = F.col("event_id")
    ext = F.array(*[F.lit(e) for e in (".pdf", ".xlsx", ".docx", ".pptx", ".ppt")])[(k % 5).cast("int")]
    return table(spark, folder, "events").select(
        "event_id", "user_id", "ts",
        F.concat(F.lit("file_"), _s(F.col("user_id")), ext).alias("path"),
        ext.alias("ext"),
        F.when(F.col("event_type") == "view", "success")
        .when(F.col("event_type") == "click", " SUCCESS ")
        .when(F.col("event_type") == "purchase", "requires_ocr")
        .when(F.col("event_type") == "error", "failed").otherwise(F.col("event_type")).alias("raw_status"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).when(k % 3 == 1, F.lit("  "))
        .otherwise(F.col("props")).alias("raw_text"),
        F.when(k % 4 == 0, F.lit(None).cast("string"))
        .when(k % 4 == 1, F.lit(" Needs OCR now "))
        .when(k % 4 == 2, F.lit("Request TIMED OUT")).otherwise(F.lit("")).alias("raw_message"),
        F.col("value").alias("seconds"),
    )


STATUSES = ("pending", "done", "error", "retry")


def page_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of a notebook: section = host, encoded deep link, status by number."""
    k = F.col("page_id")
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    link = F.concat(
        F.lit("https://notes.example/view?id=1&wd=target%28"), host, F.lit(".one%7Csec-"), host,
        F.lit("%2FTitle%20no+"), _s(k), F.lit("%7Cguid-"), _s(F.floor(k / 2)), F.lit("%2F%29&x=1"),
    )
    return table(spark, folder, "pages").select(
        "page_id",
        host.alias("section"),
        F.concat(F.lit("Title "), _s(k)).alias("title"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 0, F.concat(F.lit("https://notes.example/view?wd=plain%20"), _s(k)))
        .otherwise(link).alias("deep_link"),
        F.array(*[F.lit(s) for s in STATUSES])[(k % 4).cast("int")].alias("status"),
        F.concat(F.lit("pdf/"), host, F.lit("/page_"), _s(k), F.lit(".pdf")).alias("pdf_path"),
    )


def page_features(spark: SparkSession, folder: str) -> DataFrame:
    """Measured features of printed pages; every 19th file is missing."""
    k = F.col("page_id")
    return table(spark, folder, "pages").select(
        "page_id",
        F.concat(
            F.lit("pdf/"), F.regexp_extract("url", "^https?://([^/]+)", 1),
            F.lit("/page_"), _s(k), F.lit(".pdf")).alias("pdf_path"),
        (k % 19 != 0).alias("present"),
        (F.octet_length("html") / 1024.0 * (k % 9)).alias("size_kb"),
        ((k * 37 % 100) / 100.0).alias("white_ratio"),
        (k * 13 % 80).alias("text_chars"),
    )
