"""Row-wise decisions: routing, OCR need, file categories, results, page verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import patterns as P
from ..functions.text import blank, contains_any, let, lines, matches_any, strip

CHUNK_TRIGGER = 30_000

# Statuses, hints and messages of conversion results.
STATUSES = ("success", "requires_ocr", "failed")
OCR_HINTS = ("requires ocr", "ocr", "image", "画像", "スキャン", "scan")
OPENXML_EXT = (".xlsx", ".xlsm", ".xltx", ".xltm")
PASSWORD_EXT = (".xlsx", ".xls", ".xlsm", ".docx", ".doc", ".pptx", ".ppt")
CONTAINER_MESSAGES = {
    "openxml_password_protected": "Password-protected workbook detected (EncryptedPackage present). Please remove the password and retry.",
    "openxml_legacy_ole": "Workbook saved as legacy OLE container with .xlsx extension. Re-save as modern .xlsx before rerunning.",
    "openxml_invalid_container": "Invalid OpenXML container (not a ZIP archive). Re-save the workbook before rerunning.",
}


def is_excluded(
    name: Column, exact: Sequence[str] = (), parts: Sequence[str] = (), patterns: Sequence[str] = ()
) -> Column:
    """Exact name, substring, or pattern found anywhere."""
    hit = F.lit(False)
    if exact:
        hit = hit | name.isin(*exact)
    if parts:
        hit = hit | contains_any(name, parts)
    if patterns:
        hit = hit | matches_any(name, patterns)
    return hit


def is_table_heavy(text: Column) -> Column:
    """Sheet markers, or more than 30 % pipe lines."""
    ls = lines(text)
    pipes = F.size(F.filter(ls, lambda x: strip(x).startswith("|")))
    return (
        text.contains("**ファイル形式:** xls") | text.contains("## シート:") | (pipes / F.size(ls) > 0.3)
    )


def route_by_size(text: Column, trigger: int = CHUNK_TRIGGER) -> Column:
    return (
        F.when(F.length(text) < trigger, "single")
        .when(is_table_heavy(text), "sheet_chunks").otherwise("chunks")
    )


def classify_response(response: Column) -> Column:
    head = F.upper(strip(F.coalesce(response, F.lit(""))))
    return F.struct(
        head.startswith("SKIP").alias("is_skip"),
        head.startswith("SCREENSHOT_NEEDED").alias("needs_screenshot"),
        contains_any(F.lower(F.coalesce(response, F.lit(""))), P.DIAGRAM_WORDS).alias("has_diagram_words"),
    )


def page_needs_ocr(body: Column, threshold: int = 99_999, all_pages: bool = False) -> Column:
    return F.lit(all_pages) | (F.length(body) <= threshold)


def documents_need_ocr(pages: DataFrame, min_length: int = 100, n_pages: int = 3) -> DataFrame:
    """Per document of ``pages(doc_id, page_no, text, encrypted, size_bytes)``: too little text
    on the first pages, and the scan test by text or by bytes per page.

    Only the first pages carry text into the aggregate; the sums combine map-side.
    """
    first = F.col("page_no") <= n_pages
    head = F.when(first, F.col("text"))
    # Joined text without outer white space: white space counts inside, so the
    # stripped length follows from the ordered few first pages.
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(
        F.when(first, F.struct("page_no", "text")))), lambda r: r["text"]), "")
    grouped = pages.groupBy("doc_id").agg(
        F.coalesce(F.sum(F.length(head)), F.lit(0)).alias("raw_length"),
        F.length(strip(joined)).alias("stripped_length"),
        F.max("encrypted").alias("encrypted"),
        F.count("*").alias("n_pages"), F.max("size_bytes").alias("size_bytes"),
    )

    def too_little(limit: int) -> Column:
        return ~F.col("encrypted") & (F.col("raw_length") < limit) & (F.col("stripped_length") < limit)

    return grouped.select(
        "doc_id", too_little(min_length).alias("needs_ocr"),
        (too_little(50) | (F.col("size_bytes") / F.col("n_pages") > 500 * 1024)).alias("is_scanned"),
    )


def keep_page_image(width: Column, height: Column, least: int = 150) -> Column:
    return (width >= least) & (height >= least)


def fit_sheet_image(width: Column, height: Column, max_width: int, least: int = 50) -> Column:
    """NULL for tiny images, else the size after scaling to ``max_width``."""
    return F.when((width >= least) & (height >= least), F.struct(
        F.least(width, F.lit(max_width)).alias("width"),
        F.when(width > max_width, F.floor(height * max_width / width)).otherwise(height).cast("bigint").alias("height"),
    ))


def diagram_regions(
    drawings: DataFrame, page_width: float, page_height: float,
    min_objects: int = 8, min_area: float = 10_000, padding: float = 10,
) -> DataFrame:
    """Padded union box of the drawings of each page that looks like a diagram.

    ``drawings(doc_id, page_no, item_type, x0, y0, x1, y1)``.  Counts and
    bounds combine map-side, so a page with very many drawings is no hot group.
    """
    kind = F.col("item_type")
    pages = drawings.groupBy("doc_id", "page_no").agg(
        F.count("*").alias("n"), F.count_if(kind == "l").alias("n_lines"),
        F.count_if(kind == "re").alias("n_rects"), F.count_if(kind == "c").alias("n_curves"),
        F.min("x0").alias("bx0"), F.min("y0").alias("by0"), F.max("x1").alias("bx1"), F.max("y1").alias("by1"),
    )
    items = F.col("n_lines") + F.col("n_rects") + F.col("n_curves")
    rect_share = F.col("n_rects") / items
    is_diagram = (F.col("n_curves") >= 5) | ((F.col("n_lines") > 50) & (rect_share < 0.5))
    area = (F.col("bx1") - F.col("bx0")) * (F.col("by1") - F.col("by0"))
    return pages.filter(
        (F.col("n") >= min_objects) & (items > 0) & is_diagram
        & (area >= min_area) & (area <= page_width * page_height * 0.9)
    ).select(
        "doc_id", "page_no",
        F.greatest(F.col("bx0") - padding, F.lit(0.0)).alias("x0"),
        F.greatest(F.col("by0") - padding, F.lit(0.0)).alias("y0"),
        F.least(F.col("bx1") + padding, F.lit(page_width)).alias("x1"),
        F.least(F.col("by1") + padding, F.lit(page_height)).alias("y1"),
    )


def extension_of(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def _hex_head(content: Column, n: int) -> Column:
    return F.hex(F.substring(content, 1, n))


OLE_MAGIC = "D0CF11E0A1B11AE1"


def classify_container(path: Column, content: Column) -> Column:
    """NULL for a sound package or another kind of file, else the defect of the container."""
    marked = F.contains(content, F.lit(b"EncryptedPackage")) | F.contains(content, F.lit(b"Encrypted Summary"))
    return (
        F.when(~extension_of(path).isin(*OPENXML_EXT) | (_hex_head(content, 2) == "504B"), F.lit(None).cast("string"))
        .when(_hex_head(content, 8) != OLE_MAGIC, "openxml_invalid_container")
        .when(marked, "openxml_password_protected").otherwise("openxml_legacy_ole")
    )


def container_message(classification: Column) -> Column:
    messages = F.create_map(*[F.lit(x) for pair in CONTAINER_MESSAGES.items() for x in pair])
    return F.when(classification.isNotNull(), F.coalesce(
        messages[classification], F.lit("Unable to process workbook due to unsupported container format.")))


def detect_password(path: Column, content: Column) -> Column:
    """An OLE header on a new-style workbook that is no package; lock files never."""
    name = F.regexp_extract(path, "([^/]*)$", 1)
    ext = extension_of(path)
    return (
        ext.isin(*PASSWORD_EXT) & ~name.startswith("~$") & ext.isin(".xlsx", ".xlsm")
        & (_hex_head(content, 8) == OLE_MAGIC)
    )


def detect_mime(content: Column) -> Column:
    return (
        F.when(_hex_head(content, 8) == "89504E470D0A1A0A", "image/png")
        .when(_hex_head(content, 3) == "FFD8FF", "image/jpeg")
        .when(_hex_head(content, 6).isin("474946383761", "474946383961"), "image/gif")
        .when((_hex_head(content, 4) == "52494646") & (F.hex(F.substring(content, 9, 4)) == "57454250"), "image/webp")
        .otherwise("image/png")
    )


def categorize_file(
    name: Column, ext: Column, has_password: Column, in_ocr_list: Column, has_text: Column
) -> Column:
    """Ordered rules; an existing text then overrides OCR and password."""
    convertible, legacy = ext.isin(*P.EXT_CONVERTIBLE), ext.isin(*P.EXT_LEGACY)
    base = (
        F.when(ext.isin(*P.EXT_EXCLUDED) | name.startswith("~$"), "other_excluded")
        .when(has_password, "password_protected")
        .when((ext == ".pdf") & in_ocr_list, "requires_ocr")
        .when(ext.isin(*P.EXT_IMAGE), "requires_ocr")
        .when(ext.isin(".ppt", ".pptx") & ~has_text, "requires_ocr")
        .when(legacy, "requires_libre").when(convertible, "convertible_as_is")
        .otherwise("other_excluded")
    )
    return let(base, lambda c: (
        F.when(has_text & (c == "requires_ocr") & (ext == ".pdf"), "convertible_as_is")
        .when(has_text & (c == "password_protected") & legacy, "requires_libre")
        .when(has_text & (c == "password_protected") & convertible, "convertible_as_is")
        .otherwise(c)
    ))


def normalise_result(ext: Column, raw_status: Column, raw_text: Column, raw_message: Column) -> Column:
    """One (status, text, message) contract for every converter answer."""
    lowered = F.lower(strip(F.coalesce(raw_status, F.lit(""))))
    status0 = F.when(lowered.isin("true", *STATUSES), F.when(lowered == "true", "success").otherwise(lowered)).otherwise("failed")
    message0 = strip(F.coalesce(raw_message, F.lit("")))

    def finish(s: Column) -> Column:
        empty = (s["status"] == "success") & blank(raw_text)
        slides, to_ocr = ext.isin(".ppt", ".pptx"), ext.isin(".pdf", ".ppt", ".pptx") | contains_any(
            F.lower(s["message"]), OCR_HINTS)
        status = F.when(empty & to_ocr, "requires_ocr").when(empty, "failed").otherwise(s["status"])
        silent = s["message"] == ""
        message = (
            F.when(~silent, s["message"])
            .when(empty & to_ocr & slides, "PowerPoint with empty text requires OCR")
            .when(empty & to_ocr, "Image-based PDF detected during normalisation")
            .when(empty, "Converter returned empty text")
            .when(status == "requires_ocr", "Marked as requires_ocr")
            .when(status == "failed", "Conversion failed").otherwise("")
        )
        return F.struct(
            status.alias("status"), F.when(status == "success", raw_text).alias("text"), message.alias("message"))

    return let(F.struct(status0.alias("status"), message0.alias("message")), finish)


def is_transient(message: Column) -> Column:
    return contains_any(F.lower(message), P.TRANSIENT)


def next_page_status(attempts: DataFrame, max_attempts: int = 3, error_width: int = 240) -> DataFrame:
    """Status after the last attempt of each page; ``error`` up to a display width, ``whole_error`` as it was.

    ``attempts(page_id, deep_link, attempt, ok, pdf_path, error)``.  The last
    attempt is an arg-max with map-side combine, not a sort of all attempts.
    """
    last = attempts.groupBy("page_id").agg(F.max_by(
        F.struct("deep_link", "attempt", "ok", "pdf_path", "error"), F.col("attempt")).alias("a")
    ).select("page_id", "a.*")
    no_link = F.coalesce(F.col("deep_link"), F.lit("")) == ""
    again = (F.col("attempt") < max_attempts) & is_transient(F.col("error"))
    return last.select(
        "page_id",
        F.when(no_link, "error").when(F.col("ok"), "done").when(again, "retry").otherwise("error").alias("status"),
        F.when(~no_link & F.col("ok"), F.col("pdf_path")).alias("pdf_path"),
        F.when(no_link, "deep_link missing").when(~F.col("ok"), F.substring("error", 1, error_width)).alias("error"),
        F.when(~F.col("ok"), F.col("error")).alias("whole_error"),
    )


def run_mode(base: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: ``update`` if a ledger or documents exist, else ``new``; reads one row of each at most."""
    some = base.limit(1).select(F.lit(1)).unionAll(ledger.limit(1).select(F.lit(1)))
    return some.agg(F.when(F.count("*") > 0, "update").otherwise("new").alias("mode"))


def pdf_verdict(present: Column, size_kb: Column, white_ratio: Column, text_chars: Column) -> Column:
    return (
        F.when(~present, "MISSING").when(size_kb < 5, "TINY")
        .when((white_ratio > 0.90) & (text_chars > 30), "WHITE_BOX")
        .when((white_ratio > 0.95) & (text_chars <= 30), "EMPTY").otherwise("CLEAN")
    )
