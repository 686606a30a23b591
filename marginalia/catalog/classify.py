"""Routing, OCR need, file categories, converter results and page verdicts."""

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import classify as C
from ..views import converter_results, documents, files, md_docs, page_features, page_manifest, table
from . import sqlviews as Q
from .registry import query

SP = P.SPACE


def _in(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


@query(
    "exclude_documents", "doc_id:l name:s",
    """SELECT doc_id, name FROM md_docs WHERE NOT (name IN ('src1-1', 'src2-2') OR contains(name, 'src13')
      OR contains(name, '-77') OR regexp_matches(name, '^src[0-4]-[0-9]*5$'))""",
)
def _(spark, d):
    hit = C.is_excluded(F.col("name"), ["src1-1", "src2-2"], ["src13", "-77"], ["^src[0-4]-[0-9]*5$"])
    return md_docs(spark, d).filter(~hit).select("doc_id", "name")


_HEAVY = f"""(contains(text, '**ファイル形式:** xls') OR contains(text, '## シート:')
  OR len(list_filter(string_split(text, chr(10)), lambda x: starts_with({Q.strip('x')}, '|')))::DOUBLE / len(string_split(text, chr(10))) > 0.3::DOUBLE)"""


@query("is_table_heavy", "doc_id:l heavy:b", f"SELECT doc_id, {_HEAVY} AS heavy FROM md_docs")
def _(spark, d):
    return md_docs(spark, d).select("doc_id", C.is_table_heavy(F.col("text")).alias("heavy"))


@query(
    "route_by_size", "doc_id:l route:s",
    f"SELECT doc_id, CASE WHEN length(text) < 30000 THEN 'single' WHEN {_HEAVY} THEN 'sheet_chunks' ELSE 'chunks' END AS route FROM long_docs",
)
def _(spark, d):
    return long_docs(spark, d).select("doc_id", C.route_by_size(F.col("text")).alias("route"))


def long_docs(spark, d):
    """Markdown documents, every one repeated up to 60 000 characters if it mentions a table often."""
    n = F.when(F.col("doc_id") % 10 == 0, F.ceil(F.lit(60000) / F.greatest(F.length("text"), F.lit(1)))).otherwise(1)
    return md_docs(spark, d).select("doc_id", "name", F.expr("text").alias("t"), n.cast("int").alias("n")).select(
        "doc_id", "name", F.array_join(F.array_repeat("t", F.col("n")), "\n").alias("text"))


Q.VIEWS["long_docs"] = """SELECT doc_id, name, CASE WHEN doc_id % 10 = 0 THEN
    array_to_string(list_transform(range(ceil(60000::DOUBLE / greatest(length(text), 1))::BIGINT), lambda i: text), chr(10))
    ELSE text END AS text FROM md_docs"""


@query(
    "classify_response", "conv_id:l turn:l is_skip:b needs_screenshot:b has_diagram_words:b",
    f"""SELECT conv_id, turn, starts_with(u, 'SKIP') AS is_skip, starts_with(u, 'SCREENSHOT_NEEDED') AS needs_screenshot,
      regexp_matches(lower(r), '{"|".join(P.DIAGRAM_WORDS)}') AS has_diagram_words
      FROM (SELECT *, upper({Q.strip('r')}) AS u FROM (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN ' skip ' || text
        WHEN 1 THEN chr(10) || 'Screenshot_needed: ' || text WHEN 2 THEN text || ' フロー' ELSE text END AS r FROM conversations))""",
)
def _(spark, d):
    t = F.col("turn")
    r = (F.when(t % 4 == 0, F.concat(F.lit(" skip "), "text")).when(t % 4 == 1, F.concat(F.lit("\nScreenshot_needed: "), "text"))
         .when(t % 4 == 2, F.concat("text", F.lit(" フロー"))).otherwise(F.col("text")))
    return table(spark, d, "conversations").select("conv_id", "turn", C.classify_response(r).alias("c")).select(
        "conv_id", "turn", "c.*")


@query(
    "needs_ocr", "doc_id:l needs_ocr:b is_scanned:b",
    f"""SELECT doc_id, NOT enc AND raw < 100 AND len_stripped < 100 AS needs_ocr,
      (NOT enc AND raw < 50 AND len_stripped < 50) OR size / n > 512000 AS is_scanned
      FROM (SELECT conv_id AS doc_id, coalesce(sum(length(text)) FILTER (WHERE turn < 3), 0) AS raw,
        length({Q.strip("coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE turn < 3), '')")}) AS len_stripped,
        bool_or(conv_id % 7 = 0) AS enc, count(*) AS n, max(conv_id * 20000)::DOUBLE AS size FROM conversations GROUP BY conv_id)""",
)
def _(spark, d):
    pages = table(spark, d, "conversations").select(
        F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).alias("page_no"), "text",
        (F.col("conv_id") % 7 == 0).alias("encrypted"), (F.col("conv_id") * 20000).alias("size_bytes"))
    return C.documents_need_ocr(pages)


@query(
    "filter_images", "p_partkey:l keep_page:b width:l height:l",
    """SELECT p_partkey, w >= 150 AND h >= 150 AS keep_page, CASE WHEN ok THEN least(w, 800) END AS width,
      CASE WHEN ok THEN CASE WHEN w > 800 THEN floor(h * 800::DOUBLE / w) ELSE h END END AS height
      FROM (SELECT *, w >= 50 AND h >= 50 AS ok FROM (SELECT p_partkey, p_partkey * 37 % 1500 AS w, p_size * 9 AS h FROM part))""",
)
def _(spark, d):
    w, h = F.col("p_partkey") * 37 % 1500, F.col("p_size") * 9
    fit = C.fit_sheet_image(w, h, 800)
    return table(spark, d, "part").select(
        "p_partkey", C.keep_page_image(w, h).alias("keep_page"), fit["width"].alias("width"), fit["height"].alias("height"))


def drawings(spark, d):
    q = F.col("l_quantity")
    x0, y0 = q * 7 % 500, F.col("l_extendedprice") % 600
    return table(spark, d, "lineitem").select(
        (F.col("l_partkey") % 50).alias("doc_id"), (F.col("l_linenumber") % 3).alias("page_no"),
        F.when(q < 10, "c").when(q < 30, "l").otherwise("re").alias("item_type"),
        x0.alias("x0"), y0.alias("y0"), (x0 + q).alias("x1"), (y0 + q * 2).alias("y1"))


@query(
    "diagram_regions", "doc_id:l page_no:l x0:d y0:d x1:d y1:d",
    """SELECT doc_id, page_no, greatest(a0 - 10, 0) AS x0, greatest(b0 - 10, 0) AS y0, least(a1 + 10, 595) AS x1, least(b1 + 10, 842) AS y1
      FROM (SELECT doc_id, page_no, count(*) AS n, count(*) FILTER (WHERE t = 'l') AS nl, count(*) FILTER (WHERE t = 're') AS nr,
          count(*) FILTER (WHERE t = 'c') AS nc, min(x0) AS a0, min(y0) AS b0, max(x0 + q) AS a1, max(y0 + q * 2) AS b1
        FROM (SELECT l_partkey % 50 AS doc_id, l_linenumber % 3 AS page_no, l_quantity AS q, l_quantity * 7 % 500 AS x0, l_extendedprice % 600 AS y0,
            CASE WHEN l_quantity < 10 THEN 'c' WHEN l_quantity < 30 THEN 'l' ELSE 're' END AS t FROM lineitem) GROUP BY ALL)
      WHERE n >= 8 AND (nc >= 5 OR (nl > 50 AND nr::DOUBLE / (nl + nr + nc) < 0.5)) AND (a1 - a0) * (b1 - b0) BETWEEN 10000 AND 595 * 842 * 0.9""",
)
def _(spark, d):
    return C.diagram_regions(drawings(spark, d), 595.0, 842.0)


def containers(spark, d):
    """Pages as byte contents: packages, old containers with and without encryption mark, other bytes."""
    k = F.col("page_id")
    head = (F.when(k % 4 == 0, F.unhex(F.lit("504B0304"))).when(k % 4 == 3, F.unhex(F.lit("00010203")))
            .otherwise(F.unhex(F.lit(C.OLE_MAGIC))))
    mark = F.when(k % 4 == 1, F.lit("EncryptedPackage")).otherwise(F.lit("")).cast("binary")
    return files(spark, d).join(table(spark, d, "pages").select("page_id", "html"), "page_id").select(
        "page_id", "path", F.concat(head, F.col("html").cast("binary"), mark).alias("content"))


@query(
    "classify_container", "page_id:l defect:s has_message:b",
    f"""SELECT page_id, defect, defect IS NOT NULL AS has_message FROM (SELECT page_id, CASE WHEN ext NOT IN ('.xlsx', '.xlsm') OR page_id % 4 = 0 THEN NULL
      WHEN page_id % 4 = 1 THEN 'openxml_password_protected' WHEN page_id % 4 = 2 THEN 'openxml_legacy_ole' ELSE 'openxml_invalid_container' END AS defect FROM files)""",
)
def _(spark, d):
    defect = C.classify_container(F.col("path"), F.col("content"))
    return containers(spark, d).select(
        "page_id", defect.alias("defect"), C.container_message(defect).isNotNull().alias("has_message"))


@query(
    "detect_password", "page_id:l has_password:b",
    "SELECT page_id, ext IN ('.xlsx', '.xlsm') AND page_id % 25 <> 0 AND page_id % 4 IN (1, 2) AS has_password FROM files",
)
def _(spark, d):
    return containers(spark, d).select("page_id", C.detect_password(F.col("path"), F.col("content")).alias("has_password"))


@query(
    "detect_mime", "page_id:l mime:s",
    "SELECT page_id, CASE page_id % 5 WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/gif' WHEN 3 THEN 'image/webp' ELSE 'image/png' END AS mime FROM pages",
)
def _(spark, d):
    k = F.col("page_id")
    head = (F.when(k % 5 == 0, F.unhex(F.lit("89504E470D0A1A0A"))).when(k % 5 == 1, F.unhex(F.lit("FFD8FFE0")))
            .when(k % 5 == 2, F.lit("GIF89a").cast("binary")).when(k % 5 == 3, F.lit("RIFF1234WEBP").cast("binary"))
            .otherwise(F.lit("?").cast("binary")))
    return table(spark, d, "pages").select(
        "page_id", C.detect_mime(F.concat(head, F.col("html").cast("binary"))).alias("mime"))


Q.VIEWS["file_categories"] = f"""SELECT *, CASE WHEN has_text AND c = 'requires_ocr' AND ext = '.pdf' THEN 'convertible_as_is'
    WHEN has_text AND c = 'password_protected' AND ext IN {_in(P.EXT_LEGACY)} THEN 'requires_libre'
    WHEN has_text AND c = 'password_protected' AND ext IN {_in(P.EXT_CONVERTIBLE)} THEN 'convertible_as_is' ELSE c END AS category
  FROM (SELECT *, CASE WHEN ext IN {_in(P.EXT_EXCLUDED)} OR page_id % 25 = 0 THEN 'other_excluded' WHEN has_password THEN 'password_protected'
    WHEN ext = '.pdf' AND in_ocr_list THEN 'requires_ocr' WHEN ext IN {_in(P.EXT_IMAGE)} THEN 'requires_ocr'
    WHEN ext IN ('.ppt', '.pptx') AND NOT has_text THEN 'requires_ocr' WHEN ext IN {_in(P.EXT_LEGACY)} THEN 'requires_libre'
    WHEN ext IN {_in(P.EXT_CONVERTIBLE)} THEN 'convertible_as_is' ELSE 'other_excluded' END AS c FROM files)"""


@query("categorize_file", "page_id:l category:s", "SELECT page_id, category FROM file_categories")
def _(spark, d):
    return files(spark, d).select("page_id", C.categorize_file(
        F.substring_index("path", "/", -1), F.col("ext"), F.col("has_password"), F.col("in_ocr_list"), F.col("has_text")
    ).alias("category"))


Q.VIEWS["results"] = f"""SELECT *, CASE WHEN status = 'success' THEN raw_text END AS text,
    CASE WHEN m <> '' THEN m WHEN empty AND ocr AND ext IN ('.ppt', '.pptx') THEN 'PowerPoint with empty text requires OCR'
      WHEN empty AND ocr THEN 'Image-based PDF detected during normalisation' WHEN empty THEN 'Converter returned empty text'
      WHEN status = 'requires_ocr' THEN 'Marked as requires_ocr' WHEN status = 'failed' THEN 'Conversion failed' ELSE '' END AS message
  FROM (SELECT *, CASE WHEN empty THEN CASE WHEN ocr THEN 'requires_ocr' ELSE 'failed' END ELSE s END AS status
    FROM (SELECT *, s = 'success' AND coalesce({Q.strip('raw_text')}, '') = '' AS empty,
        ext IN ('.pdf', '.ppt', '.pptx') OR regexp_matches(lower(m), '{"|".join(C.OCR_HINTS)}') AS ocr
      FROM (SELECT *, CASE WHEN lower({Q.strip('raw_status')}) IN {_in(C.STATUSES)} THEN lower({Q.strip('raw_status')}) ELSE 'failed' END AS s,
        {Q.strip("coalesce(raw_message, '')")} AS m FROM converter_results)))"""


def results(spark, d):
    r = C.normalise_result(F.col("ext"), F.col("raw_status"), F.col("raw_text"), F.col("raw_message"))
    return converter_results(spark, d).select("*", r.alias("r")).select(
        "event_id", "user_id", "ts", "path", "ext", "seconds", "r.*")


@query("normalise_result", "event_id:l status:s text:s message:s", "SELECT event_id, status, text, message FROM results")
def _(spark, d):
    return results(spark, d)


@query(
    "transient_errors", "event_id:l transient:b",
    f"SELECT event_id, regexp_matches(lower(coalesce(raw_message, '')), '{'|'.join(P.TRANSIENT)}') AS transient FROM converter_results",
)
def _(spark, d):
    return converter_results(spark, d).select(
        "event_id", C.is_transient(F.coalesce("raw_message", F.lit(""))).alias("transient"))


def attempts(spark, d):
    """Fetch attempts: one event is one attempt at the page of its user, numbered by time."""
    e = converter_results(spark, d)
    return e.select(
        F.col("user_id").alias("page_id"), F.struct("ts", "event_id").alias("at"),
        F.when(F.col("user_id") % 13 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("link-"), "user_id")).alias("deep_link"),
        F.coalesce(F.col("event_id") % 4 + 1, F.lit(1)).alias("attempt"),
        (F.trim(F.lower("raw_status")) == "success").alias("ok"), F.concat(F.lit("pdf/"), "path").alias("pdf_path"),
        F.coalesce("raw_message", F.lit("unknown error")).alias("error"))


@query(
    "next_page_status", "page_id:l status:s pdf_path:s error:s",
    f"""SELECT page_id, CASE WHEN link IS NULL THEN 'error' WHEN ok THEN 'done' WHEN attempt < 3 AND regexp_matches(lower(err), '{'|'.join(P.TRANSIENT)}') THEN 'retry'
        ELSE 'error' END AS status, CASE WHEN link IS NOT NULL AND ok THEN pdf END AS pdf_path,
        CASE WHEN link IS NULL THEN 'deep_link missing' WHEN NOT ok THEN left(err, 240) END AS error
      FROM (SELECT user_id AS page_id, CASE WHEN user_id % 13 = 0 THEN NULL ELSE 'l' END AS link, event_id % 4 + 1 AS attempt,
          trim(lower(raw_status)) = 'success' AS ok, 'pdf/' || path AS pdf, coalesce(raw_message, 'unknown error') AS err,
          row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM converter_results) WHERE rn = 1""",
)
def _(spark, d):
    # The newest attempt of a page decides; its stated number is kept for the retry limit.
    a = attempts(spark, d)
    newest = a.groupBy("page_id").agg(
        F.max_by(F.struct("deep_link", "attempt", "ok", "pdf_path", "error"), F.col("at")).alias("a")).select("page_id", "a.*")
    return C.next_page_status(newest)


@query(
    "run_mode", "mode:s",
    "SELECT CASE WHEN EXISTS (SELECT 1 FROM md_docs) THEN 'update' ELSE 'new' END AS mode",
)
def _(spark, d):
    base = md_docs(spark, d).select("path")
    return C.run_mode(base, base.filter("path = ''"))


@query(
    "pdf_verdict", "page_id:l verdict:s",
    """SELECT page_id, CASE WHEN NOT present THEN 'MISSING' WHEN size_kb < 5 THEN 'TINY' WHEN white_ratio > 0.90 AND text_chars > 30 THEN 'WHITE_BOX'
      WHEN white_ratio > 0.95 AND text_chars <= 30 THEN 'EMPTY' ELSE 'CLEAN' END AS verdict FROM page_features""",
)
def _(spark, d):
    return verdicts(spark, d)


def verdicts(spark, d):
    v = C.pdf_verdict(F.col("present"), F.col("size_kb"), F.col("white_ratio"), F.col("text_chars"))
    return page_features(spark, d).select("*", v.alias("verdict"))


Q.VIEWS["verdicts"] = """SELECT *, CASE WHEN NOT present THEN 'MISSING' WHEN size_kb < 5 THEN 'TINY' WHEN white_ratio > 0.90 AND text_chars > 30 THEN 'WHITE_BOX'
    WHEN white_ratio > 0.95 AND text_chars <= 30 THEN 'EMPTY' ELSE 'CLEAN' END AS verdict FROM page_features"""
