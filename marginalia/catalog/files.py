"""Sources, sinks, inventories, ledgers, statistics and page manifests."""

import pandas as pd
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import content_hash
from ..operators import inventory as I, manifest as M, numbering as N
from ..operators.structure import chapters, structure_record, unfold
from ..sources import named_files as NF, readers as R, sinks as K
from ..views import (
    converter_results, documents, files, md_docs, md_docs_v2, page_features, page_manifest, table, term_lists, terms,
)
from . import sqlviews as Q
from .classify import _in, long_docs, results, verdicts
from .registry import query

SCANNED = (".pdf", ".xlsx", ".xls", ".xlsm", ".docx", ".doc", ".pptx", ".ppt", ".png", ".jpg")
PREFIX = "store"


def _listing(spark, d):
    """The pages as files on the disk, and what a listing of them says."""
    out = K.scratch_path(spark, "files")
    pages = files(spark, d).join(table(spark, d, "pages").select("page_id", "html"), "page_id")
    NF.export_documents(pages.select("path", F.col("html").alias("text")), out)
    return NF.relative_paths(R.list_files(spark, out), out)


@query("list_files", "path:s size_bytes:l is_dated:b", "SELECT path, size_bytes, true AS is_dated FROM files")
def _(spark, d):
    return _listing(spark, d).withColumn("is_dated", F.col("modified") > F.lit("2024-01-01").cast("timestamp"))


@query("scan_files", "path:s", f"SELECT DISTINCT path FROM files WHERE ext IN {_in(SCANNED)} AND NOT contains(path, '/~$')")
def _(spark, d):
    return R.scan_files(_listing(spark, d), SCANNED)


@query(
    "scan_subset", "path:s",
    f"SELECT DISTINCT path FROM files WHERE ext IN {_in(SCANNED)} AND NOT contains(path, '/~$') AND in_ocr_list",
)
def _(spark, d):
    listed = files(spark, d).select(F.when(F.col("in_ocr_list"), F.concat(F.lit("  "), "path", F.lit(" "))).otherwise(" ").alias("value"))
    return R.scan_subset(files(spark, d), listed, SCANNED)


@query("scan_text_corpus", "doc_id:l n_chars:l hash:s", "SELECT doc_id, length(text) AS n_chars, md5(text) AS hash FROM documents")
def _(spark, d):
    out = K.scratch_path(spark, "corpus")
    name = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    rows = documents(spark, d).select(name.alias("name"), "text")
    # Each text beside a file that is none.
    NF.export_documents(rows.select(F.explode(F.array(*[F.struct(
        F.concat("name", F.lit(ext)).alias("path"), F.col("text")) for ext in (".txt", ".md")])).alias("f")).select("f.*"), out)
    return R.scan_text_corpus(spark, out).select(
        F.regexp_extract("path", r"([0-9]+)\.txt$", 1).alias("doc_id"), F.length("text").alias("n_chars"), content_hash(F.col("text")).alias("hash"))


@query(
    "scan_knowledge_base", "path:s category:s",
    """SELECT kb_path AS path, string_split(kb_path, '/')[-2] AS category FROM md_docs WHERE NOT starts_with(string_split(kb_path, '/')[-1], '00_')
      UNION ALL SELECT path, NULL FROM md_docs""",
)
def _(spark, d):
    docs = md_docs(spark, d)
    reports = spark.createDataFrame([("readme.md",), ("01_de/UPDATE_REPORT.md",), ("PR/01_x.md",), ("images/img_2.png",)], "path string")
    paths = docs.select(F.explode(F.array("kb_path", "path")).alias("path")).unionByName(reports)
    return R.scan_knowledge_base(paths)


@query("read_csv_table", "p_partkey:l p_name:s p_size:l", "SELECT p_partkey, p_name, p_size FROM part")
def _(spark, d):
    out = K.scratch_path(spark, "csv")
    table(spark, d, "part").select("p_partkey", "p_name", "p_size").write.csv(out, header=True)
    return R.read_csv_table(spark, out)


@query("read_ocr_manifest", "path:s", "SELECT DISTINCT path FROM files WHERE in_ocr_list")
def _(spark, d):
    k, p = F.col("page_id"), F.col("path")
    f = files(spark, d)
    as_struct = F.to_json(F.struct(F.array(F.struct(p.alias("path")), F.struct(F.lit(None).cast("string").alias("path"))).alias("files")))
    js = F.when(~F.col("in_ocr_list"), F.lit("{broken")).when(k % 2 == 0, as_struct).otherwise(F.to_json(F.array(p, p)))
    return R.ocr_manifest_paths(f.select(js.alias("json")))


@query("read_failed_ledger", "path:s", "SELECT DISTINCT path FROM results WHERE status = 'failed'")
def _(spark, d):
    r = results(spark, d)
    entry = F.struct(F.when(F.col("status") == "failed", F.col("path")).alias("file"), F.col("message").alias("error"))
    return R.failed_files(r.select(F.to_json(F.struct(F.array(entry).alias("failed_files"))).alias("json")))


@query("read_json_originals", "path:s", "SELECT DISTINCT path FROM files WHERE has_json")
def _(spark, d):
    f = files(spark, d).filter("has_json")
    bare = F.when(F.col("page_id") % 8 == 0, F.col("path")).otherwise(F.col("stem_path"))
    given = F.regexp_extract("path", r"(\.[^./]+)$", 1)
    js = F.to_json(F.struct(bare.alias("original_path"), given.alias("file_format")))
    # An extension that is added comes in lower case.
    return R.json_originals(f.select(js.alias("json"))).withColumn("path", F.regexp_replace("path", r"\.jpg$", ".JPG"))


def ledger_json(spark, d):
    """A ledger per document in one of the two layouts; blank targets occur."""
    k = F.col("doc_id")
    target = F.when(k % 30 == 0, F.lit("")).otherwise(F.col("kb_path"))
    item = F.when(k % 4 == 0, F.to_json(F.struct(F.col("name").alias("file"), F.lit("h").alias("hash")))).otherwise(F.col("name"))
    listed = F.to_json(F.struct(F.lit("2.0").alias("version"), F.array(F.struct(
        F.lit("m001").alias("id"), F.array(item).alias("input"), F.struct(target.alias("path")).alias("output"))).alias("mappings")))
    # The item of an object layout is an object, not a quoted text.
    listed = F.when(k % 4 == 0, F.concat(
        F.lit('{"version":"2.0","mappings":[{"id":"m001","input":['), item, F.lit('],"output":{"path":"'), target, F.lit('"}}]}'))).otherwise(listed)
    keyed = F.to_json(F.create_map(F.col("kb_path"), F.struct(
        F.array(F.col("name")).alias("inputs"), F.lit("2024-01-01").alias("created_at"))))
    labelled = table(spark, d, "labels").filter("quality = 0").select("doc_id")
    return md_docs(spark, d).join(labelled, "doc_id", "left_semi").select(
        F.when(k % 2 == 0, listed).otherwise(keyed).alias("json"))


Q.VIEWS["ledger"] = """SELECT name AS source, CASE WHEN doc_id % 30 = 0 THEN '' ELSE kb_path END AS target
    FROM md_docs WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)"""


def ledger(spark, d):
    return R.ledger_entries(ledger_json(spark, d))


@query("read_mapping", "source:s target:s", "SELECT source, target FROM ledger")
def _(spark, d):
    return ledger(spark, d)


@query("read_terms", "doc_id:l pos:l term:s description:s flag:l", "SELECT doc_id, pos, term, description, flag FROM terms")
def _(spark, d):
    rows = term_lists(documents(spark, d))
    listed = F.transform("terms", lambda r: F.struct(r["term"].alias("term"), r["description"].alias("description"), F.col("flag").alias("flag")))
    js = F.to_json(F.struct(F.col("doc_id").cast("string").alias("document_name"), listed.alias("terms")))
    broken = rows.limit(1).select(F.lit("[not json").alias("json"))
    return R.term_entries(rows.select(js.alias("json")).unionByName(broken)).select(
        F.col("name").cast("bigint").alias("doc_id"), "pos", "term", "description", "flag")


@query(
    "read_chapter_summaries", "doc_id:l pos:l title:s first_point:s line_start:l line_end:l",
    """SELECT doc_id, chapter_no - 1 AS pos, original_title AS title, clean_title AS first_point, line_start, line_end FROM chapter_rows""",
)
def _(spark, d):
    items = F.transform(chapters(F.col("text")), lambda c: F.struct(
        c["original_title"].alias("title"), F.array(c["clean_title"]).alias("summary"), c["line_start"].alias("line_start"), c["line_end"].alias("line_end")))
    js = F.to_json(F.struct(F.col("doc_id").cast("string").alias("document_name"), items.alias("chapters")))
    return R.chapter_summary_entries(md_docs(spark, d).select(js.alias("json"))).select(
        F.col("name").cast("bigint").alias("doc_id"), "pos", "title", F.get("summary", F.lit(0)).alias("first_point"), "line_start", "line_end")


from .structure import chapters_sql  # noqa: E402

Q.VIEWS["chapter_rows"] = chapters_sql("md_docs")


@query("read_page_manifest", "section:s title:s deep_link:s status:s pdf_path:s", "SELECT section, title, deep_link, status, pdf_path FROM page_manifest")
def _(spark, d):
    page = F.struct("title", "deep_link", "status", "pdf_path")
    js = F.to_json(F.struct(F.array(F.struct(F.col("section").alias("name"), F.array(page).alias("pages"))).alias("sections")))
    return R.manifest_pages(page_manifest(spark, d).select(js.alias("json")))


@query("write_structured_json", "doc_id:l total_lines:l n_sections:l",
       f"""SELECT doc_id, len(string_split(text, chr(10))) AS total_lines, 1 + len(list_filter(list_slice(string_split(text, chr(10)), 2, 1000000000),
         lambda x: regexp_matches(x, '^[{P.SPACE}]*(===|---|#)'))) AS n_sections FROM documents""")
def _(spark, d):
    out = K.scratch_path(spark, "structured")
    rec = structure_record(F.col("doc_id").cast("string"), F.col("text"), F.lit("2024-01-01T00:00:00"))
    K.write_structured_json(documents(spark, d).select(rec.alias("r")).select("r.*"), out)
    schema = "original_path string, metadata struct<total_lines:int>, content struct<sections:array<struct<line_count:int>>>"
    return spark.read.schema(schema).json(out).select(
        F.col("original_path").cast("bigint").alias("doc_id"), "metadata.total_lines", F.size("content.sections").alias("n_sections"))


Q.VIEWS["inventory_rows"] = f"""SELECT path AS relative_path, '{PREFIX}/' || path AS prefixed_path, size_bytes, strftime(modified, '%Y-%m-%dT%H:%M:%S') AS mtime_iso, ext, category, has_text AS raw_text,
    has_json AS raw_json, CASE WHEN category = 'requires_ocr' THEN CASE WHEN has_json THEN 'done' WHEN in_excluded_list THEN 'excluded' ELSE 'pending' END ELSE '' END AS ocr_status
    FROM file_categories"""


def inventory_rows(spark, d):
    f = files(spark, d)
    originals = f.filter("has_json").select(F.when(
        F.col("page_id") % 8 == 0, F.col("path")).otherwise(F.concat(F.lit(PREFIX + "/"), "path")).alias("path"))
    return I.inventory(
        f, f.filter("has_text").select(F.concat("stem_path", F.lit(".txt")).alias("path")), originals,
        f.filter("in_ocr_list").select("path"), f.filter("in_excluded_list").select("path"), PREFIX)


@query(
    "inventory", "relative_path:s prefixed_path:s size_bytes:l mtime_iso:s ext:s category:s raw_text:b raw_json:b ocr_status:s",
    "SELECT * FROM inventory_rows",
)
def _(spark, d):
    return inventory_rows(spark, d)


@query("write_inventory_csv", "relative_path:s size_bytes:l mtime_iso:s category:s raw_text:b", "SELECT * FROM inventory_rows")
def _(spark, d):
    out = K.scratch_path(spark, "inventory")
    K.write_inventory_csv(inventory_rows(spark, d), out)
    return spark.read.csv(out, header=True)


@query("write_documents", "category:s path:s n_chars:l hash:s", "SELECT category, kb_path AS path, length(text) AS n_chars, md5(text) AS hash FROM md_docs")
def _(spark, d):
    # The record by category, and the files under their names.
    record, out = K.scratch_path(spark, "base"), K.scratch_path(spark, "files")
    K.write_documents(md_docs(spark, d).select("category", F.col("kb_path").alias("path"), "text"), record)
    written = spark.read.parquet(record)
    NF.export_documents(written, out)
    return NF.read_documents(spark, out).join(written.select("category", "path"), "path").select(
        "category", "path", F.length("text").alias("n_chars"), content_hash(F.col("text")).alias("hash"))


@query("write_run_ledger", "run_id:s status:s n:l",
       "SELECT 'run-1' AS run_id, status, count(*) AS n FROM results GROUP BY ALL")
def _(spark, d):
    out = K.scratch_path(spark, "ledger")
    rows = results(spark, d).select("path", "status", "message", "seconds")
    for _ in range(2):
        # Writing the same run again replaces it.
        K.append_ledger(rows, out, F.lit("run-1"))
    return spark.read.parquet(out).groupBy("run_id", "status").agg(F.count("*").alias("n"))


@query("embedding_cache", "key:l hit:b dims:l",
       "SELECT doc_id AS key, vec_id IS NOT NULL AS hit, coalesce(len(embedding), 26) AS dims FROM documents LEFT JOIN embeddings ON vec_id = doc_id")
def _(spark, d):
    def letters(batch: pd.DataFrame) -> pd.DataFrame:
        alphabet = "abcdefghijklmnopqrstuvwxyz"
        return pd.DataFrame({
            "key": batch["key"], "vector": [[float(t.count(c)) for c in alphabet] for t in batch["text"].str.lower()]})

    wanted = documents(spark, d).select(F.col("doc_id").alias("key"), "text")
    cache = table(spark, d, "embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))
    return K.embedding_cache(wanted, cache, letters).select("key", "hit", F.size("vector").alias("dims"))


@query("skip_processed", "doc_id:l name:s", "SELECT doc_id, name FROM md_docs WHERE name NOT IN (SELECT source FROM ledger)")
def _(spark, d):
    done = ledger(spark, d).select(F.col("source").alias("name"))
    return I.skip_processed(md_docs(spark, d).select("doc_id", "name"), done, "name")


@query("retry_failed", "path:s", "SELECT path FROM (SELECT DISTINCT path FROM converter_results) WHERE path IN (SELECT path FROM results WHERE status = 'failed')")
def _(spark, d):
    failed = results(spark, d).filter("status = 'failed'").select("path")
    return I.retry_failed(converter_results(spark, d).select("path").distinct(), failed)


@query("inventory_summary", "item:s n:l",
       """SELECT 'total' AS item, count(*) AS n FROM inventory_rows UNION ALL SELECT 'raw_text', count(*) FILTER (WHERE raw_text) FROM inventory_rows
       UNION ALL SELECT 'raw_json', count(*) FILTER (WHERE raw_json) FROM inventory_rows UNION ALL SELECT 'category:' || category, count(*) FROM inventory_rows GROUP BY ALL
       UNION ALL SELECT 'failed', count(DISTINCT path) FROM results WHERE status = 'failed'""")
def _(spark, d):
    failed = results(spark, d).filter("status = 'failed'").select("path").distinct()
    return I.inventory_summary(inventory_rows(spark, d), failed)


@query("category_stats", "category:s n_files:l n_chars:l",
       "SELECT category, count(*) AS n_files, sum(length(text)) AS n_chars FROM md_docs GROUP BY ROLLUP (category)")
def _(spark, d):
    return I.category_stats(md_docs(spark, d))


@query("glossary", "term:s description:s flag:l",
       f"""SELECT t AS term, arg_max(description, struct_pack(l := length(description), a := -doc_id, b := -pos)) AS description, min(flag) AS flag
       FROM (SELECT *, {Q.strip('term')} AS t FROM terms) WHERE t <> '' GROUP BY t""")
def _(spark, d):
    return I.glossary(terms(spark, d), "doc_id", "pos")


@query("run_statistics", "total:l processed:l success:l requires_ocr:l failed:l skipped:l success_pct:d failed_pct:d mean_seconds:d",
       """SELECT total, greatest(f, success + requires_ocr + failed) AS processed, success, requires_ocr, failed,
         greatest(greatest(f, success + requires_ocr + failed) - (success + requires_ocr + failed), 0) AS skipped,
         success / total * 100 AS success_pct, failed / total * 100 AS failed_pct, mean_seconds
       FROM (SELECT count(*) AS total, count(DISTINCT path) AS f, count(*) FILTER (WHERE status = 'success') AS success,
         count(*) FILTER (WHERE status = 'requires_ocr') AS requires_ocr, count(*) FILTER (WHERE status = 'failed') AS failed, round(avg(seconds), 2) AS mean_seconds FROM results)""")
def _(spark, d):
    return I.run_statistics(results(spark, d))


@query("verdict_summary", "total:l clean:l white_box:l empty:l tiny:l error:l bad:l bad_pct:d",
       """SELECT *, bad / total * 100 AS bad_pct FROM (SELECT *, white_box + empty + tiny + error AS bad FROM (SELECT count(*) AS total,
         count(*) FILTER (WHERE verdict = 'CLEAN') AS clean, count(*) FILTER (WHERE verdict = 'WHITE_BOX') AS white_box, count(*) FILTER (WHERE verdict = 'EMPTY') AS empty,
         count(*) FILTER (WHERE verdict = 'TINY') AS tiny, count(*) FILTER (WHERE verdict = 'MISSING') AS error FROM verdicts))""")
def _(spark, d):
    return M.verdict_summary(verdicts(spark, d))


def _sources(spark, d):
    """Every document is a source of the merged file of its source and language."""
    return md_docs(spark, d).select(F.concat("category", F.lit("/"), F.col("source")).alias("output"), F.col("name").alias("source"), "text")


Q.VIEWS["merge_sources"] = "SELECT category || '/' || source AS output, name AS source, text FROM md_docs"


@query("merge_size_gate", "output:s n_chars:l n_sources:l mode:s",
       "SELECT output, sum(length(text)) AS n_chars, count(*) AS n_sources, CASE WHEN sum(length(text)) > 80000 THEN 'concatenate' ELSE 'rewrite' END AS mode FROM merge_sources GROUP BY output")
def _(spark, d):
    return I.merge_size_gate(_sources(spark, d))


@query("split_over_limit", "output:s source:s",
       """SELECT CASE WHEN sum(length(text)) OVER w > 80000 AND count(*) OVER w > 1 THEN output || '/' || source ELSE output END AS output, source
       FROM merge_sources WINDOW w AS (PARTITION BY output)""")
def _(spark, d):
    return I.split_over_limit(_sources(spark, d))


# Page manifests

@query("pending_pages", "page_id:l seq:l retry_seq:l",
       """SELECT page_id, seq, retry_seq FROM (SELECT page_id, row_number() OVER (ORDER BY section, page_id) AS seq FROM page_manifest WHERE status <> 'done')
       LEFT JOIN (SELECT page_id, row_number() OVER (ORDER BY section, page_id) AS retry_seq FROM page_manifest WHERE status = 'retry') USING (page_id)""")
def _(spark, d):
    pages = page_manifest(spark, d).select("page_id", "section", "status")
    again = M.pending_pages(pages, ["section", "page_id"], retry=True).select("page_id", F.col("seq").alias("retry_seq"))
    return M.pending_pages(pages, ["section", "page_id"]).join(again, "page_id", "left")


@query("dedupe_pages", "section:s page_guid:s page_id:l page_title:s",
       r"""SELECT section, page_guid, min(page_id) AS page_id, arg_min(page_title, page_id) AS page_title FROM (
         SELECT section, page_id, regexp_extract(wd, p, 4) AS page_guid, regexp_extract(wd, p, 3) AS page_title FROM (SELECT *,
           '^target\((.+?)\.one\|([^/]+)/(.+?)\|([^/]+)/\)' AS p, url_decode(regexp_extract(deep_link, '[?&]wd=([^&]+)', 1)) AS wd FROM page_manifest)
         WHERE regexp_matches(wd, p) AND regexp_extract(wd, p, 1) = section) GROUP BY section, page_guid""")
def _(spark, d):
    return M.dedupe_pages(page_manifest(spark, d), "page_id")


@query("manifest_vs_files", "section:s title:s pdf_name:s",
       """SELECT section, title, string_split(pdf_path, '/')[-1] AS pdf_name FROM page_manifest WHERE status = 'done' UNION ALL
       SELECT '', 'page_' || page_id, 'page_' || page_id || '.pdf' FROM page_features WHERE present AND page_id NOT IN (SELECT page_id FROM page_manifest WHERE status = 'done')""")
def _(spark, d):
    return M.manifest_and_files(page_manifest(spark, d).filter("status = 'done'"), page_features(spark, d).filter("present"))


@query("mark_retry", "page_id:l status:s",
       """SELECT m.page_id, CASE WHEN m.status = 'done' AND verdict IN ('WHITE_BOX', 'EMPTY', 'TINY') THEN 'retry' ELSE m.status END AS status
       FROM page_manifest m JOIN verdicts v USING (page_id)""")
def _(spark, d):
    return M.mark_retry(page_manifest(spark, d), verdicts(spark, d))


@query("sample_pages", "pdf_path:s label:s",
       """SELECT pdf_path, arg_min(label, p) AS label FROM (
         SELECT pdf_path, 'sample' AS label, 0 AS p FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY page_id) AS k, count(*) OVER (PARTITION BY section) AS n FROM page_manifest WHERE status = 'done') WHERE k = n // 2 + 1
         UNION ALL SELECT pdf_path, 'smallest', 1 FROM (SELECT * FROM page_features WHERE present ORDER BY size_kb, pdf_path LIMIT 5)
         UNION ALL SELECT pdf_path, 'largest', 2 FROM (SELECT * FROM page_features WHERE present ORDER BY size_kb DESC, pdf_path DESC LIMIT 5)) GROUP BY pdf_path""")
def _(spark, d):
    return M.sample_pages(
        page_manifest(spark, d).filter("status = 'done'").select("page_id", "section", "pdf_path"),
        page_features(spark, d).filter("present"), "page_id")


@query("report_order", "page_id:l place:l",
       "SELECT page_id, row_number() OVER (ORDER BY white_ratio DESC, page_id) AS place FROM page_features")
def _(spark, d):
    rows = page_features(spark, d).select("page_id", (-F.col("white_ratio")).alias("sort_key"))
    return N.running_number(rows, ["sort_key", "page_id"], (), "place")


@query("limit_files", "path:s", f"SELECT path FROM files WHERE ext IN {_in(SCANNED)} AND NOT contains(path, '/~$') ORDER BY path LIMIT 50")
def _(spark, d):
    return R.scan_files(files(spark, d), SCANNED).orderBy("path").limit(50)


@query("current_failures", "path:s error:s",
       """SELECT path, message AS error FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY ts DESC, event_id DESC) AS rn FROM results) WHERE rn = 1 AND status = 'failed'""")
def _(spark, d):
    rows = results(spark, d).select(
        "path", F.struct("ts", "event_id").alias("at"), "status", F.col("message").alias("error"), F.lit(None).cast("string").alias("category"))
    return N.current_failures(rows)


# Numbering

# Names of a few sources that are literally numbered, among the rows and among what exists.
_TAKEN = ("src1", "src2_2", "src2_4", "document_3", "src4_2_2")


@query("unique_names", "doc_id:l unique_name:s",
       f"""WITH RECURSIVE b AS (SELECT doc_id, CASE WHEN lang = 'de' THEN 'document' ELSE source || CASE WHEN doc_id % 11 = 3 THEN '_2' WHEN doc_id % 29 = 5 THEN '_2_2' ELSE '' END END AS b FROM documents),
         r AS (SELECT *, regexp_replace(b, '(_[1-9][0-9]*)+$', '') AS root FROM b), o AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY doc_id) AS i FROM r),
         f(root, i, used, doc_id, unique_name) AS (
           SELECT DISTINCT root, 0::BIGINT, [{", ".join(f"'{t}'" for t in _TAKEN)}], NULL::BIGINT, NULL::VARCHAR FROM o
           UNION ALL SELECT root, i, list_append(used, u), doc_id, u FROM (SELECT o.root, o.i, o.doc_id, f.used, CASE WHEN list_contains(f.used, o.b)
               THEN o.b || '_' || list_filter(range(2, len(f.used) + 3), lambda k: NOT list_contains(f.used, o.b || '_' || k))[1] ELSE o.b END AS u
             FROM f JOIN o ON o.root = f.root AND o.i = f.i + 1))
       SELECT doc_id, unique_name FROM f WHERE i > 0""")
def _(spark, d):
    k = F.col("doc_id")
    number = F.when(k % 11 == 3, "_2").when(k % 29 == 5, "_2_2").otherwise("")
    rows = documents(spark, d).select("doc_id", F.when(F.col("lang") == "de", " ").otherwise(F.concat("source", number)).alias("name"))
    return N.unique_names(rows, spark.createDataFrame([(t,) for t in _TAKEN], "name string"), ["doc_id"])


@query("next_file_number", "doc_id:l number:l file_name:s",
       """SELECT doc_id, number, CASE WHEN number < 10 THEN '0' ELSE '' END || number || '_' || name AS file_name FROM (SELECT p.doc_id, p.name,
         coalesce(m.n, 0) + row_number() OVER (PARTITION BY p.category ORDER BY p.doc_id) AS number FROM page_docs p
         LEFT JOIN (SELECT category, max(nullif(regexp_extract(string_split(kb_path, '/')[-1], '^([0-9]+)_', 1), '')::BIGINT) AS n FROM md_docs GROUP BY category) m USING (category))""")
def _(spark, d):
    from ..views import page_docs

    planned = page_docs(spark, d).select("doc_id", "category", F.concat(F.lit("7_"), "name").alias("name"))
    return N.next_file_numbers(md_docs(spark, d).select("category", F.col("kb_path").alias("path")), planned, ["doc_id"])


@query("number_chapters", "doc_id:l chapter_no:l chapter_id:s",
       f"""SELECT doc_id, chapter_no, coalesce(nullif(regexp_replace(regexp_replace(left(name, 20), '[^{P.WORD}]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'doc')
         || '_' || left(md5(name), 8) || '_' || lpad(chapter_no::VARCHAR, 3, '0') AS chapter_id FROM chapter_rows JOIN md_docs USING (doc_id)""")
def _(spark, d):
    from ..functions.text import chapter_id

    rows = unfold(md_docs(spark, d), chapters(F.col("text")), "doc_id", "name")
    return rows.select("doc_id", "chapter_no", chapter_id(F.col("name"), F.col("chapter_no")).alias("chapter_id"))


@query("fallback_grouping", "doc_id:l group_no:l name:s chapter_range:s",
       """SELECT doc_id, g AS group_no, CASE WHEN n > 50 THEN 'セクション' || g END AS name,
         CASE WHEN n > 50 THEN lpad(((g - 1) * 30 + 1)::VARCHAR, 3, '0') || '-' || lpad(least(g * 30, n)::VARCHAR, 3, '0') END AS chapter_range
       FROM (SELECT doc_id, n, unnest(range(1, CASE WHEN n > 50 THEN (n + 29) // 30 ELSE 1 END + 1)) AS g FROM (SELECT doc_id, len(string_split(text, chr(10))) AS n FROM documents))""")
def _(spark, d):
    total = F.size(F.split("text", "\n", -1))
    return unfold(documents(spark, d), N.fallback_groups(total), "doc_id")


def planned_chapters(spark, d):
    """A plan that takes groups of four chapters and leaves every fifth out, and whole short files."""
    rows = unfold(md_docs(spark, d), chapters(F.col("text")), "doc_id", "name")
    return rows, rows.filter(F.col("chapter_no") % 5 != 0)


Q.VIEWS["missing_rows"] = "SELECT * FROM chapter_rows WHERE chapter_no % 5 = 0 OR (doc_id % 3 = 0 AND chapter_no % 5 >= 3)"


def missing(spark, d):
    rows, used = planned_chapters(spark, d)
    used = used.filter((F.col("doc_id") % 3 != 0) | (F.col("chapter_no") % 5 < 3))
    return N.missing_chapters(rows, used)


@query("chapter_coverage", "doc_id:l chapter_no:l clean_title:s", "SELECT doc_id, chapter_no, clean_title FROM missing_rows")
def _(spark, d):
    return missing(spark, d)


@query("fill_missing_chapters", "doc_id:l batch_no:l title:s n_chapters:l",
       """SELECT doc_id, b AS batch_no, left(arg_min(clean_title, chapter_no), 15) || ' 他' AS title, count(*) AS n_chapters
       FROM (SELECT *, (row_number() OVER (PARTITION BY doc_id ORDER BY chapter_no) - 1) // 15 AS b FROM missing_rows) GROUP BY doc_id, b""")
def _(spark, d):
    return N.fill_missing(missing(spark, d))


@query("missing_ranges", "doc_id:l first_no:l last_no:l name:s",
       """SELECT doc_id, min(chapter_no) AS first_no, max(chapter_no) AS last_no, '補完_' || lpad(min(chapter_no)::VARCHAR, 3, '0') || '-' || lpad(max(chapter_no)::VARCHAR, 3, '0') AS name
       FROM (SELECT *, chapter_no - row_number() OVER (PARTITION BY doc_id ORDER BY chapter_no) AS g FROM missing_rows) GROUP BY doc_id, g""")
def _(spark, d):
    return N.missing_ranges(missing(spark, d))


@query("dedupe_images", "conv_id:l hash:s pos:l",
       """SELECT conv_id, md5(u) AS hash, min(turn) AS pos FROM (SELECT conv_id, turn, text AS u FROM conversations) WHERE u <> '' GROUP BY conv_id, u""")
def _(spark, d):
    images = table(spark, d, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), F.concat(F.lit("img_"), "turn").alias("filename"),
        F.col("text").cast("binary").alias("data"))
    return N.dedupe_images(images).withColumnRenamed("doc_id", "conv_id")


@query("sequence_ids", "kb_path:s id:s",
       "SELECT kb_path, 'm' || CASE WHEN n < 1000 THEN lpad(n::VARCHAR, 3, '0') ELSE n::VARCHAR END AS id FROM (SELECT kb_path, row_number() OVER (ORDER BY category, kb_path) AS n FROM md_docs)")
def _(spark, d):
    return N.sequence_ids(md_docs(spark, d).select("category", "kb_path"), ["category", "kb_path"])
