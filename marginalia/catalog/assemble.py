"""Assembled texts, planned outputs, carried-out plans, reports and user functions."""

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import content_hash, lines, normalize_title
from ..operators import assemble as A, inventory as I
from ..operators.numbering import running_number
from ..operators.structure import chapters, heading_titles, sections_h12, structure_record, unfold
from ..plans import execution as E, inference as X, structure as S, updates as U
from ..views import documents, files, image_files, md_docs, md_docs_v2, table, terms, versions
from . import sqlviews as Q
from .classify import containers
from .matching import _changes_sql, _plan_pairs, plan
from .quality import _issues
from ..sources import named_files as N, sinks as K
from .registry import query
from .rewrite import greedy_sql
from .structure import sections_sql

SP = P.SPACE
NL = "chr(10)"
TS = "2024-01-01T00:00:00"


def _hash(df, *keep):
    return df.select(*keep, content_hash(F.col("text")).alias("hash"), F.length("text").alias("n_chars"))


def _sql_hash(sql, keep):
    return f"SELECT {keep}, md5(text) AS hash, length(text) AS n_chars FROM ({sql})"


# Converter output


@query("content_markdown", "doc_id:l hash:s n_chars:l", _sql_hash(
    f"""SELECT doc_id, '# ' || 'doc_' || doc_id || {NL} || {NL} || '**元ファイル:** doc_' || doc_id || '.md  ' || {NL} || '**ファイル形式:** md  ' || {NL} || '**抽出日時:** {TS}  ' || {NL} || {NL}
      || '---' || {NL} || {NL} || text || CASE WHEN len(ls) < 3 THEN '' ELSE {NL} || {NL} || '---' || {NL} || {NL} || '## 抽出画像' || {NL} || {NL}
      || '### a.png (Page 1)' || {NL} || {NL} || '![a.png](../04_images/a.png)' || {NL} || {NL} || '> **図の説明:**' || {NL} || '>' || {NL} || '> ' || ls[1] || {NL} || '> ' || ls[2] || {NL} || {NL}
      || '### b.png' || {NL} || {NL} || '![b.png](../04_images/b.png)' || {NL} END AS text FROM (SELECT doc_id, text, string_split(text, {NL}) AS ls FROM documents)""", "doc_id"))
def _(spark, d):
    ls = lines(F.col("text"))
    one = F.struct(F.lit("a.png").alias("filename"), F.lit("Page 1").alias("page"), F.array_join(F.slice(ls, 1, 2), "\n").alias("description"))
    two = F.struct(F.lit("b.png").alias("filename"), F.lit(None).cast("string").alias("page"), F.lit("").alias("description"))
    images = F.when(F.size(ls) >= 3, F.array(one, two))
    path = F.concat(F.lit("in/doc_"), F.col("doc_id"), F.lit(".md"))
    return _hash(documents(spark, d).select("doc_id", A.content_markdown(path, F.lit(TS), F.col("text"), images).alias("text")), "doc_id")


def elements(spark, d):
    rows = documents(spark, d).select("doc_id", F.posexplode(lines(F.col("text"))).alias("p", "line"))
    i = F.col("p") + 1
    kind = F.array(F.lit("text"), F.lit("image"), F.lit("table"), F.lit("diagram"))[i % 4]
    return rows.select(
        "doc_id", F.ceil(i / 10).alias("page"), (37 * i % 101).alias("y"), i.alias("seq"), kind.alias("kind"),
        F.when(kind == "text", F.col("line")).otherwise(F.concat(F.lit("img_"), i, F.lit(".png"))).alias("content"),
        F.when(i % 8 == 3, F.lit(None)).otherwise(F.concat("line", F.lit("\nmore"))).alias("description"))


@query("assemble_pages", "doc_id:l hash:s n_chars:l", _sql_hash(
    f"""SELECT doc_id, string_agg(CASE WHEN i % 4 = 0 THEN line ELSE {NL} || '![img_' || i || '.png](../04_images/img_' || i || '.png)' || {NL} || CASE WHEN i % 8 = 3 THEN '' ELSE
        {NL} || CASE WHEN i % 4 = 2 THEN '> **表の説明:**' ELSE '> **図の説明:**' END || {NL} || '>' || {NL} || '> ' || line || {NL} || '> more' || {NL} END END, {NL} || {NL} ORDER BY ceil(i / 10), 37 * i % 101, i) AS text
      FROM (SELECT doc_id, line, line_no AS i FROM ({Q.explode('documents')})) GROUP BY doc_id""", "doc_id"))
def _(spark, d):
    return _hash(A.assemble_pages(elements(spark, d)), "doc_id")


@query("assemble_slides", "doc_id:l hash:s n_chars:l", _sql_hash(
    f"""SELECT conv_id AS doc_id, {Q.strip(f"string_agg('## Slide ' || (turn + 1) || {NL} || {NL} || CASE WHEN turn % 3 = 0 THEN '![slide_' || n || '.png](../04_images/slide_' || n || '.png)' || {NL} || {NL} ELSE '' END || CASE WHEN turn % 2 = 0 THEN 'OCR ' || text ELSE text END, {NL} || {NL} || '---' || {NL} || {NL} ORDER BY turn)")} AS text
      FROM (SELECT *, CASE WHEN turn + 1 < 1000 THEN lpad((turn + 1)::VARCHAR, 3, '0') ELSE (turn + 1)::VARCHAR END AS n FROM conversations) GROUP BY conv_id""", "doc_id"))
def _(spark, d):
    c = table(spark, d, "conversations").select(
        F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).alias("slide_no"), "text", (F.col("turn") % 3 == 0).alias("has_screenshot"))
    ocr = c.filter(F.col("slide_no") % 2 == 1).select("doc_id", "slide_no", F.concat(F.lit("OCR "), "text").alias("ocr_text"))
    return _hash(A.assemble_slides(c, ocr), "doc_id")


def cells(spark, d):
    """Parts as sheet cells, one row per part: one sheet per brand, five columns, gaps, pipes and line breaks."""
    parts = table(spark, d, "part").select("p_brand", F.col("p_partkey").alias("k"), "p_name", "p_type", "p_size")
    k = F.col("k")
    values = F.array(
        F.col("p_name"), F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("p_type")), F.concat("p_name", F.lit("|x")),
        F.concat("p_type", F.lit("\ny")), F.col("p_size").cast("string"))
    return running_number(parts, ["k"], ["p_brand"], "row").select(
        F.lit("book").alias("file"), F.col("p_brand").alias("sheet"), F.col("row").cast("int").alias("row"),
        F.posexplode(values).alias("c", "value")).select("file", "sheet", "row", (F.col("c") + 1).alias("col"), "value")


def merged(spark, d):
    sheets = cells(spark, d).select("file", "sheet").distinct()
    ranges = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, ("seq", "min_row", "max_row", "min_col", "max_col"))])
                       for r in ((1, 2, 4, 1, 2), (2, 4, 4, 2, 3), (3, 60, 90, 5, 5))])
    return sheets.select("file", "sheet", F.inline(ranges))


Q.VIEWS["cells"] = f"""SELECT 'book' AS file, sheet, row, unnest([1, 2, 3, 4, 5]) AS col, unnest([n, CASE WHEN k % 3 = 0 THEN NULL ELSE t END, n || '|x', t || {NL} || 'y', z]) AS value
  FROM (SELECT p_brand AS sheet, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS row, p_partkey AS k, p_name AS n, p_type AS t, p_size::VARCHAR AS z FROM part)"""
Q.VIEWS["filled_cells"] = f"""SELECT c.file, c.sheet, c.row, c.col, CASE WHEN r.seq IS NOT NULL THEN t.value ELSE c.value END AS value FROM cells c
  LEFT JOIN (SELECT x.row, x.col, max(seq) AS seq FROM (SELECT DISTINCT row, col FROM cells) x JOIN (VALUES (1, 2, 4, 1, 2), (2, 4, 4, 2, 3), (3, 60, 90, 5, 5)) m(seq, r1, r2, c1, c2)
    ON x.row BETWEEN r1 AND r2 AND x.col BETWEEN c1 AND c2 GROUP BY ALL) r ON r.row = c.row AND r.col = c.col
  LEFT JOIN (VALUES (1, 2, 1), (2, 4, 2), (3, 60, 5)) h(seq, r1, c1) ON h.seq = r.seq
  LEFT JOIN cells t ON t.sheet = c.sheet AND t.row = h.r1 AND t.col = h.c1"""


@query("fill_merged_cells", "sheet:s row:l col:l value:s", "SELECT sheet, row, col, value FROM filled_cells")
def _(spark, d):
    return A.fill_merged_cells(cells(spark, d), merged(spark, d))


_CELL = f"replace(replace({Q.strip('coalesce(value, chr(32))')}, {NL}, '<br>'), '|', '\\|')"


@query("cells_to_markdown", "file:s pos:s row:l line:s",
    f"""SELECT 'book' AS file, sheet AS pos, row, CASE WHEN k = 1 THEN line || {NL} || '| --- | --- | --- | --- | --- |' ELSE line END AS line
      FROM (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY row) AS k FROM (SELECT sheet, row, '| ' || string_agg({_CELL}, ' | ' ORDER BY col) || ' |' AS line FROM filled_cells GROUP BY sheet, row))
    UNION ALL SELECT 'book', sheet, 0, CASE WHEN row_number() OVER (ORDER BY sheet) = 1 THEN '' ELSE {NL} END || '## シート: ' || sheet || {NL} || tail
      FROM (SELECT DISTINCT sheet, '' AS tail FROM cells UNION ALL SELECT 'zz empty', {NL} || '*(空のシート)*')""")
def _(spark, d):
    c = cells(spark, d)
    sheets = c.select("file", "sheet").distinct().unionByName(c.select("file").distinct().select("file", F.lit("zz empty").alias("sheet")))
    return A.cells_to_markdown(A.fill_merged_cells(c, merged(spark, d)), sheets.withColumn("pos", F.col("sheet")))


@query("image_list", "doc_id:l images:s",
       f"""SELECT doc_id, coalesce(images, '（画像なし）') AS images FROM documents LEFT JOIN (SELECT doc_id, string_agg('- `' || f || '`: ../04_images/' || f, {NL} ORDER BY f) AS images
         FROM (SELECT doc_id, 'img_' || line_no || CASE line_no % 3 WHEN 0 THEN '.PNG' WHEN 1 THEN '.webp' ELSE '.svg' END AS f, line_no FROM ({Q.explode('documents')})) WHERE line_no % 3 < 2 AND line_no > 3 GROUP BY doc_id) USING (doc_id)""")
def _(spark, d):
    rows = documents(spark, d).select("doc_id", F.explode(F.sequence(F.lit(1), F.size(lines(F.col("text"))))).alias("i"))
    images = rows.filter("i > 3").select("doc_id", F.concat(F.lit("img_"), "i", F.when(
        F.col("i") % 3 == 0, ".PNG").when(F.col("i") % 3 == 1, ".webp").otherwise(".svg")).alias("filename"))
    return A.image_list(documents(spark, d), images)


# Chunks and merged files

from .rewrite import _chunk_rows  # noqa: E402
from ..operators import chunking as C  # noqa: E402


@query("merge_chunks", "doc_id:l hash:s n_chars:l", _sql_hash(
    f"""SELECT doc_id, '# ' || name || {NL} || {NL} || '## サマリー' || {NL} || 'one summary' || {NL} || {NL} || '---' || {NL} || {NL} || string_agg(body, {NL} || {NL} || '---' || {NL} || {NL} ORDER BY k) || {NL} || {NL} || '---' || {NL} || {NL} || '## 関連資料' || {NL} || {NL} || 'なし' || {NL} AS text
      FROM (SELECT doc_id, name, k, {Q.strip(f"coalesce(string_agg(line, {NL} ORDER BY line_no) FILTER (WHERE NOT starts_with(t, '# ') AND mark IS DISTINCT FROM 1 AND coalesce(state, 0) = 0 AND NOT (t = '---' AND before = 1)), '')")} AS body
        FROM (SELECT *, last(mark IGNORE NULLS) OVER (PARTITION BY doc_id, k ORDER BY line_no) AS state, last(mark IGNORE NULLS) OVER (PARTITION BY doc_id, k ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
          FROM (SELECT *, CASE WHEN starts_with(t, '# ') THEN NULL WHEN starts_with(t, '## サマリー') OR lower(t) = '## summary' THEN 1 WHEN t = '---' OR starts_with(t, '## ') OR starts_with(t, '### ') THEN 0 END AS mark
            FROM (SELECT *, {Q.strip('line')} AS t FROM (SELECT doc_id, name, k, unnest(string_split(text, {NL})) AS line, generate_subscripts(string_split(text, {NL}), 1) AS line_no
              FROM (SELECT doc_id, name, 1 AS k, text FROM md_docs UNION ALL SELECT doc_id, name, 2, text FROM md_docs_v2 WHERE doc_id % 5 <> 0)))))
        GROUP BY doc_id, name, k) WHERE body <> '' GROUP BY doc_id, name""", "doc_id"))
def _(spark, d):
    one = md_docs(spark, d).select("doc_id", F.lit(1).alias("chunk_no"), F.lit(True).alias("success"), "text")
    two = md_docs_v2(spark, d).select("doc_id", F.lit(2).alias("chunk_no"), (F.col("doc_id") % 5 != 0).alias("success"), "text")
    summaries = md_docs(spark, d).select("doc_id", "name", F.lit("one summary").alias("summary"))
    return _hash(A.merge_chunks(one.unionByName(two), summaries), "doc_id")


_NO_TITLE = f"regexp_replace(text, '^# [^\\n]*\\n', '')"


Q.VIEWS["merge_pieces"] = f"""SELECT output, k AS place, CASE WHEN k = 1 THEN text ELSE {NL} || {NL} || '---' || {NL} || {NL} || '## 【' || source || '】' || CASE WHEN k % 2 = 0 THEN ' - part' ELSE '' END || {NL} || {NL} || {_NO_TITLE} END AS piece
      FROM (SELECT *, row_number() OVER (PARTITION BY output ORDER BY source) AS k FROM merge_sources)"""


def _merge_pieces(spark, d):
    from .files import _sources

    rows = running_number(_sources(spark, d), ["source"], ["output"], "pos").select(
        "output", "pos", F.col("source").alias("file"), F.when(F.col("pos") % 2 == 0, "part").alias("chapter"), "text")
    return A.concatenate_sources(rows)


def _piece_hash(df):
    return df.select("output", "place", content_hash(F.col("piece")).alias("hash"), F.length("piece").alias("n_chars"))


@query("concatenate_sources", "output:s place:l hash:s n_chars:l", "SELECT output, place, md5(piece) AS hash, length(piece) AS n_chars FROM merge_pieces")
def _(spark, d):
    return _piece_hash(_merge_pieces(spark, d))


@query("write_files", "output:s n_chars:l hash:s", f"SELECT output, length(text) AS n_chars, md5(text) AS hash FROM (SELECT output, string_agg(piece, {NL} ORDER BY place) || {NL} AS text FROM merge_pieces GROUP BY output)")
def _(spark, d):
    out = K.scratch_path(spark, "pieces")
    N.write_files(_merge_pieces(spark, d), out)
    return N.read_files(spark, out).select(F.col("path").alias("output"), F.length("text").alias("n_chars"), content_hash(F.col("text")).alias("hash"))


def _wanted_chapters():
    return F.array(F.lit(2), F.lit(1), F.lit(7)).cast("array<bigint>")


@query("extract_chapters", "doc_id:l seq:l chapter_no:l title:s line_start:l line_end:l hash:s",
       f"""SELECT c.doc_id, w.seq, chapter_no, clean_title AS title, line_start, line_end, md5(array_to_string(list_slice(string_split(text, {NL}), line_start, line_end), {NL})) AS hash
       FROM chapter_rows c JOIN md_docs USING (doc_id) JOIN (VALUES (1, 2), (2, 1), (3, 7)) w(seq, n) ON n = chapter_no""")
def _(spark, d):
    rows = unfold(md_docs(spark, d), A.extract_chapters(F.col("text"), _wanted_chapters()), "doc_id")
    return rows.withColumn("hash", content_hash(F.col("content")))


def output_plan(spark, d):
    """Whole files, chapter files and files merged from all documents of a source and language."""
    docs = md_docs(spark, d)
    k = F.col("doc_id")
    none = F.lit(None).cast("array<bigint>")
    single = docs.select(F.concat("category", F.lit("/"), "name", F.lit(".md")).alias("output"), F.lit(1).alias("pos"), F.col("name").alias("file"),
                         F.when(k % 2 == 0, none).otherwise(_wanted_chapters()).alias("chapter_nos"))
    many = docs.select(F.concat(F.lit("05_merged/"), "source", F.lit("_"), "lang", F.lit(".md")).alias("output"), k.cast("int").alias("pos"), F.col("name").alias("file"),
                       F.when(k % 3 == 0, _wanted_chapters()).otherwise(none).alias("chapter_nos"))
    return single.unionByName(many)


Q.VIEWS["plan_parts"] = f"""SELECT o.output, o.pos, o.name AS file, o.part, CASE WHEN part THEN cs.seq END AS i, CASE WHEN part THEN cs.title END AS title, CASE WHEN cs.content IS NOT NULL AND part THEN cs.content ELSE o.text END AS content,
    o.text AS whole, cs.line_start, cs.line_end
  FROM (SELECT doc_id, name, text, category || '/' || name || '.md' AS output, 1 AS pos, doc_id % 2 = 1 AS part FROM md_docs
    UNION ALL SELECT doc_id, name, text, '05_merged/' || source || '_' || lang || '.md', doc_id, doc_id % 3 = 0 FROM md_docs) o
  LEFT JOIN (SELECT c.doc_id, w.seq, clean_title AS title, line_start, line_end, array_to_string(list_slice(string_split(text, {NL}), line_start, line_end), {NL}) AS content
    FROM chapter_rows c JOIN md_docs USING (doc_id) JOIN (VALUES (1, 2), (2, 1), (3, 7)) w(seq, n) ON n = chapter_no) cs ON cs.doc_id = o.doc_id AND o.part"""


@query("split_or_merge_outputs", "output:s place:l hash:s n_chars:l",
    f"""SELECT output, place, md5(piece) AS hash, length(piece) AS n_chars FROM (SELECT output, k AS place, CASE WHEN n = 1 THEN CASE WHEN k = 1 THEN content ELSE {NL} || '---' || {NL} || {NL} || content END
        WHEN k = 1 THEN content ELSE {NL} || {NL} || '---' || {NL} || {NL} || '## 【' || file || '】' || CASE WHEN title <> '' THEN ' - ' || title ELSE '' END || {NL} || {NL} || regexp_replace(content, '^# [^\\n]*\\n', '') END AS piece
      FROM (SELECT *, row_number() OVER (PARTITION BY output ORDER BY pos, i) AS k, (SELECT count(DISTINCT pos) FROM plan_parts q WHERE q.output = p.output) AS n FROM plan_parts p))""")
def _(spark, d):
    docs = md_docs(spark, d).select(F.col("name").alias("file"), "text")
    return _piece_hash(A.planned_pieces(output_plan(spark, d), docs))


def mapping(spark, d):
    from ..operators.numbering import sequence_ids

    p = output_plan(spark, d)
    docs = md_docs(spark, d).select(F.col("name").alias("file"), "text")
    return A.build_mapping(p, docs, sequence_ids(p.select("output").distinct(), ["output"]).select("output", "id"))


Q.VIEWS["output_ids"] = "SELECT output, 'm' || CASE WHEN n < 1000 THEN lpad(n::VARCHAR, 3, '0') ELSE n::VARCHAR END AS id FROM (SELECT output, row_number() OVER (ORDER BY output) AS n FROM (SELECT DISTINCT output FROM plan_parts))"


@query("build_mapping", "id:s path:s category:s is_merged:b pos:l file:s hash:s n_ranges:l first_line:l is_split:b",
       """SELECT id, output AS path, string_split(output, '/')[1] AS category, count(*) OVER (PARTITION BY output) > 1 AS is_merged, pos, file, hash, n_ranges, first_line, part AS is_split
       FROM (SELECT output, pos, file, any_value(md5(whole)) AS hash, count(line_start) AS n_ranges, arg_min(line_start, i) AS first_line, bool_or(part) AS part FROM plan_parts GROUP BY output, pos, file) JOIN output_ids USING (output)""")
def _(spark, d):
    return mapping(spark, d).select(
        "id", "path", "category", "is_merged", "pos", "source.file", "source.hash", F.size("source.line_ranges").alias("n_ranges"),
        F.get(F.get("source.line_ranges", F.lit(0)), F.lit(0)).alias("first_line"), "source.is_split")


# Front matter, images, merge rules


@query("front_matter", "doc_id:l created:s updated:s source_form:s",
       f"""SELECT doc_id, '---' || {NL} || 'source:' || {NL} || '  - file: "' || name || '"' || {NL} || '  - split_index: 2' || {NL} || 'generated_at: "{TS}"' || {NL} || '---' AS created,
         md5('---' || {NL} || 'source:' || {NL} || '  - file: "' || name || '"' || {NL} || 'updated_at: "{TS}"' || {NL} || '---' || {NL} || text) AS updated,
         '---' || {NL} || 'source:' || {NL} || '  - file: "' || name || '"' || {NL} || CASE WHEN titles IS NULL THEN '' ELSE '    chapters:' || {NL} || titles END || 'generated_at: "{TS}"' || {NL} || 'mapping_id: "m001"' || {NL} || '---' || {NL} || {NL} AS source_form
       FROM md_docs LEFT JOIN (SELECT doc_id, string_agg('      - "' || original_title || '"' || {NL}, '' ORDER BY chapter_no) AS titles FROM chapter_rows GROUP BY doc_id) USING (doc_id)""")
def _(spark, d):
    ts = F.lit(TS)
    titles = F.transform(chapters(F.col("text")), lambda c: c["original_title"])
    old = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit('---\nsource: a --- b\n---\n\n'), "text")).otherwise(F.col("text"))
    return md_docs(spark, d).select(
        "doc_id", U.front_matter(F.col("name"), ts, F.lit(2)).alias("created"),
        content_hash(U.update_front_matter(old, F.col("name"), ts)).alias("updated"),
        A.source_front_matter(F.array(F.struct(F.col("name").alias("file"), titles.alias("chapters"))), F.lit("m001"), ts).alias("source_form"))


@query("rewrite_image_paths", "doc_id:l text:s",
       "SELECT doc_id, regexp_replace(text, '\\]\\(images/(img_[0-9]*[02468]\\.png)', '](./images/src01_\\1', 'g') AS text FROM md_docs")
def _(spark, d):
    n = F.size(lines(F.col("text")))
    images = F.transform(F.sequence(F.lit(2), F.greatest(n, F.lit(2)), F.lit(2)), lambda i: F.struct(
        F.lit("src01").alias("prefix"), F.concat(F.lit("img_"), i.cast("string"), F.lit(".png")).alias("name")))
    return md_docs(spark, d).select("doc_id", A.rewrite_image_paths(F.col("text"), images).alias("text"))


def _h12(source):
    return f"""SELECT doc_id, sec, first(line ORDER BY line_no) AS title, coalesce(string_agg(line, {NL} ORDER BY line_no) FILTER (WHERE NOT is_head), '') AS content
      FROM (SELECT *, sum(is_head::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS sec FROM (SELECT *, regexp_matches(line, '^#{{1,2}}[{SP}]+') AS is_head FROM ({Q.explode(source)}))) WHERE sec > 0 GROUP BY doc_id, sec"""


Q.VIEWS["integrated"] = f"""WITH o AS (SELECT *, {Q.normalize_title('title')} AS k FROM ({_h12('md_docs')})), n AS (SELECT *, {Q.normalize_title('title')} AS k FROM ({_h12('md_docs_v2')})),
    m AS (SELECT doc_id, k, arg_max(title, sec) AS title, arg_max(content, sec) AS content FROM n GROUP BY doc_id, k)
  SELECT doc_id, string_agg(title || {NL} || content || {NL}, {NL} ORDER BY grp, sec) AS text FROM (
    SELECT o.doc_id, 0 AS grp, o.sec, coalesce(m.title, o.title) AS title, coalesce(m.content, o.content) AS content FROM o LEFT JOIN m USING (doc_id, k)
    UNION ALL SELECT n.doc_id, 1, n.sec, n.title, n.content FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.doc_id = n.doc_id AND o.k = n.k)) GROUP BY doc_id"""


@query("integrate_sections", "doc_id:l text:s", "SELECT doc_id, coalesce(text, '') AS text FROM md_docs LEFT JOIN (SELECT doc_id AS i, text FROM integrated) x ON i = doc_id".replace("coalesce(text", "coalesce(x.text"))
def _(spark, d):
    return versions(spark, d).select("doc_id", U.integrate_sections(F.col("before"), F.col("after")).alias("text"))


def _strategy():
    k = F.col("doc_id") % 3
    return F.when(k == 0, "append").when(k == 1, "integrate").otherwise("replace")


@query("merge_strategy", "doc_id:l hash:s n_chars:l", _sql_hash(
    f"""SELECT b.doc_id, CASE b.doc_id % 3 WHEN 0 THEN b.text || {NL} || {NL} || '---' || {NL} || {NL} || '## 追加コンテンツ' || {NL} || {NL} || a.text WHEN 1 THEN coalesce(i.text, '') ELSE a.text END AS text
      FROM md_docs b JOIN md_docs_v2 a USING (doc_id) LEFT JOIN integrated i USING (doc_id)""", "doc_id"))
def _(spark, d):
    return _hash(versions(spark, d).select(
        "doc_id", U.merge_texts(_strategy(), F.col("before"), F.col("after")).alias("text")), "doc_id")


@query("route_sections", "doc_id:l update_text:s create_text:s",
       f"""SELECT doc_id, coalesce(string_agg(line, {NL} ORDER BY line_no) FILTER (WHERE side = 'u'), '') AS update_text, coalesce(string_agg(line, {NL} ORDER BY line_no) FILTER (WHERE side = 'c'), '') AS create_text
       FROM (SELECT *, coalesce(last(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no), 'u') AS side FROM (SELECT l.*, CASE WHEN is_head THEN
           CASE WHEN list_contains(up, h) THEN 'u' WHEN list_contains(cr, h) THEN 'c'
             WHEN len(list_filter(cr, lambda x: contains(x, h) OR contains(h, x))) > 0 AND len(list_filter(up, lambda x: contains(x, h) OR contains(h, x))) = 0 THEN 'c' ELSE 'u' END END AS mark
         FROM (SELECT *, regexp_matches(line, '{P.HEADING_1_4}') AS is_head, {Q.strip(f"regexp_extract(line, '{P.HEADING_1_4}', 2)")} AS h FROM md_lines) l
         JOIN (SELECT doc_id, list_filter(list_transform(t, lambda x, i: CASE WHEN i % 3 = 1 THEN x END), lambda x: x IS NOT NULL) AS up,
           list_filter(list_transform(t, lambda x, i: CASE WHEN i % 3 = 2 THEN left(x, 6) END), lambda x: x IS NOT NULL) AS cr
           FROM (SELECT doc_id, list({Q.strip(f"regexp_extract(line, '{P.HEADING_1_4}', 2)")} ORDER BY line_no) AS t FROM md_lines WHERE regexp_matches(line, '{P.HEADING_1_4}') GROUP BY doc_id)) USING (doc_id))) GROUP BY doc_id""")
def _(spark, d):
    rows = md_docs(spark, d).select("doc_id", "text", F.explode(F.array(heading_titles(F.col("text")))).alias("t"))
    r = U.route_sections(F.col("text"), F.filter("t", lambda x, i: i % 3 == 0),
                         F.transform(F.filter("t", lambda x, i: i % 3 == 1), lambda x: F.substring(x, 1, 6)))
    return rows.select("doc_id", F.explode(F.array(r)).alias("r")).select("doc_id", "r.*")


# Carrying out a plan


def _parts_name(suffix):
    return F.concat(F.regexp_replace("target", r"\.md$", ""), F.lit(f"_{suffix}.md"))


def plan_actions(spark, d, rows=None):
    """The update plan as a list of actions in order of key, so that all their kinds occur.

    Updates of one folder share a file in runs of 50 keys, with a strategy per
    row; some updates are partial, some creates split in two.
    """
    from ..views import incoming_docs

    rows = plan(spark, d).checkpoint() if rows is None else rows
    k, action = F.col("key"), F.col("action")
    run = [F.substring_index("target", "/", 1).alias("folder"), F.floor(k / 50).alias("run")]
    shared = rows.filter("action = 'update'").select("target", *run).groupBy("folder", "run").agg(F.min("target").alias("shared"))
    heads = incoming_docs(spark, d).select(F.col("doc_id").alias("key"), F.explode(F.array(heading_titles(F.col("text")))).alias("t"))
    joined = rows.select("*", *run).join(shared, ["folder", "run"], "left").join(heads, "key")
    partial = (action == "update") & (k % 7 == 2)
    split = (action == "create") & (k % 5 == 1)
    return joined.select(
        k.alias("place"), "key", "source", F.when(partial, "partial_update").otherwise(action).alias("action"),
        F.when(action == "update", F.col("shared")).otherwise(F.col("target")).alias("target"), "reason",
        F.when(k % 3 == 0, "append").when(k % 3 == 1, "integrate").otherwise("replace").alias("strategy"),
        F.when(split, F.array(_parts_name("a"), _parts_name("b"))).alias("split_into"),
        F.when(partial, F.filter("t", lambda x, i: i % 3 == 0)).alias("update_headings"),
        F.when(partial, F.transform(F.filter("t", lambda x, i: i % 3 == 1), lambda x: F.substring(x, 1, 6))).alias("create_headings"),
        F.when(partial, F.concat(F.lit("90_new/"), "source", F.lit(".md"))).alias("create_target"))


def _execution(spark, d, rows=None):
    """Files and outcomes of the plan; texts in Spanish are missing, and so is every file of the first category."""
    from ..views import incoming_docs

    sources = incoming_docs(spark, d).filter("lang <> 'es'").select(F.col("doc_id").alias("key"), "text")
    base = md_docs(spark, d).filter("category <> '01_de'").select(F.col("kb_path").alias("target"), "text")
    return E.execute_plan(plan_actions(spark, d, rows), sources, base, F.lit(TS))


def _routed_sql(source):
    head = Q.strip(f"regexp_extract(line, '{P.HEADING_1_4}', 2)")
    return f"""SELECT doc_id, coalesce(string_agg(line, {NL} ORDER BY line_no) FILTER (WHERE side = 'u'), '') AS update_text, coalesce(string_agg(line, {NL} ORDER BY line_no) FILTER (WHERE side = 'c'), '') AS create_text
       FROM (SELECT *, coalesce(last(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no), 'u') AS side FROM (SELECT l.*, CASE WHEN is_head THEN
           CASE WHEN list_contains(up, h) THEN 'u' WHEN list_contains(cr, h) THEN 'c'
             WHEN len(list_filter(cr, lambda x: contains(x, h) OR contains(h, x))) > 0 AND len(list_filter(up, lambda x: contains(x, h) OR contains(h, x))) = 0 THEN 'c' ELSE 'u' END END AS mark
         FROM (SELECT *, regexp_matches(line, '{P.HEADING_1_4}') AS is_head, {head} AS h FROM ({Q.explode(source)})) l
         JOIN (SELECT doc_id, list_filter(list_transform(t, lambda x, i: CASE WHEN i % 3 = 1 THEN x END), lambda x: x IS NOT NULL) AS up,
           list_filter(list_transform(t, lambda x, i: CASE WHEN i % 3 = 2 THEN left(x, 6) END), lambda x: x IS NOT NULL) AS cr
           FROM (SELECT doc_id, list({head} ORDER BY line_no) AS t FROM ({Q.explode(source)}) WHERE regexp_matches(line, '{P.HEADING_1_4}') GROUP BY doc_id)) USING (doc_id))) GROUP BY doc_id"""


def _head_sql(source, field="generated_at", index=""):
    return f"""'---' || {NL} || 'source:' || {NL} || '  - file: "' || {source} || '"' || {index} {NL} || '{field}: "{TS}"' || {NL} || '---'"""


Q.VIEWS["exec_actions"] = """SELECT key, source, reason, CASE WHEN action = 'update' AND key % 7 = 2 THEN 'partial_update' ELSE action END AS action,
    CASE WHEN action = 'update' THEN min(target) OVER (PARTITION BY action, string_split(target, '/')[1], key // 50) ELSE target END AS target,
    CASE key % 3 WHEN 0 THEN 'append' WHEN 1 THEN 'integrate' ELSE 'replace' END AS strategy, action = 'create' AND key % 5 = 1 AS is_split
  FROM plan_result"""
Q.VIEWS["exec_sources"] = "SELECT doc_id, name, text FROM incoming_docs WHERE lang <> 'es'"
Q.VIEWS["exec_routed"] = _routed_sql("(SELECT s.* FROM exec_sources s JOIN exec_actions a ON a.key = s.doc_id WHERE a.action = 'partial_update')")
Q.VIEWS["exec_halves"] = f"""SELECT doc_id, p, array_to_string(list_slice(ls, CASE WHEN p = 1 THEN 1 WHEN h IS NULL THEN z + 1 ELSE h[q + 1] END,
      CASE WHEN p = 2 THEN n WHEN h IS NULL THEN z ELSE h[least(q, len(h) - 1) + 1] - 1 END), {NL}) AS text
    FROM (SELECT *, greatest(1, len(h) // 2) AS q, greatest(1, n // 2) AS z, unnest([1, 2]) AS p
      FROM (SELECT doc_id, ls, len(ls) AS n, CASE WHEN len(h2) >= 2 THEN h2 END AS h
        FROM (SELECT doc_id, ls, list_filter(range(1, len(ls) + 1), lambda i: regexp_matches(ls[i], '^#{{1,2}}[{SP}]+')) AS h2
          FROM (SELECT doc_id, string_split(text, {NL}) AS ls FROM exec_sources JOIN exec_actions ON key = doc_id WHERE is_split))))"""
_STEM = "regexp_replace(target, '\\.md$', '')"
Q.VIEWS["exec_edits"] = f"""SELECT *, row_number() OVER (PARTITION BY target ORDER BY key, part) AS step FROM (
    SELECT key, 0 AS part, source, source AS label, target, CASE action WHEN 'create' THEN 'create' ELSE 'update' END AS op, strategy, s.text, {_head_sql('source')} AS head, reason
      FROM exec_actions a JOIN exec_sources s ON s.doc_id = a.key WHERE action IN ('create', 'update') AND NOT is_split
    UNION ALL SELECT key, p - 1, source, source, {_STEM} || CASE p WHEN 1 THEN '_a.md' ELSE '_b.md' END, 'create', strategy, h.text,
        {_head_sql('source', index=f"{NL} || '  - split_index: ' || p ||")}, reason FROM exec_actions a JOIN exec_halves h ON h.doc_id = a.key
    UNION ALL SELECT key, 0, source, source || ' (部分更新)', target, 'share', strategy, update_text, NULL, reason
      FROM exec_actions a JOIN exec_routed r ON r.doc_id = a.key WHERE update_text <> ''
    UNION ALL SELECT key, 1, source, source || ' (新規部分)', '90_new/' || source || '.md', 'create', strategy, '# ' || replace(source, '_', ' ') || '（新規セクション）' || {NL} || {NL} || create_text, {_head_sql('source')}, reason
      FROM exec_actions a JOIN exec_routed r ON r.doc_id = a.key WHERE create_text <> '')"""
_FRONT = r"'(?s)^---[^\n]*\n(?:.*?\n)??---[ \t]*(?:\n|\z)'"


def _sections_of(text):
    """Sections of level 1 and 2 as a list (k, t, c), inside an expression over lists."""
    heads = f"list_filter(range(1, len(ls) + 1), lambda i: regexp_matches(ls[i], '^#{{1,2}}[{SP}]+'))"
    return f"""(SELECT list_transform(hs, lambda p, i: {{'k': {Q.normalize_title('ls[p]')}, 't': ls[p], 'c': array_to_string(list_slice(ls, p + 1, coalesce(hs[i + 1], len(ls) + 1) - 1), {NL})}})
      FROM (SELECT ls, {heads} AS hs FROM (SELECT string_split({text}, {NL}) AS ls)))"""


# The fold itself, edit by edit over the whole text, which the library never makes.
Q.VIEWS["exec_fold"] = f"""WITH RECURSIVE e AS MATERIALIZED (SELECT *, {_sections_of('text')} AS new_sections FROM exec_edits),
    fold(target, step, text, result, label, source, reason, edits, key) AS (
      SELECT t.target, 0::BIGINT, b.text, NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR, 0::BIGINT, NULL::BIGINT FROM (SELECT DISTINCT target FROM exec_edits) t
        LEFT JOIN (SELECT kb_path, text FROM md_docs WHERE category <> '01_de') b ON b.kb_path = t.target
      UNION ALL
      SELECT target, step, CASE WHEN makes THEN head || {NL} || {NL} || new_text WHEN ignored THEN NULL WHEN op = 'share' THEN merged
          ELSE {_head_sql('source', 'updated_at')} || {NL} || CASE WHEN starts_with(merged, '---') AND regexp_matches(merged, {_FRONT})
            THEN regexp_replace(regexp_replace(merged, {_FRONT}, ''), '^[{SP}]+', '') ELSE merged END END,
        CASE WHEN ignored THEN NULL WHEN makes THEN 'created' ELSE 'updated' END, label, source, reason, edits + CASE WHEN ignored THEN 0 ELSE 1 END, key
      FROM (SELECT *, CASE strategy WHEN 'append' THEN old_text || {NL} || {NL} || '---' || {NL} || {NL} || '## 追加コンテンツ' || {NL} || {NL} || new_text
            WHEN 'integrate' THEN array_to_string(list_transform(list_concat(
                list_transform(old_sections, lambda o: CASE WHEN list_contains(list_transform(new_sections, lambda n: n.k), o.k) THEN list_filter(new_sections, lambda n: n.k = o.k)[-1] ELSE o END),
                list_filter(new_sections, lambda n: NOT list_contains(list_transform(old_sections, lambda o: o.k), n.k))), lambda s: s.t || {NL} || s.c || {NL}), {NL})
            ELSE new_text END AS merged
        FROM (SELECT e.target, e.step, e.op, e.strategy, e.label, e.source, e.reason, e.head, e.key, e.text AS new_text, e.new_sections, f.text AS old_text, f.edits,
            e.op = 'create' OR (e.op = 'update' AND f.text IS NULL) AS makes, e.op = 'share' AND f.text IS NULL AS ignored,
            list_transform(f.hs, lambda p, i: {{'k': {Q.normalize_title('f.ls[p]')}, 't': f.ls[p], 'c': array_to_string(list_slice(f.ls, p + 1, coalesce(f.hs[i + 1], len(f.ls) + 1) - 1), {NL})}}) AS old_sections
          FROM (SELECT *, list_filter(range(1, len(ls) + 1), lambda i: regexp_matches(ls[i], '^#{{1,2}}[{SP}]+')) AS hs FROM (SELECT *, string_split(coalesce(text, ''), {NL}) AS ls FROM fold)) f
          JOIN e ON e.target = f.target AND e.step = f.step + 1)))
    SELECT * FROM fold"""
Q.VIEWS["exec_files"] = """SELECT target, arg_max(text, step) AS text, max(edits) AS n_edits, arg_max(result, step) FILTER (result IS NOT NULL) AS result,
    arg_max(source, step) FILTER (result IS NOT NULL) AS source, arg_max(reason, step) FILTER (result IS NOT NULL) AS reason
  FROM exec_fold GROUP BY target HAVING max(edits) > 0"""
Q.VIEWS["exec_outcomes"] = """SELECT key, label AS source, target, row_number() OVER (PARTITION BY target ORDER BY step) AS step, result, reason FROM exec_fold WHERE result IS NOT NULL
  UNION ALL SELECT key, source, target, NULL, CASE WHEN action = 'skip' THEN 'skipped' WHEN doc_id IS NULL THEN 'error' ELSE 'ignored' END,
    CASE WHEN action <> 'skip' AND doc_id IS NULL THEN 'Source content not found: ' || source ELSE reason END
  FROM exec_actions LEFT JOIN exec_sources ON doc_id = key WHERE key NOT IN (SELECT key FROM exec_fold WHERE result IS NOT NULL)"""


@query("execute_plan", "target:s result:s source:s reason:s n_edits:l n_chars:l hash:s",
       "SELECT target, result, source, reason, n_edits, length(text) AS n_chars, md5(text) AS hash FROM exec_files")
def _(spark, d):
    files, _ = _execution(spark, d)
    return files.select("target", "result", "source", "reason", "n_edits", F.length("text").alias("n_chars"), content_hash(F.col("text")).alias("hash"))


@query("execution_outcomes", "key:l source:s target:s step:l result:s reason:s", "SELECT * FROM exec_outcomes")
def _(spark, d):
    return _execution(spark, d)[1]


#: A limit that some of the texts exceed.
WRITTEN = 2000
Q.VIEWS["exec_long"] = f"SELECT row_number() OVER (ORDER BY target) AS doc_id, target, source, text FROM exec_files WHERE result = 'updated' AND length(text) > {WRITTEN}"
Q.VIEWS["exec_blocks"] = f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sec) AS i, length(content) + length(heading) + 10 AS size,
    CASE WHEN heading = '{P.OPENING}' THEN content ELSE '## ' || heading || {NL} || {NL} || content END AS block FROM ({sections_sql('exec_long')}) WHERE n_lines > 0"""
Q.VIEWS["exec_parts"] = f"""SELECT doc_id, chunk_no, (SELECT string_agg(block, {NL} || {NL} ORDER BY i) FROM exec_blocks b WHERE b.doc_id = c.doc_id AND b.i >= c.start AND b.i < c.start + c.n_items) AS text
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM ({greedy_sql('SELECT doc_id, i, size FROM exec_blocks', str(WRITTEN))})) c WHERE n > 1"""


@query("written_files", "target:s result:s n_chars:l hash:s", f"""SELECT target, result, length(text) AS n_chars, md5(text) AS hash FROM (
      SELECT target, result, text FROM exec_files WHERE target NOT IN (SELECT target FROM exec_long JOIN exec_parts USING (doc_id))
      UNION ALL SELECT CASE chunk_no WHEN 1 THEN target ELSE {_STEM} || '_part' || chunk_no || '.md' END, 'updated',
        CASE chunk_no WHEN 1 THEN {_head_sql('source', 'updated_at')} || {NL} || CASE WHEN starts_with(p.text, '---') AND regexp_matches(p.text, {_FRONT})
            THEN regexp_replace(regexp_replace(p.text, {_FRONT}, ''), '^[{SP}]+', '') ELSE p.text END
          ELSE {_head_sql("source || ' (Part ' || chunk_no || ')'")} || {NL} || {NL} || p.text END
      FROM exec_parts p JOIN exec_long USING (doc_id))""")
def _(spark, d):
    files, _ = _execution(spark, d)
    return E.written_files(files, F.lit(TS), WRITTEN).select("target", "result", F.length("text").alias("n_chars"), content_hash(F.col("text")).alias("hash"))


@query("update_ledger", "target:s pos:l source:s created_at:s updated_at:s",
       f"""WITH l AS (SELECT DISTINCT target, source FROM ledger WHERE target <> ''),
         m AS (SELECT target, max(step) FILTER (result = 'created') AS made, count(*) FILTER (result = 'updated') AS n_updates FROM exec_outcomes WHERE result IN ('created', 'updated') GROUP BY target),
         s AS (SELECT coalesce(m.target, k.target) AS target, made, coalesce(n_updates, 0) AS n_updates, k.target IS NOT NULL AS known FROM m FULL JOIN (SELECT DISTINCT target FROM l) k ON k.target = m.target),
         r AS (SELECT target, source, 0 AS g, source AS o, 0 AS step FROM l WHERE target NOT IN (SELECT target FROM s WHERE made IS NOT NULL)
           UNION ALL SELECT o.target, o.source, 1, '', 0 FROM exec_outcomes o JOIN s ON s.target = o.target AND s.made = o.step
           UNION ALL SELECT target, source, 2, '', step FROM exec_outcomes WHERE result = 'updated'),
         f AS (SELECT target, source, min((g, o, step)) AS ord FROM r GROUP BY ALL)
       SELECT f.target, row_number() OVER (PARTITION BY f.target ORDER BY ord) AS pos, source, CASE WHEN made IS NOT NULL OR NOT known THEN '{TS}' ELSE 'before' END AS created_at,
         CASE WHEN n_updates >= CASE WHEN made IS NOT NULL OR known THEN 1 ELSE 2 END THEN '{TS}' END AS updated_at
       FROM f JOIN s ON s.target = f.target""")
def _(spark, d):
    from ..operators.numbering import running_number
    from .files import ledger

    old = running_number(ledger(spark, d).filter("target <> ''").select("target", "source").distinct(), ["source"], ["target"], "pos")
    kept = old.select("target", "pos", "source", F.lit("before").alias("created_at"), F.lit(None).cast("string").alias("updated_at"))
    return E.ledger_entries_after(kept, _execution(spark, d)[1], F.lit(TS))


# Structure plans


def decisions(spark, d):
    """A decision per document: chapters in groups of five with every fourth range missing, names
    with a chapter count on half of them, every seventh file whole, a few unknown names."""
    rows = md_docs(spark, d).select("doc_id", "category", "name", F.explode(F.array(chapters(F.col("text")))).alias("cs"))
    k, n = F.col("doc_id"), F.size("cs")
    ranges = F.transform(F.filter(F.sequence(F.lit(0), F.ceil(n / 5).cast("int")), lambda g: (g % 4 != 3) & (g * 5 < n)), lambda g: F.struct(
        F.concat(F.lit("group "), (g + 1).cast("string")).alias("name"),
        F.concat(F.format_string("%03d", g * 5 + 1), F.lit("-"), F.format_string("%03d", g * 5 + F.when(k % 5 == 0, 3).otherwise(5))).alias("chapter_range")))
    return rows.select(
        "category", k.alias("pos"), F.when(k % 97 == 5, F.lit("§")).otherwise(F.when(k % 2 == 0, F.concat("name", F.lit("（"), n, F.lit("章）"))).otherwise(F.col("name"))).alias("name"),
        (k % 7 != 0).alias("split"), ranges.alias("groups"))


Q.VIEWS["structure_files"] = f"""WITH c AS (SELECT doc_id, count(*) AS n, list(clean_title ORDER BY chapter_no) AS titles FROM chapter_rows GROUP BY doc_id),
    m AS (SELECT d.*, coalesce(c.n, 0) AS n, c.titles FROM md_docs d LEFT JOIN c USING (doc_id) WHERE d.doc_id % 97 <> 5),
    u AS (SELECT doc_id, category, name, 0 AS kind, g AS file_pos, 'group ' || (g + 1) AS title, list_filter(range(g * 5 + 1, least(g * 5 + CASE WHEN doc_id % 5 = 0 THEN 3 ELSE 5 END, n) + 1), lambda x: true) AS nos
      FROM (SELECT *, unnest(range(0, n // 5 + 1)) AS g FROM m WHERE doc_id % 7 <> 0 AND n > 0) WHERE g % 4 <> 3 AND g * 5 < n),
    x AS (SELECT doc_id, category, name, titles, list(no ORDER BY no) AS miss FROM (SELECT doc_id, category, name, titles, unnest(range(1, n + 1)) AS no FROM m WHERE doc_id % 7 <> 0 AND n > 0)
      WHERE (doc_id, no) NOT IN (SELECT (doc_id, unnest(nos)) FROM u) GROUP BY ALL),
    r AS (SELECT doc_id, category, name, 1 AS kind, b AS file_pos, left(titles[miss[b * 15 + 1]], 15) AS title, list_slice(miss, b * 15 + 1, b * 15 + 15) AS nos FROM (SELECT *, unnest(range(0, (len(miss) + 14) // 15)) AS b FROM x)),
    w AS (SELECT doc_id, category, name, 2 AS kind, 0 AS file_pos, name AS title, NULL::BIGINT[] AS nos FROM m WHERE doc_id % 7 = 0 OR n = 0)
  SELECT category, name AS file, number, kind < 2 AS is_split, array_to_string(nos, ',') AS chapter_nos, (CASE WHEN number < 10 THEN '0' ELSE '' END) || number || '_' || CASE kind WHEN 1 THEN title || '_他' WHEN 2 THEN left(title, 30) ELSE title END || '.md' AS output_name,
    CASE kind WHEN 1 THEN title || ' 他' WHEN 2 THEN left(title, 40) ELSE title END AS title
  FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY doc_id, kind, file_pos) AS number FROM (SELECT * FROM u UNION ALL SELECT * FROM r UNION ALL SELECT * FROM w))"""


def structure(spark, d):
    docs = md_docs(spark, d).select(F.col("name").alias("file"), F.transform(chapters(F.col("text")), lambda c: c["clean_title"]).alias("titles"))
    return S.plan_structure(decisions(spark, d), docs)


@query("plan_structure", "category:s number:l output_name:s title:s file:s chapter_nos:s is_split:b", "SELECT * FROM structure_files")
def _(spark, d):
    return structure(spark, d).withColumn("chapter_nos", F.array_join(F.col("chapter_nos").cast("array<string>"), ","))


@query("plan_statistics", "categories:l files:l split_files:l merged_files:l",
       "SELECT count(DISTINCT category) AS categories, count(*) AS files, count(*) FILTER (WHERE is_split) AS split_files, 0 AS merged_files FROM structure_files")
def _(spark, d):
    return I.plan_statistics(structure(spark, d).withColumn("n_sources", F.lit(1)))


@query("category_by_keywords", "doc_id:l category:s",
       """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '業務マニュアル' WHEN doc_id % 4 = 1 THEN '定型文・テンプレート' WHEN doc_id % 4 = 2 THEN 'プロジェクト報告' ELSE 'その他' END AS category FROM documents""")
def _(spark, d):
    k = F.col("doc_id") % 4
    name = F.concat("source", F.when(k == 0, "マニュアル報告").when(k == 1, "横展開PJ").when(k == 2, "PJ").otherwise(""))
    return documents(spark, d).select("doc_id", S.category_by_keywords(name).alias("category"))


# Reports


@query("report_tables", "report:s line:s",
       f"""SELECT 'readme' AS report, '| ' || left(file, 40) || ' | ' || coalesce(nullif(left(titles, 30), ''), '-') || ' | ' || output || ' |' AS line FROM (
           SELECT output, pos, file, string_agg(title, ', ' ORDER BY i) AS titles FROM plan_parts GROUP BY output, pos, file)
         UNION ALL SELECT 'glossary', '| ' || t || ' | ' || replace(description, '|', '\\|') || ' | ' || CASE WHEN flag = 1 THEN '⚠️' ELSE '' END || ' |' FROM (
           SELECT {Q.strip('term')} AS t, arg_max(description, struct_pack(l := length(description), a := -doc_id, b := -pos)) AS description, min(flag) AS flag FROM terms GROUP BY t) WHERE t <> ''
         UNION ALL SELECT 'links', '| ' || path || ' | ' || line_no || ' | ' || CASE link_type WHEN 'image' THEN '画像' WHEN 'anchor' THEN 'アンカー' ELSE 'md' END || ' | `' || target || '` | ' || issue || ' |' FROM link_issues
         UNION ALL SELECT 'overview', '| ' || name || ' | ' || length(text) || ' | ' || coalesce(n, 0) || ' | ' || coalesce(t, '-') || ' |' FROM md_docs LEFT JOIN (SELECT doc_id, count(*) AS n, arg_min(clean_title, chapter_no) AS t FROM chapter_rows GROUP BY doc_id) USING (doc_id)""")
def _(spark, d):
    parts = {
        "readme": A.readme_rows(mapping(spark, d)), "glossary": A.glossary_rows(I.glossary(terms(spark, d), "doc_id", "pos")),
        "links": A.link_report_rows(_issues(spark, d)), "overview": A.overview_rows(md_docs(spark, d)),
    }
    out = None
    for name, rows in parts.items():
        one = rows.select(F.lit(name).alias("report"), "line")
        out = one if out is None else out.unionByName(one)
    return out


@query("update_report", "section:l key:l source:s place:l line:s",
       f"""SELECT CASE result WHEN 'created' THEN 1 WHEN 'updated' THEN 2 WHEN 'skipped' THEN 3 ELSE 4 END AS section, key, source, 0 AS place, CASE result WHEN 'created' THEN '| `' || target || '` | ' || source || ' | ' || reason || ' |'
         WHEN 'updated' THEN '### ' || source || ' → ' || target WHEN 'skipped' THEN '| ' || source || ' | ' || reason || ' |' ELSE '| ' || source || ' | ' || result || ' | ' || reason || ' |' END AS line FROM exec_outcomes
       UNION ALL SELECT 2, o.key, o.source, 1, '**マージ後サイズ**: ' || format('{{:,}}', length(f.text)) || '文字' FROM exec_outcomes o JOIN exec_files f ON f.target = o.target AND o.step = f.n_edits WHERE o.result = 'updated'
       UNION ALL SELECT 2, o.key, o.source, 2, '**分割**: ⚠️ ' || p.n || 'ファイルに分割されました（' || format('{{:,}}', {WRITTEN}) || '文字超過のため）' FROM exec_outcomes o JOIN exec_files f ON f.target = o.target AND o.step = f.n_edits
         JOIN (SELECT target, count(*) AS n FROM exec_long JOIN exec_parts USING (doc_id) GROUP BY target) p ON p.target = o.target WHERE o.result = 'updated'
       UNION ALL SELECT 2, o.key, o.source, CASE kind WHEN 'added' THEN 100 + place WHEN 'changed' THEN 200 + place ELSE 300 END, CASE kind
           WHEN 'added' THEN CASE WHEN heading IS NULL THEN '| ✨ ... 他' || n || '件の新規セクション | ' || c.target || ' |  |  |  |' ELSE '| ✨ 新規: ' || heading || ' | ' || c.target || ' | （末尾に追加） | （なし） | 新規セクション追加 |' END
           WHEN 'changed' THEN CASE WHEN heading IS NULL THEN '| 📝 ... 他' || n || '件の更新セクション | ' || c.target || ' |  |  |  |' ELSE '| 📝 更新: ' || heading || ' | ' || c.target || ' | ' || line_start || '-' || line_end || '行 | 既存の内容 | 更新された内容 |' END
           ELSE '| 📌 保持: 既存' || n || 'セクション | ' || c.target || ' | （既存内容を保持） |  |  |' END
         FROM exec_outcomes o JOIN (SELECT x.*, target FROM ({_changes_sql('pair_diff')}) x JOIN plan_pairs USING (pair)) c ON c.pair = o.key WHERE o.result = 'updated'""")
def _(spark, d):
    rows = plan(spark, d).checkpoint()
    files, outcomes = _execution(spark, d, rows)
    parts = F.when(F.col("result") == "updated", F.size(C.split_large_update(F.col("text"), WRITTEN)))
    about = files.select("target", "n_edits", F.length("text").alias("n_chars"), F.coalesce(parts, F.lit(1)).alias("n_parts"))
    return A.update_report_rows(outcomes, about, U.plan_changes(_plan_pairs(spark, d, rows)), WRITTEN)


# User functions


@query("register_converter", "page_id:l status:s n_chars:l message:s",
       """SELECT page_id, CASE WHEN ext = '.pdf' AND page_id % 4 <> 0 THEN 'failed' WHEN ext IN ('.pdf', '.txt', '.xlsx') THEN 'success' ELSE 'failed' END AS status,
         CASE WHEN (ext = '.pdf' AND page_id % 4 = 0) OR ext IN ('.txt', '.xlsx') THEN strlen(html) + CASE page_id % 4 WHEN 1 THEN 24 WHEN 2 THEN 8 ELSE 4 END END AS n_chars,
         CASE WHEN ext = '.pdf' AND page_id % 4 <> 0 THEN 'no package' WHEN ext IN ('.pdf', '.txt', '.xlsx') THEN '' ELSE 'Unsupported file format: ' || ext END AS message FROM files JOIN pages USING (page_id)""")
def _(spark, d):
    def size(content: bytes) -> str:
        return str(len(content))

    def package_only(content: bytes) -> str:
        if content[:2] != b"PK":
            raise ValueError("no package")
        return str(len(content))

    registry = X.Converters()
    for ext, convert in ((".txt", size), (".xlsx", size), (".PDF", package_only)):
        registry.register(ext, convert)
    source = containers(spark, d)
    return registry.convert(source).join(source.select("path", "page_id"), "path").withColumn("n_chars", F.col("text").cast("bigint"))


@query("batch_infer", "key:l response:s error:s tries:l",
       """SELECT doc_id AS key, CASE WHEN doc_id % 10 <> 0 THEN lower(left(text, 20)) END AS response, CASE WHEN doc_id % 10 = 0 THEN 'refused' END AS error,
         CASE WHEN doc_id % 10 = 0 THEN 3 ELSE 1 END AS tries FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _(spark, d):
    def answer(prompt: str) -> str:
        if prompt.startswith("0"):
            raise RuntimeError("refused")
        return prompt[1:21].lower()

    prompts = documents(spark, d).select(
        F.col("doc_id").alias("key"), F.concat((F.col("doc_id") % 10).cast("string"), "text").alias("prompt"))
    done = table(spark, d, "labels").select(F.col("doc_id").alias("key"))
    return X.batch_infer(prompts, answer, done, wait=0.0)


def responses(spark, d):
    """Answers as JSON in a fence, bare, with leading prose, or broken."""
    k = F.col("conv_id") % 4
    js = F.to_json(F.struct(F.col("text").alias("formatted_markdown"), F.array(F.struct(
        F.col("role").alias("term"), F.lit("d").alias("description"), F.lit(1).alias("flag"))).alias("terms")))
    out = (F.when(k == 0, F.concat(F.lit("```json\n"), js, F.lit("\n```"))).when(k == 1, js)
           .when(k == 2, F.concat(F.lit("Here it is: "), js)).otherwise(F.concat(F.lit("{broken "), "text")))
    return table(spark, d, "conversations").select("conv_id", "turn", "text", out.alias("response"))


@query("parse_responses", "conv_id:l turn:l parsed:b hash:s n_terms:l has_object:b",
       f"""SELECT conv_id, turn, conv_id % 4 < 2 AS parsed, CASE WHEN conv_id % 4 < 2 THEN md5(text) END AS hash, CASE WHEN conv_id % 4 < 2 THEN 1 ELSE 0 END AS n_terms, conv_id % 4 < 3 AS has_object FROM conversations""")
def _(spark, d):
    r = responses(spark, d).select("conv_id", "turn", F.explode(F.array(X.parse_markdown_response(F.col("response")))).alias("p"),
                                   X.first_object(F.col("response")).isNotNull().alias("has_object"))
    return r.select("conv_id", "turn", "p.parsed", F.when(F.col("p.parsed"), content_hash(F.col("p.markdown"))).alias("hash"),
                    F.size("p.terms").alias("n_terms"), "has_object")


@query("attach_enhancement", "conv_id:l turn:l stage:s summary_short:s summary_long:s file_type:s",
       """SELECT conv_id, turn, CASE WHEN conv_id % 3 < 2 AND text <> '' THEN 'ai_enhanced' ELSE 'structured' END AS stage, CASE WHEN conv_id % 3 < 2 AND text <> '' THEN text END AS summary_short,
         CASE WHEN conv_id % 3 < 2 AND text <> '' THEN text END AS summary_long, CASE WHEN conv_id % 3 < 2 AND text <> '' THEN role END AS file_type FROM conversations""")
def _(spark, d):
    k = F.col("conv_id") % 3
    fields = [F.col("text").alias("summary_short"), F.col("text").alias("summary_long"), F.array(F.lit("a")).alias("companies")]
    full = F.to_json(F.struct(*fields, F.col("role").alias("file_type")))
    # The third kind lacks a required field.
    js = F.when(k < 2, full).otherwise(F.to_json(F.struct(*fields)))
    rec = structure_record(F.col("conv_id").cast("string"), F.col("text"), F.lit(TS)).withField("text", F.when(k == 0, F.col("text")))
    c = table(spark, d, "conversations").select("conv_id", "turn", F.explode(F.array(F.struct(
        rec.alias("rec"), X.parse_enhancement(js).alias("e")))).alias("x"))
    done = X.attach_enhancement(F.col("x.rec"), F.col("x.e"), F.lit(TS), F.lit("m"))
    return c.select("conv_id", "turn", F.explode(F.array(done)).alias("r")).select(
        "conv_id", "turn", "r.processing.stage", "r.ai_enhancement.summary_short", "r.ai_enhancement.summary_long", "r.ai_enhancement.file_type")
