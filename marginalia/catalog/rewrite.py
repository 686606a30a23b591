"""Renumbering, tables of contents, skeletons and chunks."""

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import chunking as C, rewrite as R
from ..operators.structure import unfold
from ..views import md_docs, md_docs_v2
from . import sqlviews as Q
from .classify import long_docs
from .registry import query
from .structure import links_sql

SP = P.SPACE
NL = "chr(10)"


def body_docs(spark, d):
    """Bodies with all kinds of headings: quotes as level two, image lines below a related-material
    heading, links as numbered list entries."""
    k, t = F.col("doc_id"), F.col("text")
    t = F.when(k % 3 == 0, F.regexp_replace(t, "(?md)^> ", "## ")).otherwise(t)
    t = F.when(k % 4 == 1, F.regexp_replace(t, r"(?md)^!\[", "## 関連資料\n![")).otherwise(t)
    t = F.when(k % 2 == 0, F.regexp_replace(t, r"(?md)^\[([^\]\n]*)\]\(", r"- [1.2 $1](")).otherwise(t)
    return md_docs(spark, d).select("doc_id", "name", t.alias("text"))


Q.VIEWS["body_docs"] = f"""SELECT doc_id, name, CASE WHEN doc_id % 2 = 0 THEN regexp_replace(t2, '(?m)^\\[([^\\]\\n]*)\\]\\(', '- [1.2 \\1](', 'g') ELSE t2 END AS text
  FROM (SELECT *, CASE WHEN doc_id % 4 = 1 THEN regexp_replace(t1, '(?m)^!\\[', '## 関連資料' || {NL} || '![', 'g') ELSE t1 END AS t2
    FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN regexp_replace(text, '(?m)^> ', '## ', 'g') ELSE text END AS t1 FROM md_docs))"""


def split_lines_sql(text):
    u = f"regexp_replace({text}, '\\r\\n|[\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\x{{2028}}\\x{{2029}}]', {NL}, 'g')"
    return f"string_split(regexp_replace({u}, '\\n$', ''), {NL})"


def _lines(source, text="text"):
    ls = split_lines_sql(text)
    return f"SELECT doc_id, unnest({ls}) AS line, generate_subscripts({ls}, 1) AS line_no FROM {source}"


def _x(pattern, group=1, of="s"):
    return Q.strip(f"regexp_extract({of}, '{pattern}', {group})")


def _marks(x):
    return Q.strip(f"regexp_replace({x}, '^[.・\\-–— ]+', '')")


def renumber_sql(source, text="text"):
    """(doc_id, text) of the renumbered bodies."""
    anchor = "'<a id=\"sec-' || major || '\"></a>'"
    sub_anchor = "'<a id=\"sec-' || major || '-' || minor || '\"></a>'"
    title3 = _marks(f"CASE WHEN regexp_matches(s, '{R.H3_LINK}') THEN {_x(R.H3_LINK, 2)} WHEN regexp_matches(s, '{R.H3_NUMBERED}') THEN {_x(R.H3_NUMBERED)} ELSE {_x(R.H3)} END")
    title4 = _marks(f"CASE WHEN regexp_matches(s, '{R.H4_NUMBERED}') THEN {_x(R.H4_NUMBERED)} ELSE {_x(R.H4)} END")
    return f"""SELECT doc_id, {Q.strip(f"string_agg(out, {NL} ORDER BY line_no)")} AS text FROM (
      SELECT doc_id, line_no, CASE kind2
          WHEN 'M' THEN {anchor} || {NL} || '### ' || major || '. ' || title || {NL}
          WHEN 'm' THEN CASE WHEN synthetic AND is_first THEN {anchor} || {NL} || '### 1. 概要' || {NL} || {NL} ELSE '' END
            || {sub_anchor} || {NL} || '#### ' || major || '.' || minor || ' ' || title ELSE line END AS out
      FROM (SELECT *, sum((kind2 = 'm')::INT) OVER (PARTITION BY doc_id, major ORDER BY line_no) AS minor
        FROM (SELECT *, sum((kind2 = 'M' OR (synthetic AND is_first))::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS major
          FROM (SELECT *, CASE WHEN is_first AND kind = '2' THEN 'M' WHEN kind IN ('2', 's', 'm') THEN 'm' ELSE kind END AS kind2,
              is_first AND kind IN ('s', 'm') AS synthetic
            FROM (SELECT *, kind <> 't' AND row_number() OVER (PARTITION BY doc_id, kind <> 't' ORDER BY line_no) = 1 AS is_first
              FROM (SELECT *, last(CASE WHEN starts_with(s, '#') THEN kind END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS under
                FROM (SELECT *, CASE kind WHEN '2' THEN {_x(R.H2)} WHEN 'M' THEN CASE WHEN contains({title3}, '](#') THEN {Q.strip(f"string_split({title3}, '](#')[1]")} ELSE {title3} END
                    WHEN 'm' THEN {title4} WHEN 's' THEN {_x(R.SUB_LINK, 3)} END AS title
                  FROM (SELECT *, CASE WHEN regexp_matches(s, '{R.ANCHOR_LINE}') OR regexp_matches(s, '^#[{SP}]+[^\\n]+$') THEN 'x'
                      WHEN regexp_matches(s, '{R.RELATED}') THEN 'r'
                      WHEN regexp_matches(s, '{R.H2}') THEN CASE WHEN lower({_x(R.H2)}) IN ('サマリー', 'summary', '目次', 'table of contents') THEN 'x' ELSE '2' END
                      WHEN regexp_matches(s, '{R.H3}') THEN 'M' WHEN regexp_matches(s, '{R.H4}') THEN 'm' WHEN regexp_matches(s, '{R.SUB_LINK}') THEN 's' ELSE 't' END AS kind
                    FROM (SELECT *, {Q.strip('line')} AS s FROM ({_lines(source, text)})))))
              WHERE kind NOT IN ('x', 'r') AND coalesce(under, '') <> 'r'))))) GROUP BY doc_id"""


def toc_entries_sql(source):
    """(doc_id, line_no, major, minor, title) of renumbered texts."""
    return f"""SELECT doc_id, line_no, CASE WHEN minor IS NULL THEN m ELSE major END AS major, minor, title FROM (
        SELECT *, last(CASE WHEN minor IS NULL THEN m END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS major
        FROM (SELECT doc_id, line_no, CASE WHEN regexp_matches(s, '^###[{SP}]+[0-9]+[.][{SP}]+[^\\n]+$') THEN regexp_extract(s, '^###[{SP}]+([0-9]+)', 1) ELSE regexp_extract(s, '^####[{SP}]+([0-9]+)', 1) END::BIGINT AS m,
            nullif(regexp_extract(s, '^####[{SP}]+[0-9]+[.]([0-9]+)', 1), '')::BIGINT AS minor, {Q.strip(f"regexp_extract(s, '^####?[{SP}]+[0-9]+[.][0-9]*[{SP}]+([^\\n]+)$', 1)")} AS title
          FROM (SELECT *, {Q.strip('line')} AS s FROM ({_lines(source)}))
          WHERE regexp_matches(s, '^###[{SP}]+[0-9]+[.][{SP}]+[^\\n]+$') OR regexp_matches(s, '^####[{SP}]+[0-9]+[.][0-9]+[{SP}]+[^\\n]+$')))
      WHERE major IS NOT NULL AND (minor IS NULL OR m = major)"""


def toc_text_sql(entries):
    return f"""SELECT doc_id, string_agg(CASE WHEN minor IS NULL THEN CASE WHEN k > 1 THEN {NL} ELSE '' END || '### [' || {Q.strip("major || '. ' || title")} || '](#sec-' || major || ')'
        ELSE '- [' || {Q.strip("major || '.' || minor || ' ' || title")} || '](#sec-' || major || '-' || minor || ')' END, {NL} ORDER BY line_no) AS toc
      FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS k FROM ({entries})) GROUP BY doc_id"""


Q.VIEWS["renumbered"] = renumber_sql("body_docs")
Q.VIEWS["renumbered_toc"] = toc_entries_sql("renumbered")


@query("renumber_headings", "doc_id:l text:s", "SELECT * FROM renumbered")
def _(spark, d):
    return body_docs(spark, d).select("doc_id", R.renumber_headings(F.col("text")).alias("text"))


@query("derive_toc", "doc_id:l seq:l major:l minor:l title:s",
       "SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS seq FROM renumbered_toc")
def _(spark, d):
    rows = body_docs(spark, d).select("doc_id", F.explode(F.array(R.renumber_headings(F.col("text")))).alias("text"))
    return rows.select("doc_id", F.posexplode(R.derive_toc(F.col("text"))).alias("i", "e")).select(
        "doc_id", (F.col("i") + 1).alias("seq"), "e.*")


@query("render_toc", "doc_id:l toc:s",
       f"SELECT doc_id, coalesce(toc, '') AS toc FROM renumbered LEFT JOIN ({toc_text_sql('SELECT * FROM renumbered_toc')}) USING (doc_id)")
def _(spark, d):
    rows = body_docs(spark, d).select("doc_id", F.explode(F.array(R.renumber_headings(F.col("text")))).alias("text"))
    return rows.select("doc_id", R.render_toc(R.derive_toc(F.col("text"))).alias("toc"))


Q.VIEWS["final_parts"] = f"""SELECT doc_id, any_value(title) AS title,
    {Q.strip(f"coalesce(string_agg(line, {NL} ORDER BY line_no) FILTER (WHERE line_no > i_sum AND line_no < i_toc AND s <> '---'), '')")} AS summary,
    {Q.strip(f"coalesce(string_agg(line, {NL} ORDER BY line_no) FILTER (WHERE line_no >= i_end), '')")} AS body
  FROM (SELECT *, min(line_no) FILTER (WHERE line_no > i_toc AND (s = '---' OR (starts_with(s, '### ') AND NOT starts_with(s, '### [')))) OVER (PARTITION BY doc_id) AS i_end
    FROM (SELECT *, min(line_no) FILTER (WHERE starts_with(s, '## サマリー')) OVER w AS i_sum, min(line_no) FILTER (WHERE starts_with(s, '## 目次')) OVER w AS i_toc,
        coalesce(arg_min(s, line_no) FILTER (WHERE starts_with(line, '# ')) OVER w, '# ' || name) AS title
      FROM (SELECT l.*, name, {Q.strip('line')} AS s FROM ({_lines('body_docs')}) l JOIN md_docs USING (doc_id)) WINDOW w AS (PARTITION BY doc_id))) GROUP BY doc_id"""
Q.VIEWS["final_bodies"] = renumber_sql("final_parts", "body")
Q.VIEWS["final_toc"] = toc_text_sql(toc_entries_sql("final_bodies"))


@query("finalize_document", "doc_id:l text:s",
       f"""SELECT doc_id, regexp_replace(p.title || {NL} || {NL} || '## サマリー' || {NL} || CASE WHEN summary <> '' THEN summary || {NL} ELSE '' END || {NL} || '---' || {NL} || {NL}
         || '## 目次' || {NL} || {NL} || CASE WHEN coalesce(toc, '') <> '' THEN toc || {NL} ELSE '' END || {NL} || '---' || {NL} || {NL} || coalesce(b.text, ''), '[{SP}]+$', '') || {NL} AS text
       FROM final_parts p LEFT JOIN final_bodies b USING (doc_id) LEFT JOIN final_toc USING (doc_id)""")
def _(spark, d):
    return body_docs(spark, d).select("doc_id", R.finalize_document(F.col("text"), F.col("name")).alias("text"))


def strip_sql(source):
    return f"""SELECT doc_id, coalesce(string_agg(line, {NL} ORDER BY line_no) FILTER (WHERE keep), '') AS text FROM (
      SELECT *, CASE WHEN mark = 1 THEN false WHEN coalesce(state, 0) = 1 THEN false WHEN mark = 0 AND s = '---' AND before = 1 THEN false ELSE true END AS keep
      FROM (SELECT *, last(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS state,
          last(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
        FROM (SELECT *, CASE WHEN starts_with(s, '## サマリー') OR starts_with(s, '## 目次') THEN 1 WHEN starts_with(s, '## ') OR s = '---' THEN 0 END AS mark
          FROM (SELECT *, {Q.strip('line')} AS s FROM ({Q.explode(source)}))))) GROUP BY doc_id"""


Q.VIEWS["stripped"] = strip_sql("body_docs")
_TOC = f"""SELECT doc_id, '## 目次' || {NL} || {NL} || string_agg(item, {NL} ORDER BY line_no) AS toc, count(*) AS n FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS k, CASE WHEN starts_with(s, '### ') THEN '' ELSE '  ' END || '- [' || title || '](#' || {Q.anchor('title')} || ')' AS item
    FROM (SELECT *, {Q.strip("CASE WHEN starts_with(s, '### ') THEN substr(s, 5) ELSE substr(s, 6) END")} AS title
      FROM (SELECT *, {Q.strip('line')} AS s FROM ({Q.explode('stripped')})) WHERE regexp_matches(s, '^####? ')))"""
Q.VIEWS["short_toc"] = f"{_TOC} WHERE k <= 20 GROUP BY doc_id"
Q.VIEWS["whole_toc"] = f"{_TOC} GROUP BY doc_id"


@query("strip_toc_summary", "doc_id:l text:s", "SELECT * FROM stripped")
def _(spark, d):
    return body_docs(spark, d).select("doc_id", R.strip_toc_summary(F.col("text")).alias("text"))


@query("toc_cap", "doc_id:l toc:s", "SELECT doc_id, coalesce(toc, '') AS toc FROM stripped LEFT JOIN short_toc USING (doc_id)")
def _(spark, d):
    return body_docs(spark, d).select("doc_id", R.build_toc(R.strip_toc_summary(F.col("text"))).alias("toc"))


@query("rebuild_toc", "doc_id:l text:s",
       f"""SELECT doc_id, '# ' || name || {NL} || {NL} || block || {NL} || {NL} || CASE WHEN toc IS NULL THEN '' ELSE toc || {NL} || {NL} END || '---' || {NL} || {NL} || s.text AS text
       FROM body_docs b JOIN stripped s USING (doc_id) LEFT JOIN whole_toc USING (doc_id) JOIN (
         SELECT doc_id, string_agg(line, {NL} ORDER BY line_no) FILTER (WHERE line_no >= o AND line_no < c) AS block FROM (
           SELECT *, min(line_no) FILTER (WHERE line_no > o AND (t = '---' OR starts_with(t, '## '))) OVER (PARTITION BY doc_id) AS c
           FROM (SELECT *, min(line_no) FILTER (WHERE starts_with(t, '## サマリー')) OVER (PARTITION BY doc_id) AS o FROM (SELECT *, {Q.strip('line')} AS t FROM ({Q.explode('body_docs')})))) GROUP BY doc_id) USING (doc_id)""")
def _(spark, d):
    return body_docs(spark, d).select("doc_id", R.rebuild_toc(F.col("text"), F.col("name")).alias("text"))


@query("add_table_headers", "doc_id:l text:s",
       f"""SELECT doc_id, string_agg(CASE WHEN NOT here THEN line WHEN n >= 10 THEN '| ' || array_to_string(list_transform(range(1, n + 1), lambda j: coalesce(h[j], 'col' || j)), ' | ') || ' |' || {NL} || sep || {NL} || line
           ELSE line || {NL} || sep END, {NL} ORDER BY line_no) AS text
         FROM (SELECT *, '| ' || array_to_string(list_transform(range(n), lambda j: '---'), ' | ') || ' |' AS sep,
             [{", ".join(f"'{x}'" for x in R.WIDE_HEADERS)}] AS h,
             pipe AND NOT starts_with(s, '| ---') AND NOT coalesce(starts_with(next, '| ---'), false) AND NOT coalesce(before, false) AS here
           FROM (SELECT *, starts_with(s, '|') AS pipe, lead(s) OVER w AS next, starts_with(lag(s) OVER w, '|') AS before,
               greatest(len(string_split(line, '|')) - 2, 1) AS n FROM (SELECT *, {Q.strip('line')} AS s FROM ({Q.explode('wide_docs')})) WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)))
         GROUP BY doc_id""")
def _(spark, d):
    return wide_docs(spark, d).select("doc_id", R.add_table_headers(F.col("text")).alias("text"))


def wide_docs(spark, d):
    """Tables without separator, with one, and with many columns."""
    k, t = F.col("doc_id"), F.col("text")
    t = F.when(k % 3 == 0, F.regexp_replace(t, r"\|---\|---\|", "| --- | --- |")).when(
        k % 3 == 1, F.regexp_replace(t, r"\| a \| b \|", "| " + " | ".join("abcdefghijklmnop") + " |")).otherwise(t)
    return md_docs(spark, d).select("doc_id", t.alias("text"))


Q.VIEWS["wide_docs"] = f"""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace(text, '|---|---|', '| --- | --- |')
    WHEN 1 THEN replace(text, '| a | b |', '| {" | ".join("abcdefghijklmnop")} |') ELSE text END AS text FROM md_docs"""


@query("normalize_body_with_toc", "doc_id:l n_majors:l n_minors:l n_lines:l")
def _(spark, d):
    docs = body_docs(spark, d).select("doc_id", F.explode(F.array(
        R.normalize_body_with_toc(F.col("text"), F.col("text")))).alias("t"))
    return docs.select(
        "doc_id", F.regexp_count("t", F.lit(r'(?m)^<a id="sec-[0-9]+"></a>$')).alias("n_majors"),
        F.regexp_count("t", F.lit(r'(?m)^<a id="sec-[0-9]+-[0-9]+"></a>$')).alias("n_minors"), F.size(F.split("t", "\n", -1)).alias("n_lines"))


# Chunks


def greedy_sql(items: str, limit: str) -> str:
    """(doc_id, chunk_no, start, n_items, size) of greedy packing over items(doc_id, i, size)."""
    return f"""WITH RECURSIVE it AS MATERIALIZED (SELECT *, sum(size) OVER (PARTITION BY doc_id ORDER BY i) AS cum FROM ({items})),
      c(doc_id, k, start, base) AS (SELECT doc_id, 1, 1, 0::HUGEINT FROM it WHERE i = 1
        UNION ALL SELECT c.doc_id, c.k + 1, min(it.i), arg_min(it.cum - it.size, it.i) FROM c JOIN it ON it.doc_id = c.doc_id AND it.i > c.start AND it.cum - c.base > {limit}
          GROUP BY c.doc_id, c.k),
      s AS (SELECT doc_id, k, start, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY k), 1000000000) AS stop FROM c)
      SELECT s.doc_id, s.k AS chunk_no, s.start, count(*) AS n_items, sum(it.size) AS size FROM s JOIN it ON it.doc_id = s.doc_id AND it.i >= s.start AND it.i < s.stop GROUP BY ALL"""


def _chunk_rows(df, chunks):
    return df.select("doc_id", F.explode(F.array(chunks)).alias("cs")).select(
        "doc_id", F.posexplode("cs").alias("i", "chunk")).select(
        "doc_id", (F.col("i") + 1).alias("chunk_no"), "chunk", F.length("chunk").alias("n_chars"), F.md5(F.col("chunk").cast("binary")).alias("hash"))


Q.VIEWS["long_lines"] = Q.explode("long_docs")


@query("pack_lines", "doc_id:l chunk_no:l n_lines:l n_chars:l",
       f"SELECT doc_id, chunk_no, n_items AS n_lines, size - 1 AS n_chars FROM ({greedy_sql('SELECT doc_id, line_no AS i, length(line) + 1 AS size FROM long_lines', '30000')})")
def _(spark, d):
    return _chunk_rows(long_docs(spark, d), C.pack_lines(F.col("text"))).withColumn("n_lines", F.size(F.split("chunk", "\n", -1)))


_SECS = """SELECT doc_id, sec AS i, sum(length(line) + 1) - 1 AS size FROM (SELECT *, 1 + sum((line_no > 1 AND starts_with(line, '## '))::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS sec
  FROM long_lines) GROUP BY doc_id, sec"""


@query("pack_chunks", "doc_id:l chunk_no:l n_chars:l",
       f"""WITH big AS (SELECT doc_id FROM ({_SECS}) GROUP BY doc_id HAVING count(*) <= 1 OR max(size) > 60000)
       SELECT doc_id, chunk_no, size + 2 * (n_items - 1) AS n_chars FROM ({greedy_sql(_SECS, '30000')}) WHERE doc_id NOT IN (SELECT doc_id FROM big)
       UNION ALL SELECT doc_id, chunk_no, size - 1 FROM ({greedy_sql('SELECT doc_id, line_no AS i, length(line) + 1 AS size FROM long_lines', '30000')}) WHERE doc_id IN (SELECT doc_id FROM big)""")
def _(spark, d):
    return _chunk_rows(long_docs(spark, d), C.pack_chunks(F.col("text")))


def sheet_docs(spark, d):
    """Long documents as sheet exports: chapters become sheets, tables get more columns."""
    t = F.regexp_replace("text", "(?md)^### ", "## シート: ")
    t = F.regexp_replace(t, r"(?md)^\| ([0-9]+) \| ([0-9]+) \|$", r"| $1 | 業務 | $2 | x |")
    return long_docs(spark, d).select("doc_id", "name", t.alias("text"))


Q.VIEWS["sheet_docs"] = """SELECT doc_id, name, regexp_replace(regexp_replace(text, '(?m)^### ', '## シート: ', 'g'),
    '(?m)^\\| ([0-9]+) \\| ([0-9]+) \\|$', '| \\1 | 業務 | \\2 | x |', 'g') AS text FROM long_docs"""


def _sheet_sql(sheets):
    """(id, line_no, line, pipe), the header (id, head), the numbered data lines and their breaks of ``sheets(id, t)``."""
    cell = lambda n: Q.strip(f"string_split(line, '|')[{n}]")
    return f"""l AS MATERIALIZED (SELECT *, starts_with({Q.strip('line')}, '|') AS pipe FROM ({Q.explode(sheets, 't', 'id')})),
      p AS (SELECT id, min(line_no) AS p1, (list(line_no ORDER BY line_no))[2] AS p2 FROM l WHERE pipe GROUP BY id),
      hd AS (SELECT id, string_agg(line, {NL} ORDER BY line_no) AS head FROM l JOIN p USING (id) WHERE line_no <= p1 OR line_no = p2 GROUP BY id),
      dt AS MATERIALIZED (SELECT id AS doc_id, row_number() OVER (PARTITION BY id ORDER BY line_no) AS i, line, length(line) + 1 AS size, head,
          pipe AND len(string_split(line, '|')) >= 4 AND ({cell(3)} NOT IN ('', '-') OR {cell(4)} NOT IN ('', '-')) AS brk
        FROM l JOIN p USING (id) JOIN hd USING (id) WHERE line_no > p1 AND line_no IS DISTINCT FROM p2),
      n AS (SELECT doc_id, count(*) AS n_data, count(*) FILTER (WHERE brk) AS n_brk FROM dt GROUP BY doc_id)"""


def _blocks_sql(starts):
    return f"""SELECT s.doc_id AS id, s.k, any_value(d.head) || {NL} || string_agg(d.line, {NL} ORDER BY d.i) AS x
      FROM ({starts}) s JOIN dt d ON d.doc_id = s.doc_id AND d.i >= s.start AND d.i < s.stop GROUP BY s.doc_id, s.k"""


def _category_sql(sheets, limit):
    """Parts (id, k, x) of ``sheets(id, t)``: by breaks, else by size, else whole."""
    stops = lambda x: f"SELECT *, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY k), 1000000000) AS stop FROM ({x})"
    by_size = greedy_sql(f"SELECT doc_id, i, size, {limit} - length(head) AS room FROM dt JOIN n USING (doc_id) WHERE n_data >= 10 AND n_brk < 2", "it.room")
    return f"""WITH RECURSIVE {_sheet_sql(sheets)},
      g AS MATERIALIZED (SELECT doc_id, b, pt, sum(size) FILTER (WHERE i < pt) AS size, any_value(length(head)) AS h FROM (
          SELECT d.*, k.b, k.pt, k.before FROM (SELECT doc_id, i AS pt, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS b, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), 1) AS before
            FROM dt JOIN n USING (doc_id) WHERE brk AND n_data >= 10 AND n_brk >= 2) k JOIN dt d ON d.doc_id = k.doc_id AND d.i >= k.before AND d.i <= k.pt) GROUP BY ALL),
      f(doc_id, b, size, start, k) AS (
        SELECT DISTINCT doc_id, 0::BIGINT, 0::HUGEINT, 1::BIGINT, 1::BIGINT FROM g
        UNION ALL SELECT doc_id, b, CASE WHEN cuts THEN 0 ELSE total END, CASE WHEN cuts THEN pt ELSE start END, k + CASE WHEN cuts THEN 1 ELSE 0 END
          FROM (SELECT g.doc_id, g.b, g.pt, f.start, f.k, f.size + coalesce(g.size, 0) AS total, g.h + f.size + coalesce(g.size, 0) >= {limit} AND g.pt > f.start AS cuts
            FROM f JOIN g ON g.doc_id = f.doc_id AND g.b = f.b + 1)),
      parts AS (
        SELECT * FROM ({_blocks_sql(stops('SELECT DISTINCT doc_id, k, start FROM f WHERE doc_id IN (SELECT doc_id FROM f WHERE k > 1)'))})
        UNION ALL SELECT * FROM ({_blocks_sql(stops(f'SELECT doc_id, chunk_no AS k, start FROM ({by_size})'))}))
      SELECT id, k, x FROM parts UNION ALL SELECT id, 1, t FROM {sheets} WHERE id NOT IN (SELECT id FROM parts)"""


def _by_size_sql(sheets, limit):
    """Parts (id, k, x) of ``sheets(id, t)`` by size alone."""
    items = greedy_sql(f"SELECT doc_id, i, size, {limit} - length(head) AS room FROM dt", "it.room")
    stops = f"SELECT doc_id, chunk_no AS k, start, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY chunk_no), 1000000000) AS stop FROM ({items})"
    return f"""WITH RECURSIVE {_sheet_sql(sheets)}, parts AS ({_blocks_sql(stops)})
      SELECT id, k, x FROM parts UNION ALL SELECT id, 1, t FROM {sheets} WHERE id NOT IN (SELECT id FROM parts)"""


#: A limit that some sheets exceed.
SHEET_LIMIT = 2000
Q.VIEWS["whole_sheets"] = "SELECT doc_id AS id, text AS t FROM sheet_docs"
Q.VIEWS["merged_sheets"] = f"""WITH l AS (SELECT *, sum(starts_with({Q.strip('line')}, '## シート:')::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS sheet FROM ({Q.explode('sheet_docs')})),
       h AS (SELECT doc_id, string_agg(line, {NL} ORDER BY line_no) AS header FROM l WHERE sheet = 0 GROUP BY doc_id),
       s AS (SELECT doc_id, sheet, string_agg(line, {NL} ORDER BY line_no) AS t FROM l WHERE sheet > 0 GROUP BY doc_id, sheet),
       g AS (SELECT *, sum((sheet = 1 OR NOT (length({Q.strip('t')}) < 100 OR contains(t, '*(空のシート)*')))::INT) OVER (PARTITION BY doc_id ORDER BY sheet) AS grp FROM s),
       m AS (SELECT doc_id, grp, string_agg(t, {NL} || {NL} ORDER BY sheet) AS t FROM g GROUP BY doc_id, grp)
       SELECT doc_id, grp, doc_id * 1000000 + grp AS id, CASE WHEN header IS NULL THEN t ELSE header || {NL} || {NL} || t END AS t FROM m LEFT JOIN h USING (doc_id)"""
Q.VIEWS["large_sheets"] = f"SELECT id, t FROM merged_sheets WHERE length(t) > {SHEET_LIMIT}"


@query("split_sheets", "doc_id:l chunk_no:l n_chars:l hash:s",
       f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY grp, k) AS chunk_no, length(x) AS n_chars, md5(x) AS hash FROM (
         SELECT doc_id, grp, 1 AS k, t AS x FROM merged_sheets WHERE length(t) <= {SHEET_LIMIT}
         UNION ALL SELECT id // 1000000, id % 1000000, k, x FROM ({_category_sql('large_sheets', SHEET_LIMIT)}))""")
def _(spark, d):
    return _chunk_rows(sheet_docs(spark, d), C.split_sheets(F.col("text"), SHEET_LIMIT))


@query("split_by_category", "doc_id:l chunk_no:l n_chars:l hash:s", f"SELECT id AS doc_id, k AS chunk_no, length(x) AS n_chars, md5(x) AS hash FROM ({_category_sql('whole_sheets', 20_000)})")
def _(spark, d):
    return _chunk_rows(sheet_docs(spark, d), C.split_by_category(F.col("text"), 20_000))


@query("split_sheet_by_size", "doc_id:l chunk_no:l n_chars:l hash:s", f"SELECT id AS doc_id, k AS chunk_no, length(x) AS n_chars, md5(x) AS hash FROM ({_by_size_sql('whole_sheets', 20_000)})")
def _(spark, d):
    return _chunk_rows(sheet_docs(spark, d), C.split_sheet_by_size(F.col("text"), 20_000))


def _parts_sql(lossless: bool) -> str:
    """Three parts at level 1-3 headings, else level 1-2, else by lines."""
    lo = "CASE WHEN p = 1 THEN 1 ELSE h[(p - 1) * q + 1] END" if lossless else "h[(p - 1) * q + 1]"
    last = "n" if lossless else "least(z * 3, n)"
    return f"""SELECT doc_id, p AS part_no, md5(array_to_string(list_slice(ls, lo, hi), {NL})) AS hash FROM (
      SELECT *, CASE WHEN h IS NULL THEN (p - 1) * z + 1 ELSE {lo} END AS lo,
        CASE WHEN h IS NULL THEN CASE WHEN p = 3 THEN {last} ELSE least(p * z, n) END WHEN p = 3 THEN n ELSE h[least(p * q, len(h) - 1) + 1] - 1 END AS hi
      FROM (SELECT *, greatest(1, len(h) // 3) AS q, greatest(1, n // 3) AS z, unnest([1, 2, 3]) AS p
        FROM (SELECT doc_id, ls, len(ls) AS n, CASE WHEN len(h3) >= 3 THEN h3 WHEN len(h2) >= 3 THEN h2 END AS h
          FROM (SELECT doc_id, ls, list_filter(range(1, len(ls) + 1), lambda i: regexp_matches(ls[i], '^#{{1,3}}[{SP}]+')) AS h3,
            list_filter(range(1, len(ls) + 1), lambda i: regexp_matches(ls[i], '^#{{1,2}}[{SP}]+')) AS h2 FROM (SELECT doc_id, string_split(text, {NL}) AS ls FROM md_docs_v2)))))"""


def _parts(spark, d, lossless):
    parts = C.split_by_headings(F.col("text"), F.lit(3), lossless=lossless)
    return _chunk_rows(md_docs_v2(spark, d), parts).withColumnRenamed("chunk_no", "part_no")


@query("split_by_headings", "doc_id:l part_no:l hash:s", _parts_sql(True))
def _(spark, d):
    return _parts(spark, d, True)


@query("split_by_headings_mirror", "doc_id:l part_no:l hash:s", _parts_sql(False))
def _(spark, d):
    return _parts(spark, d, False)


from .structure import sections_sql  # noqa: E402

_UPDATE = f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sec) AS i, length(content) + length(heading) + 10 AS size
  FROM ({sections_sql('long_docs')}) WHERE n_lines > 0 AND doc_id IN (SELECT doc_id FROM long_docs WHERE length(text) > 10000)"""


@query("split_large_update", "doc_id:l chunk_no:l path:s n_sections:l",
       f"""SELECT doc_id, chunk_no, 'doc_' || doc_id || CASE WHEN chunk_no > 1 THEN '_part' || chunk_no ELSE '' END || '.md' AS path, n_items AS n_sections
       FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM ({greedy_sql(_UPDATE, '10000')})) WHERE n > 1""")
def _(spark, d):
    rows = long_docs(spark, d).select("doc_id", F.explode(F.array(C.split_large_update(F.col("text")))).alias("cs"))
    parts = rows.select("doc_id", F.posexplode("cs").alias("i", "chunk"))
    path = F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".md"))
    return parts.select(
        "doc_id", (F.col("i") + 1).alias("chunk_no"), C.part_path(path, F.col("i") + 1).alias("path"),
        F.regexp_count("chunk", F.lit(r"(?md)^## ")).alias("n_sections"))
