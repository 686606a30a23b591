"""Column functions, each run over a whole table."""

from pyspark.sql import functions as F

from ..functions import patterns as P, similarity as M, text as T
from ..operators.structure import all_sections, heading_titles, headings, summary, unfold
from ..views import converter_results, documents, files, md_docs, md_docs_v2, table, versions
from . import sqlviews as Q
from .registry import query
from .structure import sections_sql, summary_sql

SP = P.SPACE


def _col(name, columns, build, sql, source=documents):
    @query(name, columns, sql)
    def _(spark, d):
        return source(spark, d).select("doc_id", *build())


def _x():
    return F.col("text")


_col("normalize_content", "doc_id:l value:s", lambda: [T.normalize_content(_x()).alias("value")],
     f"SELECT doc_id, {Q.normalize_content('text')} AS value FROM md_docs", md_docs)
_col("normalize_title", "doc_id:l value:s", lambda: [T.normalize_title(_x()).alias("value")],
     f"SELECT doc_id, {Q.normalize_title('text')} AS value FROM md_docs", md_docs)
_col("anchor", "doc_id:l value:s", lambda: [T.anchor(_x()).alias("value")],
     f"SELECT doc_id, {Q.anchor('text')} AS value FROM documents")


def _decorated():
    return F.concat(F.lit("【v"), F.col("doc_id").cast("string"), F.lit("】★2024-01-05__"), F.col("source"),
                    F.lit("__"), F.col("text"))


_DECORATED = "'【v' || doc_id || '】★2024-01-05__' || source || '__' || text"
_col("clean_filename", "doc_id:l value:s", lambda: [T.clean_filename(_decorated()).alias("value")],
     f"SELECT doc_id, {Q.clean_filename(_DECORATED)} AS value FROM documents")


def _output_name():
    k = F.col("doc_id")
    return F.concat(
        F.when(k % 2 == 0, F.lit("240105_")).otherwise(F.lit("★")), F.col("source"), F.lit("【x】 "),
        F.col("text"), F.when(k % 3 == 0, F.lit(" (2)")).otherwise(F.lit("")))


_OUTPUT_NAME = ("CASE WHEN doc_id % 2 = 0 THEN '240105_' ELSE '★' END || source || '【x】 ' || text "
                "|| CASE WHEN doc_id % 3 = 0 THEN ' (2)' ELSE '' END")
_col("clean_output_name", "doc_id:l value:s", lambda: [T.clean_output_name(_output_name()).alias("value")],
     f"SELECT doc_id, {Q.clean_output_name(f'({_OUTPUT_NAME})')} AS value FROM documents")
_col("sanitize_filename", "doc_id:l value:s title:s",
     lambda: [T.sanitize_filename(_x()).alias("value"), T.sanitize_title(_x()).alias("title")],
     f"""SELECT doc_id, left({Q.strip(r"regexp_replace(text, '[\\/*?:\"<>|\n\r\t]', '_', 'g')")}, 120) AS value,
       regexp_replace(text, '[/\\\\:*?"<>|]', '・', 'g') AS title FROM documents""")
_col("truncate", "doc_id:l short:s preview:s cut:s",
     lambda: [T.truncate(_x(), 60).alias("short"), T.preview(_x()).alias("preview"), F.substring("text", 1, 150).alias("cut")],
     """SELECT doc_id, CASE WHEN length(text) > 60 THEN left(text, 57) || '...' ELSE text END AS short,
       CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS preview, left(text, 150) AS cut FROM documents""")
_col("content_hash", "doc_id:l hash:s", lambda: [T.content_hash(_x()).alias("hash")],
     "SELECT doc_id, md5(text) AS hash FROM documents")
_col("chapter_id", "doc_id:l chapter_id:s", lambda: [T.chapter_id(_x(), F.col("doc_id")).alias("chapter_id")],
     f"""SELECT doc_id, coalesce(nullif(regexp_replace(regexp_replace(left(text, 20), '[^{P.WORD}]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'doc')
       || '_' || left(md5(text), 8) || '_' || CASE WHEN doc_id < 1000 THEN lpad(doc_id::VARCHAR, 3, '0') ELSE doc_id::VARCHAR END AS chapter_id
       FROM documents""")


def _range_text():
    k = F.col("doc_id")
    return (F.when(k % 4 == 0, F.concat(T.pad(k % 50, 3), F.lit("-"), T.pad(k % 50 + 15, 3)))
            .when(k % 4 == 1, (k % 60).cast("string")).when(k % 4 == 2, F.lit("all")).otherwise(F.lit("5-")))


@query(
    "parse_chapter_range", "doc_id:l first:l last:l",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN greatest(0, doc_id % 50 - 1) WHEN 1 THEN greatest(0, doc_id % 60 - 1) ELSE 0 END AS first,
      CASE doc_id % 4 WHEN 0 THEN least(doc_id % 50 + 14, n - 1) WHEN 1 THEN least(doc_id % 60 - 1, n - 1) ELSE n - 1 END AS last
      FROM (SELECT doc_id, len(string_split(text, chr(10))) AS n FROM documents)""",
)
def _(spark, d):
    r = T.parse_chapter_range(_range_text(), F.size(T.lines(F.col("text"))))
    return documents(spark, d).select("doc_id", r.alias("r")).select("doc_id", "r.*")


def _pair_queries(name, build, sql):
    @query(name, "doc_id:l score:d", sql)
    def _(spark, d):
        return versions(spark, d).select("doc_id", build().alias("score"))


_pair_queries("string_similarity", lambda: M.string_similarity(F.col("before"), F.col("after")),
              f"""SELECT doc_id, {Q.jaccard('a', 'b')} AS score FROM
              (SELECT doc_id, {Q.word_set('before')} AS a, {Q.word_set('after')} AS b FROM versions)""")


def _titles_sql(text):
    h = P.HEADING_1_4
    picked = f"list_filter(string_split({text}, chr(10)), lambda x: regexp_matches(x, '{h}'))"
    title = Q.strip(f"regexp_extract(x, '{h}', 2)")
    return f"list_transform({picked}, lambda x: {title})"


def _lower_list(x):
    return f"list_distinct(list_transform({x}, lambda y: lower(y)))"


_pair_queries("list_similarity", lambda: M.list_similarity(heading_titles(F.col("before")), heading_titles(F.col("after"))),
              f"""SELECT doc_id, {Q.jaccard('a', 'b')} AS score FROM (SELECT doc_id, {_lower_list(_titles_sql('before'))} AS a,
              {_lower_list(_titles_sql('after'))} AS b FROM versions)""")


def content_similarity_sql(rows: str, keep: str) -> str:
    """(keep, score) over ``rows(keep, a, b)``."""
    def grams(c):
        return (f"list_distinct(list_transform(list_slice(list_zip({c}, list_slice({c}, 2, len({c})), list_slice({c}, 3, len({c}))), 1, len({c}) - 2), "
                f"lambda z: z[1] || z[2] || z[3]))")
    return f"""SELECT {keep}, CASE WHEN a = '' OR b = '' THEN 0.0 WHEN na = nb THEN 1.0 WHEN na = '' OR nb = '' THEN 0.0
        WHEN len(ga) = 0 OR len(gb) = 0 THEN {Q.jaccard('wa', 'wb')}
        ELSE {Q.jaccard('wa', 'wb')} * 0.4::DOUBLE + {Q.jaccard('ga', 'gb')} * 0.6::DOUBLE END AS score
      FROM (SELECT *, list_distinct(string_split(lower(na), ' ')) AS wa, list_distinct(string_split(lower(nb), ' ')) AS wb,
          {grams('ca')} AS ga, {grams('cb')} AS gb
        FROM (SELECT *, string_split(lower(na), '') AS ca, string_split(lower(nb), '') AS cb
          FROM (SELECT *, {Q.normalize_content('a')} AS na, {Q.normalize_content('b')} AS nb FROM ({rows}))))"""


_pair_queries("content_similarity", lambda: M.content_similarity(F.col("before"), F.col("after")),
              content_similarity_sql("SELECT doc_id, before AS a, after AS b FROM versions", "doc_id"))
_NAMES = "string_split(name || '.md', '/')[-1]"


@query(
    "document_similarity", "doc_id:l score:d",
    f"""SELECT b.doc_id, {Q.jaccard(Q.word_set('b.name'), Q.word_set("b.name || '.md'"))} * 0.20::DOUBLE
        + {Q.jaccard(Q.word_set('sb.summary'), Q.word_set('sa.summary'))} * 0.40::DOUBLE
        + {Q.jaccard(_lower_list(_titles_sql('b.text')), _lower_list(_titles_sql('a.text')))} * 0.30::DOUBLE
        + (1.0::DOUBLE - least(abs(length(b.text) - length(a.text))::DOUBLE / greatest(length(b.text), length(a.text)), 1.0::DOUBLE)) * 0.10::DOUBLE AS score
      FROM md_docs b JOIN md_docs_v2 a USING (doc_id) JOIN ({summary_sql('md_docs')}) sb USING (doc_id)
      JOIN ({summary_sql('md_docs_v2')}) sa USING (doc_id)""",
)
def _(spark, d):
    b, a = F.col("before"), F.col("after")
    return versions(spark, d).select("doc_id", M.weighted_document_score(
        M.string_similarity(F.col("name"), F.concat("name", F.lit(".md"))),
        M.string_similarity(summary(b), summary(a)),
        M.list_similarity(heading_titles(b), heading_titles(a)),
        M.size_similarity(F.length(b), F.length(a)),
    ).alias("score"))


@query(
    "cosine", "vec_id:l score:d",
    """SELECT vec_id, list_dot_product(e, list_reverse(e)) / sqrt(list_dot_product(e, e)) / sqrt(list_dot_product(e, e)) AS score
      FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)""",
)
def _(spark, d):
    return table(spark, d, "embeddings").select(
        "vec_id", M.cosine(F.col("embedding"), F.reverse("embedding")).alias("score"))


def _cell():
    k = F.col("p_partkey")
    return (F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 5 == 1, F.concat(F.lit(" a|"), F.col("p_name")))
            .when(k % 5 == 2, F.concat(F.col("p_name"), F.lit("\r\nx\ry\nz "))).otherwise(F.col("p_brand")))


@query(
    "sanitize_cell", "p_partkey:l cell:s",
    f"""SELECT p_partkey, replace(replace(replace(replace({Q.strip('c')}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10), '<br>'), '|', '\\|') AS cell
      FROM (SELECT p_partkey, coalesce(CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' a|' || p_name
        WHEN 2 THEN p_name || chr(13) || chr(10) || 'x' || chr(13) || 'y' || chr(10) || 'z ' ELSE p_brand END, '') AS c FROM part)""",
)
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", T.sanitize_cell(_cell()).alias("cell"))


@query(
    "strip_code_fence", "doc_id:l value:s",
    f"""SELECT doc_id, CASE doc_id % 4 WHEN 3 THEN text ELSE {Q.strip('text')} END AS value FROM md_docs""",
)
def _(spark, d):
    k = F.col("doc_id")
    fenced = (F.when(k % 4 == 0, F.concat(F.lit("```markdown\n"), "text", F.lit("\n```")))
              .when(k % 4 == 1, F.concat(F.lit("```"), "text", F.lit("\n```")))
              .when(k % 4 == 2, F.concat(F.lit("``` \n"), "text", F.lit("\n```"))).otherwise(F.col("text")))
    return md_docs(spark, d).select("doc_id", T.strip_code_fence(fenced).alias("value"))


@query(
    "normalise_original_path", "page_id:l value:s",
    """SELECT page_id, CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 5 = 4 THEN '/other/' || path ELSE path END AS value FROM files""",
)
def _(spark, d):
    k = F.col("page_id")
    raw = (F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.concat(F.lit("home/base/"), "path"))
           .when(k % 5 == 2, F.concat(F.lit("/home/base/"), "path")).when(k % 5 == 3, F.concat(F.lit("store/"), "path"))
           .otherwise(F.concat(F.lit("/other/"), "path")))
    return files(spark, d).select("page_id", T.normalise_original_path(raw, "/home/base", "store/").alias("value"))


@query(
    "resolve_path", "doc_id:l resolved:s",
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN category || '/x.md' WHEN 1 THEN 'x/y.md' WHEN 2 THEN 'x.md'
      WHEN 3 THEN category || '/b/c.md' ELSE '../x.md' END AS resolved FROM md_docs""",
)
def _(spark, d):
    k = F.col("doc_id")
    target = (F.when(k % 5 == 0, F.lit("./x.md")).when(k % 5 == 1, F.lit("/x//y.md")).when(k % 5 == 2, F.lit("../x.md"))
              .when(k % 5 == 3, F.lit("a/../b/./c.md")).otherwise(F.lit("../../x.md")))
    return md_docs(spark, d).select("doc_id", T.resolve_path(F.col("category"), target).alias("resolved"))


@query(
    "format_numbers", "doc_id:l thousands:s two:s three:s share:s",
    """SELECT doc_id, format('{:,}', length(text)) AS thousands, lpad((doc_id % 100)::VARCHAR, 2, '0') AS two,
      CASE WHEN doc_id < 1000 THEN lpad(doc_id::VARCHAR, 3, '0') ELSE doc_id::VARCHAR END AS three,
      CAST(round((doc_id % 1000)::DOUBLE / 1000::DOUBLE * 100) AS BIGINT) || '%' AS share FROM documents""",
)
def _(spark, d):
    k, n = F.col("doc_id"), F.length("text")
    return documents(spark, d).select(
        "doc_id", F.format_number(n, 0).alias("thousands"), T.pad(k % 100, 2).alias("two"), T.pad(k, 3).alias("three"),
        T.percent((k % 1000) / 1000.0).alias("share"))


@query(
    "parse_leading_number", "doc_id:l line_no:l heading_no:l file_no:l",
    f"""SELECT m.doc_id, line_no, nullif(regexp_extract(title, '^([0-9]+)', 1), '')::BIGINT AS heading_no,
      nullif(regexp_extract(string_split(kb_path, '/')[-1], '^([0-9]+)_', 1), '')::BIGINT AS file_no
      FROM md_docs m JOIN (SELECT doc_id, line_no, {Q.strip(f"regexp_extract(line, '{P.HEADING_1_4}', 2)")} AS title
        FROM md_lines WHERE regexp_matches(line, '{P.HEADING_1_4}')) h USING (doc_id)""",
)
def _(spark, d):
    rows = unfold(md_docs(spark, d), headings(F.col("text")), "doc_id", "kb_path")
    return rows.select(
        "doc_id", "line_no", T.leading_number(F.col("title")).alias("heading_no"),
        T.leading_number(F.substring_index("kb_path", "/", -1), "_").alias("file_no"))
