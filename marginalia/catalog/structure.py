"""Taking documents apart: lines, sections, chapters, links, tables."""

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import anchor
from ..operators import structure as S
from ..views import documents, incoming_docs, md_docs, page_manifest, page_texts, table
from . import sqlviews as Q
from .registry import query

SP = P.SPACE


@query("explode_lines", "doc_id:l line_no:l line:s", Q.explode("documents"))
def _(spark, d):
    return S.unfold(documents(spark, d), S.line_rows(F.col("text")), "doc_id")


@query(
    "structure_text", "doc_id:l total_lines:l total_characters:l file_size_bytes:l n_sections:l stage:s",
    r"""SELECT doc_id, len(string_split(text, chr(10))) AS total_lines, length(text) AS total_characters,
      strlen(text) AS file_size_bytes,
      1 + len(list_filter(list_slice(string_split(text, chr(10)), 2, 1000000000),
        lambda x: regexp_matches(x, '^[%s]*(===|---|#)'))) AS n_sections,
      'structured' AS stage FROM documents""" % SP,
)
def _(spark, d):
    rec = S.structure_record(F.concat(F.lit("doc_"), F.col("doc_id")), F.col("text"), F.lit("2024-01-01T00:00:00"))
    return documents(spark, d).select("doc_id", rec.alias("r")).select(
        "doc_id", "r.metadata.*", F.size("r.content.sections").alias("n_sections"), "r.processing.stage")


@query(
    "raw_sections", "doc_id:l sec_no:l content:s line_count:l",
    f"""SELECT doc_id, sec_no, string_agg(line, chr(10) ORDER BY line_no) AS content, count(*) AS line_count
      FROM (SELECT *, 1 + sum(CASE WHEN line_no > 1 AND regexp_matches(line, '^[{SP}]*(===|---|#)') THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY line_no) AS sec_no FROM md_lines) GROUP BY doc_id, sec_no""",
)
def _(spark, d):
    return S.unfold(md_docs(spark, d), S.raw_sections(F.col("text")), "doc_id")


def _heads(levels: int) -> str:
    h = f"^(#{{1,{levels}}})[{SP}]+([^\\n]+)"
    return f"""SELECT doc_id, line_no, length(regexp_extract(line, '{h}', 1)) AS level,
      {Q.strip(f"regexp_extract(line, '{h}', 2)")} AS title FROM md_lines WHERE regexp_matches(line, '{h}')"""


@query("headings", "doc_id:l line_no:l level:l title:s", _heads(4))
def _(spark, d):
    return S.unfold(md_docs(spark, d), S.headings(F.col("text")), "doc_id")


@query("heading_anchors", "doc_id:l line_no:l anchor:s", f"SELECT doc_id, line_no, {Q.anchor('title')} AS anchor FROM ({_heads(6)})")
def _(spark, d):
    return S.unfold(md_docs(spark, d), S.headings_to_6(F.col("text")), "doc_id").withColumn("anchor", anchor(F.col("title")))


def sections_sql(source: str, keep: str = "doc_id") -> str:
    """(keep, sec, heading, line_start, line_end, n_lines, content) of level 1-4 sections."""
    h = P.HEADING_1_4
    return f"""SELECT {keep}, sec,
      CASE WHEN sec = 0 THEN '{P.OPENING}' ELSE {Q.strip(f"regexp_extract(first(line ORDER BY line_no), '{h}', 2)")} END AS heading,
      min(line_no) AS line_start, max(line_no) AS line_end,
      count(*) - CASE WHEN sec = 0 THEN 0 ELSE 1 END AS n_lines,
      coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT is_head), '') AS content
      FROM (SELECT *, sum(is_head::INT) OVER (PARTITION BY {keep} ORDER BY line_no) AS sec
        FROM (SELECT *, regexp_matches(line, '{h}') AS is_head FROM ({Q.explode(source, keep=keep)})))
      GROUP BY {keep}, sec"""


def keyed_sections_sql(source: str, keep: str = "doc_id") -> str:
    return f"""SELECT {keep}, heading, min(line_start) AS sec_pos, max(line_start) AS line_start,
      max_by(line_end, line_start) AS line_end, max_by(content, line_start) AS content
      FROM ({sections_sql(source, keep)}) GROUP BY {keep}, heading"""


@query("sections_with_lines", "doc_id:l heading:s sec_pos:l line_start:l line_end:l content:s", keyed_sections_sql("md_docs"))
def _(spark, d):
    return S.sections_with_lines(md_docs(spark, d), "text", "doc_id")


@query(
    "sections_list", "doc_id:l sec_no:l heading:s content:s char_count:l",
    f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sec) AS sec_no, heading, content,
      length(content) AS char_count FROM ({sections_sql('md_docs')}) WHERE n_lines > 0""",
)
def _(spark, d):
    return S.unfold(md_docs(spark, d), S.sections_list(F.col("text")), "doc_id")


@query(
    "sections_h12", "doc_id:l sec_no:l title:s content:s",
    f"""SELECT doc_id, sec AS sec_no, first(line ORDER BY line_no) AS title,
      coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT is_head), '') AS content
      FROM (SELECT *, sum(is_head::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS sec
        FROM (SELECT *, regexp_matches(line, '^#{{1,2}}[{SP}]+') AS is_head FROM md_lines))
      WHERE sec > 0 GROUP BY doc_id, sec""",
)
def _(spark, d):
    return S.unfold(md_docs(spark, d), S.sections_h12(F.col("text")), "doc_id")


def chapters_sql(source: str) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_start) AS chapter_no,
        coalesce(lead(line_start) OVER (PARTITION BY doc_id ORDER BY line_start) - 1, n_lines) AS line_end,
        {Q.strip(Q.sub('original_title', f'^[0-9]+[.][{SP}]*'))} AS clean_title
      FROM (SELECT doc_id, line_no AS line_start, n_lines, {Q.strip('substr(t, 5)')} AS original_title
        FROM (SELECT *, min(line_no) FILTER (WHERE is_toc AND line_no > toc_close) OVER (PARTITION BY doc_id) AS toc_again
          FROM (SELECT *, min(line_no) FILTER (WHERE ends AND line_no > toc_open) OVER (PARTITION BY doc_id) AS toc_close
            FROM (SELECT *, min(line_no) FILTER (WHERE is_toc) OVER (PARTITION BY doc_id) AS toc_open,
                count(*) OVER (PARTITION BY doc_id) AS n_lines,
                NOT is_toc AND ((starts_with(t, '## ') AND NOT contains(t, '目次')) OR t = '---'
                  OR starts_with(t, '<a id=') OR is_chapter) AS ends
              FROM (SELECT *, starts_with(t, '## 目次') OR lower(t) = '## table of contents' AS is_toc,
                  starts_with(t, '### ') AND NOT contains(t, '[') AS is_chapter
                FROM (SELECT *, {Q.strip('line')} AS t FROM ({Q.explode(source)}))))))
        WHERE is_chapter AND (toc_open IS NULL OR line_no < toc_open
          OR (line_no >= toc_close AND (toc_again IS NULL OR line_no < toc_again))))"""


@query("chapters", "doc_id:l chapter_no:l original_title:s clean_title:s line_start:l line_end:l", chapters_sql("md_docs"))
def _(spark, d):
    return S.unfold(md_docs(spark, d), S.chapters(F.col("text")), "doc_id")


@query(
    "chapter_previews", "doc_id:l chapter_no:l title:s preview:s line_start:l line_end:l batch:l",
    f"""SELECT c.doc_id, chapter_no, title, line_start, line_end, (chapter_no - 1) // 20 AS batch,
        coalesce(left(string_agg(m.line, chr(10) ORDER BY m.line_no), 1500), '') AS preview
      FROM (SELECT doc_id, {Q.strip('substr(t, 5)')} AS title, line_no AS line_start,
          row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS chapter_no,
          coalesce(lead(line_no) OVER (PARTITION BY doc_id ORDER BY line_no) - 1, n_lines) AS line_end
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_lines,
            last(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS state
          FROM (SELECT *, CASE WHEN starts_with(t, '## 目次') OR lower(t) = '## table of contents' THEN 1
              WHEN t = '---' OR (starts_with(t, '## ') AND NOT contains(t, '目次')) THEN 0 END AS mark
            FROM (SELECT *, {Q.strip('line')} AS t FROM md_lines)))
        WHERE coalesce(state, 0) = 0 AND starts_with(t, '### ') AND NOT starts_with(t, '### [')) c
      LEFT JOIN md_lines m ON m.doc_id = c.doc_id AND m.line_no >= line_start AND m.line_no < least(line_end, line_start + 30)
      GROUP BY ALL""",
)
def _(spark, d):
    return S.unfold(md_docs(spark, d), S.chapter_previews(F.col("text")), "doc_id")


def summary_sql(source: str) -> str:
    """(doc_id, summary): the capped form and, as ``points``, the bullet-free form."""
    return f"""SELECT doc_id,
        array_to_string(list_slice(coalesce(list(t ORDER BY line_no)
          FILTER (WHERE line_no > o1 AND line_no < coalesce(c1, 1000000000) AND t <> '' AND NOT s1), []), 1, 10), chr(10)) AS summary,
        array_to_string(coalesce(list(CASE WHEN starts_with(t, '-') THEN {Q.strip('substr(t, 2)')} ELSE t END ORDER BY line_no)
          FILTER (WHERE line_no > o2 AND line_no < coalesce(c2, 1000000000) AND t <> '' AND NOT s2), []), chr(10)) AS points
      FROM (SELECT *, min(line_no) FILTER (WHERE line_no > o1 AND starts_with(t, '## ') AND NOT s1) OVER w AS c1,
          min(line_no) FILTER (WHERE line_no > o2 AND (starts_with(t, '## ') OR t = '---') AND NOT s2) OVER w AS c2
        FROM (SELECT *, min(line_no) FILTER (WHERE s1) OVER w AS o1, min(line_no) FILTER (WHERE s2) OVER w AS o2
          FROM (SELECT *, starts_with(lower(t), '## サマリー') OR starts_with(lower(t), '## summary') AS s1,
              starts_with(t, '## サマリー') OR lower(t) = '## summary' AS s2
            FROM (SELECT *, {Q.strip('line')} AS t FROM ({Q.explode(source)})))
          WINDOW w AS (PARTITION BY doc_id))
        WINDOW w AS (PARTITION BY doc_id)) GROUP BY doc_id"""


@query("extract_summary", "doc_id:l summary:s points:s", summary_sql("md_docs"))
def _(spark, d):
    return md_docs(spark, d).select(
        "doc_id", S.summary(F.col("text")).alias("summary"), F.array_join(S.summary_points(F.col("text")), "\n").alias("points"))


@query(
    "split_summary_toc_body", "doc_id:l summary:s toc:s body:s",
    f"""SELECT doc_id, {Q.strip("coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE dest = 's'), '')")} AS summary,
        {Q.strip("coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE dest = 't'), '')")} AS toc,
        {Q.strip("coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE dest = 'b'), '')")} AS body
      FROM (SELECT *, CASE WHEN mark IN ('s', 't') THEN 'x' WHEN mark = 'h' THEN 'b'
          WHEN mark = 'r' THEN CASE WHEN before IN ('h', 'r') AND seen THEN 'b' ELSE 'x' END
          ELSE CASE before WHEN 's' THEN 's' WHEN 't' THEN 't' ELSE 'b' END END AS dest
        FROM (SELECT *, last(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
            coalesce(bool_or(mark IN ('s', 't', 'h')) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS seen
          FROM (SELECT *, CASE WHEN starts_with(t, '## サマリー') OR starts_with(t, '## summary') THEN 's'
              WHEN starts_with(t, '## 目次') OR starts_with(t, '## table of contents') THEN 't'
              WHEN regexp_matches(t, '^#{{1,4}} ') THEN 'h' WHEN t = '---' THEN 'r' END AS mark
            FROM (SELECT *, lower({Q.strip('line')}) AS t FROM md_lines))))
      GROUP BY doc_id""",
)
def _(spark, d):
    return md_docs(spark, d).select("doc_id", S.summary_toc_body(F.col("text")).alias("p")).select("doc_id", "p.*")


def links_sql(source: str, keep: str = "doc_id") -> str:
    def part(kind: str, pattern: str, external: str) -> str:
        return f"""SELECT {keep}, line_no, '{kind}' AS kind, link_text, target FROM (
          SELECT {keep}, line_no, unnest(regexp_extract_all(line, '{pattern}', 1)) AS link_text,
            unnest(regexp_extract_all(line, '{pattern}', 2)) AS target FROM ({Q.explode(source, keep=keep)}))
          WHERE NOT regexp_matches(target, '{external}')"""
    return part("link", P.LINK, "^(https?://|mailto:)") + " UNION ALL " + part("image", P.IMAGE, "^https?://")


@query("extract_links", "doc_id:l line_no:l kind:s link_text:s target:s", links_sql("md_docs"))
def _(spark, d):
    return S.unfold(md_docs(spark, d), S.links(F.col("text")), "doc_id")


@query(
    "table_rows", "doc_id:l line_no:l line:s",
    f"SELECT * FROM md_lines WHERE regexp_matches(line, '{P.TABLE_ROW}') AND NOT regexp_matches(line, '{P.TABLE_SEPARATOR}')",
)
def _(spark, d):
    return S.unfold(md_docs(spark, d), S.table_rows(F.col("text")), "doc_id")


@query(
    "extract_keywords", "doc_id:l keywords:s",
    f"""SELECT doc_id, array_to_string(list_slice(list(k ORDER BY pos), 1, 10), ',') AS keywords FROM (
        SELECT doc_id, k, min(pos) AS pos FROM (SELECT doc_id, unnest(ks) AS k, generate_subscripts(ks, 1) AS pos
          FROM (SELECT doc_id, regexp_extract_all(text, '{P.KEYWORD}') AS ks FROM documents)) GROUP BY doc_id, k)
      GROUP BY doc_id UNION ALL
      SELECT doc_id, '' FROM documents WHERE NOT regexp_matches(text, '{P.KEYWORD}')""",
)
def _(spark, d):
    return documents(spark, d).select("doc_id", F.array_join(S.keywords(F.col("text")), ",").alias("keywords"))


@query(
    "topics_and_business", "doc_id:l topics:s target_business:s",
    f"""SELECT d.doc_id, coalesce(topics, '') AS topics,
        coalesce(nullif(regexp_extract(string_split(points, chr(10))[1], '{P.BUSINESS}', 1), ''), '不明') AS target_business
      FROM ({summary_sql('md_docs')}) d LEFT JOIN (SELECT doc_id, string_agg(topic, chr(10) ORDER BY pos) AS topics FROM (
        SELECT doc_id, {Q.strip(Q.sub('t', f'^###[{SP}]*[0-9]+[.][{SP}]*'))} AS topic, min(line_no) AS pos
        FROM (SELECT *, {Q.strip('line')} AS t FROM md_lines) WHERE starts_with(t, '### ') AND NOT contains(t, '目次')
        GROUP BY doc_id, topic) WHERE topic <> '' GROUP BY doc_id) USING (doc_id)""",
)
def _(spark, d):
    return md_docs(spark, d).select(
        "doc_id", F.array_join(S.topics(F.col("text")), "\n").alias("topics"), S.target_business(F.col("text")).alias("target_business"))


@query(
    "parse_toc", "doc_id:l group_major:l is_minor:b major:l minor:l title:s",
    f"""SELECT doc_id, group_major, NOT big AS is_minor, major, minor, title FROM (
        SELECT *, sum(big::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS grp,
          last(CASE WHEN big THEN major END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS group_major
        FROM (SELECT doc_id, line_no, big, regexp_extract(label, '^([0-9]+)', 1)::BIGINT AS major,
            nullif(regexp_extract(label, '^[0-9]+[.]([0-9]+)', 1), '')::BIGINT AS minor,
            {Q.strip(Q.sub(Q.strip(Q.sub('label', f'^[0-9]+([.][0-9]+)?[{SP}]*')), '^[.・–— -]+'))} AS title
          FROM (SELECT doc_id, line_no, starts_with(t, '###') AS big,
              {Q.strip(f"CASE WHEN starts_with(t, '### ') THEN substr(t, 5) WHEN regexp_matches(t, '^-[{SP}]+[[].+?[]][(][^)]+[)]$') THEN regexp_extract(t, '^-[{SP}]+[[](.+?)[]][(][^)]+[)]$', 1) END")} AS label
            FROM (SELECT doc_id, line_no, {Q.strip('line')} AS t FROM md_lines))
          WHERE label IS NOT NULL AND regexp_matches(label, '^[0-9]+') AND big = NOT regexp_matches(label, '^[0-9]+[.][0-9]')))
      WHERE grp > 0""",
)
def _(spark, d):
    return S.unfold(md_docs(spark, d), S.parse_toc(F.col("text")), "doc_id")


@query(
    "decode_deep_link", "page_id:l section_name:s section_guid:s page_title:s page_guid:s raw:s",
    r"""SELECT page_id, CASE WHEN t THEN regexp_extract(wd, p, 1) END AS section_name,
        CASE WHEN t THEN regexp_extract(wd, p, 2) END AS section_guid,
        CASE WHEN t THEN regexp_extract(wd, p, 3) END AS page_title, CASE WHEN t THEN regexp_extract(wd, p, 4) END AS page_guid,
        CASE WHEN NOT t THEN wd END AS raw
      FROM (SELECT *, regexp_matches(wd, p) AS t FROM (SELECT page_id,
        '^target\((.+?)\.one\|([^/]+)/(.+?)\|([^/]+)/\)' AS p,
        url_decode(regexp_extract(deep_link, '[?&]wd=([^&]+)', 1)) AS wd FROM page_manifest WHERE deep_link IS NOT NULL))""",
)
def _(spark, d):
    got = page_manifest(spark, d).select("page_id", S.decode_deep_link(F.col("deep_link")).alias("w"))
    return got.filter("w IS NOT NULL").select("page_id", "w.*")


@query(
    "strip_page_furniture", "doc_id:l body:s",
    f"""SELECT doc_id, coalesce(string_agg(t, ' ' ORDER BY line_no) FILTER (WHERE t <> ''
        AND NOT regexp_matches(t, '(?i)' || '{"|".join("(?:" + p + ")" for p in P.FURNITURE)}')), '') AS body
      FROM (SELECT *, {Q.strip('line')} AS t FROM ({Q.explode('documents')})) GROUP BY doc_id""",
)
def _(spark, d):
    return documents(spark, d).select("doc_id", S.strip_page_furniture(F.col("text")).alias("body"))
