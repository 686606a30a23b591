"""The derived input tables and the text rules, spelled for DuckDB."""

from __future__ import annotations

from ..functions.patterns import SPACE, WORD
from ..views import EXTENSIONS, PAGE_OFFSET, STATUSES


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def sub(x: str, pattern: str, new: str = "") -> str:
    return f"regexp_replace({x}, '{pattern}', '{new}', 'g')"


def normalize_content(x: str) -> str:
    return strip(sub(x, f"[{SPACE}]+", " "))


def normalize_title(x: str) -> str:
    return f"lower({sub(sub(x, f'^#+[{SPACE}]*'), f'[{SPACE}]+')})"


def anchor(x: str) -> str:
    kept = sub(f"lower({x})", rf"[^{WORD}{SPACE}\-\x{{3040}}-\x{{30ff}}\x{{4e00}}-\x{{9fff}}]")
    return sub(sub(sub(kept, f"[{SPACE}]+", "-"), "-+", "-"), "^-|-$")


def word_set(x: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({x}), '[{WORD}]+'))"


def jaccard(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return (
        f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0::DOUBLE "
        f"ELSE {both}::DOUBLE / (len({a}) + len({b}) - {both}) END"
    )


def clean_filename(x: str) -> str:
    c = sub(sub(sub(x, "【[^】]*】"), "[0-9]{4}[-_]?[0-9]{2}[-_]?[0-9]{2}"), "[★☆●○◆◇■□▲△▼▽]")
    c = sub(sub(c, "_+", "_"), "^[_\\- ]+|[_\\- ]+$")
    return f"coalesce(nullif({c}, ''), 'document')"


def clean_output_name(x: str) -> str:
    c = sub(sub(sub(x, "【.*?】"), "★"), "^[0-9]{6}_")
    c = strip(sub(c, f"[{SPACE}]*\\([0-9]+\\)$"))
    return f"coalesce(nullif({c}, ''), {x})"


def heads(x: str) -> str:
    """First three words of a line."""
    return f"array_to_string(list_slice(string_split({x}, ' '), 1, 3), ' ')"


def explode(source: str, text: str = "text", keep: str = "doc_id") -> str:
    """Rows (keep, line_no, line) of a text column."""
    return (
        f"SELECT {keep}, unnest(string_split({text}, chr(10))) AS line, "
        f"generate_subscripts(string_split({text}, chr(10)), 1) AS line_no FROM {source}"
    )


def _markdown(source: str, revised: bool) -> str:
    def drop(divisor: int, kept: str, lost: str = "[]::VARCHAR[]") -> str:
        return f"(CASE WHEN doc_id % {divisor} = 0 THEN {lost} ELSE {kept} END)" if revised else kept

    row = "['| ' || i || ' | ' || length(x) || ' |']"
    head = "['| a | b |', '|---|---|']"
    w = heads("x")
    other = "((doc_id * 7 + i) % (n_docs + 40))"
    back = anchor(f"(i - 4) || '. ' || {heads('ls[i - 4]')}")
    tail = "|| CASE WHEN doc_id % 11 = 0 THEN ' (rev)' ELSE '' END" if revised else ""
    number = "CASE WHEN doc_id % 13 = 0 OR (doc_id % 5 = 0 AND i BETWEEN 29 AND 35) THEN 'b. ' ELSE '. ' END" if revised else "'. '"
    section, part = f"'### ' || i || {number} || {w}", f"'#### ' || i || '.1 ' || {w}"
    if revised:
        section = f"CASE WHEN doc_id % 17 = 0 THEN '### Neu ' || i ELSE {section} END"
        part = f"CASE WHEN doc_id % 17 = 0 AND i % 2 = 0 THEN '### Neu ' || i ELSE {part} END"
    one = f"""CASE
      WHEN i = 1 THEN list_concat(['# ' || {w}, '', '## サマリー', '- ' || CASE WHEN doc_id % 23 = 0 THEN '見積業務、' ELSE '' END || x, '', '---', '', '## 目次', '', '---', ''],
        {"[]::VARCHAR[]" if revised else "CASE WHEN doc_id % 19 = 0 THEN ['![表紙](images/img_2.png)', '作成日：2024-01-01 ' || " + w + ", '図の説明：' || " + w + "] ELSE [] END"})
      WHEN (i + doc_id) % 7 = 0 THEN [{section}, x]
      WHEN (i + doc_id) % 7 = 1 THEN {drop(3, f"[{part}, x]", "[x]")}
      WHEN (i + doc_id) % 7 = 2 THEN list_concat({head}, CASE WHEN i % 2 = 1 THEN {drop(5, row)} ELSE {row} END)
      WHEN (i + doc_id) % 7 = 3 THEN {drop(2, "['> ' || x]")}
      WHEN (i + doc_id) % 7 = 4 AND i % 3 = 0 THEN
        ['[' || {w} || '](' || CASE WHEN i >= 5 THEN '#' || {back} ELSE '#none' END || ')']
      WHEN (i + doc_id) % 7 = 4 AND i % 3 = 1 THEN ['[' || {w} || '](doc_' || {other} || '.md#no-such)']
      WHEN (i + doc_id) % 7 = 4 THEN ['[' || {w} || '](doc_' || {other} || '.md)']
      WHEN (i + doc_id) % 7 = 5 THEN ['![' || {w} || '](images/img_' || i || '.png)']
      {"WHEN doc_id % 5 = 1 AND i BETWEEN 15 AND 21 THEN ['### Neu ' || i, x]" if revised else ""}
      ELSE [x {tail}] END"""
    built = f"flatten(list_transform(ls, lambda x, i: {one}))"
    if revised:
        built = f"CASE WHEN doc_id % 7 = 0 THEN list_slice({built}, 1, len({built}) // 2) ELSE {built} END"
    category = (
        "CASE lang WHEN 'de' THEN '01_de' WHEN 'en' THEN '02_en' WHEN 'es' THEN '03_es' "
        "WHEN 'fr' THEN '04_fr' ELSE '05_other' END"
    )
    return f"""SELECT doc_id, lang, source, source || '-' || doc_id AS name, {category} AS category,
      'doc_' || doc_id || '.md' AS path,
      {category} || '/' || lpad((doc_id % 12)::VARCHAR, 2, '0') || '_' || source || '-' || doc_id || '.md' AS kb_path,
      array_to_string({built}, chr(10)) AS text
      FROM (SELECT *, string_split(text, chr(10)) AS ls,
        (SELECT max(doc_id) + 1 FROM {source}) AS n_docs FROM {source})"""


def _pick(values, index: str) -> str:
    return "(ARRAY[" + ", ".join(f"'{v}'" for v in values) + f"])[({index}) + 1]"


HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"

VIEWS: dict[str, str] = {
    "page_texts": f"""SELECT page_id + {PAGE_OFFSET} AS doc_id,
      regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang, {HOST} AS source,
      array_to_string(regexp_extract_all(html, '<p>([^<]+)', 1), chr(10)) AS text FROM pages""",
    "md_docs": _markdown("documents", False),
    "md_docs_v2": _markdown("documents", True),
    "page_docs": _markdown("page_texts", False),
    "incoming_docs": "SELECT * FROM md_docs_v2 UNION ALL SELECT * FROM page_docs",
    "versions": """SELECT b.doc_id, b.name, b.text AS before, a.text AS after
      FROM md_docs b JOIN md_docs_v2 a USING (doc_id)""",
    "md_lines": explode("md_docs"),
    "image_files": """SELECT 'images/img_' || unnest(range(2, greatest(n, 2) + 1, 2)) || '.png' AS path
      FROM (SELECT max(len(string_split(text, chr(10)))) AS n FROM documents)""",
    "files": f"""SELECT page_id, base || ext0 AS path, base AS stem_path, lower(ext0) AS ext,
      strlen(html) AS size_bytes, make_timestamp((1704067200 + page_id * 61) * 1000000) AS modified, page_id % 3 = 0 AS has_text, page_id % 5 = 0 AS in_ocr_list,
      page_id % 4 = 0 AS has_json, page_id % 10 = 0 AS in_excluded_list, page_id % 17 = 0 AS has_password
      FROM (SELECT *, {_pick(EXTENSIONS, f'page_id % {len(EXTENSIONS)}')} AS ext0,
        {HOST} || '/' || CASE WHEN page_id % 25 = 0 THEN '~$' ELSE '' END || 'file_' || page_id AS base FROM pages)""",
    "terms": """SELECT doc_id, i - 1 AS pos, lower(w[i]) AS term,
      array_to_string(list_slice(w, i + 1, i + 5), ' ') AS description,
      CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS flag
      FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents))""",
    "converter_results": f"""SELECT event_id, user_id, ts,
      'file_' || user_id || {_pick(('.pdf', '.xlsx', '.docx', '.pptx', '.ppt'), 'event_id % 5')} AS path,
      {_pick(('.pdf', '.xlsx', '.docx', '.pptx', '.ppt'), 'event_id % 5')} AS ext,
      CASE event_type WHEN 'view' THEN 'success' WHEN 'click' THEN ' SUCCESS ' WHEN 'purchase' THEN 'requires_ocr'
        WHEN 'error' THEN 'failed' ELSE event_type END AS raw_status,
      CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE props END AS raw_text,
      CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ' Needs OCR now ' WHEN 2 THEN 'Request TIMED OUT' ELSE '' END AS raw_message,
      value AS seconds FROM events""",
    "page_manifest": f"""SELECT page_id, {HOST} AS section, 'Title ' || page_id AS title,
      CASE WHEN page_id % 13 = 0 THEN NULL
        WHEN page_id % 7 = 0 THEN 'https://notes.example/view?wd=plain%20' || page_id
        ELSE 'https://notes.example/view?id=1&wd=target%28' || {HOST} || '.one%7Csec-' || {HOST} || '%2FTitle%20no+'
          || page_id || '%7Cguid-' || (page_id // 2) || '%2F%29&x=1' END AS deep_link,
      {_pick(STATUSES, 'page_id % 4')} AS status, 'pdf/' || {HOST} || '/page_' || page_id || '.pdf' AS pdf_path
      FROM pages""",
    "page_features": f"""SELECT page_id, 'pdf/' || {HOST} || '/page_' || page_id || '.pdf' AS pdf_path,
      page_id % 19 <> 0 AS present, strlen(html)::DOUBLE / 1024.0::DOUBLE * (page_id % 9) AS size_kb,
      (page_id * 37 % 100)::DOUBLE / 100.0::DOUBLE AS white_ratio, page_id * 13 % 80 AS text_chars FROM pages""",
}
