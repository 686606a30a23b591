"""Matching, section diffs, name resolution and update plans."""

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import inventory as I, matching as M
from ..operators.structure import chapters, heading_titles, unfold
from ..plans import updates as U
from ..sources.sinks import stored
from ..views import documents, incoming_docs, md_docs, page_docs, table, versions
from . import sqlviews as Q
from .files import ledger
from .registry import query
from .scalars import _lower_list, _titles_sql, content_similarity_sql
from .structure import chapters_sql, keyed_sections_sql, sections_sql, summary_sql

SP = P.SPACE
EXCLUDE = dict(exact=["src1-1"], parts=["src13"], patterns=["-1[0-9]5$"])

Q.VIEWS["incoming_summaries"] = summary_sql("incoming_docs")
Q.VIEWS["base_summaries"] = summary_sql("md_docs")


def _features(source, summaries, key, name):
    return f"""SELECT {key} AS key, d.category, length(d.text) AS size, md5(d.text) AS hash, {Q.word_set(name)} AS n,
      {Q.word_set('b.summary')} AS s, {_lower_list(_titles_sql('d.text'))} AS h FROM {source} d JOIN {summaries} b USING (doc_id)"""


Q.VIEWS["new_features"] = _features("incoming_docs", "incoming_summaries", "d.doc_id", "d.name")
Q.VIEWS["base_features"] = _features("md_docs", "base_summaries", "d.kb_path", "string_split(d.kb_path, '/')[-1]")


def _overlap(c):
    return f"""SELECT a.key AS nk, b.key AS bk, count(*) AS shared FROM (SELECT key, unnest({c}) AS t FROM new_features) a
      JOIN (SELECT key, unnest({c}) AS t FROM base_features) b USING (t) GROUP BY ALL"""


for _c in "nsh":
    Q.VIEWS[f"shared_{_c}"] = _overlap(_c)


def _ratio(c):
    return f"coalesce(x{c}.shared, 0)::DOUBLE / greatest(len(a.{c}) + len(b.{c}) - coalesce(x{c}.shared, 0), 1)"


Q.VIEWS["matches"] = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, target) AS rn FROM (
    SELECT a.key, b.key AS target, b.category, a.hash = b.hash AS same,
      {_ratio('n')} * 0.20::DOUBLE + {_ratio('s')} * 0.40::DOUBLE + {_ratio('h')} * 0.30::DOUBLE
      + (1.0::DOUBLE - least(abs(a.size - b.size)::DOUBLE / greatest(a.size, b.size), 1.0::DOUBLE)) * 0.10::DOUBLE AS score
    FROM new_features a CROSS JOIN base_features b LEFT JOIN shared_n xn ON xn.nk = a.key AND xn.bk = b.key
    LEFT JOIN shared_s xs ON xs.nk = a.key AND xs.bk = b.key LEFT JOIN shared_h xh ON xh.nk = a.key AND xh.bk = b.key))
  WHERE rn = 1 AND score > 0.1"""


def _base(spark, d):
    return md_docs(spark, d).select(F.col("kb_path").alias("path"), "category", "text")


def _new(spark, d):
    return incoming_docs(spark, d).select(F.col("doc_id").alias("key"), "name", "text")


@query("best_match", "key:l target:s similarity:d", "SELECT key, target, score AS similarity FROM matches")
def _(spark, d):
    base = _base(spark, d).withColumn("file_name", F.substring_index("path", "/", -1))
    return M.best_match(M.features(_new(spark, d), "key", "name"), M.features(base, "path", "file_name"))


_CLEAN = Q.clean_filename("name")
Q.VIEWS["plan_rows"] = f"""SELECT name AS source, key, is_excluded, known,
    CASE WHEN is_excluded OR known IS NOT NULL OR same THEN 'skip' WHEN score IS NULL OR score < 0.8 THEN 'create' ELSE 'update' END AS action,
    CASE WHEN is_excluded OR known IS NOT NULL THEN 0.0 WHEN same THEN 1.0 ELSE coalesce(score, 0.0) END AS similarity,
    CASE WHEN is_excluded THEN '{U.REASON_EXCLUDED}' WHEN known IS NOT NULL THEN '{U.REASON_LEDGER}' WHEN same THEN '{U.REASON_SAME}'
      WHEN score IS NULL THEN '{U.REASON_NONE}（類似度0%）' WHEN score < 0.8 THEN '「' || category || '」カテゴリに関連する内容のため、同カテゴリへ配置を推奨。{U.REASON_SIMPLE}（類似度' || CAST(round_even(score * 100, 0) AS BIGINT) || '%）'
      ELSE '既存『' || target || '』と類似。同一トピックのため更新対象。{U.REASON_SIMPLE}' END AS reason, target AS match
  FROM (SELECT i.doc_id AS key, i.name, i.name = 'src1-1' OR contains(i.name, 'src13') OR regexp_matches(i.name, '-1[0-9]5$') AS is_excluded,
      l.target AS known, m.target, m.category, m.same, m.score
    FROM incoming_docs i LEFT JOIN (SELECT source, min(target) AS target FROM ledger WHERE target <> '' GROUP BY source) l
      ON l.source = i.name AND NOT (i.name = 'src1-1' OR contains(i.name, 'src13') OR regexp_matches(i.name, '-1[0-9]5$'))
    LEFT JOIN matches m ON m.key = i.doc_id)"""
Q.VIEWS["plan_result"] = f"""SELECT source, key, action, is_excluded, similarity, reason, CASE WHEN is_excluded THEN NULL WHEN known IS NOT NULL THEN known
    WHEN action = 'create' THEN first_cat || '/' || CASE WHEN n < 10 THEN '0' ELSE '' END || n || '_' || {_CLEAN} || '.md' ELSE match END AS target
  FROM (SELECT *, source AS name, (SELECT min(category) FROM md_docs) AS first_cat,
    (SELECT max(nullif(regexp_extract(string_split(kb_path, '/')[-1], '^([0-9]+)_', 1), '')::BIGINT) FROM md_docs WHERE category = (SELECT min(category) FROM md_docs))
      + row_number() OVER (PARTITION BY action ORDER BY key) AS n FROM plan_rows)"""


def plan(spark, d):
    return U.plan_updates(_new(spark, d), _base(spark, d), ledger(spark, d), **EXCLUDE)


@query("plan_updates", "source:s key:l action:s target:s similarity:d reason:s", "SELECT * FROM plan_result")
def _(spark, d):
    return plan(spark, d)


@query("action_summary", "action:s n:l",
       """SELECT k AS action, (SELECT count(*) FROM plan_result WHERE CASE WHEN is_excluded THEN 'excluded' ELSE action END = k) AS n
       FROM (VALUES ('create'), ('update'), ('skip'), ('excluded')) t(k)""")
def _(spark, d):
    return I.action_summary(plan(spark, d))


@query("top_match", "key:l target:s", "SELECT key, target FROM matches WHERE score >= 0.8")
def _(spark, d):
    base = _base(spark, d).withColumn("file_name", F.substring_index("path", "/", -1))
    return M.best_match(M.features(_new(spark, d), "key", "name"), M.features(base, "path", "file_name"), nearby=False)


@query("already_in_base", "name:s target:s", "SELECT DISTINCT i.name, l.target FROM incoming_docs i JOIN ledger l ON l.source = i.name WHERE l.target <> ''")
def _(spark, d):
    return M.already_in_base(incoming_docs(spark, d).select("name"), ledger(spark, d))


@query("embedding_topk", "key:l target:l sim:d rank:l",
       """SELECT key, target, sim, rank FROM (SELECT a.vec_id AS key, b.vec_id AS target, s AS sim, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(s, 12) DESC, b.vec_id) AS rank
         FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) a CROSS JOIN LATERAL (SELECT vec_id, list_dot_product(a.e, e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(e, e)) AS s
           FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)) b) WHERE rank <= 10
       UNION ALL SELECT doc_id, vec_id, NULL, rn FROM documents CROSS JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rn FROM embeddings) WHERE rn <= 10
         AND doc_id NOT IN (SELECT vec_id FROM embeddings)""")
def _(spark, d):
    e = table(spark, d, "embeddings")
    docs = documents(spark, d).select(F.col("doc_id").alias("key"))
    vectors = e.select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))
    queries = docs.join(vectors, "key", "full_outer")
    base = e.select(F.col("vec_id").alias("target"), F.col("vec_id").alias("place"), F.col("embedding").alias("vector"))
    return M.embedding_topk(queries, base, 64)


Q.VIEWS["new_sections"] = keyed_sections_sql("md_docs_v2")
Q.VIEWS["old_sections"] = keyed_sections_sql("md_docs")
def _diff_sql(new, old):
    return f"""SELECT coalesce(a.pair, b.pair) AS pair, coalesce(a.heading, b.heading) AS heading, b.line_start, b.line_end,
    CASE WHEN b.heading IS NULL THEN 'added' WHEN a.heading IS NULL THEN CASE WHEN b.heading IN ('サマリー', '目次', '概要', 'Summary') THEN 'special' ELSE 'kept' END
      WHEN {Q.normalize_content('a.content')} = {Q.normalize_content('b.content')} THEN 'unchanged' ELSE 'changed' END AS kind
  FROM {new} a FULL JOIN {old} b ON a.pair = b.pair AND a.heading = b.heading"""


Q.VIEWS["diff_rows"] = _diff_sql("version_new", "version_old")
_NAT = "CASE WHEN regexp_matches(heading, '^[0-9]') THEN 0 ELSE 1 END, coalesce(nullif(regexp_extract(heading, '^([0-9]+)', 1), '')::HUGEINT, 0), heading"


def _diff(spark, d):
    rows = versions(spark, d).withColumnRenamed("doc_id", "pair")
    return unfold(rows, M.section_diff(F.col("after"), F.col("before")), "pair")


@query("section_diff", "pair:l heading:s kind:s line_start:l line_end:l", "SELECT * FROM diff_rows")
def _(spark, d):
    return _diff(spark, d)


def _changes_sql(diff):
    return f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY pair, kind ORDER BY {_NAT}) AS place, CASE kind WHEN 'added' THEN 15 ELSE 10 END AS cap FROM {diff} WHERE kind IN ('added', 'changed'))
       SELECT pair, kind, place, heading, line_start, line_end, 1 AS n, true AS is_primary FROM r WHERE place <= cap
       UNION ALL SELECT pair, kind, min(place), NULL, NULL, NULL, count(*), true FROM r WHERE place > cap GROUP BY pair, kind
       UNION ALL SELECT pair, kind, 1, NULL, NULL, NULL, count(*), false FROM {diff} WHERE kind = 'kept' GROUP BY pair, kind"""


@query("change_rows", "pair:l kind:s place:l heading:s line_start:l n:l is_primary:b", _changes_sql("diff_rows"))
def _(spark, d):
    return M.change_rows(_diff(spark, d), "pair")


def _placements_sql(new, old):
    """Greedy placement of the sections of ``new`` in those of ``old``, both (pair, heading, sec_pos, line_start, line_end, content), section by section."""
    return f"""WITH RECURSIVE n AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY sec_pos) - 1 AS i FROM {new}),
      o AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY sec_pos) - 1 AS j FROM {old}),
      sims AS ({content_similarity_sql('SELECT n.pair, n.i, o.j, n.content AS a, o.content AS b FROM n JOIN o ON o.pair = n.pair WHERE NOT EXISTS (SELECT 1 FROM o x WHERE x.pair = n.pair AND x.heading = n.heading)', 'pair, i, j')}),
      c AS (SELECT pair, i, list({{'s': score, 'j': j}} ORDER BY score DESC, j) AS free FROM sims WHERE score >= 0.5 GROUP BY pair, i),
      w AS MATERIALIZED (SELECT n.pair, n.i, o.j AS same, c.free FROM n LEFT JOIN o ON o.pair = n.pair AND o.heading = n.heading LEFT JOIN c ON c.pair = n.pair AND c.i = n.i),
      g(pair, i, used, pick) AS (
        SELECT DISTINCT pair, -1::BIGINT, []::BIGINT[], NULL::STRUCT(s DOUBLE, j BIGINT) FROM n
        UNION ALL SELECT pair, i, CASE WHEN same IS NOT NULL THEN list_append(used, same) WHEN pick IS NOT NULL THEN list_append(used, pick.j) ELSE used END, pick
          FROM (SELECT w.pair, w.i, w.same, g.used, CASE WHEN w.same IS NULL THEN list_filter(coalesce(w.free, []), lambda x: NOT list_contains(g.used, x.j))[1] END AS pick
            FROM g JOIN w ON w.pair = g.pair AND w.i = g.i + 1))
      SELECT n.pair, n.i AS sec_pos, n.heading, CASE WHEN s.j IS NOT NULL THEN CASE WHEN {Q.normalize_content('n.content')} = {Q.normalize_content('s.content')} THEN 'unchanged' ELSE 'updated' END
          WHEN g.pick IS NOT NULL THEN 'matched' ELSE 'new' END AS kind, coalesce(s.heading, m.heading) AS old_heading, coalesce(s.line_start, m.line_start) AS line_start,
        coalesce(s.line_end, m.line_end) AS line_end, CASE WHEN s.j IS NULL THEN g.pick.s END AS similarity
      FROM n JOIN g ON g.pair = n.pair AND g.i = n.i LEFT JOIN o s ON s.pair = n.pair AND s.heading = n.heading LEFT JOIN o m ON m.pair = n.pair AND m.j = g.pick.j"""


Q.VIEWS["version_new"] = "SELECT doc_id AS pair, * EXCLUDE (doc_id) FROM new_sections"
Q.VIEWS["version_old"] = "SELECT doc_id AS pair, * EXCLUDE (doc_id) FROM old_sections"


@query("match_sections", "pair:l sec_pos:l heading:s kind:s old_heading:s line_start:l line_end:l similarity:d", _placements_sql("version_new", "version_old"))
def _(spark, d):
    return M.match_sections(versions(spark, d).select(
        F.col("doc_id").alias("pair"), F.col("after").alias("new_text"), F.col("before").alias("old_text")))


# What the updates of the plan do to their targets


Q.VIEWS["plan_pairs"] = "SELECT key AS pair, target, b.doc_id AS base_id FROM plan_result JOIN md_docs b ON b.kb_path = target WHERE action = 'update'"
Q.VIEWS["pair_new"] = keyed_sections_sql("(SELECT doc_id AS pair, text FROM incoming_docs WHERE doc_id IN (SELECT pair FROM plan_pairs))", "pair")
Q.VIEWS["pair_old"] = keyed_sections_sql("(SELECT pair, text FROM plan_pairs JOIN md_docs ON doc_id = base_id)", "pair")
Q.VIEWS["pair_diff"] = _diff_sql("pair_new", "pair_old")


def _plan_pairs(spark, d, rows=None):
    return stored(U.matched_pairs(plan(spark, d) if rows is None else rows, _new(spark, d), _base(spark, d)), "pairs")


@query("plan_changes", "pair:l target:s kind:s place:l heading:s line_start:l line_end:l n:l is_primary:b",
       f"SELECT c.*, target FROM ({_changes_sql('pair_diff')}) c JOIN plan_pairs USING (pair)")
def _(spark, d):
    return U.plan_changes(_plan_pairs(spark, d))


@query("plan_placements", "pair:l target:s sec_pos:l heading:s kind:s old_heading:s line_start:l line_end:l similarity:d",
       f"SELECT c.*, target FROM ({_placements_sql('pair_new', 'pair_old')}) c JOIN plan_pairs USING (pair)")
def _(spark, d):
    return U.plan_placements(_plan_pairs(spark, d))


_PAIRS = f"SELECT doc_id, {_titles_sql('after')} AS a, {_titles_sql('before')} AS b FROM versions"


def _joined(x):
    return f"array_to_string(list_sort(list_distinct({x})), chr(10))"


@query("heading_sets", "doc_id:l added:s common:s removed:s",
       f"""SELECT doc_id, {_joined('list_filter(a, lambda x: NOT list_contains(b, x))')} AS added, {_joined('list_filter(a, lambda x: list_contains(b, x))')} AS common,
       {_joined('list_filter(b, lambda x: NOT list_contains(a, x))')} AS removed FROM ({_PAIRS})""")
def _(spark, d):
    s = M.heading_sets(heading_titles(F.col("after")), heading_titles(F.col("before")))
    return versions(spark, d).select("doc_id", F.explode(F.array(s)).alias("s")).select(
        "doc_id", *[F.array_join(f"s.{c}", "\n").alias(c) for c in ("added", "common", "removed")])


@query("heading_diff", "doc_id:l kind:s heading:s n:l",
       f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, kind ORDER BY heading) AS place FROM (
         SELECT doc_id, CASE WHEN b.heading IS NULL THEN 'added' ELSE 'common' END AS kind, a.heading FROM new_headings a LEFT JOIN old_headings b USING (doc_id, heading)))
       SELECT doc_id, kind, heading, 1 AS n FROM r WHERE place <= CASE kind WHEN 'added' THEN 15 ELSE 10 END
       UNION ALL SELECT doc_id, kind, NULL, count(*) FROM r WHERE place > CASE kind WHEN 'added' THEN 15 ELSE 10 END GROUP BY doc_id, kind""")
def _(spark, d):
    rows = M.heading_diff(heading_titles(F.col("after")), heading_titles(F.col("before")))
    return unfold(versions(spark, d), rows, "doc_id")


Q.VIEWS["new_headings"] = f"SELECT DISTINCT doc_id, unnest(a) AS heading FROM ({_PAIRS})"
Q.VIEWS["old_headings"] = f"SELECT DISTINCT doc_id, unnest(b) AS heading FROM ({_PAIRS})"


@query("split_by_heading_overlap", "doc_id:l pos:l heading:s side:s is_partial:b",
       f"""SELECT doc_id, pos - 1 AS pos, heading, side, sum(chars) OVER w > 0 AND coalesce(sum(chars) FILTER (WHERE side = 'create') OVER w, 0)::DOUBLE / sum(chars) OVER w >= 0.3
           AND coalesce(sum(chars) FILTER (WHERE side = 'update') OVER w, 0)::DOUBLE / sum(chars) OVER w >= 0.2 AS is_partial
         FROM (SELECT s.doc_id, s.heading, length(s.content) AS chars, row_number() OVER (PARTITION BY s.doc_id ORDER BY sec) AS pos, count(*) OVER (PARTITION BY s.doc_id) AS n,
             CASE WHEN s.heading = '{P.OPENING}' OR EXISTS (SELECT 1 FROM old_headings o WHERE o.doc_id = s.doc_id
               AND (contains(o.heading, s.heading) OR contains(s.heading, o.heading))) THEN 'update' ELSE 'create' END AS side
           FROM ({sections_sql('md_docs_v2')}) s JOIN md_docs_v2 m USING (doc_id) WHERE n_lines > 0 AND length(m.text) >= 2000)
         WHERE n >= 2 WINDOW w AS (PARTITION BY doc_id)""")
def _(spark, d):
    r = M.split_by_heading_overlap(F.col("after"), F.col("before"))
    rows = versions(spark, d).select("doc_id", F.explode(F.array(r)).alias("r")).filter("r IS NOT NULL")
    return rows.select("doc_id", F.coalesce("r.is_partial", F.lit(False)).alias("is_partial"), F.posexplode("r.sections").alias("pos", "s")).select(
        "doc_id", "pos", "s.heading", "s.side", "is_partial")


@query("heading_natural_sort", "pair:l heading:s place:l",
       f"SELECT pair, heading, row_number() OVER (PARTITION BY pair ORDER BY {_NAT}) AS place FROM diff_rows")
def _(spark, d):
    from pyspark.sql import Window as W

    w = W.partitionBy("pair").orderBy(*M.natural_order(F.col("heading")))
    return _diff(spark, d).select("pair", "heading", F.row_number().over(w).alias("place"))


@query("cap_with_rest", "category:s place:l label:s n:l",
       """WITH r AS (SELECT category, kb_path, row_number() OVER (PARTITION BY category ORDER BY length(text) DESC, kb_path) AS place FROM md_docs)
       SELECT category, place, kb_path AS label, 1 AS n FROM r WHERE place <= 15 UNION ALL SELECT category, 16, NULL, count(*) FROM r WHERE place > 15 GROUP BY category""")
def _(spark, d):
    rows = md_docs(spark, d).select("category", "kb_path", F.length("text").alias("n_chars"))
    return M.cap_with_rest(rows, "category", [F.desc("n_chars"), F.col("kb_path")], "kb_path", 15)


# Names


def _wanted(spark, d):
    """Names as a plan may state them: exact, with a chapter count, shortened, decorated, unknown."""
    k, n = F.col("doc_id"), F.col("name")
    return md_docs(spark, d).select(k.alias("key"), (
        F.when(k % 5 == 0, n).when(k % 5 == 1, F.concat(n, F.lit("（12章）")))
        .when(k % 5 == 2, F.substring(n, 1, 5)).when(k % 10 == 3, F.concat(F.substring(n, 1, 3), F.lit("【】"), F.substr(n, F.lit(4)))).when(k % 5 == 3, F.concat(F.lit("★【240101_"), n, F.lit("】")))
        .otherwise(F.concat(F.lit("zz"), k.cast("string")))).alias("name"))


Q.VIEWS["wanted_names"] = """SELECT doc_id AS key, CASE doc_id % 5 WHEN 0 THEN name WHEN 1 THEN name || '（12章）' WHEN 2 THEN left(name, 5)
    WHEN 3 THEN CASE WHEN doc_id % 10 = 3 THEN left(name, 3) || '【】' || substr(name, 4) ELSE '★【240101_' || name || '】' END ELSE 'zz' || doc_id END AS name FROM md_docs"""


@query("resolve_file_name", "key:l file:s rule:l",
       """WITH c AS (SELECT *, regexp_replace(name, '[（(][0-9]+章[）)]$', '') AS cleaned FROM wanted_names),
       e AS (SELECT key, name AS file, 1 AS rule FROM c WHERE name IN (SELECT name FROM md_docs)),
       x AS (SELECT key, cleaned AS file, 2 AS rule FROM c WHERE cleaned IN (SELECT name FROM md_docs) AND key NOT IN (SELECT key FROM e)),
       t AS (SELECT c.key, min(m.name) AS file, 3 AS rule FROM c JOIN md_docs m ON contains(c.cleaned, m.name) OR contains(m.name, c.cleaned) OR contains(c.name, m.name) OR contains(m.name, c.name)
         WHERE c.key NOT IN (SELECT key FROM e UNION SELECT key FROM x) GROUP BY c.key),
       s AS (SELECT name, CORE AS core FROM md_docs),
       f AS (SELECT c.key, min(s.name) AS file, 4 AS rule FROM (SELECT key, CORE AS core FROM c) c JOIN s ON s.core <> '' AND c.core <> '' AND (contains(c.core, s.core) OR contains(s.core, c.core))
         WHERE c.key NOT IN (SELECT key FROM e UNION SELECT key FROM x UNION SELECT key FROM t) GROUP BY c.key)
       SELECT * FROM e UNION ALL SELECT * FROM x UNION ALL SELECT * FROM t UNION ALL SELECT * FROM f""".replace("CORE", Q.strip(Q.sub(
           Q.sub(Q.sub("name", r"[【】★\[\]]"), "[0-9]{6}_"), "[（(][0-9]+章[）)]"))))
def _(spark, d):
    return M.resolve_file_names(_wanted(spark, d), md_docs(spark, d).select(F.col("name").alias("file")))


@query("resolve_chapter", "doc_id:l wanted:s line_start:l",
       f"""SELECT doc_id, wanted, line_start FROM (SELECT w.doc_id, w.wanted, c.line_start, row_number() OVER (PARTITION BY w.doc_id, w.chapter_no ORDER BY
           CASE WHEN wanted = original_title OR wanted = clean_title THEN 0 WHEN contains(original_title, wanted) OR contains(clean_title, wanted) OR contains(wanted, original_title) OR contains(wanted, clean_title) THEN 1 ELSE 2 END,
           CASE WHEN wanted = original_title OR wanted = clean_title OR contains(original_title, wanted) OR contains(clean_title, wanted) OR contains(wanted, original_title) OR contains(wanted, clean_title) THEN 0
             ELSE -len(list_intersect(ws, cw))::DOUBLE / len(ws) END, c.chapter_no) AS rn,
           CASE WHEN wanted = original_title OR wanted = clean_title OR contains(original_title, wanted) OR contains(clean_title, wanted) OR contains(wanted, original_title) OR contains(wanted, clean_title) THEN true
             ELSE len(ws) >= 2 AND len(list_intersect(ws, cw))::DOUBLE / len(ws) >= 0.5 END AS ok
         FROM (SELECT *, list_distinct(regexp_extract_all(lower(wanted), '[{P.WORD}]+')) AS ws FROM chapter_wishes) w
         JOIN (SELECT *, list_distinct(regexp_extract_all(lower(original_title || ' ' || clean_title), '[{P.WORD}]+')) AS cw FROM chapter_rows) c USING (doc_id)) WHERE rn = 1 AND ok""")
def _(spark, d):
    cs = md_docs(spark, d).select("doc_id", F.explode(F.array(chapters(F.col("text")))).alias("cs"))
    wishes = cs.select("doc_id", "cs", F.explode("cs").alias("c")).select("doc_id", "cs", _wish().alias("wanted"))
    return wishes.select("doc_id", "wanted", M.resolve_chapter(F.col("wanted"), F.col("cs"))["line_start"].alias("line_start")).filter(
        "line_start IS NOT NULL")


def _wish():
    n, t = F.col("c.chapter_no"), F.col("c.clean_title")
    return (F.when(n % 4 == 0, F.concat(F.lit("x "), t, F.lit(" y"))).when(n % 4 == 1, F.col("c.original_title"))
            .when(n % 4 == 2, F.concat(F.substring_index(t, " ", 2), F.lit(" zz"))).otherwise(F.lit("nothing like it")))


Q.VIEWS["chapter_wishes"] = """SELECT doc_id, chapter_no, CASE chapter_no % 4 WHEN 0 THEN 'x ' || clean_title || ' y' WHEN 1 THEN original_title
    WHEN 2 THEN array_to_string(list_slice(string_split(clean_title, ' '), 1, 2), ' ') || ' zz' ELSE 'nothing like it' END AS wanted FROM chapter_rows"""


@query("attach_chapter_summary", "doc_id:l chapter_no:l summary:s",
       """SELECT c.doc_id, c.chapter_no, (SELECT arg_min(s.original_title || ' summary', s.chapter_no) FROM chapter_rows s WHERE s.doc_id = c.doc_id AND s.chapter_no % 3 <> 0
         AND CASE WHEN s.chapter_no % 2 = 0 THEN s.clean_title ELSE s.original_title END IN (c.original_title, c.clean_title)) AS summary FROM chapter_rows c""")
def _(spark, d):
    rows = unfold(md_docs(spark, d), chapters(F.col("text")), "doc_id")
    n = F.col("chapter_no")
    summaries = rows.filter(n % 3 != 0).select(
        "doc_id", n.alias("pos"), F.when(n % 2 == 0, F.col("clean_title")).otherwise(F.col("original_title")).alias("title"),
        F.concat("original_title", F.lit(" summary")).alias("summary"))
    return M.attach_chapter_summaries(rows, summaries)


@query("apply_overrides", "source:s action:s target:s reason:s",
       """SELECT p.source, CASE WHEN o.k IN (0, 1, 2) THEN (['skip', 'create', 'update'])[o.k + 1] ELSE p.action END AS action,
         CASE WHEN o.k = 1 THEN 'x/' || p.source || '.md' ELSE p.target END AS target, CASE WHEN o.k = 2 THEN 'by hand' ELSE p.reason END AS reason
       FROM plan_result p LEFT JOIN (SELECT m.name AS source, l.doc_id % 4 AS k FROM labels l JOIN md_docs m USING (doc_id) WHERE toxic = 1) o USING (source)""")
def _(spark, d):
    k = F.col("doc_id") % 4
    overrides = table(spark, d, "labels").filter("toxic = 1").join(md_docs(spark, d).select("doc_id", "name"), "doc_id").select(
        F.col("name").alias("source"), F.col("doc_id").alias("pos"),
        F.when(k == 0, "skip").when(k == 1, "CREATE").when(k == 2, "update").otherwise("destroy").alias("action_type"),
        F.when(k == 1, F.concat(F.lit("x/"), "name", F.lit(".md"))).otherwise("").alias("target_path"),
        F.when(k == 2, "by hand").alias("reason"))
    return M.apply_overrides(plan(spark, d), overrides)
