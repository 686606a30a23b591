"""Secrets in texts, judged by who owns them across the corpus.

Every candidate value is hashed, and its hashes are counted by distinct
repositories and owners over all documents.  A value that many repositories or
many owners hold is a widely copied example, even one that a single owner
spreads; a value of few is live-looking, also if it was copied once, and gets a
span of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import letters, matches, stored

#: Fixed patterns of the base kinds, in the order in which ties are listed.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = f"""({"|".join(map(letters, KEYWORDS))})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
#: A short match of these two holds no long one, so the length is asked for in the pattern.
ACCESS = f"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}"
HEX = f"[0-9a-f]{{{HEX_LEAST},}}"
KINDS = ("assign", "access", "hex")
LIVE = "live"
#: A value held by this many owners, or in this many repositories, is an example.
OWNERS, REPOS = 3, 10

_SPANS = "array<struct<kind:string,start:bigint,end:bigint,value:string,at:bigint>>"


def spans(text: Column) -> Column:
    """Base spans by start, then kind: (kind, start, end, value, at), ``at`` being where the value starts."""
    value = lambda m: F.regexp_extract(m["match"], f"^{ASSIGN}$", 2)

    def span(kind: str, m: Column, v: Column) -> Column:
        end = (m["start"] + F.length(m["match"])).cast("bigint")
        return F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), end.alias("end"), v.alias("value"),
                        (end - F.length(v)).cast("bigint").alias("at"))

    assign = F.filter(
        F.transform(matches(text, ASSIGN), lambda m: span("assign", m, value(m))), lambda s: F.length(s["value"]) >= ASSIGN_LEAST)
    access = F.transform(matches(text, ACCESS), lambda m: span("access", m, m["match"]))
    hexes = F.transform(matches(text, HEX), lambda m: span("hex", m, m["match"]))
    rank = lambda s: reduce(lambda c, k: c.when(s["kind"] == k[1], k[0]), enumerate(KINDS), F)
    keyed = F.transform(F.concat(assign, access, hexes), lambda s: F.struct(s["start"].alias("a"), rank(s).alias("b"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"]).cast(_SPANS)


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def ownership(candidates: DataFrame) -> DataFrame:
    """``value_hash, n_repos, n_owners`` for ``candidates(value_hash, owner, repo)``.

    Rows are made distinct and summed in steps, each combined before its
    shuffle, so a value that a third of all rows hold is no hot group.  Null
    owners and repositories each count as one.
    """
    pairs = candidates.select("value_hash", "owner", "repo").distinct()
    return pairs.groupBy("value_hash", "owner").agg(F.count("*").alias("n")).groupBy("value_hash").agg(
        F.sum("n").alias("n_repos"), F.count("*").alias("n_owners"))


def scanned(docs: DataFrame, repo: str = "doc_id", owner: str = "source", owners: int = OWNERS, repos: int = REPOS) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, most_repos, most_owners`` per row of ``docs``.

    ``repo`` and ``owner`` name the columns that say where a document lives and
    whose it is.  ``spans`` holds the base spans and, for values of fewer than
    ``owners`` owners and ``repos`` repositories, a ``live`` span over the
    value; the last two columns are the counts of the values that are held
    most widely, 0 without one.  Null text is empty; the digest of no span is
    that of the empty string; repeated rows are each returned and count once;
    an empty table gives no rows.
    """
    found = docs.select(
        "doc_id", F.col(owner).alias("owner"), F.col(repo).alias("repo"), spans(F.coalesce("text", F.lit(""))).alias("found"))
    base = stored(found.withColumn("row", F.monotonically_increasing_id()), "spans")
    values = base.filter(F.size("found") > 0).select("row", "owner", "repo", F.explode("found").alias("s")).select(
        "row", "owner", "repo", F.sha2("s.value", 256).alias("value_hash"), F.col("s.at").alias("at"), F.col("s.end").alias("end"))
    owned = ownership(values)
    live = (F.col("n_owners") < owners) & (F.col("n_repos") < repos)
    judged = values.join(owned, "value_hash").select("row", "at", "end", "n_owners", "n_repos", live.alias("live"))
    per_row = judged.groupBy("row").agg(
        F.array_sort(F.collect_set(F.when(F.col("live"), F.struct("at", "end")))).alias("live"),
        F.count_if("live").cast("bigint").alias("n_live"), F.count_if(~F.col("live")).cast("bigint").alias("n_example"),
        F.max("n_repos").alias("most_repos"), F.max("n_owners").alias("most_owners"))
    none = F.array().cast("array<struct<at:bigint,end:bigint>>")
    met = base.join(per_row, "row", "left").withColumn("live", F.coalesce("live", none))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    added = F.transform("live", lambda v: F.struct(
        v["at"].alias("start"), F.lit(len(KINDS)).alias("rank"), F.lit(LIVE).alias("kind"), v["end"].alias("end")))
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).cast("int") - 1
    first = F.transform("found", lambda s: F.struct(
        s["start"].alias("start"), rank(s).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    return met.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(_listed(F.col("found")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat(first, added))).alias("spans"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_live", "n_example", "most_repos", "most_owners")])


def op3(spark: SparkSession, folder: str) -> DataFrame:
    return scanned(spark.read.parquet(f"{folder}/documents.parquet"))


def _sql_kind(kind: str, pattern: str, value: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT row, doc_id, source, '{kind}' AS kind, {KINDS.index(kind)} AS rank, m AS match, {value.replace("PATTERN", quoted)} AS value,
    CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda g: len(g))), 0)
      + coalesce(list_sum(list_transform(found[1:i - 1], lambda g: len(g))), 0) AS BIGINT) AS start
  FROM (SELECT row, doc_id, source, found, gaps, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS m
    FROM (SELECT row, doc_id, source, regexp_extract_all(text, '{quoted}') AS found,
      regexp_split_to_array(text, '{quoted}') AS gaps FROM docs) WHERE len(found) > 0)"""


SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents),
every AS (
  {_sql_kind("assign", ASSIGN, "regexp_extract(m, 'PATTERN', 2)")}
  UNION ALL {_sql_kind("access", ACCESS, "m")}
  UNION ALL {_sql_kind("hex", HEX, "m")}),
base AS (
  SELECT *, start + len(match) AS stop FROM every WHERE kind <> 'assign' OR len(value) >= {ASSIGN_LEAST}),
owned AS (
  SELECT value, count(DISTINCT coalesce(source, chr(1))) AS n_owners,
    count(DISTINCT coalesce(source, chr(1)) || chr(2) || coalesce(CAST(doc_id AS VARCHAR), chr(1))) AS n_repos FROM base GROUP BY value),
judged AS (
  SELECT b.*, n_owners, n_repos, n_owners < {OWNERS} AND n_repos < {REPOS} AS live FROM base b JOIN owned USING (value)),
every_span AS (
  SELECT row, start, rank, kind, stop FROM judged
  UNION ALL SELECT DISTINCT row, stop - len(value), {len(KINDS)}, '{LIVE}', stop FROM judged WHERE live),
listed AS (
  SELECT row, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) AS spans FROM every_span GROUP BY row),
counted AS (
  SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example,
    max(n_repos) AS most_repos, max(n_owners) AS most_owners,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS base FROM judged GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
  coalesce(most_repos, 0) AS most_repos, coalesce(most_owners, 0) AS most_owners
FROM docs LEFT JOIN listed USING (row) LEFT JOIN counted USING (row)
"""
