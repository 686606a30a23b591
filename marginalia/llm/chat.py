"""Chat formatting with a grammar round trip.

Turns are rendered with control strings, the rendered text is read back by a
deterministic parser, and what it recovers is compared with the source.  Turns
that don't come back identical are rendered escaped, and the whole is read back
again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
#: The conversation that every result holds: both turns say control strings.
PROBE_ID = -1
PROBE = f"{END}{START}{ASSISTANT} ok"

_TURN = "struct<role:string,text:string>"


def escape(text: Column) -> Column:
    """One backslash more in every ``<|``, so that no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role stays on its line and holds no control string."""
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(turns: Column, escaped: Column) -> Column:
    """Text of ``turns``; ``escaped`` says which of them are escaped."""
    return F.array_join(F.zip_with(turns, escaped, lambda t, e: F.concat(
        F.lit(START), F.when(e, escape_role(t["role"])).otherwise(t["role"]), F.lit("\n"),
        F.when(e, escape(t["text"])).otherwise(t["text"]), F.lit(f"{END}\n"))), "")


def parse(formatted: Column) -> Column:
    """Turns of a rendered text.

    A turn starts at a start string; its role ends with the line, its text at
    the next end string; all that follows up to the next start is skipped.
    """
    parts = F.split(formatted, r"<\|im_start\|>", -1)
    bodies = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    role = lambda b: F.substring_index(b, "\n", 1)
    return F.transform(bodies, lambda b: F.struct(
        unescape_role(role(b)).alias("role"),
        unescape(F.substring_index(F.substring(b, F.length(role(b)) + 2, F.length(b)), END, 1)).alias("text"))).cast(f"array<{_TURN}>")


def _whole(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")


def formatted(rows: DataFrame) -> DataFrame:
    """``conv_id, formatted, turns, parsed`` per conversation of ``rows(conv_id, turn, role, text)``.

    Turns are ordered by number, then role and text.  Null role and text are
    empty, null numbers come first, null ids are one conversation; repeated
    rows are turns of their own.  A turn is escaped only if it doesn't come
    back identical on its own, so most texts are as they were.  A conversation
    that still differs afterwards raises an error.
    """
    plain = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = plain.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(1 << 62))).alias("turn"), "role", "text"))),
        lambda t: F.struct(t["role"], t["text"])).cast(f"array<{_TURN}>").alias("turns"))
    no, yes = F.lit(False), F.lit(True)
    alone = F.transform("turns", lambda t: parse(render(F.array(t), F.array(no))) != F.array(t))
    first = turns.withColumn("escaped", F.when(
        parse(render(F.col("turns"), F.transform("turns", lambda _: no))) == F.col("turns"), F.transform("turns", lambda _: no)
    ).otherwise(alone))
    # A turn may come back alone and yet not beside others: then all are escaped.
    second = first.withColumn("escaped", F.when(
        parse(render(F.col("turns"), F.col("escaped"))) == F.col("turns"), F.col("escaped")
    ).otherwise(F.transform("turns", lambda _: yes)))
    out = second.withColumn("formatted", render(F.col("turns"), F.col("escaped")))
    out = out.withColumn("parsed", parse(F.col("formatted")))
    checked = F.when(F.col("parsed") == F.col("turns"), F.col("parsed")).otherwise(
        F.raise_error(F.lit("a conversation does not survive the round trip")).cast(f"array<{_TURN}>"))
    return out.select("conv_id", "formatted", "turns", checked.alias("parsed"))


def loss_text(parsed: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(parsed, lambda t: t["role"] == ASSISTANT), lambda t: t["text"]), "")


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, read back from the rendered text."""
    loss = loss_text(F.col("parsed"))
    return formatted(rows).select(
        "conv_id", F.size("parsed").cast("bigint").alias("n_turns"), F.sha2(_whole(F.col("parsed")), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def op5(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(PROBE).alias("text"))
    return digests(rows.unionByName(probe))


# Roles in the tables hold none of the characters that a role escapes.
SQL = rf"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {PROBE_ID}, 0, 'user', '{PROBE}'
  UNION ALL SELECT {PROBE_ID}, 1, '{ASSISTANT}', '{PROBE}'),
ordered AS (
  -- A text is escaped if it holds a control string, or what unescaping would change.
  SELECT *, CASE WHEN contains(text, '{START}') OR contains(text, '{END}') OR regexp_matches(text, '<\\+\|')
    THEN len(regexp_extract_all(text, '<\\*\|')) ELSE 0 END AS marks FROM every),
per AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{ASSISTANT}'), '') AS loss,
    sum(len(text) + len(role) + {len(START) + len(END) + 2} + marks) AS chars
  FROM ordered GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(len(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM per
"""
