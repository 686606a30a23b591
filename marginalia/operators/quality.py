"""Content-loss checks between two versions of a document, computed inside the row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import patterns as P
from ..functions.text import let, lines, percent
from .structure import compute_once, table_rows

HEADING_ANY_LINE = rf"(?md)^#{{1,4}}[{P.SPACE}]+[^\n]+$"
QUOTE = rf"(?md)^>[{P.SPACE}]*[^\n]+$"


def no_space_length(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[{P.SPACE}]", ""))


def content_stats(text: Column) -> Column:
    return F.struct(
        F.length(text).alias("char_count"),
        no_space_length(text).alias("char_count_no_space"),
        F.size(lines(text)).alias("line_count"),
        F.size(table_rows(text)).alias("table_rows"),
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda s, x: s + x)


def _lost_length(found: Column, after: Column) -> Column:
    return _total(F.transform(
        F.filter(found, lambda x: ~F.contains(after, x)), lambda x: F.length(x).cast("bigint")))


def _share(removed: Column, before: Column, least: float) -> Column:
    """Removed characters as a share of all, counted only above a limit."""
    share = removed / F.length(before)
    return F.when((F.length(before) > 0) & (share > least), share).otherwise(F.lit(0.0))


def reduction_decorative(before: Column, after: Column, words: Sequence[str] = P.DECORATIVE) -> Column:
    """Lost lines about decorative images; a line counts once per pattern it has."""
    any_word = "(?i)" + "|".join(words)

    def weight(x: Column) -> Column:
        hits = [F.when(x.rlike(f"(?i){w}"), 1).otherwise(0) for w in words]
        return F.length(x).cast("bigint") * sum(hits[1:], hits[0])

    candidates = F.filter(lines(before), lambda x: x.rlike(any_word))
    lost = F.filter(candidates, lambda x: ~F.contains(after, x))
    return _share(_total(F.transform(lost, weight)), before, 0.01)


def reduction_doc_info(before: Column, after: Column, patterns: Sequence[str] = P.DOC_INFO) -> Column:
    """Lost document-information lines, and the first revision history if it is gone."""
    removed = F.lit(0).cast("bigint")
    for p in patterns:
        pattern = F.lit(f"(?i){p}")
        fewer = F.regexp_count(before, pattern) > F.regexp_count(after, pattern)
        removed = removed + F.when(
            fewer, _lost_length(F.regexp_extract_all(before, pattern, F.lit(0)), after)
        ).otherwise(0)
    # The section is cut from the text only where the cheap word test passes.
    section = F.when(before.rlike("(?:改訂|更新|変更)履歴"), F.regexp_extract(before, P.REVISION_SECTION, 1))
    gone = (F.coalesce(section, F.lit("")) != "") & ~F.contains(after, section)
    return _share(removed + F.when(gone, F.length(section)).otherwise(0), before, 0.01)


def reduction_quote(before: Column, after: Column) -> Column:
    return _share(
        _lost_length(F.regexp_extract_all(before, F.lit(QUOTE), F.lit(0)), after), before, 0.005)


def reduction_label(before: Column, after: Column, labels: Sequence[str] = P.LABELS) -> Column:
    removed = F.lit(0).cast("bigint")
    for p in labels:
        diff = F.regexp_count(before, F.lit(p)) - F.regexp_count(after, F.lit(p))
        removed = removed + F.greatest(diff, F.lit(0)) * 10
    return _share(removed, before, 0.005)


def reduction_heading(before: Column, after: Column) -> Column:
    diff = F.regexp_count(before, F.lit(HEADING_ANY_LINE)) - F.regexp_count(after, F.lit(HEADING_ANY_LINE))
    return _share(F.greatest(diff, F.lit(0)) * 20, before, 0.005)


REDUCTIONS = (
    ("decorative", "装飾画像省略", reduction_decorative),
    ("doc_info", "文書情報/改訂履歴削除", reduction_doc_info),
    ("quote", "引用記法削除", reduction_quote),
    ("label", "ラベル削除", reduction_label),
    ("heading", "見出し統合", reduction_heading),
)


def char_count_check(before: Column, after: Column) -> Column:
    """Kept characters with the explained part of the loss."""
    def judge(n: Column) -> Column:
        ratio = F.when(n["input"] > 0, n["output"] / n["input"])

        def with_shares(shares: Column) -> Column:
            # Summed left to right: the limit is compared exactly.
            explained = F.aggregate(shares, F.lit(0.0), lambda s, x: s + x)
            unexplained = (F.lit(1.0) - ratio) - explained
            empty, kept = n["input"] == 0, ratio >= P.CHAR_RATIO_OK
            lost = ratio < P.CHAR_RATIO_ERROR
            severity = (
                F.when(empty | kept, "info").when(lost, "error")
                .when(unexplained <= P.UNEXPLAINED_OK, "info").otherwise("warning"))
            return F.struct(
                F.lit("文字数チェック").alias("name"),
                (empty | ~F.coalesce(lost, F.lit(False))).alias("passed"),
                severity.alias("severity"),
                F.when(empty, F.lit("入力が空です")).otherwise(F.concat(
                    percent(ratio), F.lit(" ("), F.format_number(n["input"], 0), F.lit("文字 → "),
                    F.format_number(n["output"], 0), F.lit("文字)"))).alias("message"),
                n["input"].alias("input"), n["output"].alias("output"), ratio.alias("ratio"),
                F.when(~empty & ~kept, explained).alias("explained"),
                F.when(~empty & ~kept, unexplained).alias("unexplained"),
            )

        none = F.array(*[F.lit(0.0) for _ in REDUCTIONS])
        shares = F.when(ratio < P.CHAR_RATIO_OK, F.array(*[f(before, after) for _, _, f in REDUCTIONS]))
        return let(F.coalesce(shares, none), with_shares)

    return let(F.struct(
        no_space_length(before).cast("bigint").alias("input"),
        no_space_length(after).cast("bigint").alias("output")), judge)


def table_row_check(before: Column, after: Column) -> Column:
    def judge(n: Column) -> Column:
        ratio = F.when(n["input"] > 0, n["output"] / n["input"])
        ok = (n["input"] == 0) | (ratio >= P.TABLE_RATIO_OK)
        return F.struct(
            F.lit("表の行数チェック").alias("name"), ok.alias("passed"),
            F.when(ok, "info").otherwise("warning").alias("severity"),
            F.when(n["input"] == 0, F.lit("入力に表なし")).otherwise(F.concat(
                percent(ratio), F.lit(" ("), n["input"].cast("string"), F.lit("行 → "),
                n["output"].cast("string"), F.lit("行)"))).alias("message"),
            n["input"].alias("input"), n["output"].alias("output"), ratio.alias("ratio"),
            F.lit(None).cast("double").alias("explained"), F.lit(None).cast("double").alias("unexplained"),
        )

    return let(F.struct(
        F.size(table_rows(before)).cast("bigint").alias("input"),
        F.size(table_rows(after)).cast("bigint").alias("output")), judge)


def quality_checks(before: Column, after: Column) -> Column:
    return F.array(char_count_check(before, after), table_row_check(before, after))


def quality_report(df: DataFrame, *keep: str) -> DataFrame:
    """One row per document of ``df(before, after)``; no shuffle, the checks stay in the row."""
    checked = compute_once(df, quality_checks(F.col("before"), F.col("after")), "checks", *keep)

    def count_of(accept) -> Column:
        return F.size(F.filter("checks", accept))

    failed = F.filter("checks", lambda c: ~c["passed"])
    return checked.select(
        *keep,
        F.forall("checks", lambda c: c["passed"] | (c["severity"] != "error")).alias("passed"),
        F.size("checks").alias("total_checks"),
        count_of(lambda c: c["passed"]).alias("passes"),
        count_of(lambda c: ~c["passed"] & (c["severity"] == "warning")).alias("warnings"),
        count_of(lambda c: ~c["passed"] & (c["severity"] == "error")).alias("errors"),
        F.when(F.size(failed) > 0, F.concat(
            F.lit("以下の品質チェックに失敗しました:\n"),
            F.array_join(F.transform(failed, lambda c: F.concat(
                F.lit("- "), c["name"], F.lit(": "), c["message"])), "\n"),
        )).otherwise("").alias("failure_summary"),
    )


def retry_queue(reports: DataFrame, attempts: DataFrame, max_retries: int = 2) -> DataFrame:
    """Failed documents below the retry limit; chunked documents are not tried again.

    ``reports(name, passed, failure_summary, chunked)``, ``attempts(name, n)``.
    """
    return (
        reports.filter(~F.col("passed") & ~F.col("chunked"))
        .join(attempts, "name", "left")
        .withColumn("attempt", F.coalesce("n", F.lit(0)) + 1)
        .filter(F.col("attempt") <= max_retries)
        .select("name", "attempt", F.col("failure_summary").alias("hint"))
    )
