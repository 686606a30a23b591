"""Plan and carry out the update of a base by new documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import patterns as P
from ..functions.text import (
    clean_filename, join_range, let, lines, lstrip, normalize_title, pad, positions, strip,
)
from ..operators.chunking import UPDATE_SIZE, part_path, split_by_headings, split_large_update
from ..operators.classify import is_excluded
from ..operators.matching import UPDATE_LIMIT, already_in_base, best_match, change_rows, features, match_sections, section_diff
from ..operators.numbering import max_file_numbers, running_number
from ..operators.structure import sections_h12, unfold

#: Fixed wording of the reasons.
REASON_EXCLUDED = "除外設定にマッチ"
REASON_LEDGER = "既にナレッジ化済み（mapping.jsonに存在）"
REASON_NONE = "新規トピックとして追加。既存ナレッジに該当なし。"
REASON_SIMPLE = "（AI判定が利用できないため簡易判定）"
REASON_UNPLACED = "新規トピックとして追加。"
REASON_SAME = "変更なし（ハッシュ一致）"
NEW_CATEGORY = "01_新規"


def plan_updates(
    new: DataFrame, base: DataFrame, entries: DataFrame,
    exact: Sequence[str] = (), parts: Sequence[str] = (), patterns: Sequence[str] = (),
    nearby: bool = True,
) -> DataFrame:
    """One action per new document ``(key, name, text)`` against ``base(path, category, text)``.

    Excluded and known documents leave before their texts are looked at.
    """
    excluded = is_excluded(F.col("name"), exact, parts, patterns)
    names = new.select("key", "name", excluded.alias("is_excluded"))
    known = already_in_base(names.filter(~F.col("is_excluded")).select("name"), entries)
    todo = new.filter(~excluded).join(known.select("name"), "name", "left_anti")

    f_new = features(todo, "key", "name")
    f_base = features(base.withColumn("file_name", F.substring_index("path", "/", -1)), "path", "file_name")
    found = best_match(f_new, f_base, nearby)
    matched = (
        f_new.select("key", F.col("hash").alias("new_hash"))
        .join(found, "key", "left")
        .join(f_base.select(F.col("key").alias("target"), F.col("hash").alias("old_hash")), "target", "left")
        .select("key", F.col("target").alias("match"), "similarity", (F.col("new_hash") == F.col("old_hash")).alias("same"))
    ).checkpoint()

    is_create = F.col("match").isNull() | (~F.col("same") & (F.col("similarity") < UPDATE_LIMIT))
    creates = matched.filter(is_create).select("key").join(names.select("key", "name"), "key")
    first = base.agg(F.min("category").alias("c")).scalar()
    highest = max_file_numbers(base.select("category", "path"))
    # One row: the highest number of the first category.
    start = highest.agg(F.min_by("max_number", "category").alias("n")).scalar()
    clean = F.concat(clean_filename(F.col("name")), F.lit(".md"))
    placed = running_number(creates, ["key"], (), "k").select("key", first.alias("c"), (start + F.col("k")).alias("n"), clean.alias("f")).select(
        "key", F.when(F.col("c").isNull(), F.concat(F.lit(NEW_CATEGORY + "/"), "f")).otherwise(
            F.concat("c", F.lit("/"), pad(F.col("n"), 2), F.lit("_"), "f")).alias("created"))

    joined = (
        names.join(known.select("name", F.col("target").alias("known_target")), "name", "left")
        .join(matched, "key", "left").join(placed, "key", "left"))
    known_one = F.col("known_target").isNotNull()
    percent = F.concat(
        F.lit("（類似度"), F.bround(F.coalesce("similarity", F.lit(0.0)) * 100, 0).cast("bigint").cast("string"), F.lit("%）"))
    return joined.select(
        F.col("name").alias("source"), "key", "is_excluded",
        F.when(F.col("is_excluded") | known_one | F.col("same"), "skip")
        .when(F.col("created").isNotNull(), "create").otherwise("update").alias("action"),
        F.when(F.col("is_excluded"), F.lit(None)).when(known_one, F.col("known_target"))
        .when(F.col("created").isNotNull(), F.col("created")).otherwise(F.col("match")).alias("target"),
        F.when(F.col("is_excluded") | known_one, 0.0).when(F.col("same"), 1.0)
        .otherwise(F.coalesce("similarity", F.lit(0.0))).alias("similarity"),
        F.when(F.col("is_excluded"), REASON_EXCLUDED).when(known_one, REASON_LEDGER).when(F.col("same"), REASON_SAME)
        .when(F.col("match").isNull(), F.concat(F.lit(REASON_NONE), percent))
        .when(F.col("created").isNotNull(), F.concat(
            F.when(F.contains("match", F.lit("/")), F.concat(
                F.lit("「"), F.substring_index("match", "/", 1), F.lit("」カテゴリに関連する内容のため、同カテゴリへ配置を推奨。")))
            .otherwise(REASON_UNPLACED), F.lit(REASON_SIMPLE), percent))
        .otherwise(F.concat(F.lit("既存『"), "match", F.lit("』と類似。同一トピックのため更新対象。" + REASON_SIMPLE))).alias("reason"),
    )


def matched_pairs(actions: DataFrame, new: DataFrame, base: DataFrame) -> DataFrame:
    """``pair, target, new_text, old_text`` of the updates of a plan: the key of the new document, and both texts.

    Joined by key and path, so documents that share a name stay apart.
    """
    return actions.filter("action = 'update'").select(F.col("key").alias("pair"), "target").join(
        new.select(F.col("key").alias("pair"), F.col("text").alias("new_text")), "pair").join(
        base.select(F.col("path").alias("target"), F.col("text").alias("old_text")), "target").select("pair", "target", "new_text", "old_text")


def plan_changes(pairs: DataFrame, added: int = 15, changed: int = 10) -> DataFrame:
    """What an update changes in its target, per pair of ``matched_pairs``: added and changed sections with
    their lines up to a display limit, the number of the rest, and the number of sections that are kept."""
    diff = unfold(pairs, section_diff(F.col("new_text"), F.col("old_text")), "pair", "target")
    return change_rows(diff, "pair", added, changed).join(pairs.select("pair", "target"), "pair")


def plan_placements(pairs: DataFrame) -> DataFrame:
    """Where each section of an update goes in its target: the section of that heading, else the most similar
    one that is still free, else a new one.  In document order within each pair of ``matched_pairs``."""
    return match_sections(pairs).join(pairs.select("pair", "target"), "pair")


def front_matter(source: Column, run_ts: Column, split_index: Column | None = None, updated: bool = False) -> Column:
    """Front matter of a created or an updated file."""
    index = F.lit("") if split_index is None else F.when(split_index.isNotNull(), F.concat(
        F.lit("\n  - split_index: "), split_index.cast("string"))).otherwise("")
    field = "updated_at" if updated else "generated_at"
    return F.concat(
        F.lit('---\nsource:\n  - file: "'), source, F.lit('"'), index, F.lit(f'\n{field}: "'), run_ts, F.lit('"\n---'))


def strip_front_matter(text: Column) -> Column:
    """Drop a leading block that a rule line opens and a rule line ends."""
    rest = F.regexp_replace(text, r"(?s)\A---[^\n]*\n.*?(?<=\n)---[ \t]*(?=\n|\z)", "")
    return F.when(text.startswith("---") & (rest != text), lstrip(rest)).otherwise(text)


def update_front_matter(text: Column, source: Column, run_ts: Column) -> Column:
    return F.concat(front_matter(source, run_ts, updated=True), F.lit("\n"), strip_front_matter(text))


def integrate_sections(old_text: Column, new_text: Column, mappings: Column | None = None) -> Column:
    """Level 1-2 sections of the base, replaced by mapped or same-title new ones; the rest appended.

    ``mappings`` is an array of (new_key, old_key) of normalised titles.
    """
    def keyed(text: Column) -> Column:
        return F.transform(sections_h12(text), lambda s: F.struct(
            normalize_title(s["title"]).alias("k"), s["title"].alias("title"), s["content"].alias("content")))

    pairs = F.array().cast("array<struct<new_key:string,old_key:string>>") if mappings is None else mappings

    def build(old: Column, new: Column, maps: Column, new_keys: Column) -> Column:
        def chosen_key(s: Column) -> Column:
            mapped = F.filter(maps, lambda m: (m["old_key"] == s["k"]) & F.array_contains(new_keys, m["new_key"]))
            return F.coalesce(F.get(mapped, F.lit(0))["new_key"], F.when(F.array_contains(new_keys, s["k"]), s["k"]))

        return let(F.transform(old, chosen_key), lambda picks: let(
            F.array_distinct(F.array_compact(picks)), lambda used: F.concat(
                F.transform(old, lambda s, i: let(F.get(picks, i), lambda k: F.when(
                    k.isNull(), s).otherwise(F.element_at(F.filter(new, lambda n: n["k"] == k), -1)))),
                F.filter(new, lambda n: ~F.array_contains(used, n["k"])))))

    sections = let(keyed(old_text), lambda old: let(keyed(new_text), lambda new: let(
        pairs, lambda maps: let(F.transform(new, lambda n: n["k"]), lambda ks: build(old, new, maps, ks)))))
    return F.array_join(F.flatten(F.transform(
        sections, lambda s: F.array(s["title"], s["content"], F.lit("")))), "\n")


def merge_texts(strategy: Column, old_text: Column, new_text: Column, mappings: Column | None = None) -> Column:
    """append, integrate, or (anything else) replace."""
    return (
        F.when(strategy == "append", F.concat(old_text, F.lit("\n\n---\n\n## 追加コンテンツ\n\n"), new_text))
        .when(strategy == "integrate", integrate_sections(old_text, new_text, mappings)).otherwise(new_text))


def route_sections(text: Column, update_headings: Column, create_headings: Column) -> Column:
    """Lines of a document shared out to an update text and a create text by heading lists."""
    def decide(h: Column) -> Column:
        def near(items: Column) -> Column:
            return F.exists(items, lambda s: F.contains(h, s) | F.contains(s, h))

        return (
            F.when(F.array_contains(update_headings, h), "update")
            .when(F.array_contains(create_headings, h), "create")
            .when(near(create_headings) & ~near(update_headings), "create").otherwise("update"))

    def build(ls: Column) -> Column:
        starts = positions(ls, lambda x: x.rlike(P.HEADING_1_4))
        return let(starts, lambda s: let(
            F.concat(
                F.array(F.struct(F.lit("update").alias("side"), F.slice(
                    ls, F.lit(1), F.coalesce(F.get(s, F.lit(0)), F.size(ls) + 1) - 1).alias("block"))),
                F.transform(s, lambda p, i: F.struct(
                    decide(strip(F.regexp_extract(F.get(ls, p - 1), P.HEADING_1_4, 2))).alias("side"),
                    F.slice(ls, p, F.coalesce(F.get(s, i + 1), F.size(ls) + 1) - p).alias("block")))),
            lambda blocks: F.struct(*[
                F.array_join(F.flatten(F.transform(
                    F.filter(blocks, lambda b: b["side"] == side), lambda b: b["block"])), "\n").alias(f"{side}_text")
                for side in ("update", "create")])))

    return let(lines(text), build)


def split_long_updates(outcomes: DataFrame, run_ts: Column, limit: int = UPDATE_SIZE) -> DataFrame:
    """Updated texts over the limit in parts, each with its own front matter; other rows as they are."""
    parts = F.when(F.col("result") == "updated", split_large_update(F.col("text"), limit))
    rows = outcomes.select("*", F.explode(F.array(parts)).alias("_parts"))
    whole = rows.filter("_parts IS NULL").drop("_parts")
    cut = rows.filter("_parts IS NOT NULL").select(
        *[c for c in outcomes.columns if c != "text"], F.posexplode("_parts").alias("_i", "_part"))
    n = F.col("_i") + 1
    later = F.concat(front_matter(F.concat("source", F.lit(" (Part "), n.cast("string"), F.lit(")")), run_ts), F.lit("\n\n"), "_part")
    text = F.when(n == 1, update_front_matter(F.col("_part"), F.col("source"), run_ts)).otherwise(later)
    return whole.unionByName(cut.withColumn("text", text).withColumn("target", part_path(F.col("target"), n)).select(*outcomes.columns))
