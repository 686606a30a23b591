"""Column expressions over text: no UDF, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from .patterns import SPACE, SPACES, WORD


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it inside ``body`` (also within nested lambdas)."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(SPACES))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACES))


def lstrip_marks(c: Column) -> Column:
    """Drop leading list and number marks of a title."""
    return strip(F.regexp_replace(c, r"^[.・\-–— ]+", ""))


def blank(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit(""))) == ""


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def split_lines(text: Column) -> Column:
    """Lines at every line boundary; a final boundary opens no further line."""
    unified = F.regexp_replace(text, r"\r\n|[\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]", "\n")
    return F.when(unified == "", F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(unified, r"\n\z", ""), "\n", -1)
    )


def positions(items: Column, accept: Callable[[Column], Column]) -> Column:
    """1-based positions of the accepted elements."""
    return F.filter(
        F.transform(items, lambda x, i: F.when(accept(x), i + 1)), lambda p: p.isNotNull()
    )


def first_after(found: Column, start: Column) -> Column:
    """Smallest position greater than ``start``; NULL if there is none."""
    return F.array_min(F.filter(found, lambda p: p > start))


def join_range(items: Column, start: Column, end: Column) -> Column:
    """Elements start..end (1-based, inclusive) joined by newlines."""
    return F.array_join(F.slice(items, start, F.greatest(end - start + 1, F.lit(0))), "\n")


def normalize_content(c: Column) -> Column:
    return strip(F.regexp_replace(c, rf"[{SPACE}]+", " "))


def normalize_title(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(c, rf"^#+[{SPACE}]*", ""), rf"[{SPACE}]+", ""))


def anchor(title: Column) -> Column:
    kept = F.regexp_replace(
        F.lower(title), rf"[^{WORD}{SPACE}\-\x{{3040}}-\x{{30ff}}\x{{4e00}}-\x{{9fff}}]", ""
    )
    return F.regexp_replace(
        F.regexp_replace(F.regexp_replace(kept, rf"[{SPACE}]+", "-"), "-+", "-"), "^-|-$", ""
    )


# What the name cleaners take out or replace.
BRACKETED, DATE, ORNAMENTS = "【[^】]*】", r"[0-9]{4}[-_]?[0-9]{2}[-_]?[0-9]{2}", "[★☆●○◆◇■□▲△▼▽]"
OUTPUT_BRACKETED, OUTPUT_ORNAMENT, OUTPUT_DATE = "【.*?】", "★", r"^[0-9]{6}_"
NOT_IN_FILES, NOT_IN_TITLES = r'[\\/*?:"<>|\n\r\t]', r'[/\\:*?"<>|]'


def clean_filename(name: Column) -> Column:
    c = F.regexp_replace(name, BRACKETED, "")
    c = F.regexp_replace(c, DATE, "")
    c = F.regexp_replace(c, ORNAMENTS, "")
    c = F.regexp_replace(F.regexp_replace(c, "_+", "_"), r"^[_\- ]+|[_\- ]+\z", "")
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("document"))


def clean_output_name(name: Column) -> Column:
    c = F.regexp_replace(F.regexp_replace(name, OUTPUT_BRACKETED, ""), OUTPUT_ORNAMENT, "")
    c = F.regexp_replace(c, OUTPUT_DATE, "")
    c = strip(F.regexp_replace(c, rf"[{SPACE}]*\([0-9]+\)\z", ""))
    return F.coalesce(F.nullif(c, F.lit("")), name)


def sanitize_filename(name: Column, limit: int = 120) -> Column:
    return F.substring(strip(F.regexp_replace(name, NOT_IN_FILES, "_")), 1, limit)


def sanitize_title(title: Column) -> Column:
    return F.regexp_replace(title, NOT_IN_TITLES, "・")


def truncate(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n - 3), F.lit("..."))).otherwise(c)


def preview(c: Column, n: int = 100) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def content_hash(c: Column) -> Column:
    return F.md5(c.cast("binary"))


def chapter_id(name: Column, index: Column) -> Column:
    head = F.regexp_replace(
        F.regexp_replace(F.substring(name, 1, 20), rf"[^{WORD}]", "_"), "^_+|_+$", ""
    )
    return F.concat(
        F.coalesce(F.nullif(head, F.lit("")), F.lit("doc")), F.lit("_"),
        F.substring(content_hash(name), 1, 8), F.lit("_"), pad(index, 3),
    )


def pad(n: Column, width: int) -> Column:
    """Zero-padded number that keeps longer numbers whole."""
    return F.format_string(f"%0{width}d", n.cast("bigint"))


def parse_chapter_range(text: Column, total: Column) -> Column:
    """``001-015`` as a 0-based inclusive (first, last); anything unreadable is the whole file."""
    two = rf"^[{SPACE}]*([0-9]+)[{SPACE}]*-[{SPACE}]*([0-9]+)[{SPACE}]*\z"
    one = rf"^[{SPACE}]*([0-9]+)[{SPACE}]*\z"

    def number(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group).try_cast("bigint")

    def row(first: Column, last: Column) -> Column:
        return F.struct(first.cast("bigint").alias("first"), last.cast("bigint").alias("last"))

    return (
        F.when(text.rlike(two), row(
            F.greatest(F.lit(0), number(two, 1) - 1), F.least(number(two, 2) - 1, total - 1)))
        .when(text.rlike(one), row(
            F.greatest(F.lit(0), number(one, 1) - 1), F.least(number(one, 1) - 1, total - 1)))
        .otherwise(row(F.lit(0), total - 1))
    )


def sanitize_cell(c: Column) -> Column:
    broken = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"\r\n|\r|\n", "<br>")
    return F.regexp_replace(broken, r"\|", r"\\|")


def strip_code_fence(c: Column, language: str = "markdown") -> Column:
    """Drop a leading fence (with or without the language) and a trailing one."""
    opener = "```" + language

    def without(x: Column, prefix: str) -> Column:
        return F.when(x.startswith(prefix), strip(F.substr(x, F.lit(len(prefix) + 1)))).otherwise(x)

    def close(x: Column) -> Column:
        return F.when(x.endswith("```"), strip(F.substr(x, F.lit(1), F.length(x) - 3))).otherwise(x)

    return let(without(c, opener), lambda x: let(without(x, "```"), close))


def normalise_original_path(path: Column, root: str, prefix: str) -> Column:
    """Path relative to ``root``; ``home/…`` means ``/home/…``; a fixed prefix is dropped."""
    full = F.when(path.startswith("home/"), F.concat(F.lit("/"), path)).otherwise(path)
    base = root.rstrip("/") + "/"
    return (
        F.when(F.coalesce(path, F.lit("")) == "", F.lit(None).cast("string"))
        .when(full.startswith(base), F.substring(full, len(base) + 1, 1 << 30))
        .when(path.startswith(prefix), F.substring(path, len(prefix) + 1, 1 << 30))
        .otherwise(path)
    )


def resolve_path(folder: Column, target: Column) -> Column:
    """Join and fold ``.`` and ``..``; a path that climbs out of the base gets a ``../`` mark."""
    joined = F.when(target.startswith("/"), F.regexp_replace(target, "^/+", "")).otherwise(
        F.concat(F.when(folder == "", F.lit("")).otherwise(F.concat(folder, F.lit("/"))), target)
    )
    parts = F.filter(F.split(joined, "/", -1), lambda p: ~p.isin("", "."))
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, p: F.when(
            p != "..", F.concat(done, F.array(p))
        ).when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1)) != ".."),
            F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
        ).otherwise(F.concat(done, F.array(p))),
    )
    return F.array_join(folded, "/")


def leading_number(c: Column, suffix: str = "") -> Column:
    return F.regexp_extract(c, rf"^([0-9]+){suffix}", 1).try_cast("bigint")


def matches_any(c: Column, patterns: Sequence[str], flags: str = "") -> Column:
    """True if one pattern is found; kept as one alternation so that a line is scanned once."""
    return c.rlike(flags + "|".join(f"(?:{p})" for p in patterns))


def contains_any(c: Column, words: Sequence[str]) -> Column:
    return matches_any(c, [_quote(w) for w in words])


def _quote(word: str) -> str:
    return "".join("\\" + ch if ch in r"\.[]{}()*+-?^$|" else ch for ch in word)


def percent(c: Column) -> Column:
    return F.format_string("%.0f%%", c * 100)
