"""Ordered rewriting inside the row: renumbering, tables of contents, headers, skeleton.

A document is one row before and after, so none of this needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ..functions import patterns as P
from ..functions.text import (
    anchor, first_after, join_range, let, lines, lstrip_marks, positions, rstrip, split_lines, strip,
)
from .structure import _is_summary_title, _is_toc_title, parse_toc, summary_toc_body

S = P.SPACE
FIXED_TITLES = ("サマリー", "summary", "目次", "table of contents")
ANCHOR_LINE = '^<a id="[^"]+"></a>$'
RELATED = rf"(?i)^##?[{S}]*関連資料[{S}]*$"
H2 = rf"^##[{S}]+([^\n]+)$"
H3_LINK = rf"^###[{S}]+\[([0-9]+)\.?[{S}]*([^\]]+)\]\([^)]+\)[{S}]*$"
H3_NUMBERED = rf"^###[{S}]+[0-9]+\.?[{S}]*([^\n]+)$"
H3 = rf"^###[{S}]+([^\n]+)$"
H4_NUMBERED = rf"^####[{S}]+[0-9]+\.[0-9]+[{S}]*([^\n]+)$"
H4 = rf"^####[{S}]+([^\n]+)$"
SUB_LINK = rf"^-[{S}]+\[([0-9]+)\.([0-9]+)[{S}]*([^\]]+)\]\([^)]+\)[{S}]*$"


def _texts(items: Column) -> Column:
    return F.transform(items, lambda e: e["line"])


def _heading_class(line: Column) -> Column:
    """(kind, title, line): M major, m minor, 2 level two, t text, x dropped."""
    def classify(x: Column) -> Column:
        title2 = strip(F.regexp_extract(x, H2, 1))
        raw3 = strip(
            F.when(x.rlike(H3_LINK), F.regexp_extract(x, H3_LINK, 2))
            .when(x.rlike(H3_NUMBERED), F.regexp_extract(x, H3_NUMBERED, 1)).otherwise(F.regexp_extract(x, H3, 1)))
        title3 = let(lstrip_marks(raw3), lambda t: F.when(
            F.contains(t, F.lit("](#")), strip(F.substring_index(t, "](#", 1))).otherwise(t))
        title4 = lstrip_marks(strip(F.when(
            x.rlike(H4_NUMBERED), F.regexp_extract(x, H4_NUMBERED, 1)).otherwise(F.regexp_extract(x, H4, 1))))
        kind = (
            F.when(x.rlike(ANCHOR_LINE) | x.rlike(rf"^#[{S}]+[^\n]+$"), "x")
            .when(x.rlike(RELATED), "r")
            .when(x.rlike(H2), F.when(F.lower(title2).isin(*FIXED_TITLES), "x").otherwise("2"))
            .when(x.rlike(H3), "M").when(x.rlike(H4), "m").when(x.rlike(SUB_LINK), "s").otherwise("t"))
        title = (
            F.when(x.rlike(H2), title2).when(x.rlike(H3), title3).when(x.rlike(H4), title4)
            .otherwise(strip(F.regexp_extract(x, SUB_LINK, 3))))
        return F.struct(kind.alias("kind"), F.when(kind.isin("2", "M", "m", "s"), title).otherwise("").alias("title"), line.alias("line"))

    # Only lines that can be a heading, an anchor or a link entry are looked at closely.
    plain = F.struct(F.lit("t").alias("kind"), F.lit("").alias("title"), line.alias("line"))
    return F.when(line.rlike(rf"^[{S}]*[#<\-]"), let(strip(line), classify)).otherwise(plain)


def renumber_headings(body: Column) -> Column:
    """Headings renumbered in one pass, each with an anchor line before it."""
    def emit_major(number: Column, title: Column) -> Column:
        n = number.cast("string")
        return F.array(F.concat(F.lit('<a id="sec-'), n, F.lit('"></a>')), F.concat(F.lit("### "), n, F.lit(". "), title), F.lit(""))

    def emit_minor(major: Column, minor: Column, title: Column) -> Column:
        a, b = major.cast("string"), minor.cast("string")
        return F.array(F.concat(F.lit('<a id="sec-'), a, F.lit("-"), b, F.lit('"></a>')),
                       F.concat(F.lit("#### "), a, F.lit("."), b, F.lit(" "), title))

    def group(rows: Column, start: Column, end: Column, number: Column) -> Column:
        """Lines of one major: its heading, the text up to the first minor, then each minor."""
        def with_minors(items: Column) -> Column:
            minors = positions(items, lambda e: e["kind"].isin("m", "s", "2"))
            return let(minors, lambda m: F.concat(
                _texts(F.slice(items, F.lit(1), F.coalesce(F.get(m, F.lit(0)), F.size(items) + 1) - 1)),
                F.flatten(F.transform(m, lambda p, j: F.concat(
                    emit_minor(number, j + 1, F.get(items, p - 1)["title"]),
                    _texts(F.slice(items, p + 1, F.coalesce(F.get(m, j + 1), F.size(items) + 1) - p - 1)))))))

        return F.concat(
            emit_major(number, F.get(rows, start - 1)["title"]),
            let(F.slice(rows, start + 1, end - start), with_minors))

    def number(rows: Column) -> Column:
        majors = positions(rows, lambda e: e["kind"] == "M")
        return let(majors, lambda m: F.concat(
            _texts(F.slice(rows, F.lit(1), F.coalesce(F.get(m, F.lit(0)), F.size(rows) + 1) - 1)),
            F.flatten(F.transform(m, lambda p, g: group(
                rows, p, F.coalesce(F.get(m, g + 1), F.size(rows) + 1) - 1, g + 1)))))

    def first_major(rows: Column) -> Column:
        """The first heading is a major: a level-two one becomes it, a minor gets one before it."""
        first = F.array_min(positions(rows, lambda e: e["kind"].isin("M", "m", "s", "2")))
        default = F.struct(F.lit("M").alias("kind"), F.lit(P.DEFAULT_MAJOR).alias("title"), F.lit("").alias("line"))

        def fix(at: Column) -> Column:
            head = F.get(rows, at - 1)
            promoted = F.struct(F.lit("M").alias("kind"), head["title"].alias("title"), head["line"].alias("line"))
            before, after = F.slice(rows, F.lit(1), at - 1), F.slice(rows, at + 1, F.size(rows) - at)
            return (
                F.when(at.isNull() | (head["kind"] == "M"), rows)
                .when(head["kind"] == "2", F.concat(before, F.array(promoted), after))
                .otherwise(F.concat(before, F.array(default, head), after)))

        return let(first, fix)

    def build(ls: Column) -> Column:
        def keep(rows: Column) -> Column:
            marks = positions(ls, lambda x: x.rlike(rf"^[{S}]*#"))
            regions = let(marks, lambda h: F.transform(
                positions(rows, lambda e: e["kind"] == "r"),
                lambda p: F.struct(p.alias("open"), first_after(h, p).alias("close"))))
            return let(regions, lambda rs: F.filter(rows, lambda e, i: ~e["kind"].isin("x", "r") & ~F.exists(
                rs, lambda r: ((i + 1) > r["open"]) & F.coalesce((i + 1) < r["close"], F.lit(True)))))

        kept = let(F.transform(ls, _heading_class), keep)
        return strip(F.array_join(let(let(kept, first_major), number), "\n"))

    return F.when(strip(body) == "", body).otherwise(let(split_lines(body), build))


def derive_toc(body: Column) -> Column:
    """(major, minor, title) of a renumbered body; minor is NULL for a major.  A minor counts
    under the major it stands below only if its number names that major."""
    h3 = rf"^###[{S}]+([0-9]+)\.[{S}]+([^\n]+)$"
    h4 = rf"^####[{S}]+([0-9]+)\.([0-9]+)[{S}]+([^\n]+)$"

    def entry(x: Column) -> Column:
        big, small = x.rlike(h3), x.rlike(h4)
        return F.when(big | small, F.struct(
            F.when(big, F.regexp_extract(x, h3, 1)).otherwise(F.regexp_extract(x, h4, 1)).try_cast("bigint").alias("major"),
            F.when(small, F.regexp_extract(x, h4, 2).try_cast("bigint")).alias("minor"),
            strip(F.when(big, F.regexp_extract(x, h3, 2)).otherwise(F.regexp_extract(x, h4, 3))).alias("title")))

    def under(entries: Column) -> Column:
        majors = positions(entries, lambda e: e["minor"].isNull())
        return let(majors, lambda m: F.flatten(F.transform(m, lambda p, g: F.filter(
            F.slice(entries, p, F.coalesce(F.get(m, g + 1), F.size(entries) + 1) - p),
            lambda e: e["minor"].isNull() | (e["major"] == F.get(entries, p - 1)["major"])))))

    found = F.filter(F.transform(split_lines(body), lambda x: F.when(
        x.rlike(rf"^[{S}]*#"), entry(strip(x)))), lambda e: e.isNotNull())
    return let(found, under)


def derive_toc_from_minors(body: Column) -> Column:
    """(major, minor, title) from numbered minors alone, ordered; majors get a generic title."""
    h4 = rf"^####[{S}]+([0-9]+)\.([0-9]+)[{S}]+([^\n]+)$"
    minors = F.filter(F.transform(split_lines(body), lambda x: let(strip(x), lambda y: F.when(y.rlike(h4), F.struct(
        F.regexp_extract(y, h4, 1).try_cast("bigint").alias("major"), F.regexp_extract(y, h4, 2).try_cast("bigint").alias("minor"),
        strip(F.regexp_extract(y, h4, 3)).alias("title"))))), lambda e: e.isNotNull())
    majors = F.transform(F.array_distinct(F.transform(minors, lambda e: e["major"])), lambda n: F.struct(
        n.alias("major"), F.lit(None).cast("bigint").alias("minor"), F.concat(n.cast("string"), F.lit("章")).alias("title")))
    return F.array_sort(F.concat(majors, minors))


def render_toc(entries: Column) -> Column:
    """Linked table of contents of (major, minor, title) entries."""
    def line(e: Column, i: Column) -> Column:
        a, b = e["major"].cast("string"), e["minor"].cast("string")
        big = F.concat(F.lit("### ["), strip(F.concat(a, F.lit(". "), e["title"])), F.lit("](#sec-"), a, F.lit(")"))
        small = F.concat(F.lit("- ["), strip(F.concat(a, F.lit("."), b, F.lit(" "), e["title"])), F.lit("](#sec-"), a, F.lit("-"), b, F.lit(")"))
        gap = F.when(i > 0, "\n").otherwise("")
        return F.when(e["minor"].isNull(), F.concat(gap, big)).otherwise(small)

    return rstrip(F.array_join(F.transform(entries, line), "\n"))


def build_toc(text: Column, limit: int | None = 20) -> Column:
    """``## 目次`` with the first ``limit`` level 3-4 headings (None: all); empty if there are none."""
    def line(x: Column) -> Column:
        def item(title: Column, indent: str) -> Column:
            return let(title, lambda t: F.concat(F.lit(indent + "- ["), t, F.lit("](#"), anchor(t), F.lit(")")))

        return (F.when(x.startswith("### "), item(strip(F.substr(x, F.lit(5))), ""))
                .when(x.startswith("#### "), item(strip(F.substr(x, F.lit(6))), "  ")))

    entries = F.array_compact(F.transform(F.filter(F.transform(lines(text), strip), lambda x: x.rlike("^####? ")), line))
    if limit is not None:
        entries = F.slice(entries, 1, limit)
    return let(entries, lambda e: F.when(F.size(e) == 0, "").otherwise(
        F.concat(F.lit("## 目次\n\n"), F.array_join(e, "\n"))))


def _drop_regions(ls: Column, opens: Column, closes: Column, drop_close) -> Column:
    """Lines without the regions from each opening to the next closing line."""
    def region(p: Column) -> Column:
        return F.struct(p.alias("open"), first_after(closes, p).alias("close"))

    return let(F.transform(opens, region), lambda rs: F.filter(ls, lambda x, i: ~F.exists(rs, lambda r: (
        (i + 1) >= r["open"]) & F.coalesce(((i + 1) < r["close"]) | (((i + 1) == r["close"]) & drop_close(strip(x))), F.lit(True)))))


def strip_toc_summary(text: Column) -> Column:
    """Without the summary and contents blocks; a rule that ends a block goes too."""
    def build(ls: Column) -> Column:
        def is_open(x: Column) -> Column:
            return x.startswith(P.SUMMARY_HEADING) | x.startswith(P.TOC_HEADING)

        return let(F.transform(ls, strip), lambda t: let(positions(t, is_open), lambda o: let(
            positions(t, lambda x: (x == "---") | (x.startswith("## ") & ~is_open(x))),
            lambda c: F.array_join(_drop_regions(ls, o, c, lambda x: x == "---"), "\n"))))

    return let(lines(text), build)


def toc_and_body(text: Column) -> Column:
    """A chunk without its title lines and summary block; the block also ends at a chapter."""
    def build(ls: Column) -> Column:
        kept = F.filter(ls, lambda x: ~strip(x).startswith("# "))

        def cut(k: Column) -> Column:
            return let(F.transform(k, strip), lambda t: let(positions(t, _is_summary_title), lambda o: let(
                positions(t, lambda x: ~_is_summary_title(x) & ((x == "---") | x.startswith("## ") | x.startswith("### "))),
                lambda c: strip(F.array_join(_drop_regions(k, o, c, lambda x: x == "---"), "\n")))))

        return let(kept, cut)

    return let(lines(text), build)


def assemble_document(title: Column, summary: Column, toc: Column, body: Column) -> Column:
    def part(c: Column) -> Column:
        return let(strip(c), lambda x: F.when(x != "", F.concat(x, F.lit("\n"))).otherwise(""))

    whole = F.concat(
        strip(title), F.lit("\n\n## サマリー\n"), part(summary), F.lit("\n---\n\n## 目次\n\n"), part(toc), F.lit("\n---\n\n"), part(body))
    return F.concat(rstrip(whole), F.lit("\n"))


def finalize_document(text: Column, name: Column, stable: bool = False) -> Column:
    """Fixed skeleton with renumbered body and a contents table made from it.

    The body starts with the rule that ended the old table; ``stable`` drops it
    and repeated blank lines, so that a second run changes nothing more.
    """
    def parts(ls: Column) -> Column:
        def cut(t: Column, at_sum: Column, at_toc: Column) -> Column:
            ends = positions(t, lambda x: (x == "---") | (x.startswith("### ") & ~x.startswith("### [")))
            stop = F.coalesce(first_after(ends, at_toc), F.size(ls) + 1)
            block = F.filter(F.slice(ls, at_sum + 1, at_toc - at_sum - 1), lambda x: strip(x) != "---")
            return F.struct(
                strip(F.array_join(block, "\n")).alias("summary"),
                strip(join_range(ls, stop, F.size(ls))).alias("body"))

        def choose(t: Column) -> Column:
            return let(F.struct(
                F.array_min(positions(t, _is_summary_title)).alias("s"), F.array_min(positions(t, _is_toc_title)).alias("t"),
            ), lambda at: F.when(at["t"] > at["s"], cut(t, at["s"], at["t"])).otherwise(
                let(summary_toc_body(text), lambda p: F.struct(p["summary"].alias("summary"), p["body"].alias("body")))))

        titles = F.filter(ls, lambda x: x.startswith("# "))
        title = F.coalesce(strip(F.get(titles, F.lit(0))), F.concat(F.lit("# "), name))
        return let(F.transform(ls, strip), lambda t: let(choose(t), lambda p: F.struct(
            title.alias("title"), p["summary"].alias("summary"), p["body"].alias("body"))))

    def build(p: Column) -> Column:
        body = p["body"]
        if stable:
            body = F.regexp_replace(F.regexp_replace(body, r"\A(---\s*)+", ""), "\n{3,}", "\n\n")
        renumbered = renumber_headings(body)
        if stable:
            renumbered = F.regexp_replace(renumbered, "\n{3,}", "\n\n")
        return let(renumbered, lambda b: assemble_document(p["title"], p["summary"], render_toc(derive_toc(b)), b))

    return F.when(strip(text) == "", text).otherwise(let(let(split_lines(text), parts), build))


def rebuild_toc(text: Column, title: Column, limit: int | None = None) -> Column:
    """New title and contents table (``limit`` entries at most, default all) in front of the body; the summary block stays."""
    def summary_block(ls: Column) -> Column:
        def build(t: Column) -> Column:
            start = F.array_min(positions(t, lambda x: x.startswith(P.SUMMARY_HEADING)))
            ends = positions(t, lambda x: (x.startswith("## ") & ~x.startswith(P.SUMMARY_HEADING)) | (x == "---"))
            block = join_range(ls, start, F.coalesce(first_after(ends, start), F.size(ls) + 1) - 1)
            return F.when(start.isNull(), "").otherwise(F.concat(block, F.lit("\n\n")))

        return let(F.transform(ls, strip), build)

    def assemble(clean: Column) -> Column:
        return let(build_toc(clean, limit), lambda toc: let(let(lines(text), summary_block), lambda s: (
            F.when(toc != "", F.concat(F.lit("# "), title, F.lit("\n\n"), s, toc, F.lit("\n\n---\n\n"), clean))
            .when(s != "", F.concat(F.lit("# "), title, F.lit("\n\n"), s, F.lit("---\n\n"), clean))
            .otherwise(clean))))

    return let(strip_toc_summary(text), assemble)


# Header names of wide tables without a header.
WIDE_HEADERS = (
    "チャネル", "カテゴリ", "業務名", "備考", "No.", "次No.",
    "業務概要", "新規/既存", "担当", "実施時期", "何を", "実施場所",
    "どのように", "col14", "col15", "col16", "col17", "col18", "col19", "コメント",
    "システム1", "システム2", "システム3", "システム4", "システム5",
    "システム6", "システム7", "システム8", "システム9", "システム10",
)


def add_table_headers(text: Column, headers: Sequence[str] = WIDE_HEADERS, mirror: bool = False) -> Column:
    """Give a pipe block without a separator one: below its first line, or with a generated header
    above it for ten or more columns.  ``mirror`` applies the rule to every row of the block."""
    def build(ls: Column) -> Column:
        def is_row(x: Column) -> Column:
            return strip(x).startswith("|")

        def is_separator(x: Column) -> Column:
            return strip(x).startswith("| ---")

        def emit(x: Column, i: Column) -> Column:
            before = F.coalesce(is_row(F.get(ls, i - 1)), F.lit(False))
            follows = F.coalesce(is_separator(F.get(ls, i + 1)), F.lit(False))
            here = is_row(x) & ~is_separator(x) & ~follows
            if not mirror:
                here = here & ~before
            cols = F.greatest(F.size(F.split(x, r"\|", -1)) - 2, F.lit(1))

            def row(cells: Column) -> Column:
                return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

            names = F.array(*[F.lit(h) for h in headers])
            separator = row(F.array_repeat(F.lit("---"), cols))
            header = row(F.transform(F.sequence(F.lit(1), cols), lambda j: F.coalesce(
                F.get(names, j - 1), F.concat(F.lit("col"), j.cast("string")))))
            return F.when(~here, F.array(x)).when(cols >= 10, F.array(header, separator, x)).otherwise(F.array(x, separator))

        return F.array_join(F.flatten(F.transform(ls, emit)), "\n")

    return let(lines(text), build)


def normalize_body_with_toc(body: Column, toc: Column) -> Column:
    """Body with the majors of a contents table put before their first minor, missing ones behind.

    ``toc`` is the text of the table; without entries the minors of the body give it.
    """
    sub = rf"^####?[{S}]+([0-9]+)\.([0-9]+)[{S}]+([^\n]+)$"

    def clean(ls: Column) -> Column:
        marks = positions(ls, lambda x: x.rlike("^#{1,4} "))
        regions = let(marks, lambda h: F.transform(
            positions(ls, lambda x: strip(x).startswith("## 関連資料")),
            lambda p: F.struct(p.alias("open"), first_after(h, p).alias("close"))))
        kept = let(regions, lambda rs: F.filter(ls, lambda x, i: ~x.startswith("# ") & ~F.exists(rs, lambda r: (
            (i + 1) >= r["open"]) & F.coalesce((i + 1) < r["close"], F.lit(True)))))
        return F.transform(kept, lambda x: F.when(
            x.startswith("## "), F.concat(F.lit("#### "), strip(F.substr(x, F.lit(4))))).otherwise(x))

    def anchor_line(*parts: Column) -> Column:
        return F.concat(F.lit('<a id="sec-'), F.concat_ws("-", *[p.cast("string") for p in parts]), F.lit('"></a>'))

    def place(ls: Column, majors: Column) -> Column:
        def info(x: Column) -> Column:
            return let(strip(x), lambda y: F.when(y.rlike(sub), F.struct(
                F.regexp_extract(y, sub, 1).try_cast("bigint").alias("major"),
                F.regexp_extract(y, sub, 2).try_cast("bigint").alias("minor"), strip(F.regexp_extract(y, sub, 3)).alias("title"))))

        def major_lines(m: Column) -> Column:
            title = F.coalesce(F.nullif(strip(m["title"]), F.lit("")), F.concat(m["major"].cast("string"), F.lit("章")))
            return F.array(anchor_line(m["major"]), F.concat(F.lit("### "), m["major"].cast("string"), F.lit(". "), title), F.lit(""))

        def emit(infos: Column) -> Column:
            def line(x: Column, i: Column) -> Column:
                e = F.get(infos, i)
                first = F.size(F.filter(F.slice(infos, F.lit(1), i), lambda o: o["major"] == e["major"])) == 0
                known = F.filter(majors, lambda m: m["major"] == e["major"])
                minor = F.array(
                    anchor_line(e["major"], e["minor"]),
                    F.concat(F.lit("#### "), e["major"].cast("string"), F.lit("."), e["minor"].cast("string"), F.lit(" "), e["title"]))
                # An anchor that already stands right before is not repeated.
                present = F.coalesce(strip(F.get(ls, i - 1)) == F.get(minor, F.lit(0)), F.lit(False))
                own = F.when(present & ~(first & (F.size(known) > 0)), F.slice(minor, 2, 1)).otherwise(minor)
                return F.when(e.isNull(), F.array(x)).when(
                    first & (F.size(known) > 0), F.concat(major_lines(F.get(known, F.lit(0))), own)).otherwise(own)

            seen = F.array_distinct(F.transform(F.filter(infos, lambda e: e.isNotNull()), lambda e: e["major"]))
            rest = let(seen, lambda s: F.flatten(F.transform(
                F.filter(majors, lambda m: ~F.array_contains(s, m["major"])), major_lines)))
            return F.concat(F.flatten(F.transform(ls, line)), rest)

        return strip(F.array_join(let(F.transform(ls, info), emit), "\n"))

    given = F.transform(F.filter(parse_toc(toc), lambda e: ~e["is_minor"]), lambda e: F.struct(
        e["major"].alias("major"), e["title"].alias("title")))

    def with_majors(ls: Column) -> Column:
        derived = F.transform(F.filter(
            derive_toc_from_minors(F.array_join(ls, "\n")), lambda e: e["minor"].isNull()),
            lambda e: F.struct(e["major"].alias("major"), e["title"].alias("title")))
        return let(given, lambda g: let(F.when(F.size(g) > 0, g).otherwise(derived), lambda m: place(ls, m)))

    return F.when(strip(body) == "", body).otherwise(let(let(split_lines(body), clean), with_majors))
