"""Documents to lines, headings, sections, chapters, links and tables.

Each function maps a text column to an array of structs inside the row, so
that taking documents apart needs no shuffle; ``unfold`` turns the array
into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import patterns as P
from ..functions.text import (
    first_after, join_range, let, lines, lstrip_marks, positions, strip,
)


def unfold(df: DataFrame, items: Column, *keep: str) -> DataFrame:
    """One row per array element, struct fields as columns."""
    return df.select(*keep, F.inline(items))


def compute_once(df: DataFrame, value: Column, name: str, *keep: str) -> DataFrame:
    """Add a costly value behind a generator, so that later filters and projections
    read it instead of being rewritten into copies of its expression."""
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def fold_rows(rows: Column, separator: str = "\n") -> Column:
    """Aggregate (position, text) structs back to one text in order."""
    ordered = F.array_sort(F.collect_list(rows))
    return F.array_join(F.transform(ordered, lambda r: r["text"]), separator)


def line_rows(text: Column) -> Column:
    return F.transform(
        lines(text), lambda x, i: F.struct((i + 1).alias("line_no"), x.alias("line"))
    )


def structure_record(path: Column, text: Column, run_ts: Column) -> Column:
    """The nested record of a plain text: metadata, content with sections, processing."""
    return F.struct(
        path.alias("original_path"),
        run_ts.alias("extraction_timestamp"),
        F.struct(
            F.size(lines(text)).alias("total_lines"),
            F.length(text).alias("total_characters"),
            F.octet_length(text).alias("file_size_bytes"),
        ).alias("metadata"),
        F.struct(text.alias("full_text"), raw_sections(text).alias("sections")).alias("content"),
        F.struct(F.lit("structured").alias("stage"), F.lit("1.0").alias("version")).alias("processing"),
    )


def raw_sections(text: Column) -> Column:
    """Any marker line but the first line opens a section."""
    def build(ls: Column) -> Column:
        starts = F.array_union(
            F.array(F.lit(1)), positions(ls, lambda x: strip(x).rlike("^(===|---|#)"))
        )
        return let(starts, lambda s: F.transform(s, lambda p, i: let(
            F.coalesce(F.get(s, i + 1), F.size(ls) + 1) - 1,
            lambda end: F.struct(
                (i + 1).alias("sec_no"), join_range(ls, p, end).alias("content"),
                (end - p + 1).alias("line_count")),
        )))

    return let(lines(text), build)


def _headings(text: Column, pattern: str) -> Column:
    return F.filter(
        F.transform(lines(text), lambda x, i: F.when(x.rlike(pattern), F.struct(
            (i + 1).alias("line_no"),
            F.length(F.regexp_extract(x, pattern, 1)).alias("level"),
            strip(F.regexp_extract(x, pattern, 2)).alias("title"),
        ))), lambda h: h.isNotNull())


def headings(text: Column) -> Column:
    return _headings(text, P.HEADING_1_4)


def headings_to_6(text: Column) -> Column:
    return _headings(text, P.HEADING_1_6)


def heading_titles(text: Column) -> Column:
    return F.transform(headings(text), lambda h: h["title"])


def all_sections(text: Column) -> Column:
    """Sections cut at level 1-4 headings, with line range and text below the heading."""
    def build(ls: Column) -> Column:
        found = positions(ls, lambda x: x.rlike(P.HEADING_1_4))
        return let(found, lambda s: let(
            F.coalesce(F.get(s, F.lit(0)), F.size(ls) + 1),
            lambda first: F.concat(
                F.when(first > 1, F.array(F.struct(
                    F.lit(P.OPENING).alias("heading"), F.lit(1).alias("line_start"),
                    (first - 1).alias("line_end"), (first - 1).alias("n_lines"),
                    join_range(ls, F.lit(1), first - 1).alias("content"),
                ))).otherwise(F.array().cast(
                    "array<struct<heading:string,line_start:int,line_end:int,n_lines:int,content:string>>")),
                F.transform(s, lambda p, i: let(
                    F.coalesce(F.get(s, i + 1), F.size(ls) + 1) - 1,
                    lambda end: F.struct(
                        strip(F.regexp_extract(F.get(ls, p - 1), P.HEADING_1_4, 2)).alias("heading"),
                        p.alias("line_start"), end.alias("line_end"), (end - p).alias("n_lines"),
                        join_range(ls, p + 1, end).alias("content"),
                    ))),
            )))

    return let(lines(text), build)


def sections_list(text: Column) -> Column:
    """All sections that have at least one content line; duplicates stay."""
    return F.transform(
        F.filter(all_sections(text), lambda s: s["n_lines"] > 0),
        lambda s, i: F.struct(
            (i + 1).alias("sec_no"), s["heading"].alias("heading"),
            s["content"].alias("content"), F.length(s["content"]).alias("char_count")),
    )


def keyed_sections(text: Column) -> Column:
    """Sections keyed by heading: the last content, in the order of the first occurrence.

    ``sec_pos`` is the line of the first occurrence.  Equal headings are found
    inside the row, so no section text is shuffled.
    """
    def build(ss: Column) -> Column:
        def pick(heads: Column, back: Column) -> Column:
            def row(x: Column) -> Column:
                last = F.get(ss, (F.size(heads) - F.array_position(back, x)).cast("int"))
                first = F.get(ss, (F.array_position(heads, x) - 1).cast("int"))
                return let(last, lambda s: F.struct(
                    x.alias("heading"), first["line_start"].alias("sec_pos"), s["line_start"].alias("line_start"),
                    s["line_end"].alias("line_end"), s["content"].alias("content")))

            return F.transform(F.array_distinct(heads), row)

        return let(F.transform(ss, lambda s: s["heading"]), lambda heads: let(
            F.reverse(heads), lambda back: pick(heads, back)))

    return let(all_sections(text), build)


def sections_with_lines(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Rows of ``keyed_sections``."""
    return unfold(df, keyed_sections(F.col(text)), *keep)


def sections_h12(text: Column) -> Column:
    """Level 1-2 headings delimit; what stands before the first is left out."""
    def build(ls: Column) -> Column:
        found = positions(ls, lambda x: x.rlike(rf"^#{{1,2}}[{P.SPACE}]+"))
        return let(found, lambda s: F.transform(s, lambda p, i: F.struct(
            (i + 1).alias("sec_no"), F.get(ls, p - 1).alias("title"),
            join_range(ls, p + 1, F.coalesce(F.get(s, i + 1), F.size(ls) + 1) - 1).alias("content"),
        )))

    # A heading that is only a level mark and spaces at the end of a line counts as well.
    return let(lines(text), build)


def _is_toc_title(stripped: Column) -> Column:
    return stripped.startswith(P.TOC_HEADING) | (F.lower(stripped) == "## table of contents")


def _is_summary_title(stripped: Column) -> Column:
    return stripped.startswith(P.SUMMARY_HEADING) | (F.lower(stripped) == "## summary")


def chapters(text: Column) -> Column:
    """``### `` lines outside the first table of contents, with clean title and line range.

    A second table of contents never ends, as in the rule this follows.
    """
    def build(ls: Column) -> Column:
        st = F.transform(ls, strip)
        return let(st, lambda t: let(
            positions(t, _is_toc_title), lambda tocs: let(
                positions(t, lambda x: ~_is_toc_title(x) & (
                    (x.startswith("## ") & ~x.contains("目次")) | (x == "---")
                    | x.startswith("<a id=") | (x.startswith("### ") & ~x.contains("[")))),
                lambda ends: let(
                    F.struct(
                        F.array_min(tocs).alias("open"),
                        first_after(ends, F.array_min(tocs)).alias("close"),
                    ), lambda toc: let(
                        first_after(tocs, toc["close"]), lambda again: let(
                            F.filter(
                                positions(t, lambda x: x.startswith("### ") & ~x.contains("[")),
                                lambda p: F.coalesce(p < toc["open"], F.lit(True))
                                | ((p >= toc["close"]) & F.coalesce(p < again, F.lit(True)))),
                            lambda found: F.transform(found, lambda p, i: let(
                                strip(F.substr(F.get(t, p - 1), F.lit(5))),
                                lambda title: F.struct(
                                    (i + 1).alias("chapter_no"), title.alias("original_title"),
                                    strip(F.regexp_replace(title, rf"^[0-9]+\.[{P.SPACE}]*", "")).alias("clean_title"),
                                    p.alias("line_start"),
                                    (F.coalesce(F.get(found, i + 1), F.size(ls) + 1) - 1).alias("line_end"),
                                ))),
                        ))))))

    return let(lines(text), build)


def chapter_previews(text: Column, max_lines: int = 30, max_chars: int = 1500, batch: int = 20) -> Column:
    """Chapters with the head of their text, numbered into batches."""
    def build(ls: Column) -> Column:
        return let(F.transform(ls, strip), lambda t: let(
            positions(t, lambda x: ~_is_toc_title(x) & (
                (x == "---") | (x.startswith("## ") & ~x.contains("目次")))),
            lambda ends: let(
                F.transform(positions(t, _is_toc_title), lambda p: F.struct(
                    p.alias("open"), first_after(ends, p).alias("close"))),
                lambda tocs: let(
                    F.filter(
                        positions(t, lambda x: x.startswith("### ") & ~x.startswith("### [")),
                        lambda p: ~F.exists(tocs, lambda r: (p > r["open"]) & F.coalesce(
                            p < r["close"], F.lit(True)))),
                    lambda found: F.transform(found, lambda p, i: let(
                        F.coalesce(F.get(found, i + 1), F.size(ls) + 1) - 1,
                        lambda end: F.struct(
                            (i + 1).alias("chapter_no"),
                            strip(F.substr(F.get(t, p - 1), F.lit(5))).alias("title"),
                            F.substring(
                                join_range(ls, p, F.least(end - 1, p + max_lines - 1)), 1, max_chars
                            ).alias("preview"),
                            p.alias("line_start"), end.alias("line_end"),
                            F.floor(i / batch).alias("batch"),
                        )))))))

    return let(lines(text), build)


def summary(text: Column, max_lines: int = 10) -> Column:
    """Summary block up to the next level-2 heading, at most ``max_lines`` lines."""
    def is_title(x: Column) -> Column:
        low = F.lower(x)
        return low.startswith(P.SUMMARY_HEADING) | low.startswith("## summary")

    def build(t: Column) -> Column:
        open_at = F.array_min(positions(t, is_title))
        close_at = first_after(
            positions(t, lambda x: x.startswith("## ") & ~is_title(x)), open_at)
        block = F.slice(t, open_at + 1, F.coalesce(close_at, F.size(t) + 1) - open_at - 1)
        kept = F.filter(block, lambda x: (x != "") & ~is_title(x))
        return F.coalesce(F.array_join(F.slice(kept, 1, max_lines), "\n"), F.lit(""))

    return let(F.transform(lines(text), strip), build)


def summary_points(text: Column) -> Column:
    """Summary block up to a level-2 heading or a rule, bullet marks removed, as an array."""
    def build(t: Column) -> Column:
        open_at = F.array_min(positions(t, _is_summary_title))
        close_at = first_after(positions(
            t, lambda x: ~_is_summary_title(x) & (x.startswith("## ") | (x == "---"))), open_at)
        block = F.slice(t, open_at + 1, F.coalesce(close_at, F.size(t) + 1) - open_at - 1)
        kept = F.filter(block, lambda x: (x != "") & ~_is_summary_title(x))
        return F.coalesce(F.transform(kept, lambda x: F.when(
            x.startswith("-"), strip(F.substr(x, F.lit(2)))).otherwise(x)), F.array().cast("array<string>"))

    return let(F.transform(lines(text), strip), build)


def summary_toc_body(text: Column) -> Column:
    """(summary, toc, body) of a document by its markers; text before any marker is body."""
    def is_sum(x: Column) -> Column:
        return x.startswith(P.SUMMARY_HEADING) | x.startswith("## summary")

    def is_toc(x: Column) -> Column:
        return x.startswith(P.TOC_HEADING) | x.startswith("## table of contents")

    def is_head(x: Column) -> Column:
        return x.rlike("^#{1,4} ") & ~is_sum(x) & ~is_toc(x)

    none = F.array().cast("array<string>")

    def build(ls: Column) -> Column:
        def assemble(t: Column, opens: Column, turns: Column, heads: Column) -> Column:
            size = F.size(ls)
            parts = F.transform(opens, lambda p, i: let(
                F.coalesce(F.get(opens, i + 1), size + 1), lambda nxt: let(
                    F.least(F.coalesce(first_after(turns, p), nxt), nxt),
                    lambda turn: F.struct(
                        is_sum(F.get(t, p - 1)).alias("in_summary"),
                        F.slice(ls, p + 1, turn - p - 1).alias("block"),
                        F.when(turn >= nxt, none).when(
                            F.get(t, turn - 1) == "---", F.slice(ls, turn + 1, nxt - turn - 1)
                        ).otherwise(F.slice(ls, turn, nxt - turn)).alias("body"),
                    ))))
            first_open = F.coalesce(F.array_min(opens), size + 1)
            first_head = F.coalesce(F.array_min(heads), size + 1)
            front = F.filter(F.slice(ls, 1, first_open - 1), lambda x, i: (
                (i + 1) > first_head) | (F.lower(strip(x)) != "---"))

            def text_of(arrays: Column) -> Column:
                return strip(F.array_join(F.flatten(arrays), "\n"))

            return let(parts, lambda ps: F.struct(
                text_of(F.transform(F.filter(ps, lambda r: r["in_summary"]), lambda r: r["block"])).alias("summary"),
                text_of(F.transform(F.filter(ps, lambda r: ~r["in_summary"]), lambda r: r["block"])).alias("toc"),
                text_of(F.concat(F.array(front), F.transform(ps, lambda r: r["body"]))).alias("body"),
            ))

        return let(F.transform(ls, lambda x: F.lower(strip(x))), lambda t: let(
            positions(t, lambda x: is_sum(x) | is_toc(x)), lambda opens: let(
                positions(t, lambda x: is_head(x) | (x == "---")), lambda turns: let(
                    positions(t, is_head), lambda heads: assemble(t, opens, turns, heads)))))

    return let(lines(text), build)


def links(text: Column, images_once: bool = False) -> Column:
    """Internal links and images with line number.

    An image is also found as a link unless ``images_once``.
    """
    link = r"(?<!!)" + P.LINK if images_once else P.LINK

    def found(x: Column, i: Column, kind: str, pattern: str, external: str) -> Column:
        labels = F.regexp_extract_all(x, F.lit(pattern), F.lit(1))
        targets = F.regexp_extract_all(x, F.lit(pattern), F.lit(2))
        pairs = F.zip_with(labels, targets, lambda label, target: F.struct(
            (i + 1).alias("line_no"), F.lit(kind).alias("kind"),
            label.alias("link_text"), target.alias("target")))
        return F.filter(pairs, lambda p: ~p["target"].rlike(external))

    return F.flatten(F.transform(lines(text), lambda x, i: F.concat(
        found(x, i, "link", link, "^(https?://|mailto:)"),
        found(x, i, "image", P.IMAGE, "^https?://"),
    )))


def table_rows(text: Column, strict: bool = False) -> Column:
    """Pipe rows.  A separator of two or more columns counts as a row unless ``strict``."""
    separator = rf"^\|[{P.SPACE}\-:|]+\|$" if strict else P.TABLE_SEPARATOR
    return F.filter(line_rows(text), lambda r: r["line"].rlike(P.TABLE_ROW) & ~r["line"].rlike(separator))


def keywords(summary_text: Column, limit: int = 10) -> Column:
    return F.slice(F.array_distinct(
        F.regexp_extract_all(summary_text, F.lit(P.KEYWORD), F.lit(0))), 1, limit)


def topics(text: Column) -> Column:
    stripped = F.transform(lines(text), strip)
    heads = F.filter(stripped, lambda x: x.startswith("### ") & ~x.contains("目次"))
    clean = F.transform(heads, lambda x: strip(
        F.regexp_replace(x, rf"^###[{P.SPACE}]*[0-9]+\.[{P.SPACE}]*", "")))
    return F.array_distinct(F.filter(clean, lambda x: x != ""))


def target_business(text: Column) -> Column:
    """The first clause of the first summary point that ends in a business word.

    Clauses are tested one by one, from their start: the same answer as a
    search at every position, in linear time.
    """
    clauses = F.split(F.get(summary_points(text), F.lit(0)), "[、。]", -1)
    found = F.filter(clauses, lambda c: c.rlike("^" + P.BUSINESS))
    return F.coalesce(
        F.regexp_extract(F.get(found, F.lit(0)), "^" + P.BUSINESS, 1), F.lit("不明"))


def parse_toc(toc: Column) -> Column:
    """Majors and their minors of a written table of contents, in the order of the numbers."""
    big_link = rf"^###[{P.SPACE}]+\[([^\n]+?)\]\([^)]+\)[{P.SPACE}]*$"
    big = rf"^###[{P.SPACE}]+([^\n]+)$"
    small = rf"^-[{P.SPACE}]+\[([^\n]+?)\]\([^)]+\)[{P.SPACE}]*$"
    number = rf"^([0-9]+)(?:\.([0-9]+))?[{P.SPACE}]*([^\n]*)$"

    def entry(x: Column) -> Column:
        is_big = x.rlike(big)
        label = strip(F.when(x.rlike(big_link), F.regexp_extract(x, big_link, 1))
                      .when(is_big, F.regexp_extract(x, big, 1))
                      .when(x.rlike(small), F.regexp_extract(x, small, 1)))
        first = F.regexp_extract(label, number, 1).try_cast("bigint")
        second = F.regexp_extract(label, number, 2).try_cast("bigint")
        title = lstrip_marks(strip(F.regexp_extract(label, number, 3)))
        ok = label.isNotNull() & first.isNotNull() & (is_big == second.isNull())
        return F.when(ok, F.struct(
            is_big.alias("is_big"), first.alias("major"), second.alias("minor"), title.alias("title")))

    def rows(entries: Column) -> Column:
        majors = positions(entries, lambda e: e["is_big"])
        return let(majors, lambda m: F.flatten(F.transform(m, lambda p, g: F.transform(
            F.slice(entries, p, F.coalesce(F.get(m, g + 1), F.size(entries) + 1) - p),
            lambda e, j: F.struct(
                F.get(entries, p - 1)["major"].alias("group_major"), g.alias("group_no"),
                (j > 0).alias("is_minor"), e["major"].alias("major"), e["minor"].alias("minor"),
                j.alias("seq"), e["title"].alias("title"))))))

    found = F.filter(F.transform(lines(toc), lambda x: entry(strip(x))), lambda e: e.isNotNull())
    return F.array_sort(let(found, rows))


def decode_deep_link(link: Column) -> Column:
    """Section and page named in the ``wd=`` parameter of a deep link."""
    pattern = r"^target\((.+?)\.one\|([^/]+)/(.+?)\|([^/]+)/\)"
    raw = F.regexp_extract(link, "[?&]wd=([^&]+)", 1)
    decoded = F.try_url_decode(F.regexp_replace(raw, r"\+", "%2B"))
    return let(decoded, lambda wd: F.when(F.coalesce(raw, F.lit("")) != "", F.struct(
        *[
            F.nullif(F.regexp_extract(wd, pattern, g), F.lit("")).alias(n)
            for g, n in enumerate(("section_name", "section_guid", "page_title", "page_guid"), 1)
        ],
        F.when(~wd.rlike(pattern), wd).alias("raw"),
    )))


def strip_page_furniture(text: Column, furniture=P.FURNITURE) -> Column:
    """Body lines of a page joined by spaces, without numbers, dates and template lines."""
    pattern = "(?i)" + "|".join(f"(?:{p})" for p in furniture)
    return F.array_join(F.filter(
        F.transform(lines(text), strip), lambda x: (x != "") & ~x.rlike(pattern)), " ")
