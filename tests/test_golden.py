"""Literal cases with known answers."""

import pytest
from pyspark.sql import functions as F

from marginalia.functions import text as T
from marginalia.operators import assemble as A, quality as Q, rewrite as R, structure as S
from marginalia.plans import inference as X, updates as U


@pytest.mark.parametrize("name, want", [
    ("250929_最終ミーティング (2)", "最終ミーティング"),
    ("★251112_給湯器横展開用", "給湯器横展開用"),
    ("【25年度版】業務設計資料", "業務設計資料"),
    ("【x】", "【x】"),
])
def test_clean_output_name(one, name, want):
    assert one(T.clean_output_name, name) == want


@pytest.mark.parametrize("title, want", [
    ("1.1 資料タイトルと位置づけ", "11-資料タイトルと位置づけ"),
    ("Ünï  code -- x!", "ünï-code-x"),
    (" - a - ", "a"),
])
def test_anchor(one, title, want):
    assert one(T.anchor, title) == want


@pytest.mark.parametrize("folder, target, want", [
    ("a/b", "../c.md", "a/c.md"), ("a", "./x/./y.md", "a/x/y.md"), ("a", "/z.md", "z.md"),
    ("a", "../../z.md", "../z.md"), ("", "x//y.md", "x/y.md"), ("a", "../../../z/../q.md", "../../q.md"),
])
def test_resolve_path(one, folder, target, want):
    assert one(T.resolve_path, folder, target) == want


@pytest.mark.parametrize("text, want", [
    ("```markdown\n a \n```", "a"), ("```\nb```", "b"), ("c", "c"), (" d ", " d "), ("```markdown\n```\nx\n```\n```", "x\n```"),
])
def test_strip_code_fence(one, text, want):
    assert one(T.strip_code_fence, text) == want


@pytest.mark.parametrize("text, want", [
    ("001-015", (0, 14)), ("40-60", (39, 42)), ("7", (6, 6)), ("0", (0, -1)), ("x-3", (0, 42)), ("", (0, 42)),
])
def test_chapter_range(one, text, want):
    got = one(lambda c: T.parse_chapter_range(c, F.lit(43)), text)
    assert (got["first"], got["last"]) == want


def test_split_lines(one):
    assert one(T.split_lines, "a\r\nb\rc d\n") == ["a", "b", "c", "d"]
    assert one(T.split_lines, "") == []
    assert one(T.split_lines, "a\n\n") == ["a", ""]


def test_sections_keep_last_duplicate(spark):
    df = spark.createDataFrame([(1, "pre\n# A\nx\n## B\n# A\ny")], "doc_id int, text string")
    rows = {r["heading"]: r for r in S.sections_with_lines(df, "text", "doc_id").collect()}
    assert rows["（冒頭）"]["content"] == "pre"
    assert (rows["A"]["content"], rows["A"]["sec_pos"], rows["A"]["line_start"], rows["A"]["line_end"]) == ("y", 2, 5, 6)
    assert rows["B"]["content"] == ""


def test_second_toc_never_ends(one):
    text = "## 目次\n### [1. a](#x)\n---\n### 1. One\nt\n## 目次\n---\n### 2. Two"
    assert [c["clean_title"] for c in one(S.chapters, text)] == ["One"]


def test_links_of_images(one):
    text = "![a](b.png) [c](d.md) [e](https://x.y)"
    assert [(r["kind"], r["target"]) for r in one(S.links, text)] == [("link", "b.png"), ("link", "d.md"), ("image", "b.png")]
    once = one(lambda c: S.links(c, images_once=True), text)
    assert [(r["kind"], r["target"]) for r in once] == [("link", "d.md"), ("image", "b.png")]


def test_separator_counts_unless_strict(one):
    text = "| a | b |\n|---|---|\n| 1 | 2 |\n|---|"
    assert len(one(S.table_rows, text)) == 3
    assert len(one(lambda c: S.table_rows(c, strict=True), text)) == 2


def test_summary_toc_body(one):
    text = "# T\nlead\n---\n## サマリー\ns1\n---\nb0\n## 目次\n- x\n### One\nb1\n---\nb2"
    got = one(S.summary_toc_body, text)
    assert (got["summary"], got["toc"]) == ("s1", "- x")
    assert got["body"] == "# T\nlead\n---\nb0\n### One\nb1\n---\nb2"


def test_deep_link(one):
    link = "https://n/v?x=1&wd=target%28Sec.one%7Cg1%2FMy%20page+1%7Cg2%2F%29&e"
    got = one(S.decode_deep_link, link)
    assert (got["section_name"], got["section_guid"], got["page_title"], got["page_guid"]) == ("Sec", "g1", "My page+1", "g2")
    assert one(S.decode_deep_link, "https://n/v?wd=abc")["raw"] == "abc"
    assert one(S.decode_deep_link, "https://n/v") is None


def test_renumber(one):
    body = "lead\n#### 3.4 m0\nx\n## サマリー\nkept\n### [2. Big](#b)\n#### sub\n- [1.2 link](#z)\n## two\n## 関連資料\ngone\n### 2024年\n<a id=\"sec-9\"></a>\n# T\nend"
    want = (
        'lead\n<a id="sec-1"></a>\n### 1. 概要\n\n<a id="sec-1-1"></a>\n#### 1.1 m0\nx\nkept\n'
        '<a id="sec-2"></a>\n### 2. Big\n\n<a id="sec-2-1"></a>\n#### 2.1 sub\n<a id="sec-2-2"></a>\n#### 2.2 link\n'
        '<a id="sec-2-3"></a>\n#### 2.3 two\n<a id="sec-3"></a>\n### 3. 年\n\nend')
    assert one(R.renumber_headings, body) == want


def test_level_two_becomes_first_major(one):
    assert one(R.renumber_headings, "## A\nx\n## B").split("\n") == [
        '<a id="sec-1"></a>', "### 1. A", "", "x", '<a id="sec-1-1"></a>', "#### 1.1 B"]


def test_finalize_without_structure(one):
    got = one(R.finalize_document, "text\n### One\nx", "name")
    assert got.startswith("# name\n\n## サマリー\n\n---\n\n## 目次\n\n### [1. One](#sec-1)\n\n---\n\ntext\n")


def test_finalize_is_stable(one):
    text = "# T\n\n## サマリー\n- s\n\n---\n\n## 目次\n\n---\n\n### One\nx\n#### sub\ny"
    run = lambda c, n: R.finalize_document(c, n, stable=True)
    first = one(run, text, "n")
    assert one(run, first, "n") == first


def test_table_headers_once_per_block(one):
    text = "| a | b |\n| c | d |\nx\n| e |\n| --- |"
    assert one(R.add_table_headers, text) == "| a | b |\n| --- | --- |\n| c | d |\nx\n| e |\n| --- |"
    mirrored = one(lambda c: R.add_table_headers(c, mirror=True), text)
    assert mirrored == "| a | b |\n| --- | --- |\n| c | d |\n| --- | --- |\nx\n| e |\n| --- |"


def test_normalize_body_with_toc(one):
    body = "# t\n## up\n### 1.1 a\nx\n## 関連資料\ngone\n#### 1.2 b\n### 2.1 c"
    toc = "### 1. One\n### 2. Two\n### 3. Three"
    assert one(R.normalize_body_with_toc, body, toc).split("\n") == [
        "#### up", '<a id="sec-1"></a>', "### 1. One", "", '<a id="sec-1-1"></a>', "#### 1.1 a", "x",
        '<a id="sec-1-2"></a>', "#### 1.2 b", '<a id="sec-2"></a>', "### 2. Two", "", '<a id="sec-2-1"></a>', "#### 2.1 c",
        '<a id="sec-3"></a>', "### 3. Three"]


@pytest.mark.parametrize("before, after, ratio, severity, passed", [
    ("x" * 12340, "x" * 11106, 0.90, "info", True),
    ("\n".join(["> " + "q" * 98] * 30 + ["y" * 12000]), "y" * 11700, None, "info", True),
    ("x" * 20000, "x" * 11000, 0.55, "error", False),
    ("x" * 1000, "x" * 700, 0.70, "warning", True),
    ("", "x", None, "info", True),
])
def test_char_count(one, before, after, ratio, severity, passed):
    got = one(Q.char_count_check, before, after)
    assert (got["severity"], got["passed"]) == (severity, passed)
    if ratio is not None:
        assert got["ratio"] == pytest.approx(ratio)


def test_reductions(one):
    before = "LOGO cover line\nother\n作成日: 2024\n図の説明: a\n" + "z" * 20
    assert one(Q.reduction_decorative, before, "other") == pytest.approx(30 / len(before))
    assert one(Q.reduction_doc_info, before, "other") == pytest.approx(9 / len(before))
    assert one(Q.reduction_label, before, "other") == pytest.approx(10 / len(before))
    section = "## 改訂履歴\nv1\nv2\n"
    assert one(Q.reduction_doc_info, section + "## x\ny", "## x\ny") == pytest.approx((4 + len(section)) / len(section + "## x\ny"))


def test_front_matter_keeps_rules_in_values(one):
    text = "---\nsource: a --- b\n---\n\nbody\n---\nmore"
    assert one(U.strip_front_matter, text) == "body\n---\nmore"
    assert one(U.strip_front_matter, "no\n---\n") == "no\n---\n"


def test_integrate_uses_last_duplicate(one):
    old, new = "# A\n1\n## B\n2", "lost\n# a\n3\n## C\n4\n# A\n5"
    assert one(U.integrate_sections, old, new) == "# A\n5\n\n## B\n2\n\n## C\n4\n"


def test_image_paths_are_met_once(one):
    def build(c):
        images = F.array(*[F.struct(F.lit("src01").alias("prefix"), F.lit(n).alias("name")) for n in ("a.png", "src01_a.png")])
        return A.rewrite_image_paths(c, images)

    assert one(build, "![x](../04_images/a.png) images/b.png images/a.png") == (
        "![x](./images/src01_a.png) images/b.png ./images/src01_a.png")


def test_responses(one):
    ok = one(X.parse_markdown_response, '```json\n{"formatted_markdown": "```markdown\\n# x\\n```", "terms": []}\n```')
    assert (ok["markdown"], ok["parsed"]) == ("# x", True)
    bad = one(X.parse_markdown_response, "{broken")
    assert (bad["markdown"], bad["parsed"], bad["terms"]) == ("{broken", False, [])
    assert one(X.first_array, 'so ```json\n[{"a": 1}]\n``` end') == '[{"a": 1}]'
    assert one(X.first_array, "nothing") is None
    assert one(X.first_object, 'a {"x": {"y": 1}} b') == '{"x": {"y": 1}}'
    assert one(X.parse_enhancement, '{"summary_short": "s"}') is None


def test_converter_registration():
    c = X.Converters()
    c.register(".PDF", len)
    c.register(".pdf", len)
    with pytest.raises(ValueError):
        c.register(".pdf", str)
    c.register(".pdf", str, override=True)
    assert c.extensions() == [".pdf"] and c.supports(".Pdf")
