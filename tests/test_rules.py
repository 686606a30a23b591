"""Operators against plain readings of their rules on small inputs."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marginalia.functions.similarity import content_similarity
from marginalia.operators import assemble as A, chunking as C, links as L, manifest as N, matching as M, numbering as B
from marginalia.plans import updates as U

WORDS = "alpha beta gamma delta md report plan tokyo data line".split()


def test_running_number_with_a_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 7}", rng.random(), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, x double, i int")
    got = {r["i"]: r["number"] for r in B.running_number(df, ["x", "i"], ["g"]).collect()}
    want = {}
    for _, group in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        want.update({r[2]: k for k, r in enumerate(group, 1)})
    assert got == want


def _first_free(names, existing):
    used, out = set(existing), []
    for raw in names:
        base = raw.strip() or "document"
        name, k = base, 2
        while name in used:
            name, k = f"{base}_{k}", k + 1
        used.add(name)
        out.append(name)
    return out


@pytest.mark.parametrize("names, existing", [
    (["a", "a", "a_2", "a", "a_2", " ", "document"], []),
    (["a_2", "a", "a", "a"], ["a_3"]),
    (["a", "a_2", "a", "a_3", "a", "a_2_2", "a_2"], ["a"]),
    (["b_2", "b_3", "b", "b", "b", "b_2"], ["x"]),
])
def test_unique_names(spark, names, existing):
    rows = spark.createDataFrame(list(enumerate(names)), "i int, name string")
    taken = spark.createDataFrame([(e,) for e in existing], "name string")
    got = [r["unique_name"] for r in B.unique_names(rows, taken, ["i"]).orderBy("i").collect()]
    assert got == _first_free(names, existing)


@pytest.mark.parametrize("seed", range(3))
def test_unique_names_in_chains(spark, seed):
    """Names that other names may be numbered to, in chains, in any order, with existing ones between."""
    rng = random.Random(seed)

    def name():
        out = rng.choice(["a", "a", "a", "b", "c_0", "c_02", " ", "document"])
        while rng.random() < 0.45:
            out += f"_{rng.choice([2, 2, 3, 4, 7])}"
        return out

    names = [name() for _ in range(150)]
    existing = [name().strip() for _ in range(12)]
    rows = spark.createDataFrame(list(enumerate(names)), "i int, name string").repartition(5)
    taken = spark.createDataFrame([(e,) for e in existing if e], "name string")
    got = [r["unique_name"] for r in B.unique_names(rows, taken, ["i"]).orderBy("i").collect()]
    assert got == _first_free(names, [e for e in existing if e])


def _greedy(sizes, limit):
    chunks, size = [], 0
    for s in sizes:
        if chunks and size + s <= limit:
            chunks[-1].append(s)
            size += s
        else:
            chunks.append([s])
            size = s
    return chunks


def test_pack_lines(one):
    rng = random.Random(2)
    text = "\n".join("x" * rng.randrange(0, 40) for _ in range(200)) + "\n" + "y" * 150
    got = one(lambda c: C.pack_lines(c, 100), text)
    assert "\n".join(got) == text
    assert [len(g.split("\n")) for g in got] == [len(c) for c in _greedy([len(x) + 1 for x in text.split("\n")], 100)]


def test_pack_chunks_by_section(one):
    text = "lead\n" + "\n".join(f"## {i}\n" + "z" * (10 * i) for i in range(1, 12))
    got = one(lambda c: C.pack_chunks(c, 200), text)
    assert "\n\n".join(got).replace("\n\n", "\n") == text and len(got) > 2


def _category_split(sheet, limit):
    """Cut at category rows once the size since the last cut reaches the limit."""
    lines = sheet.split("\n")
    pipes = [i for i, x in enumerate(lines) if x.strip().startswith("|")]
    head = lines[:pipes[0]] + [lines[i] for i in pipes[:2]]
    data = [x for i, x in enumerate(lines) if i > pipes[0] and i not in pipes[:2]]
    size = len("\n".join(head))
    breaks = []
    for i, x in enumerate(data):
        cells = [c.strip() for c in x.split("|")]
        if x.strip().startswith("|") and len(cells) >= 4 and (cells[2] not in ("", "-") or cells[3] not in ("", "-")):
            breaks.append(i)
    out, start = [], 0
    for b in breaks:
        if size + sum(len(x) + 1 for x in data[start:b]) >= limit and start < b:
            out.append(data[start:b])
            start = b
    out.append(data[start:])
    return ["\n".join(head + d) for d in out] if len(out) > 1 else [sheet]


def test_split_by_category(one):
    rng = random.Random(3)
    rows = [f"| {i} | {rng.choice(['cat', '', '-'])} | {rng.choice(['', 'task'])} | {'v' * rng.randrange(30)} |" for i in range(60)]
    rows.insert(20, "note")
    sheet = "\n".join(["## シート: s", "", "| a | b | c | d |", "| --- | --- | --- | --- |"] + rows)
    got = one(lambda c: C.split_by_category(c, 400), sheet)
    assert got == _category_split(sheet, 400) and len(got) > 3
    by_size = one(lambda c: C.split_sheet_by_size(c, 400), sheet)
    assert all(len(x) <= 400 for x in by_size) and len(by_size) > 3


def test_split_by_headings_lossless(one):
    text = "lead\n" + "\n".join(f"## {i}\nt" for i in range(7))
    kept = one(lambda c: C.split_by_headings(c, F.lit(3)), text)
    assert "\n".join(kept) == text
    lost = one(lambda c: C.split_by_headings(c, F.lit(3), lossless=False), text)
    assert "lead" not in "\n".join(lost)


def test_large_update_parts(one):
    text = "pre\n" + "\n".join(f"# h{i}\n" + "t" * 40 for i in range(8))
    parts = one(lambda c: C.split_large_update(c, 120), text)
    assert parts[0].startswith("pre\n\n## h0\n\n") and len(parts) > 2
    assert one(lambda c: C.split_large_update(c, 10000), text) is None


def _doc(rng, heads):
    summary = " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 12)))
    body = "\n".join(f"## {h}\nline" for h in heads)
    return f"# t\n## サマリー\n{summary}\n---\n{body}" + "\nx" * rng.randrange(0, 9)


def _brute(new, base):
    from marginalia.operators.structure import heading_titles, summary  # noqa: F401
    import re

    def feats(name, text):
        m = re.search(r"## サマリー\n(.*?)(?:\n## |\Z)", text, re.S)
        words = set(re.findall(r"\w+", m.group(1).lower()))
        heads = {re.sub(r"^#+\s+", "", x).strip().lower() for x in text.split("\n") if re.match(r"^#{1,4}\s+.", x)}
        return set(re.findall(r"\w+", name.lower())), words, heads, len(text)

    def j(a, b):
        return len(a & b) / len(a | b) if a and b else 0.0

    out = {}
    for key, name, text in new:
        a = feats(name, text)
        best = None
        for path, fname, btext in sorted(base):
            b = feats(fname, btext)
            s = j(a[0], b[0]) * 0.20 + j(a[1], b[1]) * 0.40 + j(a[2], b[2]) * 0.30 + (1.0 - abs(a[3] - b[3]) / max(a[3], b[3])) * 0.10
            if best is None or s > best[1]:
                best = (path, s)
        if best and best[1] > 0.1:
            out[key] = best
    return out


def test_best_match_equals_all_pairs(spark):
    rng = random.Random(4)
    pool = [[f"h{rng.randrange(6)}" for _ in range(rng.randrange(1, 5))] for _ in range(12)]
    copies = [_doc(rng, h) for h in pool]
    base = [(f"c/{i:03d}.md", f"{rng.choice(WORDS)} {i % 9} md", rng.choice(copies) if i % 3 else copies[0]) for i in range(200)]
    new = [(i, f"{rng.choice(WORDS)} {i % 9} md", copies[0] if i % 3 == 0 else (rng.choice(copies) if i % 3 == 1 else _doc(rng, rng.choice(pool)))) for i in range(90)]
    f_new = M.features(spark.createDataFrame(new, "key bigint, name string, text string"), "key", "name")
    f_base = M.features(spark.createDataFrame(base, "path string, name string, text string"), "path", "name")
    want = _brute(new, base)
    got = {r["key"]: (r["target"], r["similarity"]) for r in M.best_match(f_new, f_base).collect()}
    assert got == want
    few = {r["key"]: (r["target"], r["similarity"]) for r in M.update_matches(f_new, f_base, many=3).collect()}
    assert few == {k: v for k, v in want.items() if v[1] >= 0.8} and len(few) > 20
    small = {r["key"]: (r["target"], r["similarity"]) for r in M.nearest_below(f_new, f_base, 37, 11).collect()}
    assert small == want


def test_match_candidates_do_not_grow_with_the_square(spark):
    rng = random.Random(8)

    def rows(n, first):
        tokens = [(first + i, [first + i], sorted(rng.sample(range(300), 30)), sorted(rng.sample(range(900), 6)), 100 + i) for i in range(n)]
        return spark.createDataFrame(tokens, "key bigint, n array<bigint>, s array<bigint>, h array<bigint>, size bigint").withColumn(
            "profile", F.col("key").cast("string"))

    new, base = rows(1500, 0), rows(1500, 10_000)
    copy = new.filter("key = 7").withColumn("key", F.lit(20_000)).withColumn("profile", F.lit("copy"))
    assert M.name_bound(new, base) == 0.0 and M.name_bound(new, new) == 1.0
    keys = M._keys(new.unionByName(base).select("profile", "s", "h"), 0.875, 0.83)
    met = keys.groupBy("k").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * F.col("n"))).first()[0]
    assert met < 10 * keys.count()
    pairs = M.profile_pairs(new, base.unionByName(copy.withColumn("n", F.array(F.lit(-1).cast("bigint")))))
    # Names that agree on nothing leave 0.80 to equal summaries, headings and lengths alone.
    assert [(r["new_profile"], r["base_profile"]) for r in pairs.collect()] == [("7", "copy")]


def test_names_that_few_share_need_no_search_of_texts(spark, monkeypatch):
    """Where names agree in rare tokens alone, the pairs of those are all that can reach the limit, however many texts are alike."""
    def rows(n, side):
        return spark.createDataFrame([(i, f"{side} {i} md{side}", f"# a\n\n## サマリー\n- w x y\n{'z' * (i % 5)}\n") for i in range(n)], "key bigint, name string, text string")

    new, base = M.features(rows(200, "p"), "key", "name"), M.features(rows(120, "q"), "key", "name").withColumn("key", F.format_string("b/%03d", "key"))
    monkeypatch.setattr(M, "profile_pairs", None)
    found = {r["key"]: (r["target"], round(r["similarity"], 9)) for r in M.update_matches(new, base, many=3).collect()}
    assert found == {i: (f"b/{i:03d}", 0.84) for i in range(120)}
    assert M.name_bound(new, base) == 0.2 and M.name_bound(new, base, 3) == 0.0


def test_sheet_lines_are_trimmed_without_patterns(spark):
    """Trimming by a list of characters is the same as by their class, for every code point; no line of a sheet meets a pattern."""
    from marginalia.functions import patterns as P
    from marginalia.functions.text import strip

    points = [(chr(i),) for i in range(1, 0x3100) if not 0xD800 <= i < 0xE000] + [(chr(i),) for i in (0xFEFF, 0x10000, 0x1F600, 0xE0020)]
    c = spark.createDataFrame(points, "c string")
    assert c.filter((strip(F.col("c")) == "") != F.col("c").rlike(f"^[{P.SPACE}]")).count() == 0
    assert c.agg(F.count_if(strip(F.concat("c", F.lit("x y"), "c")) == "x y")).first()[0] == len(P.SPACES)
    cut = c.select(C.split_sheet_by_size(F.col("c"), 100))
    assert "regexp" not in cut._jdf.queryExecution().analyzed().toString()


def test_similarity_makes_no_array_of_characters(spark):
    def grams(t):
        t = " ".join(t.split()).lower()
        return {t[i:i + 3] for i in range(len(t) - 2)}

    rows = [("a  b c\u3000d", "A b c e"), ("\U0001f600x\U0001f601 yz", "x\U0001f601 y"), ("ab", "ab cd"), (None, "x"), ("", "x"), (" ", "x"), ("q", "Q")]
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", content_similarity(F.col("a"), F.col("b")).alias("s"))
    for r in df.collect():
        if not r["a"] or not r["a"].strip():
            assert r["s"] == (None if r["a"] is None else 0.0)
            continue
        x, y = grams(r["a"]), grams(r["b"])
        v, w = (set(t.lower().split()) for t in (r["a"], r["b"]))
        words = len(v & w) / len(v | w)
        assert abs(r["s"] - (words * 0.4 + len(x & y) / len(x | y) * 0.6 if x and y else words)) < 1e-12
    assert ", , -1)" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_change_rows_read_the_sections_once(spark, tmp_path):
    rows = [(p, "added", f"{i}. a", i, i) for p in (1, 2) for i in range(5 * p)] + [(1, "changed", f"c{i}", 1, 2) for i in range(2)] + [
        (2, "kept", f"k{i}", 1, 2) for i in range(4)] + [(2, "unchanged", "u", 1, 2)]
    spark.createDataFrame(rows, "pair int, kind string, heading string, line_start int, line_end int").write.parquet(f"{tmp_path}/d")
    found = M.change_rows(spark.read.parquet(f"{tmp_path}/d"), "pair", 7, 2)
    got = sorted((r["pair"], r["kind"], r["place"], r["heading"], r["line_start"], r["n"], r["is_primary"]) for r in found.collect())
    assert got == [(1, "added", i + 1, f"{i}. a", i, 1, True) for i in range(5)] + [(1, "changed", i + 1, f"c{i}", 1, 1, True) for i in range(2)] + [
        (2, "added", i + 1, f"{i}. a", i, 1, True) for i in range(7)] + [(2, "added", 8, None, None, 3, True), (2, "kept", 1, None, None, 4, False)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_nearest_below_repeats_neither_side(spark):
    docs = [(i, f"d {i} md", f"# a {i}\n\n## サマリー\n- w{i % 7} x y\n") for i in range(120)]
    f = M.features(spark.createDataFrame(docs, "key bigint, name string, text string"), "key", "name")
    base = f.withColumn("key", F.concat(F.lit("b/"), F.format_string("%03d", "key")))
    found = M.nearest_below(f, base, 16, 9)
    assert {r["key"]: (r["target"], round(r["similarity"], 9)) for r in found.collect()} == {i: (f"b/{i:03d}", 1.0) for i in range(120)}
    assert "CoGroup" not in found._jdf.queryExecution().toString()


def test_block_holds_frequent_tokens_as_vectors(monkeypatch):
    """Rows that share a token with all others are found without a list of them, with the same scores."""
    rng = np.random.default_rng(5)
    n = 400
    sets = {c: [np.unique(np.r_[1, 2, rng.integers(3, 40, 6)]) if i % 9 else np.array([], np.int64) for i in range(n)] for c, _ in M.WEIGHTS}
    size = rng.integers(0, 500, n).astype(np.float64)
    targets = np.array([f"{i:03d}" for i in range(n)], object)
    packed = {c: (np.array([len(x) for x in v]), np.concatenate(v)) for c, v in sets.items()}
    block = M._Block(targets, size, packed)
    assert all({1, 2} <= often.keys() and len(often) * n <= M.DENSE * len(tokens) for _, _, _, tokens, _, often in block.parts)
    monkeypatch.setattr(M, "DENSE", 0)
    plain = M._Block(targets, size, packed)
    assert not any(often for *_, often in plain.parts)
    rows = [{"size": int(size[i]) + 3, **{c: sets[c][i] if i % 4 else np.array([90 + i]) for c, _ in M.WEIGHTS}} for i in range(60)]
    for row in rows:
        assert block.best(row, 0.1) == plain.best(row, 0.1)


def _search_sets(rng, n, name):
    """Token sets of rows: an own name token next to a frequent one, summaries and headings of frequent and of rare tokens."""
    return {"n": [np.unique(np.r_[1, name + i]) for i in range(n)],
            "s": [np.unique(np.r_[rng.integers(0, 6, 3), rng.integers(10, 400, rng.integers(0, 9))]) for _ in range(n)],
            "h": [np.unique(np.r_[1, 2, rng.integers(3, 300, rng.integers(0, 4))]) for _ in range(n)]}


def test_rows_whose_name_gives_a_high_score_are_not_compared_with_all(monkeypatch):
    """Scores and targets are those of all pairs, also in small parts; only rows without a high score see all rows of a block."""
    rng = np.random.default_rng(8)
    n, size = 1500, rng.integers(50, 900, 1500).astype(np.float64)
    base = _search_sets(rng, n, 1000)
    targets = np.array([f"{i:04d}" for i in range(n)], object)
    rows = pd.DataFrame({"key": range(90), "size": size[:90] + 7, **{c: v[:90] for c, v in base.items()}})
    other = _search_sets(rng, 90, 9000)
    for c in base:  # the last thirty share neither name nor text with a row
        rows[c] = [v if i < 60 else other[c][i] for i, v in enumerate(rows[c])]
    share = lambda a, b: len(set(a) & set(b)) / max(len(set(a) | set(b)), 1)
    want = []
    for row in rows.itertuples():
        scores = [share(row.n, base["n"][i]) * 0.20 + share(row.s, base["s"][i]) * 0.40 + share(row.h, base["h"][i]) * 0.30
                  + (1 - abs(row.size - size[i]) / max(row.size, size[i])) * 0.10 for i in range(n)]
        want.append((max(scores), targets[int(np.argmax(scores))]))
    looked = []
    scan = M._Block._scan
    monkeypatch.setattr(M._Block, "_scan", lambda self, asked, i, *a: (looked.append(i), scan(self, asked, i, *a)))
    for met in (M.MET, 200):
        monkeypatch.setattr(M, "MET", met)
        asked, looked[:] = M._Asked(rows), []
        blocks = [M._Block(targets[at], size[at], {c: (np.array([len(v[i]) for i in at]), np.concatenate([v[i] for i in at])) for c, v in base.items()})
                  for at in (np.arange(0, n, 2), np.arange(1, n, 2))]
        for block in blocks:
            block.meet_by_name(asked)
        for block in blocks:
            block.search(asked)
        assert [(round(s, 9), t) for s, t in zip(asked.score, asked.target)] == [(round(s, 9), t) for s, t in want]
        assert set(looked) <= set(range(60, 90))


def test_sections_are_placed_a_few_pairs_at_a_time():
    import pyarrow as pa

    section = lambda h, c: {"heading": h, "content": c, "line_start": 1, "line_end": 2}
    pairs = [{"pair": i, "new_sections": [section("a", "x"), section("b", "one two three")], "old_sections": [section("a", "x"), section("c", "one two three")][:i % 3]}
             for i in range(300)]
    got = list(M._place(iter([pa.RecordBatch.from_pylist(pairs)])))
    assert [len(set(b.column("pair").to_pylist())) for b in got] == [64, 64, 64, 64, 44]
    rows = [(r["pair"], r["kind"], r["line_start"], r["similarity"]) for b in got for r in b.to_pylist()]
    assert rows == [r for i in range(300) for r in (
        (i, "unchanged", 1, None) if i % 3 else (i, "new", None, None), (i, "matched", 1, 1.0) if i % 3 == 2 else (i, "new", None, None))]


def test_embedding_topk_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "LIST_ROWS", 3)
    monkeypatch.setattr(M, "ASKED_ROWS", 2)
    rng = random.Random(5)
    base = [(i, i, None if i % 11 == 0 else [float(rng.randrange(3)) for _ in range(4)]) for i in range(60)]
    queries = [(i, None if i == 5 else [float(rng.randrange(3)) for _ in range(4)]) for i in range(20)]
    b = spark.createDataFrame(base, "target bigint, place bigint, vector array<float>")
    q = spark.createDataFrame(queries, "key bigint, vector array<float>")

    def cos(x, y):
        if y is None or not any(x) or not any(y):
            return 0.0
        return sum(p * r for p, r in zip(x, y)) / (sum(p * p for p in x) ** 0.5 * sum(r * r for r in y) ** 0.5)

    want = {}
    for key, v in queries:
        order = sorted(base, key=lambda t: (-round(cos(v, t[2]), 12), t[1])) if v is not None else base
        want[key] = [t[0] for t in order[:10]]
    rows = M.embedding_topk(q, b, 4, 10).collect()
    got = {k: [r["target"] for r in sorted((r for r in rows if r["key"] == k), key=lambda r: r["rank"])] for k, _ in queries}
    assert got == want


def _place(new, old, score):
    used, out = set(), []
    for heading, text in new.items():
        if heading in old:
            used.add(heading)
            out.append((heading, "unchanged" if " ".join(text.split()) == " ".join(old[heading].split()) else "updated", heading))
            continue
        best, hit = 0.0, None
        for h, t in old.items():
            s = 0.0 if h in used else score(text, t)
            if s > best:
                best, hit = s, h
        if hit is not None and best >= 0.5:
            used.add(hit)
            out.append((heading, "matched", hit))
        else:
            out.append((heading, "new", None))
    return out


def test_match_sections(spark):
    rng = random.Random(6)

    def text():
        return " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 7)))

    def score(a, b):
        a, b = " ".join(a.split()), " ".join(b.split())
        if not a or not b:
            return 0.0
        if a == b:
            return 1.0
        w1, w2 = set(a.split()), set(b.split())
        g1, g2 = {a[i:i + 3] for i in range(len(a) - 2)}, {b[i:i + 3] for i in range(len(b) - 2)}
        j = len(w1 & w2) / len(w1 | w2)
        return 0.4 * j + 0.6 * len(g1 & g2) / len(g1 | g2) if g1 and g2 else j

    pairs, want = [], {}
    for pair in range(25):
        a = {f"n{i}" if i % 3 else f"s{i}": text() for i in range(8)}
        b = {f"o{i}" if i % 3 else f"s{i}": text() for i in range(9)}
        want[pair] = _place(a, b, score)
        pairs.append((pair, *["\n".join(f"# {h}\n{t}" for h, t in side.items()) for side in (a, b)]))
    rows = M.match_sections(spark.createDataFrame(pairs, "pair bigint, new_text string, old_text string")).collect()
    got = {p: [(r["heading"], r["kind"], r["old_heading"]) for r in sorted((r for r in rows if r["pair"] == p), key=lambda r: r["sec_pos"])] for p in want}
    assert got == want


def test_content_similarity_bounds(spark):
    pairs = [("a b c", "a b d"), ("", "x"), ("ab", "ab c"), ("  x  y ", "x y"), ("日本語テキスト", "日本語テスト")]
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        content_similarity(F.col("a"), F.col("b")).alias("x"), content_similarity(F.col("b"), F.col("a")).alias("y")).collect()
    assert all(r["x"] == r["y"] and 0.0 <= r["x"] <= 1.0 for r in rows)
    assert rows[3]["x"] == 1.0 and rows[1]["x"] == 0.0


def test_link_options(spark):
    text = '# Top\n<a id="sec-1"></a>\n[a](#sec-1) [b](#top) ![i](no.png) [c](other.md#x#y)'
    docs = spark.createDataFrame([("d/a.md", text), ("d/other.md", "# X#Y")], "path string, text string")
    none = spark.createDataFrame([], "path string")
    kinds = sorted((r["link_type"], r["target"]) for r in L.validate_links(docs, none).collect())
    assert kinds == [("anchor", "#sec-1"), ("anchor", "other.md#x#y"), ("image", "no.png"), ("md", "no.png")]
    fewer = sorted((r["link_type"], r["target"]) for r in L.validate_links(docs, none, explicit_ids=True, images_once=True).collect())
    assert fewer == [("anchor", "other.md#x#y"), ("image", "no.png")]


def test_resolve_file_name_cascade(spark):
    files = spark.createDataFrame([("【25年度版】業務設計資料",), ("250708_報告書",), ("ab",), ("abc",)], "file string")
    wanted = spark.createDataFrame([
        (1, "ab"), (2, "【25年度版】業務設計資料（43章）"), (3, "業務設計"), (4, "x abc y"), (5, "★報告書[完]"), (6, "zzz")], "key int, name string")
    got = {r["key"]: (r["file"], r["rule"]) for r in M.resolve_file_names(wanted, files).collect()}
    assert got == {1: ("ab", 1), 2: ("【25年度版】業務設計資料", 2), 3: ("【25年度版】業務設計資料", 3), 4: ("ab", 3),
                   5: ("250708_報告書", 4)}
    old = {r["key"]: (r["file"], r["rule"]) for r in M.resolve_prefixed_names(
        spark.createDataFrame([(1, "【ファイル】abc"), (2, "250708_報告の別"), (3, "qq")], "key int, name string"), files).collect()}
    assert old[1] == ("abc", 2) and old[3] == ("qq", 5)


def test_merged_cells_last_range_wins(spark):
    cells = spark.createDataFrame([("f", "s", r, c, f"{r}{c}") for r in (1, 2, 3) for c in (1, 2)], "file string, sheet string, row int, col int, value string")
    merged = spark.createDataFrame([("f", "s", 1, 1, 2, 1, 2), ("f", "s", 2, 2, 9, 2, 2)],
                                   "file string, sheet string, seq int, min_row int, max_row int, min_col int, max_col int")
    got = {(r["row"], r["col"]): r["value"] for r in A.fill_merged_cells(cells, merged, 3).collect()}
    assert got == {(1, 1): "11", (1, 2): "11", (2, 1): "11", (2, 2): "22", (3, 1): "31", (3, 2): "22"}


def test_nest_sections_in_chunks(spark):
    pages = spark.createDataFrame([("a", i, f"t{i}") for i in range(25)] + [("b", 0, "x")], "section string, i int, title string")
    rows = N.nest_sections(pages, "i", per_chunk=10).collect()
    assert sorted((r["section"], r["chunk"], len(r["pages"])) for r in rows) == [("a", 0, 10), ("a", 1, 10), ("a", 2, 5), ("b", 0, 1)]
    first = next(r for r in rows if r["section"] == "a" and r["chunk"] == 0)
    assert [p["i"] for p in first["pages"]] == list(range(10))


def test_split_update(spark):
    big = "# h\n" + "\n".join(f"## s{i}\n" + "z" * 3000 for i in range(6))
    outcomes = spark.createDataFrame([("s", "c/t.md", "updated", big, "r"), ("q", "c/u.md", "created", big, "r")],
                                     "source string, target string, result string, text string, reason string")
    parts = U.split_long_updates(outcomes, F.lit("t")).orderBy("target").collect()
    assert [r["target"] for r in parts] == ["c/t.md", "c/t_part2.md", "c/u.md"]
    assert "updated_at" in parts[0]["text"] and "(Part 2)" in parts[1]["text"] and parts[2]["text"] == big


def test_text_stream_skips_what_was_seen(spark, tmp_path):
    from marginalia.streaming.incremental import run_once, text_stream

    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    (source / "a.txt").write_text("one\ntwo")
    run_once(text_stream(spark, str(source)), out, state)
    (source / "b.txt").write_text("three")
    run_once(text_stream(spark, str(source)), out, state)
    assert sorted(r["text"] for r in spark.read.parquet(out).collect()) == ["one\ntwo", "three"]


def test_repeated_names_give_one_row_per_document(spark):
    new = spark.createDataFrame(
        [(1, "n_1", "# A\ntext one"), (2, "n_1", "# B\ntext two"), (3, "n_2", "# C\nother text")], "key long, name string, text string")
    base = spark.createDataFrame([("01_a/01_x.md", "01_a", "# Z\nsomething else")], "path string, category string, text string")
    entries = spark.createDataFrame([("n_1", 1, "01_a/01_x.md"), ("n_1", 2, "later.md")], "source string, pos int, target string")
    rows = {r["key"]: r for r in U.plan_updates(new, base, entries).collect()}
    assert len(rows) == 3 and U.plan_updates(new, base, entries).count() == 3
    assert rows[1]["target"] == rows[2]["target"] == "01_a/01_x.md" and rows[3]["action"] == "create"
    assert "（類似度" in rows[3]["reason"]


def test_last_override_and_empty_base(spark):
    from marginalia.operators import classify as K

    actions = spark.createDataFrame([("s", "create", "t", "r")], "source string, action string, target string, reason string")
    overrides = spark.createDataFrame(
        [("s", 1, "skip", "", None), ("s", 2, "update", "x.md", "by hand")], "source string, pos int, action_type string, target_path string, reason string")
    row = M.apply_overrides(actions, overrides).first()
    assert (row["action"], row["target"], row["reason"]) == ("update", "x.md", "by hand")
    empty = spark.createDataFrame([], "path string")
    assert [r["mode"] for r in K.run_mode(empty, empty).collect()] == ["new"]
    assert [r["mode"] for r in K.run_mode(overrides, empty).collect()] == ["update"]


def test_vectors_of_another_length_are_an_error_row(spark):
    q = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, float("nan")])], "key bigint, vector array<float>")
    b = spark.createDataFrame([(1, 1, [1.0, 2.0, 3.0]), (2, 2, [2.0, 4.0]), (3, 3, None)], "target bigint, place bigint, vector array<float>")
    got = {}
    for r in M.embedding_topk(q, b, 2, 2).collect():
        got.setdefault(r["key"], []).append((r["rank"], r["target"], None if r["sim"] is None else round(r["sim"], 9), r["error"]))
    wrong = [(None, None, None, "not a vector of 2 numbers")]
    assert {k: sorted(v) for k, v in got.items()} == {
        1: wrong, 2: [(1, 2, 1.0, None), (2, 1, 0.0, None)], 3: [(1, 1, None, None), (2, 2, None, None)],
        4: [(1, 1, 0.0, None), (2, 2, 0.0, None)], 5: wrong}
    assert M.embedding_topk(q, b.limit(0), 2).filter("error IS NULL").count() == 0


def test_embedding_topk_reads_few_lists_of_clusters(spark):
    """Vectors around forty centres, a third of all around one: the same as by brute force, from a share of the lists."""
    import numpy as np
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((40, 12))
    at = np.where(rng.random(3000) < 0.33, 0, rng.integers(0, 40, 3000))
    x = centres[at] + 0.05 * rng.standard_normal((3000, 12))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    b = spark.createDataFrame([(i, i, v.tolist()) for i, v in enumerate(x)], "target bigint, place bigint, vector array<double>")
    q = spark.createDataFrame([(i, x[i * 30].tolist()) for i in range(100)], "key bigint, vector array<double>")
    stats = {}
    got = {}
    for r in M.embedding_topk(q, b, 12, 10, stats).collect():
        got.setdefault(r["key"], {})[r["rank"]] = r["target"]
    for i in range(100):
        sims = np.round(unit @ unit[i * 30], 12)
        assert [got[i][r] for r in range(1, 11)] == np.lexsort((np.arange(3000), -sims))[:10].tolist()
    assert stats["lists_read"] < 0.3


def test_embedding_topk_holds_no_pair_of_query_and_list(spark):
    """Unrelated vectors, where the bound leaves out nothing: a batch of queries must not become a row per list."""
    import numpy as np
    x = np.random.default_rng(9).standard_normal((600, 16))
    b = spark.createDataFrame([(i, i, v.tolist()) for i, v in enumerate(x)], "target bigint, place bigint, vector array<double>")
    stats = {}
    found = M.embedding_topk(b.select(F.col("target").alias("key"), "vector"), b, 16, 5, stats)
    plan = found._jdf.queryExecution().toString()
    assert "CoGroup" not in plan and "MapInPandas" not in plan
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, int(t)) for i in range(600) for t in np.argsort(-np.round(unit @ unit[i], 12), kind="stable")[:5]}
    assert {(r["key"], r["target"]) for r in found.collect()} == want
    assert stats["lists_read"] > 0.5
