"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marginalia.llm import (
    chat, decontamination, hard_negatives, itq_dedup, language_id, mixing, near_dedup, nn_descent, pii, secrets, sharding, spelling, token_blocks)

LONG = " ".join(f"word{i % 997} token: secret{i:012d}zz +49 30 {1000000 + i}" for i in range(3000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (2, None, "en", "a"), (3, "", None, None), (4, " \t\n ", "de", "b"), (5, "1234 !!", "de", "b"),
    (None, "der schnelle braune fuchs springt", "de", None), (None, None, None, None),
    (6, LONG, "en", "b"), (7, "the quick brown fox jumps over the lazy dog", "en", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


def clashing(df):
    """Columns with names that operators use inside."""
    for name in ("size", "kept", "row", "key", "component_id", "rk", "place", "n", "shard", "score", "base", "found", "id", "language", "known",
                 "_lang", "_rk", "_id", "_s", "_row", "_source", "word", "run", "h"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(spark.createDataFrame(ROWS, SCHEMA)).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return clashing(spark.createDataFrame([], SCHEMA))


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_mixing(docs, none):
    rows = mixing.mixture(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    assert abs(sum({(r["source_size"], r["target"]): r["target"] for r in rows}.values()) - total) < 1e-6
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert sorted(mixing.mixture(docs).collect(), key=repr) == sorted(rows, key=repr)
    assert mixing.mixture(none).count() == 0
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    taken = sum(r["taken"] for r in rows)
    assert out.agg(F.sum(mixing.size(F.col("text")))).first()[0] == taken
    assert mixing.mixed(none).count() == 0


def test_mixing_is_nested_and_near(spark):
    df = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 9)).alias("source"))
    half = {r["doc_id"]: r["taken"] for r in mixing.mixture(df, share=0.5).collect()}
    rows = mixing.mixture(df).collect()
    assert all(half[r["doc_id"]] <= r["taken"] for r in rows)
    got: dict = {}
    for r in rows:
        key = (r["source_size"], r["target"])
        got[key] = got.get(key, 0) + r["taken"]
    for (_, target), taken in got.items():
        assert abs(target - taken) <= 7


def test_language(spark, docs, none):
    rows = language_id.identified(docs.select("doc_id", "text"), docs).select("doc_id", "language.*").collect()
    assert len(rows) == len(ROWS)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert got[2] == got[3] == got[4] == got[5] == ("und", 0.0)
    assert got[1][0] == "en" and 0 < got[1][1] <= 1
    assert language_id.identified(none, none).count() == 0
    unlearned = language_id.identified(docs, none, "found").select("found.lang_pred").distinct().collect()
    assert [r[0] for r in unlearned] == ["und"]
    kept = language_id.accepted(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 6, 7, None}


def test_language_of_an_unlearned_script(spark, docs):
    """Every text with a letter gets a learned language; the stage lets go of what it can't tell."""
    greek = "αυτό είναι ένα κείμενο στα ελληνικά"
    added = spark.createDataFrame([
        (30, greek, None, "a"), (31, f"the {greek}", None, "a"), (32, "это русский текст", "en", "a"), (33, "这是中文", None, "a"),
        (34, "the quick fox jumps, είναι", None, "a")], SCHEMA)
    df = docs.select("doc_id", "text", "lang", "source").unionByName(added)
    learned = docs.filter("lang IS NOT NULL")
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["known"]) for r in language_id.identified(
        df.select("doc_id", "text"), learned).select("doc_id", "language.*").collect()}
    assert got[30] == got[32] == got[33] == ("en", 0.5, 0.0) and got[34][0] == "en"
    assert got[31][0] in ("en", "de") and 0 < got[31][2] < 0.5
    assert got[2] == got[3] == got[4] == got[5] == ("und", 0.0, 0.0)
    kept = language_id.accepted(df.filter("doc_id IS NULL OR doc_id <> 32")).collect()
    assert {r["doc_id"] for r in kept} == {1, 6, 7, 34, None}
    tie = spark.createDataFrame([(40, "same words", "en", "a"), (41, "same words", "de", "a")], SCHEMA)
    assert {zlib.crc32(str(i).encode()) % 3 != 1 for i in (40, 41)} == {True}
    assert language_id.accepted(tie).count() == 0


def test_small_languages_keep_their_units(spark):
    """A language with few rows beside one with many, within the bound on units."""
    large = [(i, " ".join(f"groß{chr(97 + (i + k) % 26)}{chr(97 + k)}" for k in range(20)), "large") for i in range(60)]
    small = [(100 + i, "мало слов", "small") for i in range(2)]
    model = language_id.fit(spark.createDataFrame(large + small, "doc_id long, text string, lang string"), most_words=40, most_grams=40)
    assert {"мало", "слов"} <= set(model.rows[0]) and len(model.rows[0]) == 42
    assert sum(len(model.rows[n]) for n in language_id.LENGTHS) > 60
    scorer = language_id.Scorer(model)
    assert scorer.predict("мало")[0] == scorer.predict("словами")[0] == "small" and scorer.predict("großab")[0] == "large"
    few = language_id.fit(spark.createDataFrame(large + small, "doc_id long, text string, lang string"), cells=40)
    assert len(few.rows[0]) == 12 and {"мало", "слов"} <= set(few.rows[0])
    assert language_id.fit(spark.createDataFrame(large + small, "doc_id long, text string, lang string"), most_langs=1).langs == ["large"]


def test_language_against_a_plain_reading(spark):
    """The scoring rule, word by word, without tables."""
    import math
    rng = random.Random(6)
    syllables = {"aa": ["ka", "lo", "mi"], "bb": ["ka", "tu", "re"], "cc": ["zö", "mi", "re"]}
    make = lambda lang: " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(8))
    rows = [(i, make(lang), lang) for i, lang in enumerate(["aa"] * 9 + ["bb"] * 7 + ["cc"] * 5)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    langs = sorted(syllables)
    seen = {k: {lang: {} for lang in langs} for k in (0, 4, 3, 2, 1)}
    for _, text, lang in rows:
        for w in text.split():
            for k in seen:
                edged = f" {w} "
                for unit in [w] if k == 0 else [edged[i:i + k] for i in range(len(edged) - k + 1)]:
                    if unit != " ":
                        seen[k][lang][unit] = seen[k][lang].get(unit, 0) + 1

    def score(k, unit):
        if not any(unit in seen[k][lang] for lang in langs):
            return None
        totals = {lang: sum(seen[k][lang].values()) for lang in langs}
        floor = math.log(0.5 / max(totals.values()))
        return [math.log(seen[k][lang][unit] / totals[lang]) if unit in seen[k][lang] else floor for lang in langs]

    def word(w):
        if (found := score(0, w)) is not None:
            return found
        edged = f" {w} "
        for k in (4, 3, 2, 1):
            each = [s for i in range(len(edged) - k + 1) if edged[i:i + k] != " " and (s := score(k, edged[i:i + k])) is not None]
            if each:
                return [sum(c) / len(each) for c in zip(*each, strict=True)]
        return None

    scorer = language_id.Scorer(model)
    for text in [make(rng.choice(langs)) + rng.choice(["", " kalomirex", " qqq", " zötu zötu"]) for _ in range(60)]:
        each = [s for w in text.split() if (s := word(w)) is not None]
        mean = [sum(c) / len(each) for c in zip(*each, strict=True)]
        best = max(range(3), key=lambda i: mean[i])
        odds = sum(math.exp((m - mean[best]) * min(len(each), language_id.EVIDENCE)) for m in mean)
        lang, confidence, known = scorer.predict(text)
        assert lang == langs[best] and abs(confidence - 1 / odds) < 1e-4 and abs(known - len(each) / len(text.split())) < 1e-9


def test_language_backs_off(spark):
    rows = [("x", 0, "haus", 5), ("x", 1, "a", 5), ("y", 1, "o", 5), ("x", 2, "au", 3), ("y", 2, "ou", 3), ("x", 1, "u", 1), ("y", 1, "u", 1)]
    model = language_id.Model(pa.table(dict(zip(("lang", "kind", "unit", "n"), zip(*rows, strict=True), strict=True))))
    scorer = language_id.Scorer(model)
    assert (scorer.word("haus") == model.scores[0][0]).all()
    assert scorer.word("ou").argmax() == 1 and scorer.word("zau").argmax() == 0
    assert scorer.word("o").argmax() == 1 and scorer.word("§") is None
    assert scorer.predict("ou ou")[0] == "y" and scorer.predict(None) == ("und", 0.0, 0.0)


def test_secrets(spark, docs, none):
    rows = by_id(secrets.scanned(docs))
    empty = hashlib.sha256(b"").hexdigest()
    assert rows[2]["base_sha256"] == rows[3]["base_sha256"] == empty and rows[2]["spans"] == ""
    assert rows[6]["n_assign"] == 3000 and rows[6]["n_live"] == 3000
    assert secrets.scanned(none).count() == 0
    key = "AKIA" + "B" * 16
    df = spark.createDataFrame([
        (1, f"é {key}", "x"), (2, key, "y"), (3, "password='abcdefghijkl' token: short Secret=ABCDEFGHIJKLmnop", "x"),
        (4, "deadbeef" * 2 + "g" + "a" * 15, "x"), (5, "token: secret:abcdefghijklmnop", "x")], "doc_id int, text string, source string")
    rows = by_id(secrets.scanned(df))
    assert rows[1]["spans"] == "access:2:22,live:2:22" and rows[1]["n_live"] == 1
    assert (rows[1]["most_repos"], rows[1]["most_owners"]) == (2, 2)
    assert rows[3]["spans"] == "assign:0:22,live:10:22,assign:37:60,live:44:60"
    assert rows[4]["n_hex"] == 1 and rows[4]["spans"] == "hex:0:16,live:0:16"
    assert rows[5]["n_assign"] == 0


def test_secrets_by_repositories_and_owners(spark):
    """An example that one owner spreads, one that three owners hold, a secret that was copied once, and one of its own."""
    key = lambda c: "AKIA" + c * 16
    rows = [(i, key("A"), "x") for i in range(500)] + [(600 + i, key("B"), s) for i, s in enumerate("xyz")]
    rows += [(700, key("C"), "x"), (701, key("C"), "y"), (800, key("D"), None), (900, key("E"), "x")] + [(901 + i, key("F"), "x") for i in range(9)]
    found = by_id(secrets.scanned(clashing(spark.createDataFrame(rows, "doc_id int, text string, source string"))))
    assert all(found[i]["n_example"] == 1 and "live" not in found[i]["spans"] for i in (0, 499, 600, 602))
    assert all(found[i]["n_live"] == 1 and found[i]["spans"] == "access:0:20,live:0:20" for i in (700, 701, 800, 900, 901, 909))
    assert (found[3]["most_repos"], found[3]["most_owners"], found[600]["most_owners"]) == (500, 1, 3)


def test_near_dedup(docs, none):
    rows = near_dedup.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert got[7]["component_id"] == 1 and not got[7]["kept"] and got[1]["kept"]
    assert got[2]["n_shingles"] == got[3]["n_shingles"] == got[4]["n_shingles"] == 0 and got[4]["kept"]
    assert got[5]["n_shingles"] == 1
    assert near_dedup.near_duplicates(none).count() == 0
    left = near_dedup.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(["1", "2", "3", "4", "5", "6", "None", "None"])


def test_near_dedup_against_brute_force(spark):
    """Families of edited copies around the limit, so that centres, blocks and large components all decide."""
    rng = random.Random(5)
    texts = []
    for family in range(4):
        base = [f"w{rng.randrange(4000)}" for _ in range(150)]
        for _ in range(160 if family == 0 else 30):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    texts += [" ".join(f"w{rng.randrange(4000)}" for _ in range(rng.randrange(1, 60))) for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # Tuples of words, apart from the operator's own hashes.
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if (w := t.split()) else set() for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            c = len(a & sets[j])
            if c and 100 * c >= 85 * (len(a) + len(sets[j]) - c):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    rows = near_dedup.near_duplicates(df).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: find(i) for i in range(len(texts))}
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(s) for i, s in enumerate(sets)}


def test_odd_sketch_estimates():
    rng = random.Random(1)
    shared = [rng.getrandbits(63) for _ in range(900)]
    import numpy as np
    a = np.array(sorted({*shared, *(rng.getrandbits(63) for _ in range(50))}), np.uint64)
    b = np.array(sorted({*shared, *(rng.getrandbits(63) for _ in range(50))}), np.uint64)
    n = near_dedup.BANDS * near_dedup.ROWS
    apart = sum(bin(int(x) & (2**64 - 1)).count("1") for x in near_dedup.odd_sketch(near_dedup.samples(a, n)) ^ near_dedup.odd_sketch(near_dedup.samples(b, n)))
    assert apart <= near_dedup.sketch_limit(0.85, n) < near_dedup.SKETCH_BITS // 4


def test_chat(spark):
    rows = [
        (1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (2, None, None, None), (None, 1, "assistant", ""),
        (3, 1, "assistant", chat.PROBE), (3, 2, "assistant", r"<\|im_end|> <\\| <| \ <"), (3, 3, "us\ner%<|im_start|>", "x\n"),
        (4, 1, "assistant", "long " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("turns", F.lit(1))
    got = by_id(chat.digests(df), "conv_id")
    assert got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 1
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\na\nuser\na\nassistant\nb\n").hexdigest()
    assert got[2]["turns_sha256"] == hashlib.sha256(b"\n\n").hexdigest() and got[None]["n_turns"] == 1
    loss = rows[5][3] + rows[6][3]
    assert got[3]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and got[3]["loss_chars"] == len(loss)
    assert got[4]["loss_chars"] == 250_000
    text = by_id(chat.formatted(df), "conv_id")
    assert text[1]["formatted"].startswith("<|im_start|>user\na<|im_end|>\n") and text[3]["formatted"].count("<|im_start|>") == 3
    assert chat.digests(df.limit(0)).count() == 0


def test_decontamination(spark, docs, none):
    item = "Which river flows through the old town, and how long is it from its spring to the sea?"
    edited = "which RIVER flows trough the old-town and how longer is it from its spring to the see"
    items = clashing(spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "the fox")], "item_id int, text string"))
    df = docs.unionByName(clashing(spark.createDataFrame(
        [(20, f"x {edited} y", "en", "a"), (21, item.upper() * 2, "en", "a"), (22, item[:40], "en", "a")], SCHEMA)))
    rows = decontamination.contaminated(df, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(20, 1), (20, 2), (21, 1), (21, 2)}
    assert all(r["distance"] == 0 for r in rows if r["doc_id"] == 21)
    assert {r["distance"] for r in rows if r["doc_id"] == 20} == {4}
    kept = decontamination.clean(df, items)
    assert kept.columns == df.columns and kept.count() == len(ROWS) + 1
    assert decontamination.contaminated(none, items).count() == 0
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0


def test_short_items_match_at_word_borders(spark):
    items = spark.createDataFrame([(1, "the fox"), (2, "Seven rivers flow"), (3, "a"), (4, "?!")], "item_id int, text string")
    rows = [(1, "see the fox run"), (2, "breathe foxes"), (3, "seven rivers flown"), (4, "SEVEN riversflow"), (5, "seven rovers flow"), (6, "nothing"), (7, "The, Fox!")]
    found = decontamination.contaminated(spark.createDataFrame(rows, "doc_id int, text string"), items).collect()
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in found}
    # 17 characters allow one edit, which may be at a border.
    assert got == {(1, 1, 0), (7, 1, 0), (3, 2, 1), (4, 2, 1), (5, 2, 1)}


def test_decontamination_against_brute_force():
    rng = random.Random(3)

    def least(pattern, text):
        row = list(range(len(pattern) + 1))
        best = row[-1]
        for c in text:
            new = [0]
            for i, p in enumerate(pattern, 1):
                new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
            row = new
            best = min(best, row[-1])
        return best

    items = ["".join(rng.choice("abcd efg") for _ in range(rng.randrange(30, 120))) for _ in range(12)]
    plain = [decontamination.normal(i) for i in items]
    finder = decontamination.Finder(items)
    for _ in range(150):
        at = rng.randrange(len(items))
        chars = list(plain[at])
        for _ in range(rng.randrange(0, 10)):
            p = rng.randrange(len(chars))
            rng.choice([lambda: chars.pop(p), lambda: chars.insert(p, "x"), lambda: chars.__setitem__(p, "y")])()
        text = decontamination.normal("".join(rng.choice("abcd efgh") for _ in range(80)) + "".join(chars) + "zz abc")
        want = {i: d for i, p in enumerate(plain) if (d := least(p, text)) <= int(decontamination.EDIT_RATE * len(p))}
        assert {i: d for i, (d, _) in finder.find(text).items()} == want


def test_long_items_against_brute_force():
    """Items with parts, edited where parts overlap, so that the whole is within its budget where no part is."""
    import numpy as np
    rng = random.Random(8)

    def least(pattern, text):
        signs, steps = np.array(list(pattern)), np.arange(len(pattern) + 1)
        row, best = steps.copy(), len(pattern)
        for c in text:
            kept = np.concatenate([[0], np.minimum(row[1:] + 1, row[:-1] + (signs != c))])
            row = np.minimum.accumulate(kept - steps) + steps
            best = min(best, int(row[-1]))
        return best

    budget = lambda p: int(decontamination.EDIT_RATE * len(p))
    plain = [decontamination.normal("".join(rng.choice("abcd efg") for _ in range(n))) for n in (140, 175, 215, 290, 410)]
    assert all(decontamination.UNIT < len(p) <= 410 for p in plain)
    finder = decontamination.Finder(plain)
    whole_only = 0
    for trial in range(40):
        p = plain[trial % len(plain)]
        k = 1 + len(p) // 256 + len(p) // 400
        n, lost = (budget(p) + rng.randrange(-2, 3)) // k, rng.choice([0, 3])
        cuts = [0, *(len(p) * i // (k + 1) for i in range(1, k + 1)), len(p)]
        edited = ("x" * n).join(p[a + (lost if a else 0): b] for a, b in zip(cuts, cuts[1:], strict=False))
        text = decontamination.normal(f"zz {edited if trial % 4 else p[cuts[1] // 2:][:150]} abc")
        want = {}
        for i, item in enumerate(plain):
            of_whole = least(item, text)
            of_parts = [least(u, text) for u in {*decontamination.units(item)} - {item}]
            good = [d for d in of_parts if d <= budget(" " * decontamination.UNIT)]
            if of_whole <= budget(item) or good:
                want[i] = min(good + [of_whole] * (of_whole <= budget(item)))
                whole_only += not good
        found = finder.find(text)
        assert {i: d for i, (d, _) in found.items()} == want
        assert all(k <= len(decontamination.units(plain[i])) - 1 for i, (_, k) in found.items())
    assert whole_only > 5


def test_vectors(spark):
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (2, [2.0, 0.1, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [float("nan"), 1.0, 0.0]),
        (6, [1.0, None, 0.0]), (7, []), (None, [1.0, 0.0, 0.0]), (8, [0.0, 1.0, 0.0]), (9, [1.0, 0.0]), (10, [float("inf"), 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cid", F.lit("x")).withColumn("d", F.lit(1))
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in itq_dedup.near_vectors(df).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, 3, 1), (2, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (None, 3, 1), (8, 0, 8), (9, 0, 9),
        (10, 0, 10)], key=repr)
    assert itq_dedup.near_vectors(df.limit(0)).count() == 0


def test_vectors_against_brute_force(spark):
    """A large group of near copies, chains around the limit, and strangers."""
    import numpy as np
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(32)
    group = centre + 0.12 * rng.standard_normal((400, 32))
    chain = np.cumsum(np.concatenate([[rng.standard_normal(32)], 0.2 * rng.standard_normal((60, 32))]), axis=0)
    x = np.concatenate([group, chain, rng.standard_normal((1500, 32))])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in itq_dedup.near_vectors(df).collect()}
    want = near.sum(axis=1)
    found = np.array([got[i][0] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.999 * want.sum()
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(x)).min(axis=1))
        if (new == label).all():
            break
        label = new
    assert np.mean([got[i][1] == label[i] for i in range(len(x))]) > 0.999


def test_pii(spark, docs, none):
    rows = by_id(pii.scanned(docs))
    assert rows[2]["spans"] == "" and rows[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert rows[6]["n_phone"] == 3000
    assert pii.scanned(none).count() == 0
    texts = [f"customer number: user{i}@mail.example.com" for i in range(12)] + [
        "é customer number: 9988776655, other 9988776655", "a@b.c_d@e.f", "1.2.3.256 1.2.3.4.5", "4111 1111-1111 1111", "4111 1111 1111 1112",
        "+49 (30) 123456-7.", "+1 2", "9" * 30_000, "x" * 50_000]
    got = by_id(pii.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")))
    assert got[12]["spans"] == "context:19:29" and got[12]["n_context"] == 1
    assert got[13]["spans"] == "email:0:5,email:5:11"
    assert got[14]["spans"] == "ip:10:17" and got[15]["n_card"] == 1 and got[16]["n_card"] == 0
    assert got[17]["spans"].startswith("phone:0:17") and got[18]["n_phone"] == 0
    assert got[19]["n_card"] == 0 and got[20]["spans"] == ""


def test_sharding(spark, docs, none):
    rows = sharding.assigned(docs).collect()
    assert len(rows) == len(ROWS) and sharding.assigned(none).count() == 0
    assert all(r["grown_shard"] in (r["shard"], 24) for r in rows)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert {r["size"] for r in rows if r["doc_id"] == 2} == {8}
    big = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    sizes = dict(big.select(sharding.shard_of(F.col("doc_id").cast("string"), [1.0, 2.0, 0.0, 1.0]).alias("s")).groupBy("s").count().collect())
    assert set(sizes) == {0, 1, 3} and abs(sizes[1] - 10_000) < 400
    moved = sharding.assigned(big).filter("shard <> grown_shard").count()
    assert abs(moved - 800) < 150


def test_write_shards(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(ROWS)


def test_token_blocks(spark, docs, none, tmp_path):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    docs = docs.unionByName(clashing(spark.createDataFrame([(40, "end <|endoftext|> of", "en", "a"), (41, "<|endoftext|>", "en", "a")], SCHEMA)))
    token_blocks.write_tokens(docs, str(tmp_path / "t"), path)
    rows = sorted(token_blocks.read_digests(spark, str(tmp_path / "t")).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:]) and len(rows) == len(ROWS) + 2
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
    text = {r[0]: r[1] for r in ROWS if r[0] is not None} | {40: "end <|endoftext|> of", 41: "<|endoftext|>"}
    for r in rows[2:]:
        want = np.array([*plain.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["n_tokens"], r["ids_crc32"]) == (len(want), zlib.crc32(want.tobytes()))
    whole = {r["doc_id"]: r["ids"] for r in token_blocks.read_tokens(spark, str(tmp_path / "t")).collect()}
    assert whole[2] == [2] and whole[1][-1] == 2 and whole[40] == [437, 220, 50256, 286, 2] and whole[41] == [50256, 2]
    token_blocks.write_tokens(none, str(tmp_path / "n"), path)
    assert token_blocks.read_digests(spark, str(tmp_path / "n")).count() == 0


def test_workers_hold_few_texts(spark, monkeypatch):
    """All texts of a task at once would be held by both ends of a worker's stream."""
    def watched(make):
        def made(*args):
            run = make(*args)

            def work(batches):
                def few():
                    for batch in batches:
                        assert len(batch) <= 1000, f"{len(batch)} rows at once"
                        yield batch

                yield from run(few())

            return work

        return made

    monkeypatch.setattr(token_blocks, "_writer", watched(token_blocks._writer))
    monkeypatch.setattr(near_dedup, "_signer", watched(near_dedup._signer))
    many = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"))
    assert token_blocks.encoded(spark, many).count() == 3000
    assert near_dedup.near_duplicates(many).filter("kept").count() == 3000


def test_pieces_encode_as_whole_texts():
    import public_tokenizers
    encoder = token_blocks.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert encoder.by_piece
    rng = random.Random(4)
    signs = ["a", "Zé", "ß", "'s", "'ll", " ", "  ", "\n", "\t", "\r\n", "\xa0", " ", "\x1c", "\x85", "1", "²", "½", ".", ",", "!?", "中", "🙂", "<|endoftext|>", "é", "ª", "_", "-"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(0, 25))) for _ in range(1500)]
    got = [encoder.encode(t) for t in texts]
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [g.tolist() for g in got] == [w.ids for w in want]


def test_blocks_round_trip():
    import numpy as np
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 4095, 4096, 4097, 20_000):
        for values in (rng.integers(0, 2**32, n, np.uint64), rng.zipf(1.4, n) % 2**31, np.full(n, 7), np.arange(n)):
            ids = values.astype(np.uint32)
            payload = token_blocks.pack(ids)
            assert (token_blocks.unpack(payload) == ids).all() and len(token_blocks.block_starts(payload)) == -(-n // 4096)
            assert (token_blocks.unpack(payload, 4000, 300) == ids[4000:4300]).all()
    skewed = np.where(rng.random(4096) < 0.02, 2**31, rng.integers(100, 116, 4096)).astype(np.uint32)
    assert len(token_blocks.pack(skewed)) < 4096


def _brute_nearest(x, ids, q, k):
    import numpy as np
    scores = x @ q
    order = np.lexsort((ids, -scores))
    return [(int(ids[i]), scores[i]) for i in order[:k]]


def test_nearest_edges(spark):
    rows = [
        (20, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [0.0, 3.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]),
        (5, [float("nan"), 1.0, 0.0]), (6, [1.0, None, 0.0]), (7, []), (None, [1.0, 0.0, 0.0]), (40, [0.0, 1.0, 0.0]), (9, [1.0, 0.0]),
        (60, [2.0, 0.0]), (80, None), (100, [0.0, 0.0, 0.0]), (10, [float("inf"), 0.0, 1.0]), (11, [-5.0, 0.5, 0.0])]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).repartition(3)
    got: dict = {}
    for r in nn_descent.nearest(df, df.filter("vec_id % 20 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {q: sorted(v) for q, v in got.items()} == {
        20: [(1, 1, 1.0), (2, 2, 0.0), (3, 40, 0.0), (4, 11, -5.0)], 40: [(1, 2, 3.0), (2, 11, 0.5), (3, 1, 0.0), (4, 20, 0.0)], 60: [(1, 9, 2.0)]}
    assert nn_descent.nearest(df.limit(0), df).count() == 0 and nn_descent.nearest(df, df.limit(0)).count() == 0


def test_nearest_against_brute_force(spark):
    """Clusters, a group of copies and of near copies with a third of the rows each, and norms that differ a hundredfold."""
    import numpy as np
    rng = np.random.default_rng(5)
    n = 6000
    x = rng.standard_normal((n, 24)) + 2 * rng.standard_normal((8, 24))[rng.integers(0, 8, n)]
    x *= rng.choice([0.1, 1.0, 10.0], n)[:, None]
    x[:2000] = x[0]
    x[2000:4000] = x[2000] + 0.01 * rng.standard_normal((2000, 24))
    ids = rng.permutation(n) * 3
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    found: dict = {}
    for r in nn_descent.nearest(df, df.filter("vec_id % 60 = 0")).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    recall = []
    for at in np.flatnonzero(ids % 60 == 0):
        rest = np.arange(n) != at
        want = _brute_nearest(x[rest], ids[rest], x[at], 20)
        got = sorted(found[int(ids[at])])
        assert [r for r, _, _ in got] == list(range(1, 21))
        recall.append(len({v for _, v, _ in got} & {v for v, _ in want}) / 20)
    assert len(found) == len(recall) and np.mean(recall) >= 0.95


def test_search_of_vectors_outside_the_index(spark):
    import numpy as np
    rng = np.random.default_rng(9)
    x, y = rng.standard_normal((3000, 16)), rng.standard_normal((40, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "vec_id long, embedding array<double>")
    rows = nn_descent.search(nn_descent.index(df), queries, 10, own=True).collect()
    want = {(q, i) for q, v in enumerate(y) for i, _ in _brute_nearest(x, np.arange(3000), v, 10)}
    assert len(rows) == 400 and len({(r["query_id"], r["vec_id"]) for r in rows} & want) >= 0.95 * len(want)


def _brute_negatives(rows):
    """Anchors, positives and negatives from (vec_id, label, v, anchor), one by one."""
    out = []
    for a, (ai, al, av, anchor) in enumerate(rows):
        if not anchor:
            continue
        scored = [(-sum(x * y for x, y in zip(av, v, strict=True)), i, label) for b, (i, label, v, _) in enumerate(rows) if b != a and len(v) == len(av)]
        for minus, positive, _ in sorted(s for s in scored if s[2] == al)[:5]:
            p = -minus
            fit = sorted(s for s in scored if s[2] != al and 30 * p <= -100 * s[0] <= 90 * p)[:10]
            out += [(ai, positive, rank, i, p, -s) for rank, (s, i, _) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [False, True])
def test_hard_negatives_against_brute_force(spark, monkeypatch, spread):
    """Buckets of a few rows, a label with a third of all rows, lengths that differ, ties, zero vectors, repeated rows."""
    rng = random.Random(7)
    monkeypatch.setattr(hard_negatives, "BUCKET", 64)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 16)
    rows = []
    for i in range(700):
        v = [rng.randrange(-9, 10) if not spread or rng.random() < 0.2 else 0 for _ in range(12)]
        if spread:
            v[rng.randrange(12)] += rng.choice([5, 50, 500])
        rows.append((i, 3 if i % 3 == 0 else rng.randrange(6), v, i % 20 == 0))
    rows += [rows[0], rows[5], rows[5], (900, 3, [0] * 12, True), (901, 1, [0] * 12, False), (902, 3, [4, 5], True), (903, 3, [1, 1], False), (904, 2, [1, 0], False)]
    df = clashing(spark.createDataFrame(rows, "vec_id long, label int, v array<long>, anchor boolean")).repartition(4)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    got = sorted(tuple(r[c] for c in columns) for r in hard_negatives.hard_negatives(df).collect())
    assert got == _brute_negatives(rows)


def test_hard_negative_edges(spark):
    schema = "vec_id long, embedding array<double>, label int"
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.8, 0.0], 2), (3, None, 1), (4, [1.0, None], 2), (5, [1.0, 0.0], None), (None, [1.0, 0.0], 2),
            (6, [float("nan"), 0.0], 2), (7, [0.5, 0.0], 0), (100, [-1.0, 0.0], 5), (200, [], 1), (8, [1.0] * 3, 2)]
    df = clashing(spark.createDataFrame(rows, schema))
    got = {(r["anchor_id"], r["positive_id"], r["negative_id"]) for r in hard_negatives.hard_negatives(hard_negatives.whole_numbers(df)).collect()}
    # Row 7 becomes label 1, row 0 label 2: its positive is row 2, its negatives rows 1 and 7 as far as they fit.
    assert got == {(0, 2, 7)}
    assert hard_negatives.hard_negatives(hard_negatives.whole_numbers(df.limit(0))).count() == 0
    assert hard_negatives.hard_negatives(hard_negatives.whole_numbers(df.filter("vec_id = 1"))).count() == 0
    large = spark.createDataFrame([(0, 1, [2**40, 1], True), (1, 1, [2**40, 0], False), (2, 2, [2**19, 0], False)], "vec_id long, label int, v array<long>, anchor boolean")
    assert [(r["positive_score"], r["negative_score"]) for r in hard_negatives.hard_negatives(large).collect()] == [(10**18, 2**59)]


def test_coordinate_ranges_lose_nothing_and_prune():
    import numpy as np
    rng = np.random.default_rng(3)
    v = np.rint(rng.standard_normal((500, 10)) * 40 * rng.random((500, 1))).astype(np.int64)
    v[:, 1:] //= rng.choice([1, 8], (500, 1))
    table = pa.table({"bucket": [0] * 500, "d": [10] * 500, "rid": range(500), "vec_id": range(500), "label": [0] * 500, "v": v.tolist()})
    bucket = hard_negatives.Bucket.read(hard_negatives._bucket(table).to_pylist()[0])
    scores = hard_negatives.dots(v, v)
    for share in (0.3, 0.8, 0.95):
        limit = (share * scores.max(axis=1)).astype(np.int64)
        good = bucket.feasible(v, limit)
        assert (good | (scores < limit[:, None])).all()
    assert good.mean() < 0.5


def _brute_words(words):
    """Near words, forms and roots from word counts, pair by pair."""
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out = {}
    for w, n in words.items():
        others = [o for o in words if o != w and near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        out[w] = (best if best and words[best] >= 10 * n else None, len(others))
    root = lambda w: w if out[w][0] is None else root(out[w][0])
    return {w: (form, root(w), words[w], k, words.get(form)) for w, (form, k) in out.items()}


@pytest.mark.parametrize("block", [4096, 3])
def test_spelling_against_brute_force(spark, monkeypatch, block):
    """Dense words over few letters, repeated letters, accents, a half that most words share, and chains of forms."""
    for name in ("GROUP", "BLOCK", "ASKED"):
        monkeypatch.setattr(spelling, name, block)
    rng = random.Random(11)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(7, 10))): rng.choice([2, 3, 40, 500]) for _ in range(150)}
    words |= {"prefixed" + "".join(rng.choice("xyz") for _ in range(rng.randrange(1, 5))): rng.randrange(2, 60) for _ in range(60)}
    words |= {"aaaaaaa": 2, "aaaaaaaa": 20, "aaaaaaaaa": 200, "aaaaaaaaaa": 2000, "aaaaaaaaaaa": 20000, "z" * 900: 5, "z" * 901: 50}
    df = clashing(spark.createDataFrame(list(words.items()), "word string, n long").withColumnRenamed("word", "w").withColumnRenamed("n", "m")) \
        .withColumn("word", F.col("w")).withColumn("n", F.col("m")).select("word", "n")
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.grouped(df).collect()}
    assert got == _brute_words(words)


def test_vocabulary(spark):
    rng = random.Random(12)
    rows = [(i if i % 9 else None, " ".join(rng.choice(["Straßenbahn", "ÉCOLESécoles", "short", "abcdefg", "Language", "naïveté×x", "w1longword", "UPPERCASE"]) for _ in range(30)))
            for i in range(400)] + [(500, None), (501, ""), (502, "a" * 200_000 + " " + "a" * 200_000)]
    counts: dict = {}
    import re
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            word = low[:h % len(low)] + low[h % len(low) + 1:] if h % 31 == 0 else low
            if len(word) >= 7:
                counts[word] = counts.get(word, 0) + 1
    df = clashing(spark.createDataFrame(rows, "doc_id int, text string"))
    got = {r["word"]: r["n"] for r in spelling.vocabulary(df).collect()}
    assert got == {w: n for w, n in counts.items() if n >= 2} and len(got) > 10
    rows = {r["word"]: r["root"] for r in spelling.variants(df).collect()}
    assert set(rows) == set(got) and sum(root == "language" for root in rows.values()) > 1
    assert spelling.variants(df.limit(0)).count() == 0


def test_stages_on_an_empty_table(spark, none):
    items = spark.createDataFrame([(1, "some item of the benchmark, long enough")], "item_id int, text string")
    for out in (language_id.accepted(none), near_dedup.one_of_each(none), decontamination.clean(none, items), mixing.mixed(none)):
        assert out.columns == none.columns and out.count() == 0
    assert token_blocks.encoded(spark, none).count() == 0


def test_components_with_hubs(spark):
    """Stars around a few nodes, tied by chains, against a plain union."""
    from marginalia.llm.components import components
    rng = random.Random(13)
    edges = [(h, 1000 + i) for h in (5, 700, 999) for i in rng.sample(range(2000), 600)] + [(i, i + 1) for i in range(4000, 4060)] + [(7, 7), (8, 9), (8, 9)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}


def test_context_behind_a_long_word(spark):
    """The two words before a token decide, however long they are."""
    from marginalia.llm import pii
    long = "x" * 300
    rows = [(i, f"{long} kundennummer kd-{10000 + i} und mail a{i}@b.de") for i in range(4)] + [(9, f"{long} kundennummer kd-99999")]
    rows += [(20 + i, f"{long} kundennummer a{i}{i}{i}{i}{i}@b.de") for i in range(20)]
    got = by_id(pii.scanned(spark.createDataFrame(rows, "doc_id int, text string")))
    assert got[9]["n_context"] == 1 and "context" in got[9]["spans"]
