"""Registered queries of the subpackage at the smallest scale, against SQL or brute force."""

import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from marginalia.llm import decontamination, language_id, mixing
from marginalia.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cur = duck.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    assert got == sorted(cur.fetchall(), key=repr)


def shingles(text):
    """Tuples of lower-case words; A to Z only, and only ASCII space parts words."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts, pct=85):
    ids = sorted(texts)
    sets = {i: shingles(texts[i]) for i in ids}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            c = len(sets[i] & sets[j]) if j < i else 0
            if c and 100 * c >= pct * (len(sets[i]) + len(sets[j]) - c):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_dedup(spark, texts):
    rows = QUERIES["op4_near_dedup"](spark, FOLDER).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(texts)
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(shingles(t)) for i, t in texts.items()}


def test_language(spark, duck):
    lang = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op2_language_id"](spark, FOLDER).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert len(rows) == len(lang) and np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_decontamination(spark, duck, texts):
    items = dict(duck.execute("SELECT item_id, text FROM benchmark").fetchall())
    whole = {(d, i) for d, t in texts.items() for i, b in items.items() if decontamination.normal(b) in decontamination.normal(t)}
    rows = QUERIES["op6_decontamination"](spark, FOLDER).collect()
    assert whole <= {(r["doc_id"], r["item_id"]) for r in rows}
    assert {(r["doc_id"], r["item_id"]) for r in rows if r["distance"] == 0} >= whole


def test_token_blocks(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = {r["doc_id"]: r for r in QUERIES["op10_token_blocks"](spark, FOLDER).collect()}
    start = 0
    for doc_id in sorted(texts):
        ids = np.array([*plain.encode(texts[doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        r = rows[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_pipeline(spark, duck):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = [(name, fn) for name, fn in corpus_pipeline.STAGES]
    assert [n for n, _ in stages] == ["language_id", "near_dedup", "decontamination", "mixing", "token_blocks"]
    frames = [docs]
    for _, stage in stages[:-1]:
        frames.append(stage(spark, frames[-1], FOLDER).cache())
        assert frames[-1].columns == docs.columns
    told, single, clean, mix = (f.collect() for f in frames[1:])
    assert {r["doc_id"] for r in docs.collect() if language_id.words(r["text"])} == {r["doc_id"] for r in told}
    root = brute_components({r["doc_id"]: r["text"] for r in told}, 80)
    assert sorted(r["doc_id"] for r in single) == sorted(set(root.values()))
    items = [decontamination.normal(t) for (t,) in duck.execute("SELECT text FROM benchmark").fetchall()]
    finder = decontamination.Finder(items)
    assert sorted(r["doc_id"] for r in clean) == sorted(r["doc_id"] for r in single if not finder.find(r["text"]))
    size = lambda r: len(r["text"].encode().split())
    wanted = {r["doc_id"]: r for r in mixing.mixture(frames[3]).collect()}
    taken: dict = {}
    for r in mix:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + size(r)
    assert taken == {k: r["taken"] for k, r in wanted.items() if r["taken"]}
    last = stages[-1][1](spark, frames[-1], FOLDER)
    assert last.count() == len(mix)
    whole = corpus_pipeline.run(spark, FOLDER)
    cols = ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, whole.select(cols).collect())) == sorted(map(tuple, last.select(cols).collect()))
    assert whole.agg(F.sum("n_tokens")).first()[0] == max(r["start"] + r["n_tokens"] for r in whole.collect())
