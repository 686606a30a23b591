"""Registered queries of the library at the smallest scale, against their check statements.

All of them, several at once: each is a row of small jobs that leaves most cores idle.
"""

import sys
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from marginalia.catalog import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
AT_ONCE = 6
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def results(spark, request):
    """Columns and rows, or the error, of every query that this run asks for."""

    def run(name):
        try:
            df = entry.queries()[name](spark, FOLDER)
            return df.columns, [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001 - raised by the test of the query
            return e

    names = [i.callspec.params["name"] for i in request.session.items if i.originalname == "test_query" and i.module is request.module]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return dict(zip(names, pool.map(run, names), strict=True))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(results, duck, name):
    found = results[name]
    if isinstance(found, Exception):
        raise found
    got = _rows(*found)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = duck.execute(sql)
    assert got == _rows([c[0] for c in cur.description], cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["source", "key", "action", "target", "similarity", "reason"]


def test_registry():
    queries, checks = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(queries) and set(checks) <= set(queries)
    assert sum(q.sql is None for q in QUERIES.values()) <= 4
