"""The driver contract: entry, queries and their oracles agree (sf0.001)."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "conversations"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "category"


def test_a_missing_library_leaves_the_reports(tmp_path):
    """The reports stay when a library of the training-data operators is absent."""
    code = """
import sys, warnings
sys.modules["ahocorasick"] = sys.modules["tillroll.llm"] = None
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as e
assert "sales_by_category" in e.queries() and not e.LLM_QUERIES
assert any("training-data" in str(w.message) for w in said)
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(entry.__file__))


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert not {q for q in entry.queries() if q not in entry.LLM_QUERIES} - set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _canon(names, rs):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(r[i]) if isinstance(r[i], float) else str(r[i]) for i in order)
                   for r in rs), key=repr)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.LLM_QUERIES)))
def test_query_equals_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = df.collect()
    cur = duck.execute(entry.oracle_sql()[name])
    onames = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(onames)
    assert _canon(df.columns, got) == _canon(onames, want)
