"""Driver contract: entry(), every registered query against its oracle, and a run from elsewhere."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from captally.fixtures import TABLES
from captally.queries import QUERIES

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.abspath(E.__file__))


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert {r.metric for r in rows} == {"Bleu_1", "Bleu_2", "Bleu_3", "Bleu_4", "ROUGE_L", "CIDEr"}


def test_every_library_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def norm(v):
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    key = lambda row, names: tuple(norm(row[names.index(c)]) for c in sorted(names))
    a = sorted(key(tuple(r), df.columns) for r in df.collect())
    b = sorted(key(r, cols) for r in cur.fetchall())
    assert a == b


ELSEWHERE = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as E
from captally.session import local_session
spark = local_session(2, 2)
sys.path.remove({repo!r})
print("ROWS", E.queries()["rouge_l_corpus"](spark, {sf!r}).count(), E.queries()["failures_by_status"](spark, {sf!r}).count())
spark.stop()
"""


def test_workers_need_no_path_to_the_package(tmp_path):
    """From another folder and without PYTHONPATH: Python code reaches the workers by value."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run(
        [sys.executable, "-c", ELSEWHERE.format(repo=REPO, sf=SF)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "ROWS 1 3" in got.stdout, got.stderr[-2000:]
