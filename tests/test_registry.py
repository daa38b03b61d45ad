"""Every registered query against its SQL on another engine."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from moodwell.plans.registry import QUERIES

TABLES = "events documents pages labels conversations"


@pytest.fixture(scope="module")
def other(small):
    engine = duckdb.connect()
    for table in TABLES.split():
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return engine


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


def test_names_agree():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, other, small, name):
    got = entry_points.queries()[name](spark, small)
    want = other.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.collect(), got.columns) == rows_of(want.fetchall(), columns)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 200


def test_other_queries_do_without_the_libraries_of_the_training_operators():
    code = """
import sys
sys.modules["sentencepiece"] = None
import __spark_entry__ as e
from moodwell.plans.registry import QUERIES
assert set(e.queries()) == set(QUERIES), set(e.queries()) ^ set(QUERIES)
"""
    root = Path(entry_points.__file__).parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
