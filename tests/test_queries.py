"""Every registered query against its SQL, as a multiset of rows."""

import math
import subprocess
import sys
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from conftest import ROOT, SF_DIR

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, list):
        return tuple(plain(item) for item in value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    rows = frame.collect()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    expected = duck.execute(sql)
    names = [column[0] for column in expected.description]
    assert sorted(names) == sorted(frame.columns)
    expected = multiset(names, expected.fetchall())
    actual = multiset(frame.columns, rows)
    assert sum(actual.values()) == sum(expected.values())
    assert actual == expected


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["o_orderkey", "o_totalprice"]
    assert frame.count() == 1000


@pytest.mark.parametrize("module", ["xxhash", "public_tokenizers", "regex", "corpus_pipeline"])
def test_core_queries_need_no_text_operators(module):
    """Whatever the text operators lack, all other queries are there."""
    code = f"import sys; sys.modules[{module!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    core = [name for name, sql in contract._ORACLES.items() if sql]
    assert run.stdout.split() == [str(len(contract._QUERIES)), str(len(core))]
    assert "text operators cannot be loaded" in run.stderr or module == "corpus_pipeline"
