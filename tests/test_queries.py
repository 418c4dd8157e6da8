"""Every registered query gives the rows of its SQL check."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = os.environ.get("DOCLOG_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(TABLES)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{file}'")
    return connection


def _sorted(rows, names, order):
    picked = [[row[names.index(n)] for n in order] for row in rows]
    plain = [["NaN" if isinstance(v, float) and math.isnan(v) else v for v in r] for r in picked]
    return sorted(plain, key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, duck, name):
    result = queries()[name](spark, TABLES)
    expected = duck.execute(oracle_sql()[name])
    names = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(names)
    order = sorted(names)
    got = _sorted([tuple(r) for r in result.collect()], result.columns, order)
    wanted = _sorted(expected.fetchall(), names, order)
    assert len(got) == len(wanted)
    assert got == wanted


def test_entry(spark):
    assert entry(spark).columns == ["event_id", "k", "k_is_null"]
