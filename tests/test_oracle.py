"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tessera.plans import catalog  # noqa: E402
from scripts.oracle_check import TABLES, digest, type_mismatches  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(E.queries()) >= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, DATA)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(cols, orows)
    assert type_mismatches(df, con.sql(E.oracle_sql()[name])) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["moviename", "avgrate"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["traffic_totals", "term_counts", "inverted_index_counts", "cells_put",
                                  "batch_slots", "first_seen_per_type", "computed_columns", "avg_rate_by_attr"])
def test_query_matches_oracle_without_ansi(spark, con, name):
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        df = E.queries()[name](spark, DATA)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    cur = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert digest(df.columns, rows) == digest(cols, cur.fetchall())
