"""Every registered query beside its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.registry import QUERIES
from checks.compare import compare

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf_dir, name):
    verdict, rows, _ = compare(spark, db, name, sf_dir)
    assert verdict in ("same", "rows only")
    assert rows > 0 or name in ("rls_none", "risk_table_second_page")


def test_entry(spark, sf_dir):
    assert entry.entry(spark).columns == ["department_name", "headcount", "departures", "turnover_rate_pct"]


def test_most_queries_have_sql():
    without = set(QUERIES) - set(entry.oracle_sql())
    assert without == {"split_counts", "train_metrics", "feature_importance", "top_factors", "scored_employees"}
