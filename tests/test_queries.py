"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_queries import TABLES, rows


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


# See test_models.py and test_attribution.py; the smallest tables have no rows to train on before the last 48 hours.
TREES = {"tree_contributions", "tree_feature_summary", "tree_contributions_add_up"}
SLOW = {"boosted_trees", "boosted_trees_grid", "boosted_trees_past_only"} | TREES


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    got = rows(df.collect(), df.columns)
    if name in entry.oracle_sql():
        cur = con.execute(entry.oracle_sql()[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        assert got == rows(cur.fetchall(), names)


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() == 30 and out.columns[:3] == ["event_type", "ts", "value"]


def test_oracle_names_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
