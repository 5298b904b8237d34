"""The registry, and every query that has SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from rillwork.plans.oracle import ORACLE
from rillwork.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
LARGE = ("negative_sample", "pair_features_train", "recall_by_source", "validation_rules", "validation_metrics", "entity_metrics", "matching_results", "match_distribution")


def test_registry():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) - set(ORACLE) == {"gbt_scored_pairs"}


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["source1_entity_id", "candidate_entity_id"] and df.count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    return con


def plain(rows):
    return sorted([tuple("" if v is None else f"{v:.9g}" if isinstance(v, (int, float)) else str(v) for v in r) for r in rows])


@pytest.mark.parametrize("name", [n for n in ORACLE if n not in LARGE])
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = plain(df.select(*names).collect())
    sql = duck.sql(f"SELECT {', '.join(names)} FROM ({ORACLE[name]})").fetchall()
    assert got == plain(sql)
