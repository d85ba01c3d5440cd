"""Spark queries equal their DuckDB oracle (row count, columns, values) at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tidemark.sources.tables import TABLES
from tools.check_oracle import digest

FAST = [
    "cleaned_customers",
    "cohort_retention",
    "tier_cohorts",
    "risk_matrix",
    "cohort_summary",
    "business_rollup",
    "quality_report",
    "cleaning_summary",
    "missing_report",
    "transaction_metrics",
    "ttest_premium_basic",
    "chi2_referral_activation",
    "pearson_pairs",
    "histogram",
    "roc_points_rule",
    "event_features",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(sdf.columns, srows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "retention_rate_month_1" in df.columns


def test_every_query_has_a_callable():
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    assert len(qs) >= 60
