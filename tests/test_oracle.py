"""Every catalog query against its DuckDB oracle at sf0.01 (exact values)."""

import pytest

import __spark_entry__ as E
from lograft.plans.catalog import QUERIES
from conftest import SF001
from oracle_check import compare, duck

ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_oracle_keys_are_queries():
    assert set(ORACLE) <= set(E.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF001)
    if key not in ORACLE:
        assert df.count() > 0
        return
    res = compare(df, con, ORACLE[key], digits=None)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["log_level", "count", "pct"]
    assert abs(sum(r["pct"] for r in rows) - 100.0) < 1e-9


def test_fixture_facts(spark):
    """Numbers stated for the sf0.01 log-line view."""
    q = E.queries()
    totals = q["level_totals"](spark, SF001).first()
    assert totals["total_lines"] == 10000 and totals["lines_with_level"] == 9000
    assert q["app_timeline"](spark, SF001).count() == 150
    assert {r["num_applications"] for r in q["cluster_summary"](spark, SF001).collect()} == {25}
    assert q["task_durations"](spark, SF001).count() == 616
    assert q["unfinished_tasks"](spark, SF001).count() == 77
    assert q["multiline_entries"](spark, SF001).count() == 9001
