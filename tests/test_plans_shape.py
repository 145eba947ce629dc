"""Plan-shape guards: input scans per query, pushdown, no cross joins."""

import pytest

from conftest import SF0001

from lograft.operators.daily import daily_summary
from lograft.plans.catalog import QUERIES, TRIP_YEAR, _trips



@pytest.fixture
def plans(monkeypatch):
    """The plans of the jobs that run while a query is built."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen, checkpoint = [], DataFrame.checkpoint

    def noted(self, eager=True):
        seen.append(self._jdf.queryExecution())
        return checkpoint(self, eager)

    monkeypatch.setattr(DataFrame, "checkpoint", noted)
    return seen


# Keys that read several tables, one scan of each.
TABLES = {"table_union": 3}
# Keys that scan their table several times (to narrow a range, to check an estimate); each job has one scan.
SEVERAL_JOBS = {"price_p95_exact", "distinct_users", "daily_trips_exact", "daily_events", "multiline_entries", "file_entries", "file_line_entries"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_scans_and_joins(spark, plans, key):
    """In all jobs of a query: no cross join, one scan of each table, and each line built and matched once."""
    df = QUERIES[key](spark, SF0001)
    df.write.format("noop").mode("overwrite").save()
    plans.append(df._jdf.queryExecution())
    physical = [p.executedPlan().toString().split("== Initial Plan ==")[0] for p in plans]
    scans = [p.count("FileScan") for p in physical]
    assert max(scans) <= TABLES.get(key, 1) and sum(scans) >= 1, physical
    assert sum(scans) <= TABLES.get(key, 1) or key in SEVERAL_JOBS, (key, scans)
    assert not any("CartesianProduct" in p or "BroadcastNestedLoopJoin" in p for p in physical)
    for p in plans:
        logical = p.optimizedPlan().toString()
        assert logical.count("bytes result sent to driver") <= 3, logical  # up to twice in the line's rule, and in the pattern
        assert key == "table_union" or logical.count("regexp_replace(") <= 1, logical


def test_year_filter_reaches_parquet(spark):
    df = daily_summary(_trips(spark, SF0001), TRIP_YEAR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double,l_extendedprice:double" in plan


@pytest.mark.parametrize("key", ["app_gaps", "peak_concurrency", "app_overlaps", "multiline_entries"])
def test_windows_are_bucketed(spark, key):
    """No window partitions by a bare (possibly hot) key: each one carries the
    order bucket, either as a partition column or as the order of the small
    per-bucket summary."""
    df = QUERIES[key](spark, SF0001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows
    for line in windows:
        assert "_day" in line or "_bucket" in line, line


PERCENTILES = ["price_p95_exact", "daily_trips_exact", "daily_events"]
DISTRIBUTIONS = ["duration_histogram", "duration_density", "duration_histogram_clusters", "duration_density_clusters"]


@pytest.mark.parametrize("key", [*PERCENTILES, *DISTRIBUTIONS])
def test_no_data_side_is_broadcast(spark, plans, key):
    """Only rows per group are broadcast: no broadcast holds a scan or a table of values. The
    plans of the jobs that run while the query is built are looked at too."""
    df = QUERIES[key](spark, SF0001)
    plans.append(df._jdf.queryExecution())
    plans = [p.executedPlan().toString() for p in plans]
    joined = 0
    for plan in plans:
        lines = plan.split("\n")
        for i, line in enumerate(lines):
            if "BroadcastExchange" not in line:
                continue
            joined += 1
            depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
            inside = []
            for other in lines[i + 1 :]:
                if len(other) - len(other.lstrip(" :+-*()0123456789")) <= depth:
                    break
                inside.append(other)
            assert not any("FileScan" in x for x in inside), plan
    assert joined


def test_line_inventory_has_no_expand(spark):
    plan = QUERIES["line_inventory"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
