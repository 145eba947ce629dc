"""Daily KPI summaries of trip-like records (AGG6, AGG7, AGG13, AGG14, FLT4, T16, T17, SRT4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lograft.operators.quantiles import exact_percentile

def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Trip view over ``lineitem``: ship date as pickup time, quantity as distance,
    tax as MTA tax, extended price as fare, discount as tip, line number as passengers."""
    return lineitem.select(
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("tip_amount"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
    )


def in_year(df: DataFrame, ts_col: str, year: int) -> DataFrame:
    """``year(ts) = year`` written as a half-open range on the raw column (FLT4).

    ``year(ts) = 2021`` only pushes ``IsNotNull`` into the Parquet scan; a range
    on the column itself pushes ``>=``/``<`` and lets row groups be skipped.
    """
    # typed SQL literals: zone-free for TIMESTAMP_NTZ, session zone for TIMESTAMP
    kind = "TIMESTAMP_NTZ" if dict(df.dtypes)[ts_col] == "timestamp_ntz" else "TIMESTAMP"
    lo = F.expr(f"{kind} '{year:04d}-01-01 00:00:00'")
    hi = F.expr(f"{kind} '{year + 1:04d}-01-01 00:00:00'")
    return df.filter((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))


def with_day(df: DataFrame, ts_col: str) -> DataFrame:
    """``dt_year, dt_month, dt_day`` of the timestamp."""
    ts = F.col(ts_col)
    return df.withColumns({"dt_year": F.year(ts), "dt_month": F.month(ts), "dt_day": F.dayofmonth(ts)})


DAY_KEYS = ["dt_year", "dt_month", "dt_day"]


def daily_summary(trips: DataFrame, year: int | None = None, exact_p95: bool = False) -> DataFrame:
    """Daily KPIs of the trip job (AGG6): count, mean distance, max MTA tax,
    95th percentile fare, min tip, mean passengers rounded up (T17).

    One partial + final aggregate keyed by day; the percentile is Spark's
    mergeable sketch unless ``exact_p95`` asks for the nearest-rank value.
    """
    rows = in_year(trips, "tpep_pickup_datetime", year) if year is not None else trips
    rows = with_day(rows, "tpep_pickup_datetime")
    aggs = [
        F.count(F.lit(1)).alias("num_trips"),
        F.avg("trip_distance").alias("mean_trip_distance"),
        F.max("mta_tax").alias("max_mta_tax"),
        F.min("tip_amount").alias("min_tip_amount"),
        F.ceil(F.avg("passenger_count")).alias("mean_passenger_count"),
    ]
    if not exact_p95:
        aggs.insert(3, F.percentile_approx("fare_amount", 0.95).alias("q95_fare_amount"))
        return rows.groupBy(*DAY_KEYS).agg(*aggs)
    # the other KPIs ride along in the percentile's first pass: two scans in all
    daily = exact_percentile(rows, DAY_KEYS, "fare_amount", 0.95, "q95_fare_amount", extra=aggs)
    return daily.select(
        *DAY_KEYS, "num_trips", "mean_trip_distance", "max_mta_tax", "q95_fare_amount",
        "min_tip_amount", "mean_passenger_count",
    )


def newest_days(daily: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest days with their position in that order (SRT4, SRT8)."""
    first = daily.orderBy(*[F.desc(k) for k in DAY_KEYS]).limit(n)
    order = Window.orderBy(*[F.desc(k) for k in DAY_KEYS])  # n rows
    return first.withColumn("position", F.row_number().over(order))


def daily_totals(daily: DataFrame) -> DataFrame:
    """Days, total and mean trips per day over the daily result (AGG13)."""
    return daily.agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("num_trips").alias("total_trips"),
        F.avg("num_trips").alias("avg_daily_trips"),
    )


def daily_range(daily: DataFrame) -> DataFrame:
    """First and last day with data as real dates (AGG14)."""
    day = F.make_date("dt_year", "dt_month", "dt_day")
    return daily.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def daily_metrics(
    df: DataFrame, ts_col: str, value_col: str, count_col: str, year: int | None = None
) -> DataFrame:
    """The same daily KPI shape over any table: count, mean/max/p95/min of one
    measure, and the rounded-up mean of a count-like column."""
    rows = with_day(in_year(df, ts_col, year) if year is not None else df, ts_col)
    aggs = [
        F.count(F.lit(1)).alias("num_rows"),
        F.round(F.avg(value_col), 6).alias("mean_value"),
        F.max(value_col).alias("max_value"),
        F.min(value_col).alias("min_value"),
        F.ceil(F.avg(count_col)).alias("mean_count"),
    ]
    return exact_percentile(rows, DAY_KEYS, value_col, 0.95, "q95_value", extra=aggs)
