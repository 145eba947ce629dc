"""The daily trip job end to end: daily KPI CSV (newest day first) and a text summary."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.operators import daily
from lograft.session import cut_lineage
from lograft.sinks import write_report, write_single_csv


def run_daily_report(
    spark: SparkSession, trips: DataFrame, year: int, out_dir: str, exact_p95: bool = False
) -> dict:
    days = cut_lineage(daily.daily_summary(trips, year, exact_p95=exact_p95))
    write_single_csv(days, os.path.join(out_dir, "daily_kpis.csv"), [F.desc(k) for k in daily.DAY_KEYS])
    totals = daily.daily_totals(days).first()
    span = daily.daily_range(days).first()
    text = "\n".join(
        [
            f"Days with data: {totals['days']}",
            f"Date range: {span['first_day']} to {span['last_day']}",
            f"Total trips: {totals['total_trips'] or 0:,}",
            f"Average daily trips: {totals['avg_daily_trips'] or 0:.0f}",
        ]
    )
    write_report(spark, text, os.path.join(out_dir, "daily_summary.txt"))
    return {
        "days": totals["days"],
        "total_trips": totals["total_trips"],
        "first_day": span["first_day"],
        "last_day": span["last_day"],
        "summary": text,
    }
