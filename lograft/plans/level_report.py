"""The level job end to end: counts CSV, sample CSV and a text summary.

Two passes over the input instead of one per output: a single ``groupBy``
(level, including the no-level group) yields every count and total, and one
top-k yields the sample. The tiny aggregate is checkpointed in the shared
folder so writing it and reading it for the report do not rescan the logs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lograft.functions.parse import ensure_parsed
from lograft.operators.levels import sample_lines
from lograft.session import cut_lineage
from lograft.sinks import write_report, write_single_csv


# Labels and widths of the published summary.
SUMMARY_HEAD = "Total log lines processed: %s\nTotal lines with log levels: %s\nUnique log levels found: %s\n\nLog level distribution:"
SUMMARY_ROW = "  %-5s: %10s (%5s%%)"


def level_summary(counts: DataFrame) -> DataFrame:
    """The summary text (T21), one row, from the counts of all levels (``''``: no level)."""
    named = F.col("log_level") != ""
    levelled = F.sum(F.when(named, F.col("count")).otherwise(0)).over(Window.partitionBy())  # a row per level
    share = F.coalesce(F.try_divide(F.lit(100.0) * F.col("count"), levelled), F.lit(0.0))
    row = F.format_string(SUMMARY_ROW, "log_level", F.format_number("count", 0), F.format_number(share, 2))
    rows = counts.withColumn("row", F.when(named, F.struct(-F.col("count"), "log_level", row.alias("text"))))
    whole = rows.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(named, F.col("count"))), F.lit(0)).alias("levelled"),
        F.array_sort(F.collect_list("row")).alias("rows"),
    )
    head = F.format_string(
        SUMMARY_HEAD, F.format_number("total", 0), F.format_number("levelled", 0), F.size("rows").cast("string")
    )
    body = F.transform("rows", lambda r: r["text"])
    return whole.select("total", "levelled", F.array_join(F.concat(F.array(head), body), "\n").alias("text"))


def run_level_report(
    spark: SparkSession, lines: DataFrame, out_dir: str, sample_n: int = 10, seed: str = "42"
) -> dict:
    parsed = ensure_parsed(lines).select("line", "log_level")
    all_counts = cut_lineage(parsed.groupBy("log_level").agg(F.count(F.lit(1)).alias("count")))
    order = [F.desc("count"), F.asc("log_level")]
    counts = all_counts.filter(F.col("log_level") != "")
    rows = [(r["log_level"], r["count"]) for r in counts.orderBy(*order).collect()]
    summary = level_summary(all_counts).first()
    text = summary["text"]

    write_single_csv(counts, os.path.join(out_dir, "level_counts.csv"), order)
    write_single_csv(sample_lines(parsed, sample_n, seed), os.path.join(out_dir, "level_sample.csv"))
    write_report(spark, text, os.path.join(out_dir, "level_summary.txt"))
    return {"total_lines": summary["total"], "lines_with_level": summary["levelled"], "counts": rows, "summary": text}
