"""Result writers (SNK1-SNK5, SNK9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_single_csv(
    df: DataFrame, path: str, order: Sequence[str | Column] = (), timestamp_format: str | None = None
) -> None:
    """One CSV file with a header, overwriting ``path`` (SNK1, SNK2, SNK3).

    For small, already aggregated results only. ``repartition(1)`` (not
    ``coalesce(1)``) so the work before it keeps all its tasks and only the
    final rows meet in one writer, which sorts them by ``order``.
    """
    one = df.repartition(1)
    writer = (one.sortWithinPartitions(*order) if order else one).write.mode("overwrite").option("header", "true")
    if timestamp_format:
        writer = writer.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    writer.csv(path)


def write_csv(df: DataFrame, path: str, timestamp_format: str | None = None) -> None:
    """Parallel CSV, one file per task: for results that grow with the input. The files
    of an ordered frame are in order by name."""
    writer = df.write.mode("overwrite").option("header", "true")
    if timestamp_format:
        writer = writer.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    writer.csv(path)


def write_report(spark: SparkSession, text: str, path: str) -> None:
    """A short text report (a few lines built from aggregated values) as one text file (SNK4).

    The text is a literal of one task's one row: rows made in Python would start a worker on every core.
    """
    spark.range(0, 1, 1, 1).select(F.lit(text).alias("value")).write.mode("overwrite").text(path)
