"""Level distribution, component activity, samples and line filters (AGG1-3, AGG8-10, AGG18, SRT5)."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lograft.functions import patterns as P


def with_level(parsed: DataFrame) -> DataFrame:
    """Lines that carry a whole-word level (FLT1)."""
    return parsed.filter(F.col("log_level") != "")


def level_counts(parsed: DataFrame) -> DataFrame:
    """``log_level, count`` over lines with a level (AGG1); partial + final aggregate.

    Grouping first and dropping the ``''`` group afterwards gives the same rows
    as filtering first, but evaluates the level regex once per line (a filter
    on a derived column is pushed below the projection and re-evaluates it).
    """
    counts = parsed.groupBy("log_level").agg(F.count(F.lit(1)).alias("count"))
    return counts.filter(F.col("log_level") != "")


def level_share(parsed: DataFrame) -> DataFrame:
    """Counts plus each level's percent of the lines with a level (AGG10, W1).

    The ``OVER ()`` window runs on the aggregated rows (one per level), never on lines.
    """
    counts = level_counts(parsed)
    return counts.withColumn("pct", F.lit(100.0) * F.col("count") / F.sum("count").over(Window.partitionBy()))


def level_totals(parsed: DataFrame) -> DataFrame:
    """All summary counts in one pass (AGG8, AGG9): lines, lines with a level, distinct levels."""
    has_level = F.col("log_level") != ""
    return parsed.agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(has_level).alias("lines_with_level"),
        F.count_distinct(F.when(has_level, F.col("log_level"))).alias("distinct_levels"),
    )


def level_counts_unfiltered(parsed: DataFrame) -> DataFrame:
    """Loose level (T3) per line, ``''`` kept as its own group (AGG2)."""
    return parsed.groupBy(F.col("level_loose").alias("level")).agg(F.count(F.lit(1)).alias("count"))


def level_token_counts(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Every level token in every line, several per line (AGG18, T14), like ``grep -o | uniq -c``."""
    tokens = lines.select(F.explode(F.regexp_extract_all(F.col(line_col), F.lit(P.LEVEL_LOOSE), 1)).alias("level"))
    return tokens.groupBy("level").agg(F.count(F.lit(1)).alias("count"))


def component_counts(parsed: DataFrame, k: int = 20) -> DataFrame:
    """Most active components first, top ``k`` (AGG3, SRT9); ties broken by name."""
    counts = parsed.groupBy("component").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc("component")).limit(k)


def sample_lines(
    parsed: DataFrame, n: int = 10, seed: str = "42", key_col: str = "line", method: str = "md5"
) -> DataFrame:
    """Random sample of ``n`` lines with a level (SRT5, T20).

    ``md5``: order by ``md5(seed || line)``, reproducible whatever the
    partitioning. ``rand``: order by ``rand(seed)``, reproducible only for the
    same input splits. Either way every task keeps a local top-``n`` heap and
    only ``n`` rows per task reach the final merge (TakeOrderedAndProject).
    """
    rows = with_level(parsed)
    if method == "rand":
        order = F.rand(int(seed) if str(seed).isdigit() else zlib.crc32(str(seed).encode()))
    else:
        order = F.md5(F.concat(F.lit(seed), F.col(key_col)))
    return rows.orderBy(order, F.col(key_col)).limit(n).select(
        F.col(key_col).alias("log_entry"), F.col("log_level")
    )


def lines_containing(lines: DataFrame, text: str, line_col: str = "line") -> DataFrame:
    """Lines that contain ``text`` (SNK9 filter, FLT7), e.g. ``'ERROR'``."""
    return lines.filter(F.col(line_col).contains(text))


def lines_matching(lines: DataFrame, pattern: str, line_col: str = "line") -> DataFrame:
    """Lines that match a regular expression (FLT7)."""
    return lines.filter(F.col(line_col).rlike(pattern))


def only_application(parsed: DataFrame, application_id: str, col: str = "application_id") -> DataFrame:
    """Lines of one application: a development sample that stays a filter (SRC14)."""
    return parsed.filter(F.col(col) == application_id)


def line_inventory(parsed: DataFrame) -> DataFrame:
    """Distinct applications and clusters named in the text, lines, lines with
    a level, and parsable timestamps (AGG16 over line text): grouped by
    application first, so that no line is counted twice over."""
    per_app = parsed.groupBy("application_id", "cluster_id").agg(
        F.count(F.lit(1)).alias("_lines"),
        F.count_if(F.col("log_level") != "").alias("_levels"),
        F.count("event_time").alias("_times"),
    )
    per_cluster = per_app.groupBy("cluster_id").agg(
        F.count_if(F.col("application_id") != "").alias("_apps"),
        *[F.sum(c).alias(c) for c in ("_lines", "_levels", "_times")],
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_cluster.agg(
        total("_apps").alias("applications"),
        F.count_if(F.col("_apps") > 0).alias("clusters"),
        total("_lines").alias("lines"),
        total("_levels").alias("lines_with_level"),
        total("_times").alias("lines_with_time"),
    )


def log_inventory(files: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct applications, log files and lines (AGG16) in one aggregate.

    ``files`` has ``file_application_id`` and ``path`` (one row per line).
    ``approximate`` uses HyperLogLog sketches, whose memory does not grow with
    the number of distinct values; else lines are grouped by file first.
    """
    named = F.when(F.col("file_application_id") != "", F.col("file_application_id"))
    if approximate:
        return files.agg(
            F.approx_count_distinct(named).alias("applications"),
            F.approx_count_distinct("path").alias("log_files"),
            F.count(F.lit(1)).alias("lines"),
        )
    per_file = files.groupBy(named.alias("_app"), "path").agg(F.count(F.lit(1)).alias("_lines"))
    per_app = per_file.groupBy("_app").agg(F.count("path").alias("_files"), F.sum("_lines").alias("_lines"))
    return per_app.agg(
        F.count("_app").alias("applications"),
        F.coalesce(F.sum("_files"), F.lit(0)).alias("log_files"),
        F.coalesce(F.sum("_lines"), F.lit(0)).alias("lines"),
    )
