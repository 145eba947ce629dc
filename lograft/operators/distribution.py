"""Duration distribution of the busiest cluster: histogram and density (AGG19, AGG20, J3, J5, SRT7)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft.operators.joins import join_groups
from lograft.operators.timeline import with_duration


def top_cluster(summary: DataFrame) -> DataFrame:
    """The cluster with the most applications, ties to the smallest id (SRT7). One row."""
    return summary.orderBy(F.desc("num_applications"), F.asc("cluster_id")).limit(1).select("cluster_id")


def top_cluster_durations(timeline: DataFrame, summary: DataFrame) -> DataFrame:
    """Durations (seconds) of the applications of the busiest cluster.

    Semi join against a one-row frame: broadcasting it is safe by construction.
    """
    apps = with_duration(timeline)
    return apps.join(F.broadcast(top_cluster(summary)), "cluster_id", "left_semi").select(
        "cluster_id", "application_id", F.col("duration_sec").cast("double").alias("x")
    ).filter(F.col("x").isNotNull())


def all_durations(timeline: DataFrame) -> DataFrame:
    """Durations (seconds) of every cluster's applications, for one distribution per cluster."""
    return with_duration(timeline).select(
        "cluster_id", "application_id", F.col("duration_sec").cast("double").alias("x")
    ).filter(F.col("x").isNotNull())


def _stats(values: DataFrame) -> DataFrame:
    return values.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("x").alias("lo"),
        F.max("x").alias("hi"),
        F.stddev_samp("x").alias("sd"),
    )


def _weighted(values: DataFrame) -> DataFrame:
    """Equal values of a cluster as one row with their number (durations are whole seconds)."""
    return values.groupBy("cluster_id", "x").agg(F.count(F.lit(1)).alias("_w"))


def histogram(values: DataFrame, bins: int = 30, log_scale: bool = False) -> DataFrame:
    """Equal-width bins over ``[min, max]`` of ``x`` per ``cluster_id``; last bin right-closed.

    Empty bins are kept (zero count). With ``log_scale`` the bins are equal in
    ``log10(1 + x)`` and the edges are reported back in ``x`` units. Equal values are
    counted first; the one row of a cluster's bounds goes to them.
    """
    v = values.withColumn("x", F.log10(F.lit(1.0) + F.col("x"))) if log_scale else values
    weighted = _weighted(v)
    stats = weighted.groupBy("cluster_id").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = F.col("hi") - F.col("lo")
    raw = F.floor((F.col("x") - F.col("lo")) * F.lit(float(bins)) / width)
    binned = join_groups(weighted, stats, ["cluster_id"]).withColumn(
        "bin", F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    )
    counts = binned.groupBy("cluster_id", "bin").agg(F.sum("_w").alias("count"))
    edges = stats.select(
        "cluster_id", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).select(
        "cluster_id",
        "bin",
        (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("bin_hi"),
    )
    if log_scale:
        edges = edges.withColumns(
            {
                "bin_lo": F.round(F.pow(F.lit(10.0), F.col("bin_lo")) - F.lit(1.0), 6),
                "bin_hi": F.round(F.pow(F.lit(10.0), F.col("bin_hi")) - F.lit(1.0), 6),
            }
        )
    return edges.join(counts, ["cluster_id", "bin"], "left").select(
        "cluster_id", "bin", "bin_lo", "bin_hi", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")
    )


def density(values: DataFrame, points: int = 200, cut: float = 3.0, digits: int = 12) -> DataFrame:
    """Gaussian kernel density of ``x`` per ``cluster_id`` on an even grid (AGG20).

    Bandwidth by Scott's rule ``h = sd * n^(-1/5)``; the grid spans
    ``[min - cut*h, max + cut*h]`` in ``points`` steps. Equal values are counted first;
    each distinct one emits a row per grid point, summed map-side by grid point, so the
    work is ``points`` x distinct values. Needs at least two distinct values.
    """
    weighted = _weighted(values)
    stats = (
        _stats(values)
        .withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
        .filter(F.col("h") > 0)
        .withColumn("g_lo", F.col("lo") - F.lit(cut) * F.col("h"))
        .withColumn("g_step", (F.col("hi") - F.col("lo") + F.lit(2 * cut) * F.col("h")) / F.lit(float(points - 1)))
    )
    grid = join_groups(weighted, stats.select("cluster_id", "n", "h", "g_lo", "g_step"), ["cluster_id"])
    grid = grid.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    gx = F.col("g_lo") + F.col("point") * F.col("g_step")
    z = (gx - F.col("x")) / F.col("h")
    summed = grid.groupBy("cluster_id", "point", "n", "h", "g_lo", "g_step").agg(
        F.sum(F.col("_w") * F.exp(F.lit(-0.5) * z * z)).alias("k")
    )
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2.0 * math.pi))
    return summed.select(
        "cluster_id",
        "point",
        F.round(F.col("g_lo") + F.col("point") * F.col("g_step"), 6).alias("x"),
        F.round(F.col("k") / norm, digits).alias("density"),
    )
