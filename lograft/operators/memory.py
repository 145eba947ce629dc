"""Memory and cache use over time (X6, X7, X9): what block managers hold, host by host.

A line ``Added <block> in memory on <host>`` stores a block, or replaces what the host held
under that name: the last size wins, so a host's cached bytes change by the difference.
Blocks of two applications are two blocks, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft.functions import patterns as P
from lograft.functions.parse import size_to_bytes
from lograft.operators.messages import matched, num, text
from lograft.operators.ordered import previous_row, running_totals
from lograft.session import materialize

# Order buckets of the skew-safe windows, fine to coarse.
UNITS = {"_minute": "minute", "_day": "day"}


def block_changes(parsed: DataFrame, order: Sequence[str] = ("event_id",), line_col: str = "line") -> DataFrame:
    """One row per stored block with a time: ``application_id, host, block, event_time``, the ``order``
    columns, ``size_bytes``, and what the host held of it before (``prev_size_bytes``, NULL if nothing).

    ``order``: columns that tell lines of one second apart. Lines without a time have no place
    in the order and are left out.
    """
    rows = matched(parsed, P.BLOCK_ADDED, line_col).select(
        "application_id",
        "event_time",
        *order,
        text(1).alias("block"),
        text(2).alias("host"),
        F.round(size_to_bytes(text(4), text(5))).cast("bigint").alias("size_bytes"),
    )
    rows = rows.filter(F.col("event_time").isNotNull() & F.col("size_bytes").isNotNull())
    rows = rows.withColumns({name: F.date_trunc(unit, "event_time") for name, unit in UNITS.items()})
    rows = materialize(rows)  # a small share of the lines, read by each level of the order
    return previous_row(rows, ["host", "application_id", "block"], ["event_time", *order], list(UNITS), ["size_bytes"])


def cached_over_time(changes: DataFrame, order: Sequence[str] = ("event_id",)) -> DataFrame:
    """``cached_bytes`` of the host after each stored block: the running sum of the differences."""
    delta = F.col("size_bytes") - F.coalesce("prev_size_bytes", F.lit(0))
    rows = materialize(changes.withColumn("_delta", delta))
    by = [F.col("event_time"), *map(F.col, order)]
    return running_totals(rows, ["host"], by, list(UNITS), {"cached_bytes": "_delta"}).drop("_delta", *UNITS)


def cache_peaks(cached: DataFrame, order: Sequence[str] = ("event_id",)) -> DataFrame:
    """Per host: stored and replaced blocks, the most bytes held at once and since when, and the last ones."""
    at = F.struct("event_time", *order)
    return cached.groupBy("host").agg(
        F.count(F.lit(1)).alias("num_stored"),
        F.count("prev_size_bytes").alias("num_replaced"),
        F.max("cached_bytes").alias("peak_bytes"),
        F.min_by("event_time", F.struct(F.negative("cached_bytes"), at)).alias("peak_at"),
        F.max_by("cached_bytes", at).alias("last_bytes"),
    )


def hit_share(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    """Per rdd: partitions found in the host's own memory, partitions that had to be stored, and the
    share of the former. Both kinds of lines are matched in one pass."""
    rows = matched(parsed, P.RDD_BLOCK, line_col).select(num(2).alias("rdd_id"), (text(1) == "Found block").alias("_hit"))
    counts = rows.groupBy("rdd_id").agg(
        F.count_if("_hit").alias("num_hits"), F.count_if(~F.col("_hit")).alias("num_stored")
    )
    share = F.col("num_hits") / (F.col("num_hits") + F.col("num_stored"))
    return counts.filter(F.col("rdd_id").isNotNull()).withColumn("hit_share", share)
