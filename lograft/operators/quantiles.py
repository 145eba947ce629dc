"""Per-group percentiles: approximate (sketch) and exact nearest-rank (AGG7).

``approx_percentile`` is Spark's bounded-memory sketch (partial + final merge).

``exact_percentile`` returns the k-th smallest value, ``k = ceil(p * n)`` (nearest
rank, the value of ``percentile_disc`` / ``quantile_disc``) by narrowing a range per
group. The first pass takes a sketch of two quantiles around ``p`` as the range. Each
further pass cuts the range into ``BINS`` equal parts, counts the values per part (and
below and above the range), and keeps the part that holds rank ``k``, shrunk to the
smallest and largest value in it. It ends when they are equal in every group. If the
sketch missed, the part below or above is kept and narrowed like any other.

No value is shuffled: a task sends at most ``BINS + 2`` counts of a group. The ranges
are one row per group; they are broadcast up to a number of groups (``joins.BROADCAST_GROUPS``) and joined
by a shuffle beyond that. NULL keys form groups of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lograft.operators.joins import join_groups
from lograft.session import materialize

BINS = 4096


def approx_percentile(
    df: DataFrame, keys: Sequence[str], value: str, p: float, out: str, accuracy: int = 10000
) -> DataFrame:
    return df.groupBy(*keys).agg(F.percentile_approx(value, p, accuracy).alias(out))


def rank_error(df: DataFrame, keys: Sequence[str], value: str, p: float, estimate: DataFrame, col: str) -> DataFrame:
    """``keys..., n, error``: by how much of the group the estimate's rank misses ``p`` (0 if ``p`` lies
    within the ranks of the values equal to it)."""
    v = F.col(value).cast("double")
    rows = join_groups(df.filter(v.isNotNull()), estimate, keys)
    shares = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if(v < F.col(col)) / F.count(F.lit(1))).alias("_below"),
        (F.count_if(v <= F.col(col)) / F.count(F.lit(1))).alias("_upto"),
    )
    miss = F.greatest(F.col("_below") - F.lit(p), F.lit(p) - F.col("_upto"), F.lit(0.0))
    return shares.select(*keys, "n", miss.alias("error"))


def _narrow(values: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """The part of each group's range that holds its rank, as a new range."""
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    share = F.nanvl((v / 2 - lo / 2) / (hi / 2 - lo / 2), F.lit(0.5))
    part = (
        F.when(v < lo, -1)
        .when(v > hi, BINS)
        .when(v == lo, 0)
        .when(v == hi, BINS - 1)
        .otherwise(F.least(F.floor(share * BINS), F.lit(BINS - 1)))
    )
    counts = (
        join_groups(values, ranges, keys)
        .groupBy(*keys, "_k", part.cast("int").alias("_part"))
        .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    )
    upto = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    picked = counts.withColumn("_upto", F.sum("_c").over(upto))
    picked = picked.filter((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_c") < F.col("_k")))
    return materialize(picked.select(*keys, "_k", "_lo", "_hi"))


def exact_percentile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    p: float,
    out: str,
    accuracy: int = 10000,
    band: float = 5e-4,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """``keys..., out``: nearest-rank ``p``-quantile of non-null ``value`` per group.

    ``extra``: other aggregates of ``df`` per group (aliased columns), computed
    in the same pass as the sketch and returned next to ``out``. Groups whose
    ``value`` is all NULL then still appear, with ``out`` NULL.
    """
    keys = list(keys)
    extra = list(extra)
    rows = df.withColumn("_v", F.col(value).cast("double"))
    values = rows.select(*keys, "_v").filter(F.col("_v").isNotNull())
    cuts = [max(0.0, p - band), min(1.0, p + band)]
    first = (rows if extra else values).groupBy(*keys).agg(
        F.count("_v").alias("_n"), F.percentile_approx("_v", cuts, accuracy).alias("_cuts"), *extra
    )
    stats = materialize(
        first.withColumns(
            {
                "_k": F.greatest(F.lit(1), F.least(F.col("_n"), F.ceil(F.lit(p) * F.col("_n")))),
                "_lo": F.col("_cuts")[0],
                "_hi": F.col("_cuts")[1],
            }
        ).drop("_cuts")
    )
    extra_cols = [c for c in stats.columns if c not in keys and not c.startswith("_")]
    ranges = stats.filter(F.col("_n") > 0).select(*keys, "_k", "_lo", "_hi")
    while True:
        ranges = _narrow(values, ranges, keys)
        if ranges.filter(F.col("_lo") < F.col("_hi")).isEmpty():
            break
    result = ranges.select(*keys, F.col("_lo").alias(out))
    if not extra_cols:
        return result
    return join_groups(stats.select(*keys, *extra_cols), result, keys, "left").select(*keys, out, *extra_cols)
