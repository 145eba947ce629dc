"""Ordered computations (running totals, previous row) that stay parallel under skew.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one
task; when one key holds a third of the data that task is the whole job. Here
the order is cut into *buckets*, from fine to coarse (monotone functions of the
ordering column, such as the minute and the day of a timestamp):

1. the per-row work runs in windows partitioned by key and fine bucket;
2. one summary row per key and fine bucket is aggregated map-side;
3. the summaries are treated the same way within the next coarser bucket, and so
   on; only the coarsest ones meet in a window per key. What came before a bucket
   is joined back to its rows.

The result equals the single-window result; the largest task holds one fine bucket
or the summaries inside one coarser bucket. Rows with NULL keys form groups of their
own, and rows whose order (and so bucket) is NULL come first, as in a plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lograft.session import materialize

_COMBINE = {"sum": F.sum, "max": F.max, "min": F.min}


def _rejoin(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys``, NULL matching NULL. Every key is in ``summary`` once."""
    other = summary.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in summary.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return rows.join(other, on).drop(*[f"_r_{k}" for k in keys])


def _merged(how: str, before: Column, own: Column) -> Column:
    if how == "sum":
        return F.when(before.isNull(), own).when(own.isNull(), before).otherwise(before + own)
    return F.coalesce((F.greatest if how == "max" else F.least)(before, own), before, own)


def _before(summary: DataFrame, keys: list[str], buckets: list[str], names: list[str], how: str) -> DataFrame:
    """``keys, buckets[0], b_<name>``: the total of each name over all earlier buckets of the key."""
    combine = _COMBINE[how]
    fine, coarser = buckets[0], buckets[1:]
    window = Window.partitionBy(*keys, *coarser[:1]).orderBy(fine).rowsBetween(Window.unboundedPreceding, -1)
    local = summary.select(*keys, *buckets, *[combine(n).over(window).alias(f"b_{n}") for n in names])
    if not coarser:
        return local
    upper = summary.groupBy(*keys, *coarser).agg(*[combine(n).alias(n) for n in names])
    upper = _before(upper, keys, coarser, names, how)
    upper = upper.select(*keys, coarser[0], *[F.col(f"b_{n}").alias(f"u_{n}") for n in names])
    joined = _rejoin(local, upper, [*keys, coarser[0]])
    return joined.select(
        *keys, *buckets, *[_merged(how, F.col(f"u_{n}"), F.col(f"b_{n}")).alias(f"b_{n}") for n in names]
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: str | Sequence[str],
    outputs: dict[str, str],
    how: str = "sum",
) -> DataFrame:
    """For each ``out -> value`` in ``outputs``: ``out`` = ``how``-aggregate of
    ``value`` over the rows of the same ``keys`` up to and including this row
    in ``order``. All outputs share the bucket summaries, windows and joins.

    ``bucket`` names one or several columns, fine to coarse, each non-decreasing
    along ``order`` and constant within every finer bucket; ``order`` must be a
    total order within ``keys`` for the result to be deterministic.
    """
    combine = _COMBINE[how]
    keys, buckets = list(keys), [bucket] if isinstance(bucket, str) else list(bucket)
    inner = Window.partitionBy(*keys, *buckets).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    names = [f"_t{i}" for i in range(len(outputs))]
    summary = df.groupBy(*keys, *buckets).agg(
        *[combine(v).alias(n) for n, v in zip(names, outputs.values(), strict=True)]
    )
    if len(buckets) > 1:  # read at each level: one row per fine bucket, computed once
        summary = materialize(summary)
    offsets = _before(summary, keys, buckets, names, how)
    local = df.withColumns({f"_l{n}": combine(v).over(inner) for n, v in zip(names, outputs.values(), strict=True)})
    out = _rejoin(local, offsets, [*keys, *buckets])
    out = out.withColumns(
        {o: _merged(how, F.col(f"b_{n}"), F.col(f"_l{n}")) for n, o in zip(names, outputs, strict=True)}
    )
    return out.drop(*[f"_l{n}" for n in names], *[f"b_{n}" for n in names])


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: str | Sequence[str],
    value: str,
    out: str,
    how: str = "sum",
) -> DataFrame:
    """Single-output form of ``running_totals``."""
    return running_totals(df, keys, order, bucket, {out: value}, how)


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: str | Sequence[str],
    values: Sequence[str],
    prefix: str = "prev_",
) -> DataFrame:
    """Add ``prefix + v`` = value of ``v`` on the previous row within ``keys`` by ``order``
    (NULL on the first row), like ``lag`` over ``partitionBy(keys).orderBy(order)``.

    ``order`` must be a total order within ``keys``; ``bucket`` as in ``running_totals``.
    """
    keys, values = list(keys), list(values)
    buckets = [bucket] if isinstance(bucket, str) else list(bucket)
    inner = Window.partitionBy(*keys, *buckets).orderBy(*order)
    local = df.withColumn("_pos", F.row_number().over(inner))
    for v in values:
        local = local.withColumn(f"_lag_{v}", F.lag(v).over(inner))
    last = df.groupBy(*keys, *buckets).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
    if len(buckets) > 1:
        last = materialize(last)
        carry = previous_row(last, keys, [buckets[0]], buckets[1:], ["_last"], "_carry").drop("_last")
        carry = carry.withColumnRenamed("_carry_last", "_carry")
    else:
        window = Window.partitionBy(*keys).orderBy(buckets[0])
        carry = last.withColumn("_carry", F.lag("_last").over(window)).drop("_last")
    out = _rejoin(local, carry, [*keys, *buckets])
    for v in values:
        out = out.withColumn(
            prefix + v, F.when(F.col("_pos") == 1, F.col("_carry")[v]).otherwise(F.col(f"_lag_{v}"))
        )
    return out.drop("_pos", "_carry", *[f"_lag_{v}" for v in values])
