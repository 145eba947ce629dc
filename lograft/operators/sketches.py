"""Mergeable sketches stored as columns: one row per day or group, merged upwards (AGG7, AGG16).

A sketch of a month or of everything is the merge of the stored ones, so no level reads the
facts again, and a new day adds one row. Three kinds:

* **value sketches**: counts of values in buckets that keep a number's first ``BITS`` binary digits.
  Merging adds counts, so a merged sketch equals that of all rows, whatever the order. A quantile
  is known within its bucket: a relative error below ``2 ** (1 - BITS)``, and both bounds are given.
* **rank sketches**: Spark's KLL sketches; a quantile's rank is off by a small share of the rows.
* **distinct sketches**: Spark's HyperLogLog sketches, combined by union.

A sketch's size is bounded by its parameter, not by the rows: at most ``128 * 2 ** BITS`` buckets,
some ``3 k`` values, ``2 ** lg_k`` registers. NULL values take no part; NULL keys are a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 9
RANK_K = 400
LG_K = 14


# ---------------------------------------------------------------- value sketches
def _width(low: Column, bits: int) -> Column:
    """The width of the bucket that begins at ``low >= 0``: its numbers share their first ``bits`` digits."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.greatest(F.lit(0), F.length(F.bin(low)) - F.lit(bits)))


def _bucket(x: Column, bits: int) -> Column:
    """The end nearest to 0 of the bucket that holds a whole number."""
    size = F.abs(x)
    return F.signum(x).cast("bigint") * (size - size % _width(size, bits))


def _mapped(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    entries = F.collect_list(F.struct("_bucket", "_count"))  # bounded by the number of buckets
    return counts.groupBy(*keys).agg(F.sum("_count").alias("n"), F.map_from_entries(entries).alias("sketch"))


def value_sketches(df: DataFrame, keys: Sequence[str], value: str, scale: int = 100, bits: int = BITS) -> DataFrame:
    """``keys, n, sketch``: the counts of ``round(value * scale)`` by bucket, as a map column."""
    x = F.round(F.col(value) * scale).cast("bigint")
    rows = df.filter(F.col(value).isNotNull()).select(*keys, _bucket(x, bits).alias("_bucket"))
    return _mapped(rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_count")), keys)


def merge_values(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups: ``keys`` are some (or none) of the stored ones'."""
    rows = stored.select(*keys, F.explode("sketch").alias("_bucket", "_one"))
    return _mapped(rows.groupBy(*keys, "_bucket").agg(F.sum("_one").alias("_count")), keys)


def value_bounds(p: float, sketch: str = "sketch", n: str = "n", scale: int = 100, bits: int = BITS) -> tuple[Column, Column]:
    """The least and the greatest value that the nearest-rank ``p``-quantile of a sketch may have."""
    entries = F.array_sort(F.map_entries(F.col(sketch)))
    rank = F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col(n)))
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("key"))
    at = F.aggregate(
        entries,
        start,
        lambda acc, e: F.when(acc["seen"] >= rank, acc).otherwise(
            F.struct((acc["seen"] + e["value"]).alias("seen"), e["key"].alias("key"))
        ),
        lambda acc: acc["key"],
    )
    far = at + F.signum(at).cast("bigint") * (_width(F.abs(at), bits) - 1)
    return F.least(at, far) / F.lit(scale), F.greatest(at, far) / F.lit(scale)


# ---------------------------------------------------------------- rank sketches
def rank_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = RANK_K) -> DataFrame:
    """``keys, sketch``: a KLL sketch of each group's values."""
    v = F.col(value).cast("double")
    return df.filter(v.isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"))


def merge_ranks(stored: DataFrame, keys: Sequence[str], k: int = RANK_K) -> DataFrame:
    return stored.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def rank_quantile(p: float, sketch: str = "sketch") -> Column:
    """The estimated ``p``-quantile of a rank sketch."""
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(p))


# ---------------------------------------------------------------- distinct sketches
def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """``keys, sketch``: a HyperLogLog sketch of each group's distinct values."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch"))


def merge_distinct(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stored.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimate(sketch: str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def distinct_error(lg_k: int = LG_K) -> float:
    """Three standard errors of an estimate, as a share of the true count."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


# ---------------------------------------------------------------- levels
def month_and_all(stored: DataFrame, merge) -> DataFrame:
    """The stored sketches of days, merged to months, and these merged to one: ``level, dt_year, dt_month``
    and the sketch's columns."""
    months = merge(stored, ["dt_year", "dt_month"])
    rest = [c for c in months.columns if c not in ("dt_year", "dt_month")]
    none = F.lit(None).cast("int")
    return months.select(F.lit("month").alias("level"), "dt_year", "dt_month", *rest).unionByName(
        merge(months, []).select(F.lit("all").alias("level"), none.alias("dt_year"), none.alias("dt_month"), *rest)
    )
