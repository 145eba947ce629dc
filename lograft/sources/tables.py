"""Parquet and CSV sources (SRC3-SRC6, SRC9-SRC11)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table(spark: SparkSession, root: str, name: str, spread: int | None = None) -> DataFrame:
    """One driver table: ``<root>/<name>.parquet``. ``spread`` deals the rows over that many
    tasks first: a caller's choice, for files that can't be split."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return df.repartition(spread) if spread else df


def parquet_set(
    spark: SparkSession, paths: Iterable[str], merge_schema: bool = False, ignore_missing: bool = False
) -> DataFrame:
    """Several Parquet files or directories read as one table (SRC3, implicit UNION ALL).

    ``ignore_missing`` skips files that vanish between listing and reading
    (SRC7: a month that failed to arrive does not fail the job).
    """
    paths = list(paths)
    if not paths:
        raise ValueError("no input paths")
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if ignore_missing:
        reader = reader.option("ignoreMissingFiles", "true")
    return reader.parquet(*paths)


def partitioned_parquet(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Read a ``key=value`` partitioned tree with ``basePath`` so the keys stay
    columns and filters on them prune directories (SRC4)."""
    reader = spark.read.option("basePath", root)
    return reader.parquet(f"{root.rstrip('/')}/{glob}" if glob else root)


def rows_of_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows of ``df`` whose partition column ``on`` is among ``keys`` (SRC4). Where the keys are few, their
    values are found first and prune the partitions that are read (dynamic partition pruning): a
    selective filter on ``keys``, or its measured size, lets Spark plan it."""
    return df.join(keys.select(on).distinct(), on, "left_semi")


def month_paths(root: str, months: Iterable[tuple[int, int]], template: str) -> list[str]:
    """Month list -> file paths by a template with ``{root} {year} {month:02d}`` (SRC6)."""
    return [template.format(root=root.rstrip("/"), year=y, month=m) for y, m in months]


def csv_with_schema(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """CSV with an explicit schema and header (SRC11): no inference pass, ids stay text."""
    reader = spark.read.schema(schema).option("header", "true")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


TIMELINE_SCHEMA = T.StructType(
    [
        T.StructField("cluster_id", T.StringType()),
        T.StructField("application_id", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
    ]
)

CLUSTER_SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("cluster_id", T.StringType()),
        T.StructField("num_applications", T.LongType()),
        T.StructField("cluster_first_app", T.TimestampNTZType()),
        T.StructField("cluster_last_app", T.TimestampNTZType()),
    ]
)


def id_range(spark: SparkSession, n: int) -> DataFrame:
    """``id`` 0..n-1 (SRC9), e.g. to check a session end to end."""
    return spark.range(n)


def sql_on(spark: SparkSession, df: DataFrame, view: str, query: str) -> DataFrame:
    """Register ``df`` as a temp view and run SQL on it (SRC10)."""
    df.createOrReplaceTempView(view)
    return spark.sql(query)
