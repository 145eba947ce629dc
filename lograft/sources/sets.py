"""Sets of Parquet files that are not all there, not all whole or not all alike (SRC3, SRC7)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lograft.sources.logs import clean_path, list_files

_TOLERANT = {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}


def availability(spark: SparkSession, root: str, names: Iterable[str]) -> DataFrame:
    """``name, path, length``: the wanted files below ``root`` next to its listing; the last two are NULL
    for a file that isn't there."""
    wanted = spark.createDataFrame([(n,) for n in names], "name string")
    listed = list_files(spark, root).select("path", "length")
    at = F.concat(F.lit(clean_path(root.rstrip("/")) + "/"), F.col("name"))
    return wanted.join(listed, F.col("path") == at, "left")


def read_available(
    spark: SparkSession, root: str, names: Sequence[str], schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """The rows of those wanted Parquet files that can be read, and what became of each file.

    The report has ``name, outcome, rows``: ``read``; ``missing`` (not in the listing); ``corrupt`` (its
    footer can't be read); ``partial`` (fewer rows could be read than its footer counts). A file
    of no rows is ``read``. ``schema`` is given, as a corrupt file has none to infer; columns that
    a file lacks are NULL. Both frames read tolerant of files that are or go bad (SRC7: a month that
    failed to arrive does not fail the job).
    """
    found = availability(spark, root, names)
    paths = [r["path"] for r in found.where("path is not null").select("path").toLocalIterator()]  # a row per wanted file
    reader = spark.read.options(**_TOLERANT).schema(schema)
    rows = reader.parquet(*paths) if paths else spark.createDataFrame([], schema)
    if not paths:
        return rows, found.select("name", F.lit("missing").alias("outcome"), F.lit(None).cast("bigint").alias("rows"))

    own = rows.select(clean_path(F.col("_metadata.file_path")).alias("path"), *schema.names)
    whole = own.groupBy("path").agg(F.count(F.lit(1)).alias("counted"))  # reads footers only
    mark = F.xxhash64(*schema.names)  # reads every column
    delivered = own.groupBy("path").agg((F.count_if(mark == 0) + F.count_if(mark != 0)).alias("rows"))
    footers = spark.createDataFrame([(p, _has_footer(spark, p)) for p in paths], "path string, footer boolean")
    seen = found.join(whole, "path", "left").join(delivered, "path", "left").join(footers, "path", "left")
    outcome = (
        F.when(F.col("length").isNull(), "missing")
        .when(~F.col("footer"), "corrupt")
        .when(F.coalesce("rows", F.lit(0)) < F.coalesce("counted", F.lit(0)), "partial")
        .otherwise("read")
    )
    read = F.when(outcome.isin("read", "partial"), F.coalesce("rows", F.lit(0)))
    return rows, seen.select("name", outcome.alias("outcome"), read.cast("bigint").alias("rows"))


def _has_footer(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet file's footer can be read (what schema inference reads)."""
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    try:
        spark.read.parquet(path)
    except (PySparkException, Py4JJavaError):
        return False
    return True


# ---------------------------------------------------------------- schemas that differ
class SchemaConflict(ValueError):
    """Two files hold a column in types that no wider type covers."""


_NUMBERS = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds both, or None. Numbers widen as far as double (whole numbers beyond 2**53 lose
    digits there); a timestamp with a zone becomes one without (in UTC), a date a timestamp without."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    x, y = a.simpleString(), b.simpleString()
    if x in _NUMBERS and y in _NUMBERS:
        if "float" in (x, y) and {x, y} & {"int", "bigint"}:
            return T.DoubleType()  # a float holds whole numbers up to 2**24 only
        return max(a, b, key=lambda t: _NUMBERS.index(t.simpleString()))
    if {x, y} <= {"timestamp", "timestamp_ntz", "date"}:
        return T.TimestampNTZType()
    return None


def union_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of several schemas by name, in the order in which they first occur, each as wide as needed."""
    found: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            kind = wider(found.get(f.name, f.dataType), f.dataType)
            if kind is None:
                raise SchemaConflict(f"{f.name}: {found[f.name].simpleString()} and {f.dataType.simpleString()}")
            found[f.name] = kind
    return T.StructType([T.StructField(n, t) for n, t in found.items()])


def _fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema}
    columns = []
    for f in schema:
        if f.name not in kinds:
            column = F.lit(None).cast(f.dataType)
        elif kinds[f.name].simpleString() == "timestamp" and f.dataType.simpleString() == "timestamp_ntz":
            micros = F.unix_micros(F.col(f.name))  # the instant in UTC, whatever the session's zone
            column = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=micros / F.lit(1_000_000).cast("decimal(20,6)"))
        else:
            column = F.col(f.name).cast(f.dataType)
        columns.append(column.alias(f.name))
    return df.select(*columns)


def union_by_name(spark: SparkSession, paths: Sequence[str], source: str | None = None) -> DataFrame:
    """Several Parquet files or directories as one table by column name (SRC3), where ``mergeSchema`` refuses:
    columns that a file lacks are NULL there, and types are widened. Raises ``SchemaConflict`` where no
    type holds both. Files of one schema are read together, each group with its own pruned and
    filtered scan; ``source`` names a column for the file's path."""
    if not paths:
        raise ValueError("no input paths")
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for path in paths:
        schema = spark.read.parquet(path).schema
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    target = union_schema([s for s, _ in groups.values()])
    out = None
    for schema, own in groups.values():
        df = spark.read.schema(schema).parquet(*own)
        part = _fitted(df, target)
        if source:
            part = _fitted(df.withColumn(source, clean_path(F.col("_metadata.file_path"))), T.StructType([*target.fields, T.StructField(source, T.StringType())]))
        out = part if out is None else out.unionByName(part)
    return out
