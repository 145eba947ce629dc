"""Text log sources (SRC1, SRC2, SRC12, T15, T24)."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lograft.functions.parse import file_identity


def read_log_lines(spark: SparkSession, path: str, glob: str | None = "*.log", with_path: bool = False) -> DataFrame:
    """Every line of every log file below ``path``, nested directories included (SRC1).

    ``recursiveFileLookup`` walks ``application_*/`` sub-directories; many small
    files are packed into splits by ``spark.sql.files.maxPartitionBytes`` and
    ``openCostInBytes``. The line is column ``line``; ``path`` is added from
    the file metadata when asked for (T24).
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.text(path)
    if with_path:
        df = df.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"))
    else:
        df = df.withColumnRenamed("value", "line")
    return df


def read_log_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Lines of files matching a glob such as ``data/application_*/*.log`` (SRC2)."""
    return spark.read.text(pattern).withColumnRenamed("value", "line")


def read_ordered_lines(spark: SparkSession, path: str, glob: str | None = "*.log") -> DataFrame:
    """``path, line_no, line`` with 0-based line numbers, without reading files whole.

    The text source reads each split of a file in order, and a line belongs to
    exactly one split (the one it starts in). A line's number is the count of
    lines in the earlier splits of its file (a small per-split count and a
    window over the few splits of each file) plus its position inside its
    split (``monotonically_increasing_id`` is contiguous within one split).
    Files of any size are numbered in parallel, one task per split.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_rid"),
        F.col("value").alias("line"),
    )
    splits = rows.groupBy("path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_rid").alias("_first"))
    before = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return rows.join(splits.drop("_n"), ["path", "_block"]).select(
        "path", (F.col("_offset") + F.col("_rid") - F.col("_first")).alias("line_no"), "line"
    )


def with_file_identity(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Add application, container, attempt and role parsed from the file path."""
    return df.withColumns(file_identity(path_col))


def clean_path(path: str | Column) -> str | Column:
    """A path with a single slash after ``file:``, and no scheme at all for a local one: listings, file
    metadata and callers write local paths in different ways."""
    if isinstance(path, str):
        return re.sub(r"^file:/+", "/", path)
    return F.regexp_replace(path, r"^file:/+", "/")


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path, length, modificationTime`` of every file below ``path`` without reading
    contents (SRC12): the ``binaryFile`` source with the content column pruned."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(clean_path(F.col("path")).alias("path"), "length", "modificationTime")


def file_inventory(spark: SparkSession, path: str, glob: str | None = "*.log") -> DataFrame:
    """``path, length, lines`` and the identity of every file below ``path`` (AGG16, SRC12), taken from the
    listing: files without a line and files that can't be read count too, as they do for ``find``.

    ``lines`` is 0 for an empty file and NULL for one that holds bytes of which none could be read. The
    lines are counted per file in each task before they meet the listing. The names pass through the
    driver, whose file index holds them for any read of the tree.
    """
    tolerant = {"recursiveFileLookup": "true", "ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}
    if glob:
        tolerant["pathGlobFilter"] = glob
    text = spark.read.options(**tolerant).text(path)
    at = clean_path(F.col("_metadata.file_path")).alias("path")
    counted = text.groupBy(at).agg(F.count(F.lit(1)).alias("lines"))
    # scans leave out empty files, so the names come from the file index that the read has made
    names = spark.createDataFrame([(clean_path(f),) for f in text.inputFiles()], "path string")
    sizes = spark.read.format("binaryFile").options(**tolerant).load(path).select(at, "length")
    files = names.join(sizes, "path", "left").join(counted, "path", "left")
    files = files.withColumn("length", F.coalesce("length", F.lit(0).cast("bigint")))
    lines = F.coalesce("lines", F.when(F.col("length") == 0, F.lit(0).cast("bigint")))
    return with_file_identity(files.withColumn("lines", lines))


def inventory_totals(files: DataFrame) -> DataFrame:
    """Applications, files, empty and unread files, bytes and lines of a ``file_inventory``."""
    named = F.when(F.col("file_application_id") != "", F.col("file_application_id"))
    per_app = files.groupBy(named.alias("_app")).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("length") == 0).alias("empty"),
        F.count_if(F.col("lines").isNull()).alias("unread"),
        F.sum("length").alias("bytes"),
        F.sum("lines").alias("lines"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per_app.agg(
        F.count("_app").alias("applications"), total("files").alias("log_files"), total("empty").alias("empty_files"),
        total("unread").alias("unread_files"), total("bytes").alias("bytes"), total("lines").alias("lines"),
    )


def read_application(spark: SparkSession, root: str, application_id: str, glob: str | None = "*.log") -> DataFrame:
    """The lines of one application (SRC14): its directory is named before anything is listed, so the other
    applications' files are neither listed nor read. ``line`` and ``path``."""
    if not re.fullmatch(r"application_\d+_\d+", application_id):
        raise ValueError(f"not an application id: {application_id!r}")
    return read_log_lines(spark, f"{root.rstrip('/')}/{application_id}", glob, with_path=True)


def check_path(spark: SparkSession, path: str) -> dict:
    """Diagnose a source path: exists / file count / error class (SRC12)."""
    try:
        files = list_files(spark, path)
        n = files.count()
        return {"path": path, "exists": True, "files": n, "error": None}
    except AnalysisException as exc:
        cond = exc.getCondition() if hasattr(exc, "getCondition") else None
        return {"path": path, "exists": False, "files": 0, "error": cond or type(exc).__name__}
