"""Multi-line log entries and line numbers.

A header line (one that starts with a timestamp) opens an entry; the lines
after it that do not start with a timestamp (stack frames) belong to it. The
entry of a line is the last header at or before it, a running ``max`` over the
line order, computed with the bucketed prefix so no file or stream is handled
by a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft.operators.ordered import running_total


def tag_entries(
    parsed: DataFrame,
    keys: Sequence[str] = (),
    order_col: str = "event_id",
    line_col: str = "line",
    bucket_rows: int = 1 << 16,
) -> DataFrame:
    """Every line with the position of the header it belongs to (W4): ``keys...,
    order_col, line_col, log_level, entry`` (``-1`` for lines before the first header).

    Line-level and fully parallel: nothing is collected, so this is the form to
    use when entries can be arbitrarily long.
    """
    keys = list(keys)
    is_header = F.col("ts_head") != ""
    rows = parsed.select(
        *keys, order_col, line_col, "log_level",
        F.when(is_header, F.col(order_col)).alias("_hdr"),
        F.floor(F.col(order_col) / F.lit(bucket_rows)).alias("_bucket"),
        F.floor(F.col(order_col) / F.lit(bucket_rows * bucket_rows)).alias("_bucket_2"),
    )
    buckets = ["_bucket", "_bucket_2"]
    tagged = running_total(rows, keys, [F.col(order_col)], buckets, "_hdr", "entry", how="max")
    return tagged.withColumn("entry", F.coalesce(F.col("entry"), F.lit(-1))).drop("_hdr", *buckets)


def assemble_entries(
    parsed: DataFrame,
    keys: Sequence[str] = (),
    order_col: str = "event_id",
    line_col: str = "line",
    bucket_rows: int = 1 << 16,
) -> DataFrame:
    """One row per entry: ``keys..., entry_id, n_lines, log_level, text``.

    ``order_col`` is a non-negative integer position (event id or line number
    within a file named by ``keys``). Lines before the first header form their
    own entry. ``text`` joins the entry's lines with ``\\n`` in order; one entry
    (a header and its stack frames) is assembled in one task.
    """
    keys = list(keys)
    tagged = tag_entries(parsed, keys, order_col, line_col, bucket_rows)
    first = F.min_by(F.col("log_level"), F.col(order_col))
    return tagged.groupBy(*keys, "entry").agg(
        F.min(order_col).alias("entry_id"),
        F.count(F.lit(1)).alias("n_lines"),
        first.alias("log_level"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(line_col).alias("l")))),
                        lambda x: x["l"]),
            "\n",
        ).alias("text"),
    ).drop("entry")


def numbered_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line of each text with its 0-based position (T15): ``posexplode(split)``."""
    return docs.select(id_col, F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))


def line_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines, blank lines and longest line (characters) per text.

    Computed inside each row with array functions over ``split``: a narrow
    projection, no explode and no shuffle; every text is processed whole.
    """
    parts = F.split(F.col(text_col), "\n")
    return docs.select(
        id_col,
        F.size(parts).cast("bigint").alias("n_lines"),
        F.size(F.filter(parts, lambda x: F.trim(x) == "")).cast("bigint").alias("blank_lines"),
        F.array_max(F.transform(parts, lambda x: F.length(x))).cast("bigint").alias("max_line_chars"),
    )
