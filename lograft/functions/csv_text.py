"""CSV text as a column (SNK1-SNK3, SRC11): rows to lines and lines to rows inside the engine.

Fields are quoted where they hold a comma, a quote or a line break, and quotes inside are
doubled; a NULL is an empty field and an empty string is ``""``, so both come back as they
were (a text of one NUL character comes back empty). White space is kept. Timestamps are written as ISO with milliseconds and zone unless a
format is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_WITH_ZONE = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
MALFORMED = "_malformed"
_EMPTY = "\x00"  # what a quoted empty field is read as, to tell it from a NULL
_FORM = {
    "quote": '"',
    "escape": '"',
    "emptyValue": '""',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _options(timestamp_format: str | None, **more: str) -> dict[str, str]:
    form = timestamp_format or ISO_WITH_ZONE
    zone_free = form if timestamp_format else form.replace("XXX", "")
    return {**_FORM, "timestampFormat": form, "timestampNTZFormat": zone_free, **more}


def csv_line(*columns: str | Column, timestamp_format: str | None = None) -> Column:
    """One CSV line of the given columns. A TIMESTAMP_NTZ has no zone to write unless it is cast to TIMESTAMP."""
    return F.to_csv(F.struct(*columns), _options(timestamp_format))


def header(df: DataFrame) -> str:
    return ",".join(df.columns)


def csv_rows(
    lines: DataFrame, schema: T.StructType, line_col: str = "value", timestamp_format: str | None = None
) -> DataFrame:
    """The fields of CSV lines by an explicit schema; ``_malformed`` holds the line where it does not fit
    (too few or too many fields, text that is no number or time), else NULL."""
    full = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    options = _options(timestamp_format, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED, emptyValue=_EMPTY)
    row = F.from_csv(F.col(line_col), full.simpleString()[len("struct<") : -1].replace(":", " "), options)
    fields = lines.select(F.explode(F.array(row)).alias("_row")).select("_row.*")
    text = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    return fields.withColumns({c: F.when(F.col(c) == _EMPTY, "").otherwise(F.col(c)) for c in text})
