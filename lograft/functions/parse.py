"""Column expressions that turn raw log text into typed columns.

All of them are built-in Spark expressions (regexp_extract, try_to_timestamp,
CASE), so they run inside whole-stage code generation and never leave the JVM.
A regex that does not match yields ``''``, a bad timestamp yields NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lograft.functions import patterns as P


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def extract(col: str | Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(_c(col), pattern, group)


def parse_log_time(text: str | Column) -> Column:
    """``yy/MM/dd HH:mm:ss`` text -> TIMESTAMP_NTZ (NULL when unparsable).

    The log format carries no zone: the text is read as UTC and written out as UTC,
    whatever the session's zone.
    """
    at_utc = F.try_to_timestamp(F.concat(_c(text), F.lit(" +0000")), F.lit(P.TS_FORMAT + " Z"))
    return _zone_free(F.unix_seconds(at_utc))


def _zone_free(seconds: Column) -> Column:
    """Seconds since the epoch as a TIMESTAMP_NTZ in UTC."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def parse_log_time_strict(text: str | Column) -> Column:
    """Strict parse (T9): raises ``CANNOT_PARSE_TIMESTAMP`` on bad text under ANSI
    mode, also on ``''``. Only for columns already known to hold valid times;
    raw log text goes through ``parse_log_time``."""
    return F.to_timestamp(_c(text), P.TS_FORMAT).cast("timestamp_ntz")


def level(line: str | Column) -> Column:
    """First whole-word level token anywhere in the line."""
    return extract(line, P.LEVEL_WORD)


def level_loose(line: str | Column) -> Column:
    """First level token without word boundaries (T3): INFORMATION counts as INFO."""
    return extract(line, P.LEVEL_LOOSE)


def component(line: str | Column) -> Column:
    """Text between the (loose) level and the next colon (T4)."""
    return extract(line, P.COMPONENT, 2)


def app_number(application_id: str | Column) -> Column:
    """``application_<cluster>_0052`` -> ``'0052'`` (kept as text, T12)."""
    return extract(application_id, P.APP_NUMBER)


def size_to_bytes(number: str | Column, unit: str | Column) -> Column:
    """``('4.0', 'MB')`` -> 4194304.0: size text of block-manager lines as bytes."""
    factor = F.lit(None).cast("double")
    for name, mult in P.SIZE_UNITS.items():
        factor = F.when(_c(unit) == name, F.lit(float(mult))).otherwise(factor)
    return _c(number).try_cast("double") * factor


def cluster_start(cluster_id: str | Column) -> Column:
    """The cluster id is the resource manager start in epoch milliseconds."""
    return _zone_free((_c(cluster_id).cast("decimal(18,0)") / F.lit(1000)).cast("decimal(18,6)"))


def parse_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Add the parsed columns of every log line.

    Columns are only computed when a later operator uses them: Catalyst prunes
    unused projections, so adding them all here costs nothing.
    """
    line = F.col(line_col)
    ts_text = extract(line, P.TS_ANY)
    return lines.withColumns(
        {
            "ts_head": extract(line, P.TS_HEAD),
            "log_level": level(line),
            "level_loose": level_loose(line),
            "component": component(line),
            "cluster_id": extract(line, P.CLUSTER_IN_APP),
            "application_id": extract(line, P.APPLICATION),
            "event_time": parse_log_time(ts_text),
        }
    )


PARSED_COLUMNS = ("ts_head", "log_level", "level_loose", "component", "cluster_id", "application_id", "event_time")


def ensure_parsed(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``lines`` with the parsed columns: parsed here unless they are already
    present (a staged table written by ``python -m lograft stage``)."""
    if all(c in lines.columns for c in PARSED_COLUMNS):
        return lines
    return parse_lines(lines, line_col)


def with_identity(parsed: DataFrame, path_col: str = "path") -> DataFrame:
    """The application of every line by its file's path, else by the ids in its text; with the
    attempt and container that the path names (``''`` where it names none).

    Lines of the documented format name no application themselves: the path does. It is matched
    once per line, behind a generator of one row.
    """
    names = F.struct(extract(path_col, P.APP_IN_PATH).alias("_app"), extract(path_col, P.CONTAINER).alias("_container"))
    parsed = parsed.select("*", F.inline(F.array(names)))
    of_file = _identity(F.col("_app"), F.col("_container"))
    app = F.when(of_file["file_application_id"] != "", of_file["file_application_id"]).otherwise(F.col("application_id"))
    return parsed.withColumns(
        {
            **of_file,
            "application_id": app,
            "cluster_id": extract(app, P.CLUSTER_IN_APP),
        }
    ).drop("_app", "_container")


def file_identity(path: str | Column) -> dict[str, Column]:
    """Application, container, attempt and role from a log file path."""
    return _identity(extract(path, P.APP_IN_PATH), extract(path, P.CONTAINER))


def _identity(app: Column, container: Column) -> dict[str, Column]:
    number = F.split_part(container, F.lit("_"), F.lit(5))
    return {
        "file_application_id": F.when(app == "", F.lit("")).otherwise(F.concat(F.lit("application_"), app)),
        "container_id": container,
        "attempt": F.split_part(container, F.lit("_"), F.lit(4)),
        "container_number": number,
        "container_role": F.when(container == "", F.lit(None))
        .when(number == P.AM_CONTAINER, F.lit("AM"))
        .otherwise(F.lit("EXECUTOR")),
    }
