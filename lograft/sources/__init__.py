from lograft.sources.event_lines import log_lines_from_events  # noqa: F401
from lograft.sources.logs import (  # noqa: F401
    check_path,
    list_files,
    read_log_glob,
    read_log_lines,
    read_ordered_lines,
    with_file_identity,
)
from lograft.sources.tables import csv_with_schema, parquet_set, partitioned_parquet, table  # noqa: F401
