from lograft.functions.parse import (  # noqa: F401
    app_number,
    cluster_start,
    component,
    ensure_parsed,
    extract,
    file_identity,
    level,
    level_loose,
    parse_lines,
    parse_log_time,
    size_to_bytes,
)
