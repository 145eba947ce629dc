"""Independent DuckDB SQL for every catalog key (the correctness oracle).

Each string runs on DuckDB with the driver tables registered as views. The
log-line view is written again here in DuckDB SQL from the same rule as
``lograft.sources.event_lines``. The oracle's timestamp regex uses one literal
space: DuckDB's ``strptime`` accepts a double space that Spark rejects, so both
sides give NULL for such lines.
"""

from __future__ import annotations


def _s(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def _app(n: str) -> str:
    return f"('application_' || {_s(f'1485248649253 + ({n}) % 6')} || '_' || lpad({_s(n)}, 4, '0'))"


_TASK = f"""task ' || {_s('i // 13 % 2')} || '.' || {_s('i // 3900 % 4')} || ' in stage ' || {_s('i // 26 % 5 + 5 * (i // 15600)')} || '.' || {_s('i // 130 % 2')} || ' (TID '"""

_MSG = f"""CASE i % 13
  WHEN 0 THEN 'executor.Executor: Running {_TASK} || {_s('i')} || ')'
  WHEN 1 THEN 'executor.Executor: Finished {_TASK} || {_s('i - 1')} || '). ' || {_s('1000 + i % 900')} || ' bytes result sent to driver'
  WHEN 2 THEN 'python.PythonRunner: Times: total = ' || {_s('i % 5000')} || ', boot = ' || {_s('i % 70')} || ', init = ' || {_s('i % 50')} || ', finish = ' || {_s('i % 900')}
  WHEN 3 THEN 'YarnAllocator: Will request ' || {_s('1 + i % 16')} || ' executor containers, each with ' || {_s('1 + i % 5')} || ' cores and ' || {_s('1024 * (1 + i % 28)')} || ' MB memory' || CASE WHEN i % 2 = 0 THEN ' including 2560 MB overhead' ELSE '' END
  WHEN 4 THEN 'YarnAllocator: Container request (host: ' || CASE WHEN i % 3 = 0 THEN 'Any' ELSE 'node-' || {_s('i % 4')} END || ', capability: <memory:' || {_s('1024 * (1 + i % 28)')} || ', vCores:' || {_s('1 + i % 5')} || '>)'
  WHEN 5 THEN 'rdd.HadoopRDD: Input split: hdfs://10.0.0.1:9000/in/f' || {_s('i % 9')} || '.txt:' || {_s('i * 100')} || '+' || {_s('1000 + i % 500')}
  WHEN 6 THEN 'storage.MemoryStore: MemoryStore started with capacity ' || {_s('1 + i % 30')} || '.5 GB'
  WHEN 7 THEN 'storage.MemoryStore: Block broadcast_' || {_s('i % 40')} || ' stored as bytes in memory (estimated size ' || {_s('1 + i % 90')} || '.5 KB, free 2.5 GB)'
  WHEN 8 THEN 'storage.MemoryStore: Block rdd_' || {_s('i % 40')} || '_' || {_s('i % 6')} || ' stored as bytes in memory (estimated size ' || {_s('1 + i % 90')} || '.0 MB, free 2.5 GB)'
  WHEN 9 THEN 'broadcast.TorrentBroadcast: Started reading broadcast variable ' || {_s('i % 40')}
  WHEN 10 THEN 'storage.BlockManagerInfo: Added broadcast_' || {_s('i % 40')} || '_piece' || {_s('i % 3')} || ' in memory on node-' || {_s('i % 7')} || ':52848 (size: ' || {_s('1 + i % 8')} || '.0 MB, free: 2.5 GB)'
  WHEN 11 THEN 'storage.BlockManager: Found block rdd_' || {_s('i % 40')} || '_' || {_s('i % 6')} || ' locally'
  ELSE 'ApplicationMaster: step ' || {_s('i')}
END"""

LINES = f"""lines AS (
  SELECT i AS event_id,
    CASE WHEN i % 10 = 0 THEN '    at frame(' || {_s('i')} || ')' || CASE WHEN i % 20 = 0 THEN ' INFORMATION' ELSE '' END
    ELSE
      CASE WHEN i % 11 = 0 THEN '24/13/45 10:00:00'
           WHEN i % 17 = 0 THEN strftime(ts, '%y/%m/%d') || '  ' || strftime(ts, '%H:%M:%S')
           ELSE strftime(ts, '%y/%m/%d %H:%M:%S') END
      || CASE WHEN i % 19 = 0 THEN '  ' ELSE ' ' END
      || CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' WHEN 'purchase' THEN 'DEBUG' ELSE 'INFO' END
      || ' ' || {_MSG}
      || CASE WHEN i % 23 = 0 THEN ' after ERROR' ELSE '' END
      || ' for ' || {_app('n0')}
      || CASE WHEN i % 7 = 0 THEN ' and ' || {_app('n0 + 1')} ELSE '' END
    END AS line
  FROM (SELECT event_id AS i, ts, event_type, (event_id // 26) % 150 AS n0 FROM events)
)"""

PARSED = r"""parsed AS (
  SELECT event_id, line,
    regexp_extract(line, '^(\d{2}/\d{2}/\d{2}\s+\d{2}:\d{2}:\d{2})', 1) AS ts_head,
    regexp_extract(line, '\b(INFO|WARN|ERROR|DEBUG)\b', 1) AS log_level,
    regexp_extract(line, '(INFO|WARN|ERROR|DEBUG)', 1) AS level_loose,
    regexp_extract(line, '(INFO|WARN|ERROR|DEBUG)\s+([^:]+):', 2) AS component,
    regexp_extract(line, 'application_(\d+)_\d+', 1) AS cluster_id,
    regexp_extract(line, '(application_\d+_\d+)', 1) AS application_id,
    try_strptime(regexp_extract(line, '(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})', 1), '%y/%m/%d %H:%M:%S') AS event_time
  FROM lines
)"""

TIMELINE = r"""timeline AS (
  SELECT cluster_id, application_id, regexp_extract(application_id, '_(\d+)$', 1) AS app_number,
         min(event_time) AS start_time, max(event_time) AS end_time
  FROM parsed WHERE application_id <> '' AND event_time IS NOT NULL GROUP BY 1, 2
)"""

SUMMARY = """summary AS (
  SELECT cluster_id, count(*) AS num_applications, min(start_time) AS cluster_first_app,
         max(end_time) AS cluster_last_app
  FROM timeline GROUP BY 1
)"""

DURATIONS = """top AS (SELECT cluster_id FROM summary ORDER BY num_applications DESC, cluster_id LIMIT 1),
v AS (
  SELECT t.cluster_id, t.application_id, CAST(date_diff('second', t.start_time, t.end_time) AS DOUBLE) AS x
  FROM timeline t JOIN top USING (cluster_id)
)"""

TASKS = r"""te AS (
  SELECT application_id,
    CASE WHEN contains(line, 'Running task ') THEN 'running' ELSE 'finished' END AS kind,
    coalesce(TRY_CAST(regexp_extract(line, 'Running task (\d+)\.(\d+) in stage (\d+)\.(\d+) \(TID (\d+)\)', 5) AS BIGINT),
             TRY_CAST(regexp_extract(line, 'Finished task (\d+)\.(\d+) in stage (\d+)\.(\d+) \(TID (\d+)\)', 5) AS BIGINT)) AS tid,
    coalesce(TRY_CAST(regexp_extract(line, 'Running task (\d+)\.(\d+) in stage (\d+)\.(\d+) \(TID (\d+)\)', 3) AS INTEGER),
             TRY_CAST(regexp_extract(line, 'Finished task (\d+)\.(\d+) in stage (\d+)\.(\d+) \(TID (\d+)\)', 3) AS INTEGER)) AS stage_id,
    TRY_CAST(regexp_extract(line, ' task (\d+)\.(\d+) in stage (\d+)\.(\d+) ', 1) AS INTEGER) AS task_index,
    TRY_CAST(regexp_extract(line, ' task (\d+)\.(\d+) in stage (\d+)\.(\d+) ', 2) AS INTEGER) AS task_attempt,
    TRY_CAST(regexp_extract(line, ' task (\d+)\.(\d+) in stage (\d+)\.(\d+) ', 4) AS INTEGER) AS stage_attempt,
    TRY_CAST(regexp_extract(line, '\(TID \d+\)\. (\d+) bytes result sent to driver', 1) AS BIGINT) AS result_bytes,
    event_time
  FROM parsed
  WHERE (contains(line, 'Running task ') OR contains(line, 'Finished task ')) AND application_id <> ''
),
tt AS (
  SELECT application_id, tid,
    min(stage_id) FILTER (WHERE kind = 'running') AS stage_id,
    min(event_time) FILTER (WHERE kind = 'running') AS start_time,
    max(event_time) FILTER (WHERE kind = 'finished') AS end_time,
    max(result_bytes) FILTER (WHERE kind = 'finished') AS result_bytes,
    count(*) FILTER (WHERE kind = 'running') AS runs,
    count(*) FILTER (WHERE kind = 'finished') AS fins
  FROM te WHERE tid IS NOT NULL GROUP BY 1, 2
),
td AS (
  SELECT application_id, tid, stage_id, start_time, end_time,
         date_diff('second', start_time, end_time) AS duration_sec, result_bytes
  FROM tt WHERE runs > 0 AND fins > 0
)"""


FILE_LINES = f"""flines AS (
  SELECT i AS event_id, 'logs/application_' || app || '/container_' || app || '_0' || {_s('1 + (b % 4) // 2')} || '_00000' || {_s('1 + b % 2')} || '.log' AS path,
    (i // 7760) * 10 + j AS line_no,
    CASE WHEN (b % 3 = 0 AND j BETWEEN 4 AND 6) OR (b % 5 = 1 AND j = 0) THEN '    at frame(' || {_s('i')} || ')'
    ELSE strftime(TIMESTAMP '2017-03-29 10:00:00' + to_seconds(b * 100 + j * (1 + b % 9) + CASE WHEN j = 8 AND b % 50 = 0 THEN 600 ELSE 0 END), '%y/%m/%d %H:%M:%S')
      || ' ' || CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' WHEN 'purchase' THEN 'DEBUG' ELSE 'INFO' END || ' '
      || CASE j
        WHEN 0 THEN 'YarnAllocator: Will request ' || {_s('1 + b % 16')} || ' executor containers, each with ' || {_s('1 + b % 5')} || ' cores and ' || {_s('1024 * (1 + b % 28)')} || ' MB memory'
        WHEN 1 THEN 'executor.Executor: Running' || task
        WHEN 2 THEN 'python.PythonRunner: Times: total = ' || {_s('b % 5000')} || ', boot = ' || {_s('b % 70')} || ', init = ' || {_s('b % 50')} || ', finish = ' || {_s('b % 900')}
        WHEN 3 THEN CASE WHEN b % 7 = 3 THEN 'executor.Executor: waiting' ELSE 'executor.Executor: Finished' || task || '. ' || {_s('1000 + b % 900')} || ' bytes result sent to driver' END
        WHEN 4 THEN 'storage.MemoryStore: MemoryStore started with capacity ' || {_s('1 + b % 30')} || '.5 GB'
        WHEN 5 THEN 'broadcast.TorrentBroadcast: Started reading broadcast variable ' || {_s('b % 40')}
        WHEN 6 THEN 'storage.BlockManager: Found block rdd_' || {_s('b % 40')} || '_' || {_s('b % 6')} || ' locally'
        WHEN 7 THEN 'executor.Executor: Running' || task
        WHEN 8 THEN 'executor.Executor: Finished' || task || '. ' || {_s('1000 + b % 900')} || ' bytes result sent to driver'
        ELSE 'ApplicationMaster: step ' || {_s('i')} END END AS line
  FROM (SELECT *, ' task ' || {_s('CASE WHEN j >= 7 THEN 7 ELSE 1 END + CASE WHEN b % 2 = 1 AND b % 7 = 4 AND j < 7 THEN 0 ELSE 10 * (b % 2) END')}
            || CASE WHEN b % 2 = 1 AND b % 7 = 4 AND j < 7 THEN '.1' ELSE '.0' END || ' in stage ' || {_s('b // 2 % 3 + 3 * (i // 7760)')}
            || CASE WHEN b // 2 % 5 = 0 THEN '.1' ELSE '.0' END || ' (TID ' || {_s('(i // 7760) * 4 + (b % 2) * 2 + CASE WHEN j >= 7 THEN 1 ELSE 0 END')} || ')' AS task,
          {_s('1485248649253 + CASE WHEN a < 181 THEN 0 WHEN a < 189 THEN 1 WHEN a < 191 THEN 2 ELSE a - 188 END')} || '_' || lpad({_s('a + 1')}, 4, '0') AS app
        FROM (SELECT event_id AS i, event_type, event_id // 10 AS b, CAST(event_id % 10 AS INTEGER) AS j, (event_id // 10 // 4) % 194 AS a FROM events))
),
lines AS (SELECT event_id, path, line_no, line FROM flines)"""

FILE_PARSED = r"""parsed AS (
  SELECT event_id, path, line_no, line,
    regexp_extract(line, '^(\d{2}/\d{2}/\d{2}\s+\d{2}:\d{2}:\d{2})', 1) AS ts_head,
    regexp_extract(line, '\b(INFO|WARN|ERROR|DEBUG)\b', 1) AS log_level,
    split_part(path, '/', 2) AS application_id, split_part(split_part(path, '/', 2), '_', 2) AS cluster_id,
    replace(split_part(path, '/', 3), '.log', '') AS container_id, split_part(split_part(path, '/', 3), '_', 4) AS attempt,
    CASE WHEN ends_with(path, '_000001.log') THEN 'AM' ELSE 'EXECUTOR' END AS container_role,
    try_strptime(regexp_extract(line, '(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})', 1), '%y/%m/%d %H:%M:%S') AS event_time
  FROM lines
)"""


def _bytes(num: str, unit: str) -> str:
    return (
        f"(TRY_CAST({num} AS DOUBLE) * CASE {unit} WHEN 'B' THEN 1.0 WHEN 'KB' THEN 1024.0 "
        f"WHEN 'MB' THEN 1048576.0 WHEN 'GB' THEN 1073741824.0 WHEN 'TB' THEN 1099511627776.0 END)"
    )


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_LOG = (LINES, PARSED)
_TL = (LINES, PARSED, TIMELINE)
_SUM = (LINES, PARSED, TIMELINE, SUMMARY)

X1 = r"Will request (\d+) executor containers, each with (\d+) cores and (\d+) MB memory(?: including (\d+) MB overhead)?"
X2 = r"Container request \(host: ([^,]+), capability: <memory:(\d+), vCores:(\d+)>"
X4 = r"Input split: (\S+):(\d+)\+(\d+)"
X5 = r"Times: total = (\d+), boot = (\d+), init = (\d+), finish = (\d+)"
X6 = r"MemoryStore started with capacity ([\d.]+) ([KMGT]?B)"
X7 = r"Block ((broadcast|rdd)_\S+) stored as .* \(estimated size ([\d.]+) ([KMGT]?B), free ([\d.]+) ([KMGT]?B)\)"
X8 = r"Started reading broadcast variable (\d+)"
X9 = r"Added (\S+) in memory on ([^:\s]+):(\d+) \(size: ([\d.]+) ([KMGT]?B), free: ([\d.]+) ([KMGT]?B)\)"
X9L = r"Found block rdd_(\d+)_(\d+) locally"


def _rx(p: str, g: int) -> str:
    return f"regexp_extract(line, '{p}', {g})"


ORACLE: dict[str, str] = {
    "level_counts": _with(*_LOG)
    + "SELECT log_level, count(*) AS count FROM parsed WHERE log_level <> '' GROUP BY 1",
    "level_share": _with(*_LOG)
    + """, c AS (SELECT log_level, count(*) AS count FROM parsed WHERE log_level <> '' GROUP BY 1)
SELECT log_level, count, 100.0 * count / sum(count) OVER () AS pct FROM c""",
    "level_totals": _with(*_LOG)
    + """SELECT count(*) AS total_lines, count(*) FILTER (WHERE log_level <> '') AS lines_with_level,
       count(DISTINCT CASE WHEN log_level <> '' THEN log_level END) AS distinct_levels FROM parsed""",
    "level_counts_unfiltered": _with(*_LOG) + "SELECT level_loose AS level, count(*) AS count FROM parsed GROUP BY 1",
    "level_tokens_all": _with(LINES)
    + "SELECT tok AS level, count(*) AS count FROM (SELECT unnest(regexp_extract_all(line, '(INFO|WARN|ERROR|DEBUG)', 1)) AS tok FROM lines) GROUP BY 1",
    "component_counts": _with(*_LOG)
    + "SELECT component, count(*) AS count FROM parsed GROUP BY 1 ORDER BY count DESC, component LIMIT 20",
    "log_sample": _with(*_LOG)
    + "SELECT line AS log_entry, log_level FROM parsed WHERE log_level <> '' ORDER BY md5('42' || line), line LIMIT 10",
    "error_lines": _with(LINES) + "SELECT event_id, line FROM lines WHERE contains(line, 'ERROR')",
    "app_timeline": _with(*_TL) + "SELECT cluster_id, application_id, app_number, start_time, end_time FROM timeline",
    "cluster_summary": _with(*_SUM) + "SELECT * FROM summary",
    "cluster_stats": _with(*_SUM)
    + """SELECT count(*) AS total_clusters, CAST(coalesce(sum(num_applications), 0) AS BIGINT) AS total_applications,
       coalesce(CAST(sum(num_applications) AS DOUBLE) / nullif(count(*), 0), 0.0) AS avg_apps_per_cluster FROM summary""",
    "cluster_rank": _with(*_SUM)
    + "SELECT cluster_id, num_applications, CAST(rank() OVER (ORDER BY num_applications DESC) AS INTEGER) AS usage_rank FROM summary",
    "top_clusters": _with(*_SUM)
    + "SELECT * FROM summary ORDER BY num_applications DESC, cluster_id LIMIT 5",
    "line_inventory": _with(*_LOG)
    + """SELECT count(DISTINCT CASE WHEN application_id <> '' THEN application_id END) AS applications,
       count(DISTINCT CASE WHEN application_id <> '' THEN cluster_id END) AS clusters,
       count(*) AS lines, count(*) FILTER (WHERE log_level <> '') AS lines_with_level,
       count(event_time) AS lines_with_time FROM parsed""",
    "app_gaps": _with(*_TL)
    + """SELECT cluster_id, application_id, start_time,
       lag(application_id) OVER w AS prev_application_id, lag(end_time) OVER w AS prev_end_time,
       date_diff('second', lag(end_time) OVER w, start_time) AS gap_sec
FROM timeline WINDOW w AS (PARTITION BY cluster_id ORDER BY start_time, application_id)""",
    "peak_concurrency": _with(*_TL)
    + """, ev AS (SELECT cluster_id, start_time AS t, 1 AS delta FROM timeline
              UNION ALL SELECT cluster_id, end_time AS t, -1 AS delta FROM timeline),
sw AS (SELECT cluster_id, t, CAST(sum(delta) OVER (PARTITION BY cluster_id ORDER BY t, delta DESC
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running FROM ev),
pk AS (SELECT cluster_id, max(running) AS peak FROM sw GROUP BY 1)
SELECT pk.cluster_id, pk.peak AS peak_concurrency, min(sw.t) AS peak_at
FROM pk JOIN sw ON sw.cluster_id = pk.cluster_id AND sw.running = pk.peak GROUP BY 1, 2""",
    "app_overlaps": _with(*_TL)
    + """SELECT a.cluster_id, a.application_id, CAST(count(b.application_id) AS BIGINT) AS overlapping_apps
FROM timeline a LEFT JOIN timeline b
  ON a.cluster_id = b.cluster_id AND a.application_id <> b.application_id
 AND b.start_time <= a.end_time AND a.start_time <= b.end_time
GROUP BY 1, 2""",
    "cluster_start_lookup": _with(*_SUM)
    + """SELECT t.cluster_id, t.application_id, epoch_ms(CAST(t.cluster_id AS BIGINT)) AS cluster_start,
       s.num_applications, date_diff('millisecond', epoch_ms(CAST(t.cluster_id AS BIGINT)), t.start_time) AS start_offset_ms
FROM timeline t LEFT JOIN summary s USING (cluster_id)""",
    "duration_histogram": _with(*_SUM, DURATIONS)
    + """, st AS (SELECT cluster_id, min(x) AS lo, max(x) AS hi FROM v GROUP BY 1),
b AS (SELECT v.cluster_id, CASE WHEN hi = lo THEN 0 ELSE CAST(least(floor((x - lo) * 30.0 / (hi - lo)), 29) AS INTEGER) END AS bin
      FROM v JOIN st USING (cluster_id)),
c AS (SELECT cluster_id, bin, count(*) AS cnt FROM b GROUP BY 1, 2),
e AS (SELECT cluster_id, lo, hi, CAST(r.i AS INTEGER) AS bin FROM st, range(0, 30) r(i))
SELECT e.cluster_id, e.bin, e.lo + e.bin * (e.hi - e.lo) / 30.0 AS bin_lo, e.lo + (e.bin + 1) * (e.hi - e.lo) / 30.0 AS bin_hi,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM e LEFT JOIN c ON c.cluster_id = e.cluster_id AND c.bin = e.bin""",
    "duration_density": _with(*_SUM, DURATIONS)
    + """, st AS (SELECT cluster_id, count(*) AS n, min(x) AS lo, max(x) AS hi, stddev_samp(x) AS sd FROM v GROUP BY 1),
s2 AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM st),
s3 AS (SELECT cluster_id, n, h, lo - 3.0 * h AS g_lo, (hi - lo + 6.0 * h) / 199.0 AS g_step FROM s2 WHERE h > 0),
g AS (SELECT s3.cluster_id, CAST(r.p AS INTEGER) AS point, s3.n, s3.h, s3.g_lo, s3.g_step, v.x
      FROM s3 JOIN v USING (cluster_id) CROSS JOIN range(0, 200) r(p))
SELECT cluster_id, point, round(g_lo + point * g_step, 6) AS x,
       round(sum(exp(-0.5 * ((g_lo + point * g_step - x) / h) * ((g_lo + point * g_step - x) / h))) / (n * h * sqrt(2 * pi())), 12) AS density
FROM g GROUP BY cluster_id, point, n, h, g_lo, g_step""",
}


_OVERLAP = """, o AS (SELECT a.cluster_id, a.application_id, b.application_id AS partner_id,
       date_diff('second', greatest(a.start_time, b.start_time), least(a.end_time, b.end_time)) AS overlap_sec,
       row_number() OVER (PARTITION BY a.cluster_id, a.application_id ORDER BY
         least(a.end_time, b.end_time) - greatest(a.start_time, b.start_time) DESC, b.end_time DESC, b.application_id) AS place
  FROM timeline a JOIN timeline b ON a.cluster_id = b.cluster_id AND a.application_id <> b.application_id
   AND b.start_time <= a.end_time AND a.start_time <= b.end_time)
SELECT t.cluster_id, t.application_id, o.partner_id, o.overlap_sec
FROM timeline t LEFT JOIN o ON o.cluster_id = t.cluster_id AND o.application_id = t.application_id AND o.place = 1"""

_CACHED = f""", ab AS (SELECT event_id, event_time, application_id, {_rx(X9, 1)} AS block, {_rx(X9, 2)} AS host,
       CAST(round({_bytes(_rx(X9, 4), _rx(X9, 5))}) AS BIGINT) AS size_bytes
  FROM parsed WHERE contains(line, 'Added ') AND regexp_matches(line, '{X9}') AND event_time IS NOT NULL),
ch AS (SELECT *, lag(size_bytes) OVER (PARTITION BY host, application_id, block ORDER BY event_time, event_id) AS prev FROM ab),
ca AS (SELECT *, CAST(sum(size_bytes - coalesce(prev, 0)) OVER (PARTITION BY host ORDER BY event_time, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cached_bytes FROM ch)
"""


def _bucket_width(x: str) -> str:
    """The width of the bucket of a whole number that isn't negative: its numbers share their first 9 digits."""
    return f"(CAST(1 AS BIGINT) << greatest(0, length(bin({x})) - 9))"


def _bucket_low(x: str) -> str:
    return f"({x} - {x} % {_bucket_width(x)}) / 100.0::DOUBLE"


def _bucket_high(x: str) -> str:
    return f"({x} - {x} % {_bucket_width(x)} + {_bucket_width(x)} - 1) / 100.0::DOUBLE"


def _retries(ids: str) -> str:
    task = f"{ids}, stage_id, stage_attempt, task_index"
    return f""", tries AS (SELECT {task}, task_attempt, tid, min(event_time) FILTER (WHERE kind = 'running') AS start_time,
       count(*) FILTER (WHERE kind = 'finished') > 0 AS finished FROM te WHERE tid IS NOT NULL GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY {task} ORDER BY task_attempt, start_time NULLS FIRST, tid) AS place FROM tries),
first_done AS (SELECT {task}, min(place) FILTER (WHERE finished) AS done, count(*) AS num_attempts,
       count(*) FILTER (WHERE finished) AS finished_attempts, max(task_attempt) AS last_attempt,
       min(task_attempt) FILTER (WHERE finished) AS succeeded_on FROM numbered GROUP BY ALL),
lost AS (SELECT {", ".join(f"a.{c.strip()}" for c in task.split(","))}, sum(greatest(0, date_diff('second', a.start_time, b.start_time))) AS lost_sec
  FROM numbered a JOIN numbered b ON {" AND ".join(f"a.{c.strip()} = b.{c.strip()}" for c in task.split(","))} AND b.place = a.place + 1
  JOIN first_done f ON {" AND ".join(f"a.{c.strip()} = f.{c.strip()}" for c in task.split(","))} AND a.place < coalesce(f.done, 1000000) GROUP BY ALL)
SELECT f.* EXCLUDE (done), CAST(coalesce(l.lost_sec, 0) AS BIGINT) AS lost_sec, coalesce(f.done > 1, false) AS recovered
FROM first_done f LEFT JOIN lost l ON {" AND ".join(f"l.{c.strip()} = f.{c.strip()}" for c in task.split(","))} WHERE num_attempts > 1"""


_DAILY = """SELECT CAST(year(l_shipdate) AS INTEGER) AS dt_year, CAST(month(l_shipdate) AS INTEGER) AS dt_month,
       CAST(day(l_shipdate) AS INTEGER) AS dt_day, count(*) AS num_trips, avg(l_quantity) AS mean_trip_distance,
       max(l_tax) AS max_mta_tax, quantile_disc(l_extendedprice, 0.95) AS q95_fare_amount,
       min(l_discount) AS min_tip_amount, CAST(ceil(avg(CAST(l_linenumber AS DOUBLE))) AS BIGINT) AS mean_passenger_count
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
GROUP BY 1, 2, 3"""

ORACLE.update(
    {
        # the sketch holds all values of a day, and takes the one of rank ceil(0.95 n)
        "daily_trips": _DAILY.replace("quantile_disc(l_extendedprice, 0.95)", "list_sort(list(l_extendedprice))[CAST(ceil(0.95::DOUBLE * count(*)) AS BIGINT)]"),
        "daily_trips_exact": _DAILY,
        "daily_totals": f"""WITH d AS ({_DAILY})
SELECT count(*) AS days, CAST(sum(num_trips) AS BIGINT) AS total_trips, avg(num_trips) AS avg_daily_trips FROM d""",
        "daily_range": f"""WITH d AS ({_DAILY})
SELECT min(make_date(dt_year, dt_month, dt_day)) AS first_day, max(make_date(dt_year, dt_month, dt_day)) AS last_day FROM d""",
        "daily_events": """SELECT CAST(year(ts) AS INTEGER) AS dt_year, CAST(month(ts) AS INTEGER) AS dt_month,
       CAST(day(ts) AS INTEGER) AS dt_day, count(*) AS num_rows, round(avg(value), 6) AS mean_value,
       max(value) AS max_value, quantile_disc(value, 0.95) AS q95_value, min(value) AS min_value,
       CAST(ceil(avg(user_id)) AS BIGINT) AS mean_count
FROM events GROUP BY 1, 2, 3""",
        "price_p95_exact": """SELECT l_returnflag, l_linestatus, quantile_disc(l_extendedprice, 0.95) AS p95_price
FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1, 2""",
        "task_durations": _with(*_LOG, TASKS) + "SELECT * FROM td",
        "unfinished_tasks": _with(*_LOG, TASKS)
        + "SELECT application_id, tid, stage_id, start_time FROM tt WHERE runs > 0 AND fins = 0",
        "longest_overlap": _with(*_TL) + _OVERLAP,
        "cache_timeline": _with(*_LOG) + _CACHED + "SELECT event_id, host, application_id, block, size_bytes, cached_bytes FROM ca",
        "cache_peaks": _with(*_LOG)
        + _CACHED
        + """SELECT host, count(*) AS num_stored, count(prev) AS num_replaced, max(cached_bytes) AS peak_bytes,
       arg_min(event_time, (-cached_bytes, event_time, event_id)) AS peak_at,
       arg_max(cached_bytes, (event_time, event_id)) AS last_bytes FROM ca GROUP BY 1""",
        "cache_hit_share": _with(*_LOG)
        + f""", h AS (SELECT TRY_CAST({_rx(X9L, 1)} AS BIGINT) AS rdd_id, 1 AS hit FROM parsed
  WHERE contains(line, 'Found block rdd_') AND regexp_matches(line, '{X9L}')
  UNION ALL SELECT TRY_CAST(regexp_extract({_rx(X7, 1)}, '^rdd_(\\d+)_', 1) AS BIGINT), 0 FROM parsed
  WHERE contains(line, ' stored as ') AND regexp_matches(line, '{X7}'))
SELECT rdd_id, count(*) FILTER (WHERE hit = 1) AS num_hits, count(*) FILTER (WHERE hit = 0) AS num_stored,
       count(*) FILTER (WHERE hit = 1) / count(*) AS hit_share FROM h WHERE rdd_id IS NOT NULL GROUP BY 1""",
        "task_retries": _with(*_LOG, TASKS) + _retries("application_id"),
        "stage_skew": _with(*_LOG, TASKS)
        + """, g AS (SELECT application_id, stage_id, count(*) AS num_tasks, max(duration_sec) AS max_sec,
       quantile_disc(duration_sec, 0.5) AS median_sec, quantile_disc(duration_sec, 0.95) AS p95_sec
  FROM td WHERE duration_sec IS NOT NULL GROUP BY 1, 2)
SELECT *, CAST(max_sec AS DOUBLE) / CAST(greatest(median_sec, 1) AS DOUBLE) AS max_over_median,
       CAST(max_sec AS DOUBLE) / CAST(greatest(median_sec, 1) AS DOUBLE) > 2.0 AS is_skewed
FROM g""",
        "slow_tasks": _with(*_LOG, TASKS)
        + """SELECT application_id, tid, stage_id, duration_sec FROM td WHERE duration_sec IS NOT NULL
ORDER BY duration_sec DESC, application_id, tid LIMIT 10""",
        "executor_requests": _with(*_LOG)
        + f""", er AS (SELECT application_id, TRY_CAST({_rx(X1, 1)} AS BIGINT) AS executors, TRY_CAST({_rx(X1, 2)} AS BIGINT) AS cores,
       TRY_CAST({_rx(X1, 3)} AS BIGINT) AS memory_mb, TRY_CAST(nullif({_rx(X1, 4)}, '') AS BIGINT) AS overhead_mb
  FROM parsed WHERE contains(line, 'Will request ') AND regexp_matches(line, '{X1}'))
SELECT application_id, count(*) AS num_requests, CAST(sum(executors) AS BIGINT) AS total_executors,
       CAST(sum(executors * cores) AS BIGINT) AS total_cores, CAST(sum(executors * memory_mb) AS BIGINT) AS total_memory_mb,
       max(memory_mb) AS max_memory_mb, count(overhead_mb) AS requests_with_overhead
FROM er GROUP BY 1""",
        "container_requests": _with(*_LOG)
        + f""", cr AS (SELECT {_rx(X2, 1)} AS host, TRY_CAST({_rx(X2, 2)} AS BIGINT) AS memory_mb, TRY_CAST({_rx(X2, 3)} AS BIGINT) AS vcores
  FROM parsed WHERE contains(line, 'Container request (') AND regexp_matches(line, '{X2}'))
SELECT host, count(*) AS num_requests, CAST(sum(memory_mb) AS BIGINT) AS total_memory_mb, CAST(sum(vcores) AS BIGINT) AS total_vcores
FROM cr GROUP BY 1""",
        "input_splits": _with(*_LOG)
        + f""", sp AS (SELECT {_rx(X4, 1)} AS uri, TRY_CAST({_rx(X4, 2)} AS BIGINT) AS "offset", TRY_CAST({_rx(X4, 3)} AS BIGINT) AS length
  FROM parsed WHERE contains(line, 'Input split: ') AND regexp_matches(line, '{X4}'))
SELECT uri, count(*) AS num_splits, CAST(sum(length) AS BIGINT) AS total_bytes, min("offset") AS min_offset,
       max("offset" + length) AS end_offset
FROM sp GROUP BY 1""",
        "python_times": _with(*_LOG)
        + f""", pt AS (SELECT application_id, TRY_CAST({_rx(X5, 1)} AS BIGINT) AS total_ms, TRY_CAST({_rx(X5, 2)} AS BIGINT) AS boot_ms,
       TRY_CAST({_rx(X5, 3)} AS BIGINT) AS init_ms, TRY_CAST({_rx(X5, 4)} AS BIGINT) AS finish_ms
  FROM parsed WHERE contains(line, 'PythonRunner: Times: ') AND regexp_matches(line, '{X5}'))
SELECT application_id, count(*) AS num_runs, CAST(sum(total_ms) AS BIGINT) AS sum_total_ms, avg(total_ms) AS avg_total_ms,
       max(boot_ms) AS max_boot_ms, CAST(sum(init_ms) AS BIGINT) AS sum_init_ms, CAST(sum(finish_ms) AS BIGINT) AS sum_finish_ms
FROM pt GROUP BY 1""",
        "memory_capacity": _with(*_LOG)
        + f""", mc AS (SELECT application_id, {_bytes(_rx(X6, 1), _rx(X6, 2))} AS capacity_bytes
  FROM parsed WHERE contains(line, 'MemoryStore started with capacity') AND regexp_matches(line, '{X6}'))
SELECT application_id, count(*) AS num_stores, max(capacity_bytes) AS max_capacity_bytes, min(capacity_bytes) AS min_capacity_bytes
FROM mc GROUP BY 1""",
        "block_bytes": _with(*_LOG)
        + f""", bl AS (SELECT {_rx(X7, 2)} AS kind, {_bytes(_rx(X7, 3), _rx(X7, 4))} AS size_bytes, {_bytes(_rx(X7, 5), _rx(X7, 6))} AS free_bytes
  FROM parsed WHERE contains(line, ' stored as ') AND regexp_matches(line, '{X7}'))
SELECT kind, count(*) AS num_blocks, sum(size_bytes) AS total_bytes, max(size_bytes) AS max_bytes, min(free_bytes) AS min_free_bytes
FROM bl GROUP BY 1""",
        "broadcast_reads": _with(*_LOG)
        + f""", br AS (SELECT application_id, TRY_CAST({_rx(X8, 1)} AS BIGINT) AS broadcast_id
  FROM parsed WHERE contains(line, 'Started reading broadcast variable'))
SELECT application_id, count(*) AS num_reads, count(DISTINCT broadcast_id) AS distinct_broadcasts
FROM br WHERE broadcast_id IS NOT NULL GROUP BY 1""",
        "block_hosts": _with(*_LOG)
        + f""", ab AS (SELECT {_rx(X9, 2)} AS host, {_bytes(_rx(X9, 4), _rx(X9, 5))} AS size_bytes
  FROM parsed WHERE contains(line, 'Added ') AND regexp_matches(line, '{X9}'))
SELECT host, count(*) AS num_blocks, sum(size_bytes) AS total_bytes FROM ab GROUP BY 1""",
        "local_blocks": _with(*_LOG)
        + f""", lb AS (SELECT TRY_CAST({_rx(X9L, 1)} AS BIGINT) AS rdd_id, TRY_CAST({_rx(X9L, 2)} AS BIGINT) AS part
  FROM parsed WHERE contains(line, 'Found block rdd_') AND regexp_matches(line, '{X9L}'))
SELECT rdd_id, count(*) AS num_local_hits, count(DISTINCT part) AS distinct_partitions FROM lb GROUP BY 1""",
        "error_rate": _with(*_LOG)
        + """SELECT application_id, count(*) AS level_lines, count(*) FILTER (WHERE log_level = 'ERROR') AS error_lines,
       count(*) FILTER (WHERE log_level = 'ERROR') / count(*) AS error_rate
FROM parsed WHERE application_id <> '' AND log_level <> '' GROUP BY 1""",
        "multiline_entries": _with(*_LOG)
        + """, m AS (SELECT event_id, line, log_level,
       max(CASE WHEN ts_head <> '' THEN event_id END) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e
  FROM parsed)
SELECT min(event_id) AS entry_id, count(*) AS n_lines, arg_min(log_level, event_id) AS log_level,
       string_agg(line, chr(10) ORDER BY event_id) AS text
FROM m GROUP BY coalesce(e, -1)""",
        "document_line_counts": """SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines,
       CAST(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) = '')) AS BIGINT) AS blank_lines,
       list_max(list_transform(string_split(text, chr(10)), lambda x: length(x))) AS max_line_chars
FROM documents""",
        "sql_even_keys": """SELECT count(*) AS total, CAST(sum(o_orderkey * 2) AS BIGINT) AS doubled_sum
FROM orders WHERE o_orderkey % 2 = 0""",
    }
)

# ---------------------------------------------------------------- container files
_FILE = (FILE_LINES, FILE_PARSED)
_FILE_TL = (*_FILE, TIMELINE)
_FILE_TASKS = (*_FILE, TASKS.replace("application_id, tid", "application_id, attempt, tid").replace(
    "SELECT application_id,\n    CASE", "SELECT application_id, attempt,\n    CASE").replace("GROUP BY 1, 2", "GROUP BY 1, 2, 3"))

for _name in ("executor_requests", "python_times", "memory_capacity", "broadcast_reads", "error_rate"):
    ORACLE[f"file_{_name}"] = ORACLE[_name].replace(_with(*_LOG), _with(*_FILE))


def _cluster_histogram(bins: int, values: str) -> str:
    return f""", st AS (SELECT cluster_id, min(x) AS lo, max(x) AS hi FROM {values} GROUP BY 1),
b AS (SELECT v.cluster_id, CASE WHEN hi = lo THEN 0 ELSE CAST(least(floor((x - lo) * {bins}.0 / (hi - lo)), {bins - 1}) AS INTEGER) END AS bin
      FROM {values} v JOIN st USING (cluster_id)),
c AS (SELECT cluster_id, bin, count(*) AS cnt FROM b GROUP BY 1, 2),
e AS (SELECT cluster_id, lo, hi, CAST(r.i AS INTEGER) AS bin, lo + r.i * (hi - lo) / {bins}.0 AS bin_lo, lo + (r.i + 1) * (hi - lo) / {bins}.0 AS bin_hi
      FROM st, range(0, {bins}) r(i))
"""


_ALL = """v AS (SELECT cluster_id, application_id, CAST(date_diff('second', start_time, end_time) AS DOUBLE) AS x FROM timeline)"""

ORACLE.update(
    {
        "file_inventory": _with(*_FILE)
        + "SELECT count(DISTINCT application_id) AS applications, count(DISTINCT path) AS log_files, count(*) AS lines FROM parsed",
        "files_per_application": _with(*_FILE)
        + "SELECT application_id, count(DISTINCT path) AS num_files FROM parsed GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
        "container_roles": _with(*_FILE)
        + """SELECT attempt, container_role, count(DISTINCT path) AS files, count(DISTINCT container_id) AS containers,
       count(*) AS lines FROM parsed GROUP BY 1, 2""",
        "file_timeline": _with(*_FILE_TL) + "SELECT * FROM timeline",
        "file_cluster_rank": _with(*_FILE_TL, SUMMARY)
        + "SELECT cluster_id, num_applications, CAST(rank() OVER (ORDER BY num_applications DESC) AS INTEGER) AS usage_rank FROM summary",
        "file_longest_overlap": _with(*_FILE_TL) + _OVERLAP,
        "file_task_durations": _with(*_FILE_TASKS) + "SELECT * FROM td",
        "file_unfinished_tasks": _with(*_FILE_TASKS)
        + "SELECT application_id, attempt, tid, stage_id, start_time FROM tt WHERE runs > 0 AND fins = 0",
        "file_task_retries": _with(*_FILE_TASKS) + _retries("application_id, attempt"),
        "file_stage_skew": _with(*_FILE_TASKS)
        + """, g AS (SELECT application_id, attempt, stage_id, count(*) AS num_tasks, max(duration_sec) AS max_sec,
       quantile_disc(duration_sec, 0.5) AS median_sec, quantile_disc(duration_sec, 0.95) AS p95_sec FROM td GROUP BY 1, 2, 3)
SELECT *, CAST(max_sec AS DOUBLE) / greatest(median_sec, 1) AS max_over_median,
       CAST(max_sec AS DOUBLE) / greatest(median_sec, 1) > 2.0 AS is_skewed FROM g""",
        "file_slow_tasks": _with(*_FILE_TASKS)
        + """SELECT application_id, attempt, tid, stage_id, duration_sec FROM td
ORDER BY duration_sec DESC, application_id, attempt, tid LIMIT 10""",
        "file_entries": _with(*_FILE)
        + """, m AS (SELECT path, line_no, line, log_level, max(CASE WHEN ts_head <> '' THEN line_no END)
       OVER (PARTITION BY path ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e FROM parsed)
SELECT path, min(line_no) AS entry_id, count(*) AS n_lines, arg_min(log_level, line_no) AS log_level,
       string_agg(line, chr(10) ORDER BY line_no) AS text FROM m GROUP BY path, coalesce(e, -1)""",
        "file_line_entries": _with(*_FILE)
        + """SELECT path, line_no, log_level, coalesce(max(CASE WHEN ts_head <> '' THEN line_no END)
       OVER (PARTITION BY path ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS entry FROM parsed""",
        "document_lines": """SELECT doc_id, CAST(unnest(range(0, len(string_split(text, chr(10))))) AS INTEGER) AS line_no,
       unnest(string_split(text, chr(10))) AS line FROM documents""",
        "duration_histogram_log": _with(*_FILE_TL, SUMMARY, DURATIONS.replace("v AS (", "v0 AS ("))
        + ", vl AS (SELECT cluster_id, log10(1.0 + x) AS x FROM v0)" + _cluster_histogram(20, "vl")
        + """SELECT e.cluster_id, e.bin, round(pow(10.0, bin_lo) - 1.0, 6) AS bin_lo, round(pow(10.0, bin_hi) - 1.0, 6) AS bin_hi,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS count FROM e LEFT JOIN c ON c.cluster_id = e.cluster_id AND c.bin = e.bin""",
        "duration_histogram_clusters": _with(*_TL, _ALL)
        + _cluster_histogram(30, "v")
        + """SELECT e.cluster_id, e.bin, bin_lo, bin_hi, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM e LEFT JOIN c ON c.cluster_id = e.cluster_id AND c.bin = e.bin""",
        "duration_density_clusters": _with(*_TL, _ALL)
        + ORACLE["duration_density"].split(DURATIONS + "\n", 1)[1].replace("199.0", "99.0").replace("range(0, 200)", "range(0, 100)").replace(", 12) AS density", ", 9) AS density"),
        "level_order": _with(*_LOG)
        + """, c AS (SELECT log_level, count(*) AS n FROM parsed WHERE log_level <> '' GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY n DESC, log_level) - 1 AS INTEGER) AS position, log_level FROM c""",
        "strict_times": _with(LINES)
        + r"""SELECT event_id, strptime(regexp_extract(line, '^(\d{2}/(?:0\d|1[0-2])/\d{2} \d{2}:\d{2}:\d{2}) ', 1), '%y/%m/%d %H:%M:%S') AS event_time
FROM lines WHERE regexp_matches(line, '^\d{2}/(?:0\d|1[0-2])/\d{2} \d{2}:\d{2}:\d{2} ')""",
        "daily_newest": f"""WITH d AS ({_DAILY})
SELECT CAST(row_number() OVER (ORDER BY dt_year DESC, dt_month DESC, dt_day DESC) AS INTEGER) AS position, dt_year, dt_month, dt_day,
       num_trips FROM d ORDER BY position LIMIT 10""",
        "price_p95_approx": f"""WITH q AS (SELECT l_returnflag, l_linestatus, count(*) AS n,
       CAST(round(quantile_disc(l_extendedprice, 0.95) * 100) AS BIGINT) AS x FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1, 2)
SELECT l_returnflag, l_linestatus, n, {_bucket_low("x")} AS p95_low, {_bucket_high("x")} AS p95_high FROM q""",
        "fare_quantiles": f"""WITH q AS (SELECT grouping(year(l_shipdate)) AS g, year(l_shipdate) AS y, month(l_shipdate) AS m, count(*) AS n,
       CAST(round(quantile_disc(l_extendedprice, 0.5) * 100) AS BIGINT) AS a, CAST(round(quantile_disc(l_extendedprice, 0.95) * 100) AS BIGINT) AS b
  FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY GROUPING SETS ((year(l_shipdate), month(l_shipdate)), ()))
SELECT CASE WHEN g = 0 THEN 'month' ELSE 'all' END AS level, CAST(y AS INTEGER) AS dt_year, CAST(m AS INTEGER) AS dt_month, n,
       {_bucket_low("a")} AS p50_low, {_bucket_high("a")} AS p50_high, {_bucket_low("b")} AS p95_low, {_bucket_high("b")} AS p95_high FROM q""",
        "distinct_users": """SELECT CASE WHEN grouping(year(ts)) = 0 THEN 'month' ELSE 'all' END AS level, CAST(year(ts) AS INTEGER) AS dt_year,
       CAST(month(ts) AS INTEGER) AS dt_month, count(DISTINCT user_id) AS num_users, true AS within_error
FROM events GROUP BY GROUPING SETS ((year(ts), month(ts)), ())""",
        "table_union": """WITH u AS (SELECT 'documents' AS file, * FROM documents UNION ALL BY NAME SELECT 'labels' AS file, * FROM labels
  UNION ALL BY NAME SELECT 'benchmark' AS file, * FROM benchmark)
SELECT file, count(*) AS n, count(doc_id) AS n_doc_id, count(item_id) AS n_item_id, CAST(sum(quality) AS BIGINT) AS quality,
       CAST(sum(n_chars) AS BIGINT) AS n_chars, CAST(sum(length(text)) AS BIGINT) AS text_chars FROM u GROUP BY 1""",
        "timeline_csv": _with(*_TL)
        + r"""SELECT application_id, cluster_id || ',' || application_id || ',' || app_number || ','
       || strftime(start_time, '%Y-%m-%dT%H:%M:%S.000Z') || ',' || strftime(end_time, '%Y-%m-%dT%H:%M:%S.000Z') AS csv FROM timeline""",
        "lines_csv": _with(*_LOG)
        + """SELECT event_id, event_id || ',' || CASE WHEN log_level = '' THEN '""' ELSE log_level END || ','
       || CASE WHEN contains(line, ',') OR contains(line, '"') THEN '"' || replace(line, '"', '""') || '"' ELSE line END || ','
       || coalesce(strftime(event_time, '%Y-%m-%d %H:%M:%S'), '') AS csv FROM parsed""",
    }
)
