"""Log lines derived from the ``events`` table.

The driver ships no raw logs, so a deterministic log-line view is built from
``events`` with Spark expressions: every event becomes one line in the
documented line formats (header, level, component, message, application ids),
one event in ten becomes a stack-trace continuation line. The work is a single
narrow projection, so it scales with ``events`` and keeps its partitioning.

Rule (all arithmetic on ``event_id``; fixed values):

* continuation line when ``id % 10 = 0``: ``'    at frame(<id>)'`` and
  ``' INFORMATION'`` when ``id % 20 = 0``;
* otherwise ``<time><gap><LEVEL> <message>[ after ERROR] for <app0>[ and <app1>]``
  where time is ``'24/13/45 10:00:00'`` when ``id % 11 = 0``, date and time two
  spaces apart when ``id % 17 = 0``, else ``yy/MM/dd HH:mm:ss`` of ``ts``; the gap
  is two spaces when ``id % 19 = 0``; ``after ERROR`` when ``id % 23 = 0``;
  ``and <app1>`` when ``id % 7 = 0``;
* level: error -> ERROR, signup -> WARN, purchase -> DEBUG, else INFO;
* ``app(k)``: ``n = (id div 26) % 150 + k``,
  ``application_<1485248649253 + n % 6>_<n as 4 digits>``;
* message chosen by ``id % 13`` (see ``_MESSAGE``).

Each line is built behind a generator of one row, which later expressions are not merged
into, so that it is built once however many columns are parsed from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed values of the view.
CLUSTER_BASE = 1485248649253
APPS = 150
CLUSTERS = 6


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _app(n: str) -> str:
    return f"concat('application_', {_s(f'{CLUSTER_BASE} + ({n}) % {CLUSTERS}')}, '_', lpad({_s(n)}, 4, '0'))"


# Task and stage with their attempts: an application's tasks are tried again 3,900 events later, up to
# four times, before its next stage begins.
_TASK = f"""concat(' task ', {_s('i div 13 % 2')}, '.', {_s('i div 3900 % 4')}, ' in stage ',
                   {_s('i div 26 % 5 + 5 * (i div 15600)')}, '.', {_s('i div 130 % 2')})"""

# The message of an event, chosen by ``i % 13`` (one Spark SQL expression).
_MESSAGE = f"""CASE i % 13
  WHEN 0 THEN concat('executor.Executor: Running', {_TASK}, ' (TID ', {_s('i')}, ')')
  WHEN 1 THEN concat('executor.Executor: Finished', {_TASK}, ' (TID ', {_s('i - 1')}, '). ', {_s('1000 + i % 900')},
                     ' bytes result sent to driver')
  WHEN 2 THEN concat('python.PythonRunner: Times: total = ', {_s('i % 5000')}, ', boot = ', {_s('i % 70')},
                     ', init = ', {_s('i % 50')}, ', finish = ', {_s('i % 900')})
  WHEN 3 THEN concat('YarnAllocator: Will request ', {_s('1 + i % 16')}, ' executor containers, each with ',
                     {_s('1 + i % 5')}, ' cores and ', {_s('1024 * (1 + i % 28)')}, ' MB memory',
                     IF(i % 2 = 0, ' including 2560 MB overhead', ''))
  WHEN 4 THEN concat('YarnAllocator: Container request (host: ', IF(i % 3 = 0, 'Any', concat('node-', {_s('i % 4')})),
                     ', capability: <memory:', {_s('1024 * (1 + i % 28)')}, ', vCores:', {_s('1 + i % 5')}, '>)')
  WHEN 5 THEN concat('rdd.HadoopRDD: Input split: hdfs://10.0.0.1:9000/in/f', {_s('i % 9')}, '.txt:',
                     {_s('i * 100')}, '+', {_s('1000 + i % 500')})
  WHEN 6 THEN concat('storage.MemoryStore: MemoryStore started with capacity ', {_s('1 + i % 30')}, '.5 GB')
  WHEN 7 THEN concat('storage.MemoryStore: Block broadcast_', {_s('i % 40')},
                     ' stored as bytes in memory (estimated size ', {_s('1 + i % 90')}, '.5 KB, free 2.5 GB)')
  WHEN 8 THEN concat('storage.MemoryStore: Block rdd_', {_s('i % 40')}, '_', {_s('i % 6')},
                     ' stored as bytes in memory (estimated size ', {_s('1 + i % 90')}, '.0 MB, free 2.5 GB)')
  WHEN 9 THEN concat('broadcast.TorrentBroadcast: Started reading broadcast variable ', {_s('i % 40')})
  WHEN 10 THEN concat('storage.BlockManagerInfo: Added broadcast_', {_s('i % 40')}, '_piece', {_s('i % 3')},
                      ' in memory on node-', {_s('i % 7')}, ':52848 (size: ', {_s('1 + i % 8')}, '.0 MB, free: 2.5 GB)')
  WHEN 11 THEN concat('storage.BlockManager: Found block rdd_', {_s('i % 40')}, '_', {_s('i % 6')}, ' locally')
  ELSE concat('ApplicationMaster: step ', {_s('i')})
END"""

_TIME = """CASE WHEN i % 11 = 0 THEN '24/13/45 10:00:00'
     WHEN i % 17 = 0 THEN concat(date_format(ts, 'yy/MM/dd'), '  ', date_format(ts, 'HH:mm:ss'))
     ELSE date_format(ts, 'yy/MM/dd HH:mm:ss') END"""

_LEVEL = """CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN'
                       WHEN 'purchase' THEN 'DEBUG' ELSE 'INFO' END"""

LINE = f"""CASE WHEN i % 10 = 0 THEN concat('    at frame(', {_s('i')}, ')', IF(i % 20 = 0, ' INFORMATION', ''))
ELSE concat({_TIME}, IF(i % 19 = 0, '  ', ' '), {_LEVEL}, ' ', {_MESSAGE},
            IF(i % 23 = 0, ' after ERROR', ''), ' for ', {_app('n0')},
            IF(i % 7 = 0, concat(' and ', {_app('n0 + 1')}), ''))
END"""


def log_lines_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> ``(event_id bigint, line string)``, one line per event.

    The rule is one SQL expression, evaluated once per event.
    """
    base = events.selectExpr("event_id AS i", "ts", "event_type", f"(event_id div 26) % {APPS} AS n0")
    return base.selectExpr("i AS event_id", f"explode(array({LINE})) AS line")


# ---------------------------------------------------------------- lines of container files
# Fixed values of the file view: how many applications each cluster has (a skewed split),
# and one line in ten per position of a container's block.
FILE_CLUSTERS = (181, 8, 2, 1, 1, 1)
FILE_APPS = sum(FILE_CLUSTERS)
BLOCK = 10
CYCLE = 4 * BLOCK * FILE_APPS


def _cluster_number(a: str) -> str:
    upto, cases = 0, []
    for k, n in enumerate(FILE_CLUSTERS):
        upto += n
        cases.append(f"WHEN {a} < {upto} THEN {k}")
    return f"CASE {' '.join(cases)} END"


# A task that does not finish in an attempt's first container is tried again in its second.
_AGAIN = "b % 2 = 1 AND b % 7 = 4 AND j < 7"
_FILE_TASK = f"""concat(' task ', {_s(f'IF(j >= 7, 7, 1) + IF({_AGAIN}, 0, 10 * (b % 2))')}, '.', IF({_AGAIN}, '1', '0'),
                   ' in stage ', {_s('b div 2 % 3 + 3 * cycle')}, '.', IF(b div 2 % 5 = 0, '1', '0'), ' (TID ', {_s('tid')}, ')')"""

_FILE_MESSAGE = f"""CASE j
  WHEN 0 THEN concat('YarnAllocator: Will request ', {_s('1 + b % 16')}, ' executor containers, each with ',
                     {_s('1 + b % 5')}, ' cores and ', {_s('1024 * (1 + b % 28)')}, ' MB memory')
  WHEN 1 THEN concat('executor.Executor: Running', {_FILE_TASK})
  WHEN 2 THEN concat('python.PythonRunner: Times: total = ', {_s('b % 5000')}, ', boot = ', {_s('b % 70')},
                     ', init = ', {_s('b % 50')}, ', finish = ', {_s('b % 900')})
  WHEN 3 THEN IF(b % 7 = 3, 'executor.Executor: waiting',
                 concat('executor.Executor: Finished', {_FILE_TASK}, '. ', {_s('1000 + b % 900')}, ' bytes result sent to driver'))
  WHEN 4 THEN concat('storage.MemoryStore: MemoryStore started with capacity ', {_s('1 + b % 30')}, '.5 GB')
  WHEN 5 THEN concat('broadcast.TorrentBroadcast: Started reading broadcast variable ', {_s('b % 40')})
  WHEN 6 THEN concat('storage.BlockManager: Found block rdd_', {_s('b % 40')}, '_', {_s('b % 6')}, ' locally')
  WHEN 7 THEN concat('executor.Executor: Running', {_FILE_TASK})
  WHEN 8 THEN concat('executor.Executor: Finished', {_FILE_TASK}, '. ', {_s('1000 + b % 900')}, ' bytes result sent to driver')
  ELSE concat('ApplicationMaster: step ', {_s('i')})
END"""

_FILE_SECONDS = "b * 100 + j * (1 + b % 9) + IF(j = 8 AND b % 50 = 0, 600, 0)"


def container_lines_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> ``(event_id, path, line_no, line)``: lines of container files in the documented
    layout ``application_<cluster>_<app>/container_<cluster>_<app>_<attempt>_<n>.log``.

    No line names its application. Ten consecutive events are one block of a file; every
    application has two attempts of two containers, and its tasks' ids start anew with each
    attempt. Rule (fixed values): with ``b = id div 10`` and ``j = id % 10``, application
    ``a = (b div 4) % 194`` (clusters hold 181, 8, 2, 1, 1 and 1 of them), attempt
    ``1 + (b % 4) div 2``, container ``1 + b % 2``, line ``(id div 7760) * 10 + j`` of the
    file. A task that has no finish line in an attempt's first container (``b % 7 = 3``) has a
    second attempt in its other one. Lines 4 to 6 of every third block are a run of stack frames, and so is the first
    line of every fifth.
    """
    base = events.selectExpr("event_id AS i", "event_type", f"event_id div {BLOCK} AS b", f"CAST(event_id % {BLOCK} AS INT) AS j")
    base = base.selectExpr(
        "*", f"(b div 4) % {FILE_APPS} AS a", f"i div {CYCLE} AS cycle",
        # running at 1 and finished at 3; running at 7 and finished at 8
        f"(i div {CYCLE}) * 4 + (b % 2) * 2 + IF(j >= 7, 1, 0) AS tid",
    )
    base = base.selectExpr("*", f"concat({_s(f'{CLUSTER_BASE} + {_cluster_number('a')}')}, '_', lpad({_s('a + 1')}, 4, '0')) AS app")
    path = f"concat('logs/application_', app, '/container_', app, '_0', {_s('1 + (b % 4) div 2')}, '_00000', {_s('1 + b % 2')}, '.log')"
    time = f"date_format(TIMESTAMP_NTZ '2017-03-29 10:00:00' + make_dt_interval(0, 0, 0, {_FILE_SECONDS}), 'yy/MM/dd HH:mm:ss')"
    frame = "(b % 3 = 0 AND j BETWEEN 4 AND 6) OR (b % 5 = 1 AND j = 0)"
    line = f"IF({frame}, concat('    at frame(', {_s('i')}, ')'), concat({time}, ' ', {_LEVEL}, ' ', {_FILE_MESSAGE}))"
    return base.selectExpr("i AS event_id", f"cycle * {BLOCK} + j AS line_no", f"inline(array(named_struct('path', {path}, 'line', {line})))")
