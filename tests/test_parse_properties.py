"""Property test: Spark's parse columns agree with a plain-Python model on generated lines."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lograft.functions import patterns as P
from lograft.functions.parse import parse_lines

LEVELS = ["INFO", "WARN", "ERROR", "DEBUG", "INFORMATION", "XINFO", "WARNING", "info"]
WORDS = ["a", "x.Y:", "boom", "task", ":", "saw", "for", "(TID 7)", "  ", "\t"]


@st.composite
def log_line(draw):
    parts = []
    if draw(st.booleans()):
        yy, mm, dd = draw(st.integers(0, 99)), draw(st.integers(0, 14)), draw(st.integers(0, 33))
        hh, mi, ss = draw(st.integers(0, 25)), draw(st.integers(0, 61)), draw(st.integers(0, 61))
        gap = draw(st.sampled_from([" ", "  "]))
        parts.append(f"{yy:02d}/{mm:02d}/{dd:02d}{gap}{hh:02d}:{mi:02d}:{ss:02d}")
    for _ in range(draw(st.integers(0, 6))):
        kind = draw(st.integers(0, 2))
        if kind == 0:
            parts.append(draw(st.sampled_from(LEVELS)))
        elif kind == 1:
            parts.append(f"application_{draw(st.integers(10**12, 10**13))}_{draw(st.integers(0, 9999)):04d}")
        else:
            parts.append(draw(st.sampled_from(WORDS)))
    prefix = draw(st.sampled_from(["", "x ", "  "]))
    return prefix + " ".join(parts)


def _first(pattern, text, group=1):
    m = re.search(pattern, text)
    return m.group(group) if m else ""


def _time(text):
    raw = _first(P.TS_ANY, text)
    if not raw or "  " in raw or "\t" in raw:
        return None  # the Spark pattern has one space; other whitespace does not parse
    try:
        yy, mm, dd = (int(x) for x in raw[:8].split("/"))
        hh, mi, ss = (int(x) for x in raw[-8:].split(":"))
        return dt.datetime(2000 + yy, mm, dd, hh, mi, ss)
    except ValueError:
        return None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(log_line(), min_size=40, max_size=40))
def test_parse_matches_python_model(spark, lines):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "event_id bigint, line string")
    got = {r["event_id"]: r for r in parse_lines(df).collect()}
    for i, text in enumerate(lines):
        r = got[i]
        assert r["log_level"] == _first(P.LEVEL_WORD, text), text
        assert r["level_loose"] == _first(P.LEVEL_LOOSE, text), text
        assert r["component"] == _first(P.COMPONENT, text, 2), text
        assert r["application_id"] == _first(P.APPLICATION, text), text
        assert r["cluster_id"] == _first(P.CLUSTER_IN_APP, text), text
        assert r["ts_head"] == _first(P.TS_HEAD, text), text
        assert r["event_time"] == _time(text), text
