"""Joins of many rows to a table of one row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_GROUPS = 100_000


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to ``groups`` (unique per ``keys``), NULL keys matching NULL keys.

    The groups are counted: up to ``BROADCAST_GROUPS`` of them are broadcast, so the rows
    stay where they are; more are joined by a shuffle of both sides. Without ``keys``,
    ``groups`` is a single row.
    """
    keys = list(keys)
    other = groups.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    few = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    other = F.broadcast(other) if few else other.hint("merge")
    if not keys:
        return rows.crossJoin(other)
    match = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    on = match[0]
    for m in match[1:]:
        on = on & m
    return rows.join(other, on, how).drop(*[f"_of_{k}" for k in keys])
