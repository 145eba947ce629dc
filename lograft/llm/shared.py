"""Checkpoints in the shared folder, whole groups inside tasks, links and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft.session import shared_folder


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder that ``spark.checkpoint.dir`` names and returns it as read
    from there. Where the session names none, local mode (as in tests) gets a folder of our own."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


SALTS = 32


def join_hot(rows: DataFrame, found: DataFrame, key: str, spread: str, salts: int = SALTS) -> DataFrame:
    """``rows`` left-joined to the few rows of ``found``, at most one per key. Rows of one key are dealt
    over ``salts`` tasks by a hash of ``spread``, so that a key may hold any share of them."""
    many = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    few = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return many.join(few, [key, "_salt"], "left").drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """``id, component``: every node of ``edges (a, b)`` with the smallest node that it reaches.

    Large-star and small-star steps in turn, each a minimum per node and a join back to
    it, until the edges no longer change. Edges only ever point to smaller nodes, so a
    group of any size is handled by rows of two ids; no group is gathered anywhere.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    current = cut(edges.where("a <> b").select(larger, smaller).distinct())
    seen = None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = cut(least.select("a", F.col("m").alias("b")).unionByName(moved).distinct())
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def complete_groups(batches, keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of a sorted partition, several at a time: a table and the edges of its groups."""
    held: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        table = pa.Table.from_batches([b])
        if held is not None:
            table = pa.concat_tables([held, table])
        change = np.zeros(table.num_rows - 1, dtype=bool)
        for k in keys:
            column = table.column(k).to_numpy()
            change |= column[1:] != column[:-1]
        edges = np.flatnonzero(change) + 1
        if len(edges):
            yield table.slice(0, edges[-1]).combine_chunks(), np.concatenate(([0], edges))
        held = table.slice(edges[-1]) if len(edges) else table
    if held is not None:
        yield held.combine_chunks(), np.array([0, held.num_rows])


def forest(n: int, pairs) -> list[tuple[int, int]]:
    """Those of the pairs that join two trees: at most ``n - 1``."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def linked_rows(ids: np.ndarray, copies: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch | None:
    """``a, b, links`` of linked pairs ``i, j``: for each node ``a`` how many rows (``copies`` of the other
    nodes) it is linked with (``b`` null), and those pairs that join what is linked (``links`` null)."""
    if not len(i):
        return None
    links = np.bincount(i, weights=copies[j], minlength=len(ids)) + np.bincount(j, weights=copies[i], minlength=len(ids))
    at = np.flatnonzero(links)
    tree = np.array(forest(len(ids), zip(i.tolist(), j.tolist(), strict=True)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((ids[at], ids[tree[:, 0]]))),
            pa.concat_arrays([pa.nulls(len(at), pa.int64()), pa.array(ids[tree[:, 1]], pa.int64())]),
            pa.concat_arrays([pa.array(links[at].astype(np.int64)), pa.nulls(len(tree), pa.int64())]),
        ],
        names=["a", "b", "links"],
    )
