"""Embedding near-duplicates by PCA-ordered tiled comparison (operator 10).

Vectors are compared within their label by cosine. Equal vectors are one class. The
second moments of all unit vectors give a basis in which the leading dimensions hold
most of the length; each class is turned into it. A label's classes are cut into tiles
along the leading dimension, of width ``sqrt(2 - 2 * threshold)``: linked unit vectors
differ there by no more, so a tile is compared with itself and the next one. Large tiles
are cut into blocks, and a task compares two blocks.

For two tiles the products of the leading dimensions are accumulated first, for all
pairs at once. What the other dimensions can add is at most the product of the two
vectors' suffix norms; pairs that can't reach the threshold stop there. The rest go on
by some dimensions at a time, and what is left is decided by the cosine of the vectors
as given, in double precision.

A task returns the links counted per class and the pairs of a spanning forest, not all
pairs. Nothing is dropped or capped.

Defined cases: vectors that are null, of length zero or hold null or non-finite
components link with nothing, nor do rows with a null label; vectors of different
dimension don't link; a repeated row counts as one more vector, as do different vectors of
one id, each with its own links; a row with a null id
comes back unlinked; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lograft.llm.shared import complete_groups, components, cut, linked_rows

THRESHOLD = 0.98
BLOCK_ROWS = 1024
PAIRS = 1 << 16  # pairs handled at once
LEADING, STEP = 12, 8


def _valid(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v`` (v null for vectors that take no part) and a hash key of equal vectors."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    part = F.coalesce(fine, F.lit(False)) & F.coalesce(some, F.lit(False)) & F.col(label_col).isNotNull()
    part = part & F.col(id_col).isNotNull()
    rows = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.when(part, v).alias("v")
    )
    key = F.concat_ws(":", "label", F.xxhash64("v"), F.xxhash64(F.lit("second"), F.col("v")), F.size("v"))
    return rows.withColumn("key", F.when(F.col("v").isNotNull(), key))


def _unit(lists: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of one length, scaled to length 1 (the largest component first, against overflow)."""
    flat = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    x = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _bases(classes: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension of vectors a basis, leading directions first: the eigenvectors of the second
    moments of all unit vectors, added up in the tasks and then by cell."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            width = b.column("dim").to_numpy()
            for d in np.unique(width).tolist():
                x = _unit(b.column("v").filter(pa.array(width == d)), d)
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, m in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d * d, d)), pa.array(np.arange(d * d)), pa.array(m.ravel())], names=["dim", "cell", "x"]
            )

    cells = classes.select("dim", "v").mapInArrow(run, "dim long, cell long, x double")
    table = cells.groupBy("dim", "cell").agg(F.sum("x").alias("x")).toPandas()  # dim ** 2 rows of each dimension
    out = {}
    for d, own in table.groupby("dim"):
        m = np.zeros(d * d)
        m[own["cell"].to_numpy()] = own["x"].to_numpy()
        out[int(d)] = np.linalg.eigh(m.reshape(d, d))[1][:, ::-1]
    return out


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float, leading: int = LEADING, step: int = STEP):
    """Pairs (i, j) of rows of two arrays of unit vectors, leading dimensions first, whose product may
    reach the threshold (a margin of 1e-9 is left for rounding)."""
    aim = threshold - 1e-9
    norms = lambda x: np.sqrt(np.maximum(0, np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]))
    tail_a, tail_b = (np.pad(norms(x), ((0, 0), (0, 1))) for x in (a, b))
    width = a.shape[1]
    at = min(leading, width)
    part = a[:, :at] @ b[:, :at].T
    i, j = np.nonzero(part + tail_a[:, at][:, None] * tail_b[:, at][None, :] >= aim)
    found = []
    for k in range(0, len(i), PAIRS):
        x, y, done = i[k : k + PAIRS], j[k : k + PAIRS], at
        product = part[x, y]
        while done < width and len(x):
            to = min(done + step, width)
            product = product + np.einsum("ij,ij->i", a[x, done:to], b[y, done:to])
            keep = product + tail_a[x, to] * tail_b[y, to] >= aim
            x, y, product, done = x[keep], y[keep], product[keep], to
        found.append((x, y))
    if not found:
        return i, j
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each pair of rows, in double precision."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _dealt(classes: DataFrame, bases: dict[int, np.ndarray], threshold: float, block_rows: int) -> DataFrame:
    """The classes, once for each pair of blocks that holds them: ``tile, block`` of the first block,
    ``next_tile, next_block`` of the second, ``side`` (0: in the first, 1: in the second, 2: both are the same)."""
    sent = classes.sparkSession.sparkContext.broadcast({d: m[:, 0].copy() for d, m in bases.items()})
    width = math.sqrt(2 - 2 * threshold) + 1e-9

    def lead(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            out = np.zeros(b.num_rows)
            for d in np.unique(dims).tolist():
                at = dims == d
                out[at] = _unit(b.column("v").filter(pa.array(at)), d) @ sent.value[d]
            tile = pa.array(np.floor(out / width).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns, tile], names=[*b.schema.names, "tile"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    tiled = cut(classes.mapInArrow(lead, kinds + ", tile int"))
    where = ["label", "dim", "tile"]
    blocks = tiled.groupBy(*where).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    beside = lambda by, name: blocks.select(
        "label", "dim", (F.col("tile") + by).alias("tile"), F.col("blocks").alias(name)
    )
    blocks = blocks.join(beside(-1, "above"), where, "left").join(beside(1, "below"), where, "left")
    rows = tiled.join(blocks, where)
    own, tile = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"), F.col("tile")

    def struct(t, i, u, j, side) -> Column:
        return F.struct(
            t.alias("tile"), i.alias("block"), u.alias("next_tile"), j.alias("next_block"), side.cast("int").alias("side")
        )

    side = lambda k: F.when(k == own, 2).when(own < k, 0).otherwise(1)
    held = F.concat(
        F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda k: struct(tile, F.least(own, k), tile, F.greatest(own, k), side(k)),
        ),
        F.when(
            F.col("above") > 0,
            F.transform(F.sequence(F.lit(0), F.col("above") - 1), lambda k: struct(tile, own, tile + 1, k, F.lit(0))),
        ).otherwise(F.array()),
        F.when(
            F.col("below") > 0,
            F.transform(F.sequence(F.lit(0), F.col("below") - 1), lambda k: struct(tile - 1, k, tile, own, F.lit(1))),
        ).otherwise(F.array()),
    )
    return rows.select("label", "dim", "class_id", "copies", "v", F.inline(held))


def _linked(dealt: DataFrame, bases: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """The links inside each pair of blocks (see ``linked_rows``)."""
    sent = dealt.sparkSession.sparkContext.broadcast(bases)  # dimension ** 2 numbers
    keys = ["label", "dim", "tile", "block", "next_tile", "next_block"]

    def links_of(group: pa.Table) -> pa.RecordBatch | None:
        group = group.sort_by([("side", "ascending"), ("class_id", "ascending")])
        side, d = group.column("side").to_numpy(), group.column("dim")[0].as_py()
        raw = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        turned = _unit(group.column("v"), d) @ sent.value[d]
        if side[-1] == 2:
            i, j = tile_links(turned, turned, threshold)
            i, j = i[i < j], j[i < j]
        else:
            split = int((side == 0).sum())
            i, j = tile_links(turned[:split], turned[split:], threshold)
            j = j + split
        exact = [cosines(raw[i[k : k + PAIRS]], raw[j[k : k + PAIRS]]) >= threshold for k in range(0, len(i), PAIRS)]
        hit = np.concatenate(exact) if exact else np.zeros(0, dtype=bool)
        return linked_rows(group.column("class_id").to_numpy(), group.column("copies").to_numpy(), i[hit], j[hit])

    def run(batches):
        for table, edges in complete_groups(batches, keys):
            for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                found = links_of(table.slice(begin, end - begin)) if end - begin > 1 else None
                if found is not None:
                    yield found

    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a long, b long, links long")


def link_vectors(
    rows: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    every = cut(_valid(rows, id_col, vector_col, label_col))
    named = every.where("key is not null")
    groups = named.groupBy("key").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"))
    heads = named.join(groups.withColumnRenamed("class_id", "vec_id"), ["key", "vec_id"])
    heads = heads.dropDuplicates(["key", "vec_id"])
    heads = heads.select("key", F.col("vec_id").alias("least_id"), "copies", "label", F.size("v").alias("dim"), "v")
    # a class has a number of its own: different vectors of one id are in several
    classes = cut(heads.withColumn("class_id", F.monotonically_increasing_id()))

    bases = _bases(classes)
    points = classes.select("label", "dim", "class_id", "copies", "v")
    found = cut(_linked(_dealt(points, bases, threshold, block_rows), bases, threshold))
    reached = components(found.where("b is not null").select("a", "b")).withColumnRenamed("id", "class_id")
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "class_id")
    numbers = classes.select("key", "class_id", "least_id", "copies")
    least = numbers.join(reached, "class_id").groupBy("component").agg(F.min("least_id").alias("component_id"))
    per_class = (
        numbers.join(links, "class_id", "left")
        .join(reached, "class_id", "left")
        .join(least, "component", "left")
        .select(
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "least_id").alias("component_id"),
        )
    )
    linked = named.select("vec_id", "key").join(per_class, "key").drop("key")
    alone = every.where("key is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id", kept)


def oracle_sql(threshold: float = THRESHOLD) -> str:
    """The same links and groups in DuckDB SQL, by comparing all pairs within a label."""
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.n > 0 AND b.n > 0
    AND list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i])) / (a.n * b.n) >= {threshold}),
reached(id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, l.b FROM reached r JOIN links l ON r.other = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e LEFT JOIN counts c ON e.vec_id = c.a LEFT JOIN least l ON e.vec_id = l.id
"""
