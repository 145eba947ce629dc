"""Exact top-k search by MaxScore over sharded postings (operator 9).

A vector's components, as integers, are its terms' weights. In a shard the postings of a
term are one column of numbers. For a query, a term's contribution lies between two
bounds that follow from the smallest and largest weight in its postings; what exceeds
the lower one is non-negative, as MaxScore needs. With the k-th best score so far as
threshold, terms are split: the essential ones, and those of the smallest bounds, which
together can't lift a vector to the threshold. The essential postings are traversed;
vectors that remain competitive are probed in the other postings, a few at a time, and
leave as soon as their bound falls below the threshold.

Rows are dealt to shards, queries to blocks, by a hash of the whole row; a task holds one shard and
one block, both of bounded memory, and returns the shard's best k of each query. The first shard is
searched before the others: the k-th best score that a query has there goes with it to all other
shards as the threshold to start from. Inside a shard the postings are taken a part at a time, and the
threshold rises from part to part. A merge by query ranks what all shards found. Scores are exact: in
float64 as long as every sum stays below 2 ** 53, else int64.

Defined cases: vectors that are null or hold null or non-finite components take no part,
nor do rows with a null id; missing components of shorter vectors count as 0; repeated rows
(one id and the same weights) count once; different vectors of one id are candidates and
queries each, ranked together by id, and none is a candidate for its own id; ties go to the
smaller id; a query with fewer candidates than k has fewer rows; an empty table gives none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lograft.llm.shared import complete_groups, cut

SHARD_WEIGHTS = 1 << 20  # of a shard or block of queries: 8 MB
PART_ROWS = 2048  # of the postings searched at once
PROBE = 8  # terms probed at a time


def integer_terms(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, terms``: floor(scale * x) of each component, for the vectors that take part."""
    vector = F.col(vector_col)
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    terms = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    rows = rows.where(F.col(id_col).isNotNull() & vector.isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.select(F.col(id_col).cast("long").alias("id"), terms.alias("terms"))


def max_score(
    weights: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int, low: np.ndarray, high: np.ndarray, threshold=-np.inf
) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows for a query, in order: ids and scores. ``weights``: a row of postings per term,
    columns in the order of ``ids`` (ascending); ``low`` and ``high``: each term's bounds. Rows below
    ``threshold`` may be left out."""
    ends = np.stack((query * low, query * high))
    least, gain = ends.min(axis=0), ends.max(axis=0) - ends.min(axis=0)
    order = np.argsort(-gain, kind="stable")
    # rest[i]: the most that the terms from the i-th on can give
    rest = np.concatenate((np.cumsum((gain + least)[order][::-1])[::-1], [0]))
    # a start for the threshold: the k-th best of the first rows
    if not np.isfinite(threshold):
        few = np.flatnonzero(ids[: 16 * k + 1] != own)
        if len(few) >= k:
            seed = query @ weights[:, few]
            threshold = np.partition(seed, len(seed) - k)[len(seed) - k]
    # essential terms: without them no row reaches the threshold
    floor = np.concatenate(([0], np.cumsum(least[order])))
    without = gain[order][::-1].cumsum()[::-1] + floor[-1]
    essential = int(np.count_nonzero(without >= threshold)) if np.isfinite(threshold) else len(order)
    score = query[order[:essential]] @ weights[order[:essential]]
    alive = np.flatnonzero((score + rest[essential] >= threshold) & (ids != own))
    score = score[alive]
    for at in range(essential, len(order), PROBE):
        part = order[at : at + PROBE]
        score = score + query[part] @ weights[np.ix_(part, alive)]
        keep = score + rest[min(at + PROBE, len(order))] >= threshold
        alive, score = alive[keep], score[keep]
    best = np.lexsort((ids[alive], -score))[:k]
    return ids[alive[best]], score[best]


def best_of_shard(weights: np.ndarray, ids: np.ndarray, asked: np.ndarray, names: np.ndarray, k: int, thresholds: list) -> list:
    """For each of the ``asked`` queries its k best rows of a shard (a row of ``weights`` each), as in
    ``max_score``; ``thresholds``: where each query starts."""
    none = (np.zeros(0, dtype=ids.dtype), np.zeros(0, dtype=weights.dtype))
    best, thresholds = [none] * len(names), list(thresholds)
    order = np.argsort(ids, kind="stable")
    for at in range(0, len(ids), PART_ROWS):
        part = order[at : at + PART_ROWS]
        postings = np.ascontiguousarray(weights[part].T)
        low, high = postings.min(axis=1), postings.max(axis=1)
        for i, (own, query) in enumerate(zip(names, asked, strict=True)):
            found, score = max_score(postings, ids[part], query, own, k, low, high, thresholds[i])
            if not len(found):
                continue
            found, score = np.concatenate((best[i][0], found)), np.concatenate((best[i][1], score))
            top = np.lexsort((found, -score))[:k]
            best[i] = found[top], score[top]
            if len(top) == k:
                thresholds[i] = max(thresholds[i], score[top[-1]])
    return best


def _matrix(terms: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows; the missing components of shorter ones are 0."""
    sizes = np.diff(terms.offsets.to_numpy())
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = terms.flatten().to_numpy()
    return out


def search(
    rows: DataFrame,
    is_query,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int | None = None,
    query_block: int | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``is_query`` (a condition on ``id``) its k best others.

    ``shard_rows``, ``query_block``: rows of a shard, queries of a block; if not given, as many as have
    ``SHARD_WEIGHTS`` numbers."""
    terms = cut(integer_terms(rows, id_col, vector_col, scale).dropDuplicates(["id", "terms"]))
    n, asked, width = terms.agg(F.count("*"), F.count_if(is_query), F.max(F.size("terms"))).first()
    bounded = max(1, SHARD_WEIGHTS // max(width or 1, 1))
    shards, blocks = max(1, math.ceil(n / (shard_rows or bounded))), max(1, math.ceil(asked / (query_block or bounded)))
    among = lambda first, last: F.explode(F.sequence(F.lit(first), F.lit(last)))
    of = lambda name, m: F.pmod(F.xxhash64(F.lit(name), "id", "terms"), F.lit(m)).cast("int")
    sharded = terms.withColumn("shard", of("shard", shards))
    queries = terms.where(is_query).withColumn("block", of("block", blocks))
    keys = ["shard", "block"]

    def run(batches):
        for table, edges in complete_groups(batches, keys):
            for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                group = table.slice(begin, end - begin).combine_chunks()
                asks = group.column("asks").to_numpy() == 1
                if asks.all() or not asks.any():
                    continue
                held = group.column("terms").combine_chunks()
                all_weights = _matrix(held, max(int(np.diff(held.offsets.to_numpy()).max()), 1))
                ids = group.column("id").to_numpy()
                weights, asked = all_weights[~asks], all_weights[asks]
                largest = float(np.abs(weights).max()) * float(np.abs(asked).max()) * weights.shape[1] * 4
                kind = np.float64 if largest < 2.0**53 else np.int64
                starts = group.column("threshold").filter(pa.array(asks)).to_pylist()
                starts = [-np.inf if t is None else kind(t) for t in starts]
                found = best_of_shard(weights.astype(kind), ids[~asks], asked.astype(kind), ids[asks], k, starts)
                counts = [len(x) for x, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids[asks], counts)),
                        pa.array(np.concatenate([x for x, _ in found])),
                        pa.array(np.concatenate([s for _, s in found]).astype(np.int64)),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    def best(first: int, last: int, queries: DataFrame) -> DataFrame:
        candidates = sharded.where(F.col("shard").between(first, last)).select(
            "shard", among(0, blocks - 1).alias("block"), F.lit(0).alias("asks"), "id", "terms", F.lit(None).cast("long").alias("threshold")
        )
        asking = queries.select(among(first, last).alias("shard"), "block", F.lit(1).alias("asks"), "id", "terms", "threshold")
        dealt = candidates.unionByName(asking).repartition(*keys).sortWithinPartitions(*keys)
        return dealt.mapInArrow(run, "query_id long, vec_id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    found = best(0, 0, queries.withColumn("threshold", F.lit(None).cast("long")))
    if shards > 1:
        found = cut(found)
        # no query's k-th best of all shards lies below that of one
        kth = ranked(found).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("threshold"))
        found = found.unionByName(best(1, shards - 1, queries.join(kth, "id", "left")))
    return ranked(found)


def oracle_sql(every: int = 50, k: int = 5, scale: int = 256) -> str:
    """The same search in DuckDB SQL, by comparing every query with every row."""
    return f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS t
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum(list_transform(range(1, least(len(q.t), len(c.t)) + 1), lambda i: q.t[i] * c.t[i])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {every} = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}
"""
