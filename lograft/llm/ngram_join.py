"""N-gram Jaccard join with Bayesian candidate pruning (operator 3).

1. Every whole text becomes its set of word shingles (hashed to 64 bits), a digest of
   that set, a MinHash signature and band keys. Texts of one set are one class; only
   one document of a class goes on.
2. Classes that share a band key are candidates. Their signatures are compared a few
   values at a time; a pair is dropped as soon as the posterior probability that its
   similarity reaches the threshold falls below the tolerance. With a uniform prior,
   after ``m`` of ``n`` equal values it is the chance of at most ``m`` successes in
   ``n + 1`` trials of the threshold's probability.
3. What is left joins classes into candidate groups, and inside these the Jaccard
   similarity of each pair of classes is computed exactly from the shingle sets.

Large buckets and large groups are dealt out as pairs of blocks, so no task gathers
one whole; inside a bucket members that agree with a pivot need no further comparison
with each other, and a task passes on a spanning forest, not pairs.

The result has one row per document: its class, how many other documents it is linked
with (copies of its class included), the smallest id it reaches, and whether it stays.

Defined cases: words are runs of letters or digits, lower-cased; a text of one to four
words is one shingle; a null text or one without a word has no shingle and links with
nothing; a repeated row counts as one more copy; rows of one id with different texts are
documents of their own, each with its own links; rows with a null id come back
unlinked; other columns are not read; an empty table gives no rows. Of each group one row
(and its repetitions) is ``kept``: that of the least id, then the least shingle set and text hash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft.llm.shared import complete_groups, components, cut, forest, linked_rows
from lograft.llm.spans import TextBatch, chunks, mix64

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 6
TOLERANCE = 1e-6
STEP = 40  # signature values compared at a time
BUCKET_BLOCK = 1024  # members of a bucket that one task compares
GROUP_BLOCK = 384  # classes in a block of a group; a task holds two blocks' sets
GROUP_SHINGLES = 400_000  # shingles in a block of a group


def shingle_sets(texts: Sequence[str | None], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    batch = TextBatch(texts, lower=True)
    starts, ends = batch.word_spans()
    counts = np.diff(np.searchsorted(starts, batch.begins))
    word = batch.hashes(starts, ends)
    weights = mix64(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(word) - words + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        rolled += word[k : k + n] * weights[k]
    rolled = mix64(rolled)
    sets, at = [], 0
    for c in counts.tolist():
        if c >= words:
            sets.append(np.unique(rolled[at : at + c - words + 1]))
        elif c:
            few = (word[at : at + c] * weights[:c]).sum(dtype=np.uint64, keepdims=True) + np.uint64(c)
            sets.append(mix64(few))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
        at += c
    return sets


def signatures(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """One byte of each MinHash value, and the band keys, of every (non-empty) set."""
    k = bands * rows
    factors = mix64(np.arange(1, k + 1, dtype=np.uint64) + np.uint64(0xA5A5)) | np.uint64(1)
    sizes = np.array([len(s) for s in sets])
    first = np.cumsum(sizes) - sizes
    flat = np.concatenate(sets)
    least = np.empty((len(sets), k), dtype=np.uint64)
    product = np.empty_like(flat)
    for i in range(k):
        np.multiply(flat, factors[i], out=product)
        least[:, i] = np.minimum.reduceat(product, first)
    least = mix64(least)
    keys = np.zeros((len(sets), bands), dtype=np.uint64)
    for r in range(rows):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + least[:, r::rows][:, :bands])
    keys = mix64(keys + np.arange(bands, dtype=np.uint64))
    return (least & np.uint64(0xFF)).astype(np.uint8), keys


def key_marks(keys: np.ndarray) -> np.ndarray:
    """Sixteen bits of each band key: with the signature's bytes they tell whether two sets share a band."""
    return (keys >> np.uint64(48)).astype("<u2")


def least_matches(threshold: float, tolerance: float, values: int, step: int = STEP) -> list[int]:
    """For each number of compared values, the fewest equal ones at which a pair is kept."""
    out = []
    for n in range(step, values + step, step):
        n = min(n, values) + 1
        below, m = 0.0, -1
        while below < tolerance and m < n - 1:
            m += 1
            below += math.comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        out.append(m)
    return out


def alike(left: np.ndarray, right: np.ndarray, least: list[int], step: int = STEP) -> np.ndarray:
    """Which rows of two signature arrays may still reach the threshold, compared step by step."""
    alive, equal = np.arange(len(left)), np.zeros(len(left), dtype=np.int64)
    for i, most in enumerate(least):
        part = slice(i * step, (i + 1) * step)
        equal = equal + (left[alive, part] == right[alive, part]).sum(axis=1)
        keep = equal >= most
        alive, equal = alive[keep], equal[keep]
    out = np.zeros(len(left), dtype=bool)
    out[alive] = True
    return out


def bucket_links(sigs: np.ndarray, least: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs of rows that join everything alike in a bucket.

    A pivot is compared with all that are left; those alike join it and leave. The rest are
    compared with them and stay, so no pair that could bring two groups together is passed over.
    """
    left = np.arange(len(sigs))
    while len(left) > 1:
        pivot, others = left[0], left[1:]
        near = alike(np.broadcast_to(sigs[pivot], (len(others), sigs.shape[1])), sigs[others], least)
        joined, left = others[near], others[~near]
        for x in joined.tolist():
            yield int(pivot), x
        for x in joined.tolist() if len(left) else ():
            hit = alike(np.broadcast_to(sigs[x], (len(left), sigs.shape[1])), sigs[left], least)
            for y in left[hit].tolist():
                yield x, int(y)


def exact_links(sets: list[np.ndarray], threshold: float, split: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``i < j`` of sets with a Jaccard similarity of the threshold or more.

    ``split``: only pairs of one before it and one from it on. Sizes alone rule some pairs
    out; the others' common shingles are counted by products of 0/1 matrices, some columns
    at a time, over the shingles that at least two sets have.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if n == 2:
        common = np.array([[0, len(np.intersect1d(sets[0], sets[1], assume_unique=True))], [0, 0]])
    else:
        values, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(n), sizes)
        shared = count >= 2
        column = np.cumsum(shared) - 1
        keep = shared[inverse]
        owner, inverse = owner[keep], column[inverse[keep]]
        order = np.argsort(inverse, kind="stable")
        owner, inverse = owner[order], inverse[order]
        width = 4096
        common = np.zeros((n, n), dtype=np.float32)
        total = int(inverse[-1]) + 1 if len(inverse) else 0
        for c in range(0, total, width):
            a, b = np.searchsorted(inverse, [c, c + width])
            part = np.zeros((n, min(width, total - c)), dtype=np.float32)
            part[owner[a:b], inverse[a:b] - c] = 1
            common += part @ part.T
    i, j = np.triu_indices(n, 1)
    if split is not None:
        across = (i < split) & (j >= split)
        i, j = i[across], j[across]
    both = common[i, j].astype(np.int64)
    union = sizes[i] + sizes[j] - both
    hit = (both >= threshold * union - 1e-9) & (union > 0)
    return i[hit], j[hit]


def _features(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, text_hash, set_key, size, sig, band_keys`` of all documents; only the first two where there
    is no shingle."""

    def run(batches):
        names = ["doc_id", "text_hash", "set_key", "size", "sig", "band_keys"]
        for b in batches:
            texts, named = b.column(1).to_pylist(), b.column(0).is_valid().to_pylist()
            for i, j in chunks(texts):
                sets = shingle_sets(texts[i:j], words)
                have = [k for k, s in enumerate(sets) if len(s) and named[i + k]]
                none = [None] * (j - i)
                digests, sizes, sigs, lists = none[:], none[:], none[:], none[:]
                if have:
                    kept = [sets[k] for k in have]
                    for k, s, sig, own in zip(have, kept, *signatures(kept, bands, rows), strict=True):
                        digests[k] = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                        sizes[k], lists[k] = len(s), own.view(np.int64)
                        sigs[k] = sig.tobytes() + key_marks(own).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0)[i:j], b.column(2)[i:j], pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                        pa.array(sigs, pa.binary()), pa.array(lists, pa.list_(pa.int64())),
                    ],
                    names=names,
                )

    return docs.mapInArrow(run, "doc_id long, text_hash long, set_key binary, size long, sig binary, band_keys array<bigint>")


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Deals each class of a group of ``blocks`` blocks out to the pairs of blocks that hold it: ``low``,
    ``high`` and ``side`` (0: of the first block, 1: of the second, 2: both are the same)."""
    rest = [c for c in rows.columns if c != "blocks"]
    rows = rows.withColumn("_own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(
        *rest,
        F.least("_own", "_other").alias("low"),
        F.greatest("_own", "_other").alias("high"),
        F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1).alias("side"),
    )


def met_before(left: np.ndarray, right: np.ndarray, band: np.ndarray, values: int, rows: int) -> np.ndarray:
    """Which pairs of sets share a whole band before the given one: the buckets of that band have joined
    them already. ``left`` and ``right``: the bytes of the signatures, then the marks of the band keys. A pair that
    shares no band takes one for shared with a chance of some 1e-7 (at a similarity of 0.8)."""
    out = np.zeros(len(left), dtype=bool)
    for i in range(0, len(left), 1 << 16):
        part = slice(i, i + (1 << 16))
        same = left[part] == right[part]
        bands = same[:, :values].reshape(len(same), -1, rows).all(axis=2) & same[:, values:].reshape(len(same), -1, 2).all(axis=2)
        out[part] = (bands & (np.arange(bands.shape[1]) < band[part, None])).any(axis=1)
    return out


def _candidate_edges(members: DataFrame, least: list[int], bands: int, rows: int) -> DataFrame:
    """``a, b``: classes of a bucket joined by pairs that are not ruled out, each in its first bucket;
    of the pairs that a task has at once, a spanning forest."""

    def run(batches):
        for table, edges in complete_groups(batches, keys):
            ids, band = table.column("node").to_numpy(), table.column("band").to_numpy()
            whole = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
            sigs = whole[:, : bands * rows]
            sizes = np.diff(edges)
            twos = edges[:-1][sizes == 2]
            hit = twos[alike(sigs[twos], sigs[twos + 1], least)]
            found = [np.stack((hit, hit + 1), axis=1)]
            for begin, size in zip(edges[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                pairs = list(bucket_links(sigs[begin : begin + size], least))
                if pairs:
                    found.append(begin + np.array(pairs))
            i, j = np.concatenate(found).T
            new = ~met_before(whole[i], whole[j], band[i], bands * rows, rows)
            nodes, at = np.unique(np.concatenate((ids[i[new]], ids[j[new]])), return_inverse=True)
            pairs = forest(len(nodes), at.reshape(2, -1).T.tolist())
            if pairs:
                a, b = nodes[np.array(pairs)].T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    keys = ["band", "bucket", "low", "high"]
    # in the order of ids, the same pivots come first in many buckets, and their pairs are the same
    dealt = members.repartition(*keys).sortWithinPartitions(*keys, "node")
    return dealt.select(*keys, "node", "sig").mapInArrow(run, "a long, b long")


def _verified(members: DataFrame, threshold: float) -> DataFrame:
    """``a, b, links``: of each class ``a`` in a pair of blocks, how many documents it is linked with
    there (``b`` null), and pairs that join what is linked (``links`` null)."""

    def run(batches):
        for table, edges in complete_groups(batches, keys):
            for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                found = links_of(table.slice(begin, end - begin))
                if found is not None:
                    yield found

    def links_of(group: pa.Table) -> pa.RecordBatch | None:
        columns = (group.column(c).to_pylist() for c in ("node", "side", "copies", "shingles"))
        rows = {name: rest for name, *rest in zip(*columns, strict=True)}
        names = sorted(rows, key=lambda k: (rows[k][0], k))
        sides = np.array([rows[k][0] for k in names])
        if len(names) < 2:
            return None
        split = None if (sides == 2).all() else int((sides == 0).sum())
        sets = [np.frombuffer(rows[k][2], dtype=np.uint64) for k in names]
        i, j = exact_links(sets, threshold, split)
        if not len(i):
            return None
        copies = np.array([rows[k][1] for k in names], dtype=np.int64)
        return linked_rows(np.array(names, dtype=np.int64), copies, i, j)

    keys = ["component", "low", "high"]
    dealt = members.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.select(*keys, "node", "side", "copies", "shingles").mapInArrow(run, "a long, b long, links long")


def _with_shingles(members: DataFrame, words: int) -> DataFrame:
    """The members with their shingle sets in place of their texts."""
    columns = [c for c in members.columns if c != "text"]

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            for i, j in chunks(texts):
                data = [s.tobytes() for s in shingle_sets(texts[i:j], words)]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c)[i:j] for c in columns), pa.array(data, pa.binary())], names=[*columns, "shingles"]
                )

    kinds = ", ".join(f"`{c}` {members.schema[c].dataType.simpleString()}" for c in columns)
    return members.mapInArrow(run, f"{kinds}, shingles binary")


def jaccard_join(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
    tolerance: float = TOLERANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_hash: bool = False,
) -> DataFrame:
    """``doc_id, class_id, n_links, component_id, kept`` of every row of ``docs``; ``class_id`` and
    ``component_id`` are the least ids of its copies and of its group. ``with_hash`` adds ``text_hash``, the
    ``xxhash64`` of the row's text, which tells rows of one id apart."""
    hashed = F.xxhash64(F.col(text_col)).alias("text_hash")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), hashed)
    features = cut(_features(texts, words, bands, rows))
    shingled = features.where("set_key is not null")

    # a class has a number of its own: rows of one id may be in several
    first = F.min(F.struct("doc_id", "text_hash")).alias("_first")
    classes = shingled.groupBy("set_key").agg(first, F.count("*").alias("copies")).select("set_key", "_first.*", "copies")
    heads = shingled.join(classes, ["set_key", "doc_id", "text_hash"]).dropDuplicates(["set_key"])
    heads = cut(heads.withColumnRenamed("doc_id", "class_id").withColumn("node", F.monotonically_increasing_id()))

    keys = heads.select("node", F.posexplode("band_keys").alias("band", "bucket"))
    buckets = keys.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = buckets.select("band", "bucket", F.ceil(F.col("n") / BUCKET_BLOCK).cast("int").alias("blocks"))
    members = keys.join(buckets, ["band", "bucket"]).join(heads.select("node", "sig"), "node")
    alike_pairs = _candidate_edges(_block_pairs(members), least_matches(threshold, tolerance, bands * rows), bands, rows)
    candidates = cut(components(alike_pairs).withColumnRenamed("id", "node"))

    own = candidates.join(heads.select("node", "class_id", "text_hash", "copies", "size"), "node")
    blocks = F.greatest(F.ceil(F.count("*") / GROUP_BLOCK), F.ceil(F.sum("size") / GROUP_SHINGLES)).cast("int")
    groups = own.groupBy("component").agg(blocks.alias("blocks"))
    chosen = own.drop("size").join(groups, "component")
    chosen = chosen.join(texts.withColumnRenamed("doc_id", "class_id"), ["class_id", "text_hash"]).drop("class_id", "text_hash")
    verified = cut(_verified(_block_pairs(_with_shingles(chosen, words)), threshold))
    reached = components(verified.where("b is not null").select("a", "b")).withColumnRenamed("id", "node")
    links = verified.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))

    named = heads.select("node", "set_key", "class_id", F.col("text_hash").alias("_hash"), "copies")
    least = named.join(reached, "node").groupBy("component").agg(F.min(F.struct("class_id", "set_key")).alias("_least"))
    per_class = (
        named.join(links, "node", "left")
        .join(reached, "node", "left")
        .join(least, "component", "left")
        .select(
            "set_key",
            "class_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("_least.class_id", "class_id").alias("component_id"),
            (F.coalesce("_least.set_key", "set_key") == F.col("set_key")).alias("_first"),
            "_hash",
        )
    )
    joined = shingled.select("doc_id", "text_hash", "set_key").join(per_class, "set_key").drop("set_key")
    kept = (F.col("doc_id") == F.col("component_id")) & F.col("_first") & (F.col("text_hash") == F.col("_hash"))
    joined = joined.withColumn("kept", kept).drop("_first", "_hash")
    alone = features.where("set_key is null").select(
        "doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"),
    )
    out = joined.unionByName(alone)
    return out.select("doc_id", *["text_hash"] * with_hash, "class_id", "n_links", "component_id", "kept")
