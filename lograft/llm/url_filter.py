"""URL filters by a Bloom filter cascade (operator 4).

A rule is a host and a path; it fits urls of the host and its subdomains whose path
starts with the rule's, and the longest fitting rule decides. The keys that a url may
match are its host's suffixes and its path's prefixes in the shapes (labels, path
length) that the rules have. The corpus's distinct keys are the complete universe.

The cascade's first filter holds the rules' keys, the second those other keys of the
universe that the first takes in wrongly, the third the rules' keys that the second
takes in wrongly, and so on until nothing is taken in wrongly. A key of the universe is
listed if the first level without it has an even number (counted from 1), or if the
last level holds it and has an odd one. This is exact, and needs no join.

The first filter's error rate is the share of listed keys in the universe, the others'
is a half, so the size follows the number of rules and not the corpus. Rules are dealt
into shards of at most ``SHARD_KEYS``, one cascade and one broadcast each.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits
no rule; a url that no rule fits is not listed, and so allowed; repeated pages get the
same answer; of equal rules the blocking one holds; without rules or pages nothing
fails; only the id and url columns are read.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lograft.llm.shared import cut

# (verdict, host, path): the rules of the registered query (fixed values).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MOST_LEVELS = 96  # of a cascade
SHARD_KEYS = 4_000_000  # keys of one cascade: some 16 MB at the rates of a corpus of 10 ** 10 keys


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = _rest(url)
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def _keys(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """The keys of a url in each shape, in the shapes' order; null where it has too few labels or characters."""
    labels = F.when(host == "", 0).otherwise(F.size(F.split(host, r"\.", -1)))
    return F.array(
        *[
            F.when(
                (labels >= depth) & (F.length(path) >= size),
                F.concat(F.substring_index(host, ".", -depth), F.substring(path, 1, size)),
            )
            for depth, size in shapes
        ]
    )


class Filter:
    """One Bloom filter: ``bits`` positions, ``hashes`` of them for each key. Levels have different numbers
    of positions, so that keys which share all of them in one level don't in the next."""

    def __init__(self, expected: int, rate: float, level: int):
        self.hashes = max(1, round(math.log2(1 / rate)))
        words = 2 + math.ceil(expected * self.hashes / math.log(2) / 64)
        self.bits = 64 * words - (2 * level + 1) % 61
        self.words = np.zeros(words, dtype=np.uint64)

    def fill(self, keys: DataFrame) -> Filter:
        """Sets the bits of ``keys (one, two)``: ORed by word before anything is sent here."""
        step = F.explode(F.sequence(F.lit(0), F.lit(self.hashes - 1)))
        at = F.pmod(F.pmod("one", F.lit(self.bits)) + F.col("i") * F.pmod("two", F.lit(self.bits)), F.lit(self.bits))
        bits = keys.withColumn("i", step).select(at.alias("at")).select(
            F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit")
        )
        found = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most a row per word
        self.words[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.int64).view(np.uint64)
        return self

    def holds(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        out = np.ones(len(one), dtype=bool)
        one, two = one % self.bits, two % self.bits
        for i in range(self.hashes):
            at = (one + i * two) % self.bits
            out &= (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        return out


class Cascade:
    """Exact membership for the keys of a universe."""

    def __init__(self, levels: list[Filter]):
        self.levels = levels

    def listed(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        out = np.zeros(len(one), dtype=bool)
        inside = np.arange(len(one))
        for k, level in enumerate(self.levels, 1):
            inside = inside[level.holds(one[inside], two[inside])]
            out[inside] = k % 2 == 1
        return out


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.select("key", F.xxhash64("key").alias("one"), F.xxhash64(F.lit("second"), F.col("key")).alias("two"))


def _taken_in(keys: DataFrame, level: Filter) -> DataFrame:
    """The keys that a filter takes in."""

    def run(batches):
        for b in batches:
            hit = level.holds(b.column("one").to_numpy(), b.column("two").to_numpy())
            yield b.filter(pa.array(hit))

    return keys.mapInArrow(run, keys.schema)


def build_cascade(listed: DataFrame, others: DataFrame) -> Cascade:
    """Filters for ``listed (key, one, two)`` among all keys of ``listed`` and ``others``, which share none.

    Each level leaves about half of the keys before it. Two keys of one pair of hashes would never part: that
    is an error after ``MOST_LEVELS`` levels, which no number of keys comes near otherwise.
    """
    n, m = listed.count(), others.count()
    levels: list[Filter] = []
    inside, outside, count = listed, others, n
    rate = min(0.5, n / (math.sqrt(2) * max(m, 1))) if n else 0.5
    while count:
        if len(levels) == MOST_LEVELS:
            raise RuntimeError(f"{count} keys share both hashes with keys of the other list")
        levels.append(Filter(count, rate, len(levels)).fill(inside))
        rate = 0.5
        wrong = cut(_taken_in(outside, levels[-1]))
        inside, outside = wrong, inside
        count = inside.count()
    return Cascade(levels)


def rules_frame(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", shard_keys: int = SHARD_KEYS
) -> DataFrame:
    """``id_col, host, path, rule, verdict`` of every page under ``rules (verdict, host, path)``.

    ``rule`` is the longest fitting rule's host and path, null where none fits.
    """
    spark = pages.sparkSession
    url = F.col("_url")
    pages = pages.select(id_col, F.col(url_col).alias("_url")).select(
        id_col, host_of(url).alias("host"), path_of(url).alias("path")
    )
    named = rules.where("host is not null and path is not null")
    depth, size = F.size(F.split("host", r"\.", -1)), F.length("path")
    shapes = sorted((r[0], r[1]) for r in named.select(depth, size).distinct().collect())
    blocks = F.max(F.col("verdict") == "block").alias("blocks")
    listed = cut(named.groupBy(F.concat("host", "path").alias("key")).agg(blocks))
    found = pages.withColumn("keys", _keys(F.col("host"), F.col("path"), shapes) if shapes else F.array().cast("array<string>"))
    one = F.transform("keys", lambda k: F.xxhash64(k))
    two = F.transform("keys", lambda k: F.xxhash64(F.lit("second"), k))
    found = found.withColumn("one", one).withColumn("two", two).withColumn("hits", F.lit(None).cast("array<int>"))

    shards = max(1, math.ceil(listed.count() / shard_keys))
    shard = F.pmod(F.xxhash64(F.lit("shard"), F.col("key")), F.lit(shards))
    universe = cut(_hashed(found.select(F.explode("keys").alias("key")).where("key is not null").distinct()))
    # keys that the first filters take in are few, and the rules among them are left out here
    for k in range(shards):
        own = cut(_hashed(listed.where(shard == k)))
        blocking = _hashed(listed.where((shard == k) & F.col("blocks")))
        passing = _hashed(listed.where((shard == k) & ~F.col("blocks")))
        others = universe.join(own.select("key"), "key", "left_anti")
        sent = spark.sparkContext.broadcast((build_cascade(own, others), build_cascade(blocking, passing)))
        found = _with_hits(found, sent)
        if k + 1 < shards:
            found = cut(found)

    numbered = F.arrays_zip("keys", "hits")
    hits = F.filter(numbered, lambda x: x["hits"] > 0)
    best = F.array_max(F.transform(hits, lambda x: F.struct(F.length(x["keys"]), x["keys"].alias("key"), x["hits"].alias("hit"))))
    best = found.withColumn("best", best)
    verdict = F.when(F.col("best.hit") == 2, "block").otherwise("allow").alias("verdict")
    return best.select(id_col, "host", "path", F.col("best.key").alias("rule"), verdict)


def _with_hits(found: DataFrame, sent) -> DataFrame:
    """Marks which of a page's keys are listed: 1 allowed, 2 blocked, 0 neither; earlier marks stay."""

    def run(batches):
        member, blocked = sent.value
        for b in batches:
            keys, hits = b.column("keys"), b.column("hits")
            flat = keys.flatten()
            one, two = b.column("one").flatten().to_numpy(), b.column("two").flatten().to_numpy()
            mark = member.listed(one, two) & flat.is_valid().to_numpy(zero_copy_only=False)
            mark = mark * (1 + blocked.listed(one, two).astype(np.int32))
            if len(mark) and hits.null_count == 0:
                mark = np.maximum(mark, hits.flatten().to_numpy())
            lengths = keys.value_lengths().to_numpy()
            edges = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
            new = pa.ListArray.from_arrays(edges, pa.array(mark, pa.int32()))
            columns = [new if c == "hits" else b.column(c) for c in b.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return found.mapInArrow(run, found.schema)


def oracle_sql(rules: Sequence[tuple[str, str, str]] = RULES) -> str:
    """The verdicts in DuckDB SQL."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES {values}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
         FROM pages),
parts AS (SELECT page_id, regexp_extract(coalesce(r, ''), '^[^/?#]*') AS h,
                 regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
hosts AS (SELECT page_id, path, translate(h, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host FROM parts)
SELECT page_id, host, path,
       (SELECT max_by(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
       coalesce((SELECT max_by(verdict, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
FROM hosts
"""
