"""From raw documents to packed training sequences, in four stages.

Each stage takes the documents that its predecessor kept. All but the last return
the columns of ``documents``:

1. ``language``: labels each document; those without a letter go. ``lang`` becomes the language
   that covers most of the text, also where it covers little of it.
2. ``near_duplicates``: of each group of documents linked at a Jaccard similarity of 0.8
   over five-word shingles the one with the smallest id stays, of equal rows one. Rows of one id
   with different texts are documents of their own.
3. ``secrets``: secrets in the text are replaced by a mark; ``n_chars`` follows.
4. ``packing``: the documents' ids in sequences of at most 1024 tokens.

Nulls: a null text has no language and goes with stage 1; a document with a null id has
no copies that could be told from it, so it stays. Empty tables give no rows. Columns
other than those of ``documents`` are left behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.llm import language, ngram_join, packing, secret_scan
from lograft.llm.queries import vocabulary_path
from lograft.llm.shared import cut
from lograft.operators.joins import join_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def label_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = language.train(docs.where(~language.held_out()))
    found = language.identify(docs, model, carry=["text", "source", "n_chars"])
    good = found.where(F.col("lang_pred") != language.UNKNOWN)
    return good.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS).withColumn("text_hash", F.xxhash64("text"))
    keys = ["doc_id", "text_hash"]
    found = ngram_join.jaccard_join(docs, with_hash=True).groupBy(*keys).agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    # what goes and what is there more than once: narrow rows, broadcast behind a count
    fate = cut(found.where(~F.col("kept") | (F.col("n") > 1)))
    named = join_groups(docs, fate, keys, "left").where(F.coalesce("kept", F.lit(True)))
    again = named.where("n > 1").select(*COLUMNS).dropDuplicates(COLUMNS)
    return named.where("n is null").select(*COLUMNS).unionByName(again)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("language", label_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# Shingle similarity, Viterbi labels and packing have no SQL form; the tests compare the
# stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
