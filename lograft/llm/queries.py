"""The registered queries of this subpackage: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.llm import (
    bpe, chat_format, conversation_repair, embed_dedup, language, licenses, ngram_join, packing, pii, secret_scan, spelling,
    topk, url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the public tokenizer file lies on this machine (each machine has its own copy)."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def op1_bpe(spark: SparkSession, root: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    coded = bpe.round_trip(_table(spark, root, "documents"), vocabulary_path())
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op2_secrets(spark: SparkSession, root: str) -> DataFrame:
    """Every document's secrets: a first scan, with an empty ledger."""
    return secret_scan.digests(secret_scan.scan(_table(spark, root, "documents")).findings)


def op3_ngram_join(spark: SparkSession, root: str) -> DataFrame:
    """Every document's class, links and group at a Jaccard similarity of 0.8 over five-word shingles."""
    return ngram_join.jaccard_join(_table(spark, root, "documents"))


def op6_language(spark: SparkSession, root: str) -> DataFrame:
    """Every document's language, learned from the rows that aren't held out."""
    docs = _table(spark, root, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(~language.held_out()))
    found = language.identify(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op4_url_filter(spark: SparkSession, root: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return url_filter.judge(_table(spark, root, "pages"), url_filter.rules_frame(spark, url_filter.RULES))


def op5_packing(spark: SparkSession, root: str) -> DataFrame:
    """Every document's pieces in sequences of at most 1024 tokens."""
    return packing.pieces_digest(packing.pack_documents(_table(spark, root, "documents"), vocabulary_path()))


def op7_pii(spark: SparkSession, root: str) -> DataFrame:
    """Every document with its personal data replaced by surrogates."""
    return pii.replace_entities(_table(spark, root, "documents"), key="lograft")


def op8_licenses(spark: SparkSession, root: str) -> DataFrame:
    """Every document's licence: its own, or that of the nearest directory above it."""
    docs = _table(spark, root, "documents")
    files = docs.select("doc_id", licenses.document_path().alias("path"), "text")
    found = licenses.scan(files, F.col("path").endswith("/LICENSE"))
    return found.withColumnRenamed("id", "doc_id")


def op9_topk(spark: SparkSession, root: str) -> DataFrame:
    """The five best others of every vector whose id is divisible by 50."""
    return topk.search(_table(spark, root, "embeddings"), F.col("id") % 50 == 0)


def op10_embed_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Every vector's links within its label at a cosine of 0.98, and its group."""
    return embed_dedup.link_vectors(_table(spark, root, "embeddings"))


def op11_conversation_repair(spark: SparkSession, root: str) -> DataFrame:
    """Every conversation, damaged, with what its cheapest repair is and does."""
    conversations = _table(spark, root, "conversations")
    repaired = conversation_repair.repair(conversation_repair.damage(conversations))
    return conversation_repair.digests(repaired, conversations)


def op12_chat_format(spark: SparkSession, root: str) -> DataFrame:
    """Every conversation, formatted, as it is read back from ids and loss mask."""
    conversations = chat_format.with_control(spark, _table(spark, root, "conversations"))
    return chat_format.digests(chat_format.format_turns(conversations, vocabulary_path()), vocabulary_path())


def op13_spelling(spark: SparkSession, root: str) -> DataFrame:
    """Every word of seven code points or more that occurs twice, its near words and the form it stands for."""
    return spelling.group_variants(spelling.words_of(_table(spark, root, "documents")))


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_secrets": op2_secrets,
    "op3_ngram_join": op3_ngram_join,
    "op4_url_filter": op4_url_filter,
    "op5_packing": op5_packing,
    "op6_language": op6_language,
    "op7_pii": op7_pii,
    "op8_licenses": op8_licenses,
    "op9_topk": op9_topk,
    "op10_embed_dedup": op10_embed_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_chat_format": op12_chat_format,
    "op13_spelling": op13_spelling,
}

ORACLE: dict[str, str] = {
    "op2_secrets": secret_scan.oracle_sql(),
    "op4_url_filter": url_filter.oracle_sql(),
    "op9_topk": topk.oracle_sql(),
    "op10_embed_dedup": embed_dedup.oracle_sql(),
}
