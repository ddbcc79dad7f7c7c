"""Registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (byte_bpe, conversations, embedding_forest, lexical_search, mixing,
                          ngram_join, quality, secret_scan, spotsigs, token_files, toxicity,
                          url_filter, warc)
from tidemark.llm.common import Scratch, table
from tidemark.llm.labelled import held_out


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return (url_filter.judge_urls(pages, url_filter.RULES, model)
            .select("row.page_id", "host", "path", "rule", "verdict"))


def op2_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (embedding_forest.near_duplicates(table(spark, sf_dir, "embeddings"))
            .withColumnRenamed("key", "vec_id"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (ngram_join.join_ngrams(table(spark, sf_dir, "documents"), carry=["doc_id"])
            .select("row.doc_id", "class_id", "n_links", "kept"))


#: Scores from which a document counts as toxic, and as good.
TOXIC_FROM, GOOD_FROM = 0.3, 0.7


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return (toxicity.score_toxicity(docs, model, carry=["doc_id"])
            .select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                    (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
                    F.size("spans").alias("n_spans")))


#: The tokenizer of the token-file query, and the id that ends a document.
WORD_TOKENIZER, END_ID = "word_bpe_49k.json", 1


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    with open(public_tokenizers.path(WORD_TOKENIZER), encoding="utf-8") as f:
        definition = f.read()
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(
        docs, definition, Scratch(spark, "tokens").path("files"), end_id=END_ID)
    return token_files.read_token_files(manifest).withColumnRenamed("key", "doc_id")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"), Scratch(spark, "archives").path("warc"))
    return (warc.read_records(index)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return (quality.score_quality(docs, model, carry=["doc_id"])
            .select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                    (F.col("score") >= GOOD_FROM).cast("int").alias("predicted")))


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (spotsigs.compare_along_order(table(spark, sf_dir, "documents"))
            .withColumnRenamed("key", "doc_id"))


#: The rank file of the byte-level BPE query.
BYTE_BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks, pattern = public_tokenizers.path(BYTE_BPE_RANKS), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents")
    return (byte_bpe.encode(docs, ranks, pattern, carry=["doc_id"], decoded=True)
            .select("row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (mixing.mix_sources(docs)
            .select("row.doc_id", "size", "source_size", "target", "taken"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair_conversations(turns, lost="lost")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan_secrets(docs, secret_scan.train(docs), carry=["doc_id"])

    def count(kind):
        return F.size(F.filter("rules", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select("row.doc_id", *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
                        F.sha2(secret_scan.joined("rules"), 256).alias("base_sha256"),
                        secret_scan.joined("spans").alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_embedding_forest": op2_embedding_forest,
    "op3_ngram_join": op3_ngram_join,
    "op4_toxicity": op4_toxicity,
    "op5_token_files": op5_token_files,
    "op6_warc": op6_warc,
    "op7_quality": op7_quality,
    "op8_spotsigs": op8_spotsigs,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_mixing": op10_mixing,
    "op11_lexical_search": op11_lexical_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_secret_scan": op13_secret_scan,
}
