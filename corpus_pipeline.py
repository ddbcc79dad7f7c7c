"""A training corpus from ``documents`` in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
``run`` writes as Parquet and reads back as the next stage's ``docs``.  All
but the last return the columns of ``documents``.  Both classifiers learn
from ``documents`` and ``labels`` of ``sf_dir``; everything else a stage
computes is over all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, mixing, ngram_join, quality, toxicity
from tidemark.llm.common import Scratch, table
from tidemark.llm.queries import BYTE_BPE_RANKS, GOOD_FROM, TOXIC_FROM


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores ``GOOD_FROM`` or more."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return (quality.score_quality(docs, model).where(F.col("score") >= GOOD_FROM)
            .select("row.*"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger scores below ``TOXIC_FROM``."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return (toxicity.score_toxicity(docs, model).where(F.col("score") < TOXIC_FROM)
            .select("row.*"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the least
    ``doc_id``."""
    return ngram_join.join_ngrams(docs).where("kept").select("row.*")


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a document stands in it as often as the mix
    takes it."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix: ``doc_id``, ``n_tokens``, ``ids``
    (little-endian unsigned 32-bit integers) and ``decoded_sha256`` (of the
    bytes that the ids decode to)."""
    import public_tokenizers
    ranks, pattern = public_tokenizers.path(BYTE_BPE_RANKS), public_tokenizers.PATTERN
    return (byte_bpe.encode(docs, ranks, pattern, carry=["doc_id"], decoded=True)
            .select("row.doc_id", "n_tokens", "ids",
                    F.sha2("decoded", 256).alias("decoded_sha256")))


STAGES = [("quality classifier", keep_good), ("toxicity", drop_toxic),
          ("n-gram Jaccard join", drop_near_copies),
          ("mixing sources to target weights", mix_to_weights),
          ("byte-level BPE encoding and decoding", encode)]

#: SQL expresses neither classifier; the tests hold the stages against
#: brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{i}")
        if i:
            scratch.drop(f"stage-{i - 1}")
    return docs
