"""Training-data pipeline over ``documents``: five stages, each written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and returns rows with the columns of ``documents``; the
last returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.llm import bpe, mixing, secret_scan, simhash, toxicity
from dockflow.llm.base import table
from dockflow.llm.queries import byte_bpe
from dockflow.sources.scratch import scratch_path, scratch_scope

#: A document goes at this score.
TOXIC = 0.7
#: Words of a shingle and bits that near copies may differ in.
SHINGLE, NEAR_BITS = 3, 3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not reject; learned from labels that are not held out.

    Null and empty texts are scored like any other and stay; repeated rows stay repeated.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model, name="__llm_toxicity").where(F.col("__llm_toxicity") < TOXIC).drop("__llm_toxicity")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies by SimHash, that with the smallest id.

    Null and blank texts are copies of each other; of rows that repeat the smallest id one stays, and rows
    without an id stay only where their group has no other.
    """
    return simhash.without_copies(docs, width=SHINGLE, bits=NEAR_BITS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark; null texts stay null."""
    clean = secret_scan.redacted(docs, secret_scan.fit(docs))
    return clean.withColumn("n_chars", F.char_length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice.

    A null source is a source of its own; null and empty texts have no words and go as their hash says.
    """
    return mixing.repeated(docs, weights=(3, 1, 2), share=1.5, most=2)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the text that they decode to.

    Null and empty texts have no ids; repeated rows stay repeated.
    """
    ranks, pattern = byte_bpe()
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, pattern), ranks)
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_copies),
    ("secret_scan", redact_secrets),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode_tokens),
]

#: Trained models, hashes and token ids are beyond SQL; tests/llm/test_pipeline.py holds the stages
#: against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, an empty table through all of them; a stage's scratch tables go with it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
