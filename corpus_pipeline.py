"""From raw documents to token ids, in five stages.

Quality classifier (rejected documents go), exact de-duplication, SimHash
near-de-duplication (one document of each group stays), mixing of sources to
target weights, and byte-level BPE. Each stage takes the whole of what the one
before it kept, read from the Parquet files that it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.llm import bpe, exact_dedup, mixing, quality_classifier, simhash
from regline.llm.common import written
from regline.llm.queries import public_tokenizer


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(docs, labels, usable=~quality_classifier.held_out(F.col("doc_id")))
    return quality_classifier.accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first_copies(docs, exact_dedup.open_index(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids`` and digests of the ids and of the bytes they decode to."""
    tokenizer = public_tokenizer(spark)
    coded = docs.select("doc_id", "source", tokenizer.round_trip(F.col("text")).alias("coded"))
    return coded.select(
        "doc_id",
        "source",
        bpe.n_tokens(F.col("coded.ids")).alias("n_tokens"),
        "coded.ids",
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_classifier", classify_quality),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: The classifier, the fingerprints and the tokenizer can't be expressed in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
