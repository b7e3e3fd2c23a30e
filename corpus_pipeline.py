"""A training corpus made of raw documents, stage by stage.

Every stage takes all rows that the one before it kept, and its decisions take
effect. Stages before the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleetlake.llm.packing import pack
from fleetlake.llm.secret_scans import redact
from fleetlake.llm.simhash import keep_first
from fleetlake.llm.suffix_dedup import keep_unique
from fleetlake.llm.tables import ship, stored
from fleetlake.llm.toxicity import keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the limit; the model is of the labelled ones."""
    ship(spark)
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link within three bits."""
    ship(spark)
    return keep_first(docs, width=3, most=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that also are elsewhere.

    Such passages are made up of repeated strings of 240 bytes: 50 words have 245 and more
    where a word and its space have five.
    """
    ship(spark)
    return keep_unique(docs, window=240, gram=88, words=50)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced by their kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed into sequences of 1024 tokens."""
    ship(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("secret_scans", secret_scans),
    ("packing", packing),
]

# A fitted model, hashes of shingles and tokens are not in SQL's reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; a stage's rows are written before the next one reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs)
    return docs
