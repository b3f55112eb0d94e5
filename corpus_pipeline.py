"""The corpus pipeline: toxicity, exact copies, near copies, personal data, packing.

Each stage works on what the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpulse.llm import exact_dedup, packing, pii, simhash, toxicity
from cardpulse.llm.queries import SURROGATE_KEY
from cardpulse.llm.shared import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5, learnt from the labelled ones among them."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, docs.columns, name="_toxicity")
    return scored.where(F.col("_toxicity") < 0.5).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (A-Z lower-cased), the one with the largest id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (fingerprints of four words, 4 bits or fewer apart), the one with the
    least id.
    """
    return simhash.keep_one(docs, shingle=4)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with surrogates in their texts; ``n_chars`` follows."""
    made = pii.pseudonymise(docs, SURROGATE_KEY)
    return made.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in sequences of 1,024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("pii", replace_personal_data),
    ("packing", pack),
]

# No SQL can train the classifier or run the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
