"""A training-data pipeline over ``documents``: language ID, near-dedup, secret
scans, mixing and packing, each stage written as Parquet and reread.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame. All but the last return the columns of
``documents``. ``run`` applies them in order; the steps go under the shared
checkpoint folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import langid, mix, pack, secrets, simhash
from corpusprep.llm.common import materialize
from corpusprep.session import ship_package

#: Byte-level BPE vocabulary of the packing stage.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an accepted language go."""
    ship_package(spark)
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id."""
    ship_package(spark)
    return simhash.keep_representatives(docs)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; all documents stay."""
    out = secrets.redact_secrets(docs, changed_col="_changed")
    n_chars = F.when(F.col("_changed"), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).drop("_changed")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, never cut, so that sources come near
    their targets, in training order."""
    return mix.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in the sequences."""
    ship_package(spark)
    return pack.pack_documents(docs, TOKENIZER)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", near_dedup),
    ("secret_scan", scan_secrets),
    ("source_mix", mix_sources),
    ("best_fit_pack", pack_sequences),
]

#: SQL has neither the hashes nor the tokenizer; tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
