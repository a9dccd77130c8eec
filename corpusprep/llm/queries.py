"""The registered queries of this subpackage: one ``opN_<name>`` per operator.

Each takes ``(spark, sf_dir)`` and applies its operator, with production
parameters, to the whole table. ``ORACLE`` holds DuckDB SQL where SQL can
express the result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusprep.llm import collocations, embeddings, fingerprints, langid, lm, mix, neighbours, pack, secrets, simhash, spelling, toxicity, warc
from corpusprep.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _register(fn, sql: str | None = None):
    QUERIES[fn.__name__] = fn
    if sql is not None:
        ORACLE[fn.__name__] = sql
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights, by training position."""
    return mix.mix_report(_table(spark, sf_dir, "documents"))


_register(op2_mix, mix.ORACLE_SQL)


@_register
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at 3 or fewer differing bits."""
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


@_register
def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_register
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents and all pages."""
    return langid.identify_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages"))


@_register
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.edited_report(_table(spark, sf_dir, "documents"))


@_register
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_register
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and components of all vectors, within labels."""
    return embeddings.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


@_register
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents."""
    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revisits of a crawl over all pages, resolved."""
    return warc.revisit_report(_table(spark, sf_dir, "pages"))


_register(op6_warc_revisits, warc.ORACLE_SQL)


@_register
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of all documents."""
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of all documents, by language."""
    return collocations.mine_collocations(_table(spark, sf_dir, "documents"))


_register(op13_collocations, collocations.ORACLE_SQL)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


_register(op12_spelling, spelling.ORACLE_SQL)


@_register
def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors of every fiftieth vector, among all."""
    return neighbours.nearest_neighbours(_table(spark, sf_dir, "embeddings"))
