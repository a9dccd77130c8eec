"""Fixture views over the driver tables (Spark side).

The studied tool ships no data, so its record shapes are rebuilt as views over
the driver tables (FIXTURES.md). Each function here takes DataFrames and
returns a DataFrame; the operator views (``samples``, ``candidates``) are
built with the library's own operators, the rest are plain projections.
The SQL twin of every view lives in :mod:`corpusprep.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions import keys as K

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_samples(pages: DataFrame) -> DataFrame:
    pid = F.col("page_id")
    return pages.select(
        pid,
        F.col("url").alias("downloadurl"),
        F.when(pid % 5 == 0, F.lit("")).when(pid % 5 == 1, F.lit("0"))
        .when(pid % 5 == 2, F.lit(None).cast("string"))
        .otherwise((pid - 90).cast("string")).alias("longitude"),
        F.when(pid % 4 == 0, F.lit(0.0)).otherwise(pid.cast("double") / 4).alias("latitude"),
        F.when(pid % 6 == 0, F.lit(None).cast("bigint")).otherwise(pid % 17).alias("accuracy"),
        F.when(pid % 10 == 0, F.lit(1)).otherwise(F.lit(0)).alias("marker"),
        F.when(pid % 3 == 0, F.lit("png")).when(pid % 10 == 0, F.lit("mp4"))
        .otherwise(F.lit("jpg")).alias("ext"),
        F.col("html").alias("payload"),
    )


def samples(pages: DataFrame) -> DataFrame:
    """raw samples + key + shard (no coercion: that is P3's job)."""
    from corpusprep.operators.samples import with_key
    return with_key(raw_samples(pages))


def candidates(pages: DataFrame) -> DataFrame:
    """One row per (sample, candidate ord)."""
    from corpusprep.operators.resolve import candidate_keys
    return candidate_keys(samples(pages).select("page_id", "key", "shard", "marker", "ext", "payload")) \
        .select("page_id", "key", "shard", "marker", "payload", "ord", "canonical", "object_key")


def store(pages: DataFrame) -> DataFrame:
    """Object store listing with payloads: which candidates exist."""
    pid, o = F.col("page_id"), F.col("ord")
    c = candidates(pages)
    return c.where(((pid % 4 == 0) & (o == 0)) | (pid % 4 == 2) | ((pid % 4 == 3) & (o == 1))) \
        .select("object_key", F.col("payload").alias("data")).distinct()


def archive(pages: DataFrame) -> DataFrame:
    """Stored archive members (shard, ord, name, data). Some names repeat later
    in the archive, and some keys have a second member of another name at the
    same place (a tie on ``ord``)."""
    pid, o = F.col("page_id"), F.col("ord")
    c = candidates(pages).where((o == 0) & (pid % 4).isin(0, 2) & (pid % 7 != 0))
    at = (pid % 997).cast("int")
    first = c.select("shard", at.alias("ord"), F.col("object_key").alias("name"), F.col("payload").alias("data"))
    dup = c.where(pid % 6 == 0).select("shard", (at + 1000).alias("ord"), F.col("object_key").alias("name"), F.lit("dup").alias("data"))
    tie = c.where(pid % 10 == 2).select("shard", at.alias("ord"), F.regexp_replace("object_key", "[^.]+$", "zzz").alias("name"),
                                        F.lit("tie").alias("data"))
    return first.unionByName(dup).unionByName(tie)


def err_log(pages: DataFrame) -> DataFrame:
    """Error log lines (shard, line); some carry a trailing blank."""
    pid, o = F.col("page_id"), F.col("ord")
    c = candidates(pages).where(o == 0)
    a = c.where((pid % 4).isin(1, 3) | (pid % 8 == 0)).select(
        "shard", F.concat("canonical", F.lit(" ")).alias("line"))
    b = c.where(pid % 12 == 1).select("shard", F.col("canonical").alias("line"))
    return a.unionByName(b)


def ledger(pages: DataFrame) -> DataFrame:
    """Finished-shard ledger lines (repeats allowed)."""
    s = samples(pages)
    return s.where(F.col("shard") < "8").select("shard").unionByName(
        s.where(F.col("shard") < "2").select("shard"))


def vectors(embeddings: DataFrame) -> DataFrame:
    vid = F.col("vec_id")
    return embeddings.select(
        vid,
        K.derive_key(F.concat(F.lit("vec/"), vid.cast("string"))).alias("key"),
        (vid % 3 == 0).alias("already_done"),
        F.when(vid % 11 == 0, F.lit(None)).otherwise(F.col("embedding")).alias("embedding"),
    )


def images(documents: DataFrame) -> DataFrame:
    n = F.col("n_chars")
    return documents.select(
        "doc_id",
        (1 + n % 1200).alias("w"),
        (1 + (n * 7) % 900).alias("h"),
        n.alias("n_bytes"),
        F.when(F.col("doc_id") % 10 == 0, F.lit(1)).otherwise(F.lit(0)).alias("marker"),
    )


def bench_keys(lineitem: DataFrame) -> DataFrame:
    rk = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                  F.col("l_linenumber").cast("string"), F.lit("-"),
                  F.col("l_partkey").cast("string"))
    return lineitem.select(K.derive_key(rk).alias("key"))


def pixels(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x, y, v): the 64 values of a vector as an 8 x 8 gray image."""
    e = embeddings.select("vec_id", F.posexplode("embedding").alias("i", "v"))
    return e.select("vec_id", (F.col("i") % 8).alias("x"),
                    F.floor(F.col("i") / 8).alias("y"), F.col("v").cast("double").alias("v"))


def gray_rows(col="embedding") -> "F.Column":
    """The 64 values as the 8 rows of an 8 x 8 gray image: ``array<array>``."""
    return F.transform(F.sequence(F.lit(0), F.lit(7)),
                       lambda y: F.slice(F.col(col).cast("array<double>"), y * 8 + 1, 8))


def tokens(col="embedding") -> "F.Column":
    """The 64 values as 8 tokens x 8 channels: ``array<array<float>>``."""
    return F.transform(F.sequence(F.lit(0), F.lit(7)),
                       lambda t: F.slice(F.col(col) if isinstance(col, str) else col, t * 8 + 1, 8))
