"""A feature store clustered by key, and resumes that open few of its files.

:func:`write_clustered` writes each run's features in key ranges, so a file
covers a narrow part of the key space, and records per file its smallest and
largest key in a small table beside the store (``<path>-files``). A resume
cuts its pending keys into slots (first three digits, at most 4,096) and opens only
files whose range meets the pending keys of some slot.

The table only saves reads: files it lacks (a run lost between its two writes,
or an older store) are always read, as are files and keys of another form than
hex, so the stored keys found are the same as by reading everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions import keys as K
from corpusprep.sinks.writers import FEATURE_COMPRESSION
from corpusprep.sources.tables import path_exists

FEATURES = "key string, feature array<float>"
FILES = "file string, lo string, hi string, n long"


def _name(uri: Column) -> Column:
    return F.regexp_extract(uri, r"([^/]*)$", 1)


def _slot(key: str) -> Column:
    """The number of the key's first three hex digits; null for other forms."""
    head = F.substring(key, 1, 3)
    return F.when(K.is_shard_name(head), F.conv(head, 16, 10).cast("int"))


def _index(spark: SparkSession, path: str) -> DataFrame:
    index = f"{path}-files"
    if not path_exists(spark, index):
        return spark.createDataFrame([], FILES)
    return spark.read.schema(FILES).parquet(index).distinct()


def _store_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the store's files: what Spark's own listing holds on the driver."""
    if not path_exists(spark, path):
        return []
    return [f.rsplit("/", 1)[-1] for f in spark.read.schema(FEATURES).parquet(path).inputFiles()]


def _unlisted(spark: SparkSession, path: str) -> list[str]:
    known = {r.file for r in _index(spark, path).select("file").collect()}  # one row per file
    return [f for f in _store_files(spark, path) if f not in known]


def _read(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], FEATURES)
    return spark.read.schema(FEATURES).parquet(*[f"{path}/{f}" for f in files])


def index_files(spark: SparkSession, path: str) -> int:
    """Record the key range of every file not recorded yet; reads the key column of those only."""
    new = _unlisted(spark, path)
    if new:
        _read(spark, path, new).select("key", _name(F.col("_metadata.file_path")).alias("file")) \
            .groupBy("file").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count(F.lit(1)).alias("n")) \
            .coalesce(1).write.mode("append").parquet(f"{path}-files")
    return len(new)


def write_clustered(features: DataFrame, path: str, parts: int | None = None) -> None:
    """K9, range-clustered: append ``(key, feature)`` in key ranges, then record the files."""
    rows = features.select("key", "feature")
    dealt = rows.repartitionByRange(parts, "key") if parts else rows.repartitionByRange("key")
    dealt.sortWithinPartitions("key").write.mode("append").option("compression", FEATURE_COMPRESSION).parquet(path)
    index_files(features.sparkSession, path)


def files_for(pending: DataFrame, path: str, key: str = "key") -> list[str]:
    """Files of the store that may hold a key of ``pending``."""
    spark = pending.sparkSession
    wanted = pending.where(F.col(key).isNotNull()).groupBy(_slot(key).alias("slot")) \
        .agg(F.min(key).alias("_min"), F.max(key).alias("_max"))
    ranges = wanted.collect()  # at most 4,096 slots and one for other forms
    if not ranges:
        return []
    if any(r.slot is None for r in ranges):
        return _store_files(spark, path)
    slots = F.broadcast(spark.createDataFrame(ranges, "slot int, _min string, _max string"))
    files = _index(spark, path).withColumn("_a", _slot("lo")).withColumn("_b", _slot("hi"))
    odd = files.where("_a is null or _b is null").select("file")
    met = files.where("_a is not null and _b is not null").withColumn("slot", F.explode(F.sequence("_a", "_b"))) \
        .join(slots, "slot").where("lo <= _max and hi >= _min").select("file")
    chosen = {r.file for r in odd.unionByName(met).distinct().collect()}  # names of files, no keys
    stored = set(_store_files(spark, path))
    return sorted((chosen & stored) | set(_unlisted(spark, path)))


def stored_keys_near(pending: DataFrame, path: str, key: str = "key") -> DataFrame:
    """S12 for a resume: the stored keys of the files that ``pending`` can meet (one key column scan)."""
    return _read(pending.sparkSession, path, files_for(pending, path, key)).select("key")
