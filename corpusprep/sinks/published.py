"""A published version of a table (K11): written whole, then named by one small file.

Every version has a folder of its own, ``<path>/versions/<id>``. The file
``<path>/published/<number>`` holds the id and is created last; the highest number is what
readers see. A writer killed before that leaves the version before it in
place. The file is renamed into place, which fails on HDFS where the number is
taken: of two writers that started from one version one wins and the other is
told. A store whose rename replaces files (a local disk, object stores) has
only the check before it, so there writers at the same moment must be kept apart.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusprep.sinks.writers import rewrite_error_log

LOG = "object_key string, shard string"


class Outdated(RuntimeError):
    """Another writer has published since the version this one started from."""


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/published")
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, path: str) -> int:
    """Number of the published version; 0 when there is none."""
    _, folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return max((int(n) for n in names if n.isdigit()), default=0)


def publish(spark: SparkSession, path: str, version: str, after: int) -> int:
    """Make ``version`` (an id below ``versions``) what readers see, if ``after`` still is."""
    jvm, folder, fs = _folder(spark, path)
    if current(spark, path) != after:
        raise Outdated(path)
    target = jvm.org.apache.hadoop.fs.Path(folder, str(after + 1))
    # the content is written aside and renamed: a half-written pointer is never seen
    aside = jvm.org.apache.hadoop.fs.Path(folder, f"_{version}")
    out = fs.create(aside, False)
    out.writeBytes(version)
    out.close()
    if fs.exists(target) or not fs.rename(aside, target):
        raise Outdated(path)
    return after + 1


def version_path(spark: SparkSession, path: str) -> str | None:
    """Folder of the published version; null when there is none."""
    n = current(spark, path)
    if not n:
        return None
    version = spark.read.text(f"{path.rstrip('/')}/published/{n}").first()[0]
    return f"{path.rstrip('/')}/versions/{version}"


def read_published(spark: SparkSession, path: str, schema: str = LOG) -> DataFrame:
    """The published rows; none before the first version."""
    at = version_path(spark, path)
    return spark.createDataFrame([], schema) if at is None else spark.read.schema(schema).parquet(at)


def write_version(still_missing: DataFrame, path: str) -> str:
    """K11's write half: the log's distinct keys in a new version folder, not yet published."""
    version = uuid.uuid4().hex[:12]
    rewrite_error_log(still_missing, f"{path.rstrip('/')}/versions/{version}")
    return version


def rewrite_published(still_missing: DataFrame, path: str, after: int) -> int:
    """Write a version, then publish it over version ``after``, which it was computed from."""
    return publish(still_missing.sparkSession, path, write_version(still_missing, path), after)
