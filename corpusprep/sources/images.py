"""Image files as rows (S11): Spark's ``image`` source decodes in the JVM.

Undecodable files are kept (``dropInvalid`` false) and flagged, so they can be
routed to the decode-error sink (K10) instead of silently vanishing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions import keys as K

#: A task reads at most this many scan splits.
TASK_SPLITS = 256


def few_tasks(files: DataFrame) -> DataFrame:
    """A scan of small files, many splits to a task.

    Spark counts every file as ``openCostInBytes`` at least, so a split holds a
    few dozen small files and starting tasks costs more than reading. Splits are
    put together without an exchange, down to the session's shuffle partitions
    (two tasks a core at least), and never more than ``TASK_SPLITS`` to a task."""
    spark = files.sparkSession
    splits = files.rdd.getNumPartitions()  # from the listing: no job runs
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return files.coalesce(max(least, -(-splits // TASK_SPLITS)))


def scan_images(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(path, key, height, width, n_channels, mode, data, valid)``."""
    r = spark.read.format("image").option("dropInvalid", False)
    if glob:
        r = r.option("pathGlobFilter", glob)
    img = few_tasks(r.load(path))
    return img.select(
        F.col("image.origin").alias("path"),
        K.stem_first_dot(F.col("image.origin")).alias("key"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("n_channels"),
        F.col("image.mode").alias("mode"),
        F.col("image.data").alias("data"),
        (F.col("image.height") > 0).alias("valid"),
    )
