"""Row numbers within groups that stay distributed when one group is huge.

``row_number() over (partition by g order by o)`` sends every row of a group
to one task. When a single group may hold a third of the table (a shard full
of copies of one URL), that task is the whole job. :func:`row_number_within`
computes the same numbers without that funnel:

1. range-partition on ``(g, o)`` plus a per-row tiebreak - a hot group spreads
   over many partitions - sort each partition, tag each row with its partition
   id and its position, and **write that once** under the checkpoint folder.
   Both uses below read the same files, so the numbers do not depend on
   exchange reuse, on what is pruned from either branch, or on a retry;
2. aggregate per ``(partition, g)``: the group's first position there and its
   row count (at most ``#groups + #partitions`` rows; a hot group contributes
   one row per partition it spans);
3. carry = rows of the same group in earlier partitions: a running sum over
   that table, partitioned by ``g`` (each window partition is bounded by the
   partition count);
4. join the table back on ``(partition, g)`` and add: ``rn = position -
   first position + 1 + carry``. AQE broadcasts the table when its measured
   size is small; otherwise it is a sort-merge join on ``(partition, g)``,
   which is itself skew-free because no ``(partition, g)`` pair is larger
   than one range partition.

The partition count is explicit, so AQE does not coalesce the range shuffle.
Rows that tie on ``(g, o)`` get distinct but arbitrary numbers, as with
``row_number``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.sinks.writers import scratch_path


def row_tiebreak(df: DataFrame) -> Column:
    """``(hash of the row, input partition)``: the same in every attempt of a
    task, unlike a row's position. Copies of one row spread over as many range
    partitions as they had input partitions. (Maps are left out of the hash.)"""
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.struct(F.xxhash64(*cols) if cols else F.lit(0).cast("long"), F.spark_partition_id())


def row_number_within(df: DataFrame, group: list[str], order: list[str],
                      name: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """Append ``name`` = 1-based row number within ``group`` by ``order``."""
    spark = df.sparkSession
    n = int(num_partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    gcols = list(group)
    sort_cols = gcols + list(order)
    placed = df.withColumn("_tb", row_tiebreak(df)) \
        .repartitionByRange(n, *sort_cols, "_tb").sortWithinPartitions(*sort_cols, "_tb") \
        .drop("_tb") \
        .withColumn("_pid", F.spark_partition_id()) \
        .withColumn("_pos", F.monotonically_increasing_id())
    path = scratch_path(spark, "row-number")
    placed.write.parquet(path)
    base = spark.read.schema(placed.schema).parquet(path)

    stats = base.groupBy("_pid", *gcols).agg(F.min("_pos").alias("_start"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*gcols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_carry", F.coalesce(F.sum("_n").over(earlier), F.lit(0))) \
        .select(F.col("_pid").alias("_spid"), *[F.col(c).alias(f"_s_{c}") for c in gcols], "_start", "_carry")

    cond = F.col("_pid") == F.col("_spid")
    for c in gcols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    joined = base.join(stats, cond, "inner")
    return joined.withColumn(name, F.col("_pos") - F.col("_start") + 1 + F.col("_carry")) \
        .drop("_pid", "_pos", "_spid", "_start", "_carry", *[f"_s_{c}" for c in gcols])


def cluster_sorted(df: DataFrame, cols: list[str], num_partitions: int | None = None) -> DataFrame:
    """Range-partition on ``cols`` and sort each partition by them.

    Each task then holds a contiguous run of ``cols`` (a writer emits one file
    per shard it holds). A per-row tiebreak is part of the range key, so a hot
    value - or a third of the table made of copies of one row - spans several
    tasks instead of one; a retried task deals each row to the same partition.
    """
    # The partition count is explicit: AQE measures *compressed* bytes, and the
    # split pieces of a pile of copies compress to almost nothing, so it
    # would coalesce them straight back into one task.
    n = int(num_partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = df.withColumn("_tb", row_tiebreak(df)).repartitionByRange(n, *cols, "_tb")
    return w.sortWithinPartitions(*cols).drop("_tb")
