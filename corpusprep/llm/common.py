"""Helpers shared by the operators of this subpackage.

* ``materialize``: write a frame once under the cluster's checkpoint folder
  and read it back. Cuts lineage without ``localCheckpoint``: the files are in
  the shared store, so a lost executor costs nothing already written.
* ``lookup_join``: N:1 join whose hot keys are salted. The hot list has at
  most ``HOT_KEYS`` entries by construction, so its broadcast is bounded.
* ``chained_sum``: running sums within groups, with no group in one task.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusprep.session import ensure_checkpoint_dir

#: At most this many keys of one table can be hot (a key is hot above rows / HOT_KEYS).
HOT_KEYS = 2000
#: Keys below this many rows are never worth a salt.
HOT_FLOOR = 256


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written once as Parquet under the checkpoint folder and reread."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sealed(df: DataFrame, *names: str | None) -> tuple:
    """``(frame, the new names of names, restore)``: every column of ``df`` under
    a name no operator uses; ``restore`` selects them back under their own."""
    inner = [f"_in{i}" for i in range(len(df.columns))]
    at = dict(zip(df.columns, inner, strict=True))
    return df.toDF(*inner), [n and at[n] for n in names], lambda out: out.select(*inner).toDF(*df.columns)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_bounds(df: DataFrame, column: str, ranges: int) -> list[int]:
    """At most ``ranges - 1`` ascending bounds that deal a long column's values
    (nulls left out) into about equal ranges; plain numbers, so every use of
    them deals alike."""
    if ranges < 2:
        return []
    return sorted({int(x) for x in df.approxQuantile(column, [i / ranges for i in range(1, ranges)], 0.2 / ranges)})


def range_of(bounds: list[int], column: str) -> Column:
    """The number of bounds at or below the value: its range, from 0. Looked up
    in two steps (which block of bounds, which bound in it), so thousands of
    bounds stay cheap."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1
    blocks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    below = lambda array: F.size(F.filter(array, lambda b: b <= F.col(column)))
    block = below(F.array(*[F.lit(b[0]).cast("long") for b in blocks])) - 1
    inside = below(F.get(F.array(*[F.array(*[F.lit(x).cast("long") for x in b]) for b in blocks]), block))
    return F.when(F.col(column) < bounds[0], F.lit(0)).otherwise(block * step + inside)


def hot_keys(counts: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """``(_hot, _salts)`` of the keys holding more than ``total / HOT_KEYS``
    rows: at most ``HOT_KEYS`` entries whatever the data."""
    limit = max(HOT_FLOOR, -(-total // HOT_KEYS))
    return counts.where(F.col(n) > limit).select(
        F.col(key).alias("_hot"), F.ceil(F.col(n) / limit).cast("int").alias("_salts"))


def lookup_join(facts: DataFrame, table: DataFrame, key: str, hot: DataFrame, spread: Column,
                how: str = "left") -> DataFrame:
    """``facts`` joined with ``table`` (one row per ``key``) on ``key``.

    Rows of a hot key get a salt from ``spread`` (a stable row hash, so a
    retried task draws the same salt); the table's row is repeated per salt.
    """
    hb = F.broadcast(hot)  # at most HOT_KEYS rows
    f = facts.join(hb, F.col(key) == F.col("_hot"), "left") \
        .withColumn("_salt", F.when(F.col("_salts").isNotNull(), F.pmod(spread, F.col("_salts")).cast("int"))
                    .otherwise(F.lit(0))).drop("_hot", "_salts")
    t = table.join(hb, F.col(key) == F.col("_hot"), "left") \
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))) \
        .drop("_hot", "_salts")
    return f.join(t, [key, "_salt"], how).drop("_salt")


def spread_hash(*cols: str | Column) -> Column:
    """A stable 64-bit hash of a row's columns."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def chained_sum(df: DataFrame, group: list[str], bucket: Column, order: list[Column], value: str,
                name: str) -> DataFrame:
    """Append ``name`` = sum of ``value`` over the rows of ``group`` that come
    before this one by ``(bucket, *order)``.

    ``bucket`` is a pure function of the row, so the two uses of the frame
    always agree, whatever is retried or reused. A window only ever spans one
    bucket of one group; the buckets are chained by a running sum over their
    totals (one row per bucket and group). ``order`` must determine a row up
    to full copies, which may take any of their places.
    """
    # plain equality on keys without nulls: the join keeps the windows' partitioning
    keys = [f"_g{i}" for i in range(len(group))]
    tagged = df.withColumns({k: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for k, c in zip(keys, group, strict=True)}) \
        .withColumn("_bucket", bucket)
    totals = tagged.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carry"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(carry, [*keys, "_bucket"]).withColumn(name, F.col("_carry") + F.col("_local")) \
        .drop(*keys, "_bucket", "_carry", "_local")
