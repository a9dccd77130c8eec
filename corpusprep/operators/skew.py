"""Salted joins: a key (or a pile of copies) holding a third of the rows must
not land in one task.

AQE's skew join splits partitions by *bytes*; copies of one row compress so
well that their partition rarely looks skewed, although one task still has to
process all of them. The lookups here therefore salt hot keys explicitly:

* the row count per key comes from a key-level table the caller has written
  once (:func:`materialize`), so finding the hot keys scans counts only;
* a key is hot when it holds more than ``1 / HOT_KEYS`` of all rows, at every
  size alike. The counts sum to the row count, so there are never more than
  ``HOT_KEYS`` hot keys: that bound makes their broadcast safe;
* a hot row gets a salt in ``[0, salts)`` from :func:`row_spread`, and the
  lookup side is repeated once per salt for hot keys only;
* the join is on ``(key, salt)``.

The salt is a hash of the row and of its input partition: copies of one row
spread, and a retried task draws the salts of its first attempt, so no row is
lost or doubled when part of a stage is run again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: At most this many keys of one table are hot.
HOT_KEYS = 2000
#: A key with fewer rows than this is never worth a salt.
HOT_FLOOR = 256


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written once under the cluster's checkpoint folder and reread:
    cuts the lineage, and every later use reads the same rows."""
    from corpusprep.session import ensure_checkpoint_dir
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def total_of(counts: DataFrame, count_col: str = "_n") -> int:
    """Rows behind a key-level count table (one small aggregate)."""
    return int(counts.agg(F.sum(count_col)).first()[0] or 0)


def hot_keys(counts: DataFrame, keys: list[str], count_col: str = "_n", total: int | None = None) -> DataFrame:
    """``(_sj_hk struct, _sj_s salts)`` of the hot keys: at most ``HOT_KEYS``."""
    total = total_of(counts, count_col) if total is None else total
    limit = max(HOT_FLOOR, -(-total // HOT_KEYS))
    return counts.where(F.col(count_col) > limit).select(
        F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("_sj_hk"),
        F.ceil(F.col(count_col) / F.lit(limit)).cast("int").alias("_sj_s"))


def row_spread(df: DataFrame, payload: tuple[str, ...] = ("data", "payload", "_data")) -> Column:
    """A hash of the row (payload columns left out) and of its input partition."""
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields
            if f.name not in payload and not isinstance(f.dataType, (T.MapType, T.BinaryType, T.VariantType))]
    return F.xxhash64(*cols, F.spark_partition_id())


def salted_join(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str],
                how: str, hot: DataFrame, extra: Column | None = None) -> DataFrame:
    """``left JOIN right ON struct(left_on) = struct(right_on) [AND extra]``
    with hot keys (``hot``, from :func:`hot_keys` on ``left_on`` counts)
    spread over several tasks. Struct equality treats nulls inside a key as
    equal (a null-safe key). ``right`` should hold few rows per key (a lookup
    table); it is the side that is replicated."""
    hb = F.broadcast(hot)  # at most HOT_KEYS entries
    lk = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(left_on)])
    rk = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(right_on)])
    l = left.withColumn("_sj_l", lk).withColumn("_sj_h", row_spread(left)) \
        .join(hb, F.col("_sj_l") == F.col("_sj_hk"), "left").drop("_sj_hk") \
        .withColumn("_sj_ls", F.when(F.col("_sj_s").isNotNull(), F.pmod(F.col("_sj_h"), F.col("_sj_s")).cast("int"))
                    .otherwise(F.lit(0))).drop("_sj_s", "_sj_h")
    r = right.withColumn("_sj_r", rk).join(hb, F.col("_sj_r") == F.col("_sj_hk"), "left").drop("_sj_hk") \
        .withColumn("_sj_rs", F.explode(F.when(F.col("_sj_s").isNotNull(),
                                               F.sequence(F.lit(0), F.col("_sj_s") - 1))
                                        .otherwise(F.array(F.lit(0))))).drop("_sj_s")
    cond = (F.col("_sj_l") == F.col("_sj_r")) & (F.col("_sj_ls") == F.col("_sj_rs"))
    if extra is not None:
        cond = cond & extra
    out = l.join(r, cond, how)
    semi = how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti")
    return out.drop("_sj_l", "_sj_ls") if semi else out.drop("_sj_l", "_sj_ls", "_sj_r", "_sj_rs")
