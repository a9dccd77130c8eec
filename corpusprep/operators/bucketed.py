"""Repeated audits over bucketed tables: joins without an exchange.

An audit that runs every day joins the same three tables on the sample key:
the metadata, the archive members and the store. Here each is written once,
bucketed and sorted by that key into the same number of buckets. Every later
audit joins bucket with bucket: neither the listing nor a payload is shuffled
again, and the aggregates that follow reuse the bucketing.

* Metadata: one row per ``(key, marker, ext)`` with its sample count, so
  copies of a sample are one row.
* Members: the distinct ``(key, shard, object_key)``, no payload.
* Store: ``(key, object_key, data)``. A store holds a path once. Decisions read two
  of the columns; the payload column is read for what is fetched only.
* First members (J1): payload rows by ``(shard, key)``. Copies of one member
  can hold any share of the rows and a bucket cannot be split, so rows of hot
  keys (:mod:`.skew`) go to a plain table beside it and are joined salted.

The candidate test, and what else must hold beside the key, is a residual
(``IN``): as one more equi-key it would ask for another partitioning.

The tables are external. Their folder's name ends in ``-b<buckets>``, so a
later session (:func:`open_bucketed`) cannot open them with another number.
A user filter on metadata is applied before :func:`write_metadata`.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions import keys as K
from corpusprep.operators import media as M
from corpusprep.operators import resolve as R
from corpusprep.operators.samples import dedupe_last, filter_kind
from corpusprep.operators.skew import hot_keys, materialize

#: Bytes of a bucket that one task reads and sorts.
BUCKET_BYTES = 256 << 20


class Bucketed(NamedTuple):
    """A bucketed table: its frame, folder and number of buckets."""

    frame: DataFrame
    path: str
    buckets: int


def buckets_for(table_bytes: int, least: int = 8) -> int:
    """Buckets of at most :data:`BUCKET_BYTES`, a power of two, so that tables of
    different sizes can share the larger one's number and grow by doubling."""
    need = max(least, -(-table_bytes // BUCKET_BYTES))
    return 1 << (need - 1).bit_length()


def _table_name(path: str) -> str:
    return "bucketed_" + hashlib.md5(path.encode()).hexdigest()[:16]


def write_bucketed(df: DataFrame, path: str, buckets: int, keys: list[str]) -> Bucketed:
    """Write ``df`` once, one sorted file per bucket, into ``<path>-b<buckets>``."""
    full = f"{path.rstrip('/')}-b{buckets}"
    df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys) \
        .option("path", full).option("compression", "zstd").saveAsTable(_table_name(full))
    return Bucketed(df.sparkSession.table(_table_name(full)), full, buckets)


def open_bucketed(spark: SparkSession, path: str, schema: str, keys: list[str]) -> Bucketed:
    """A table written by an earlier session; ``schema`` in DDL (nothing is inferred)."""
    m = re.search(r"-b(\d+)$", path)
    if m is None:
        raise ValueError(f"{path}: the folder of a bucketed table ends in -b<buckets>")
    if not spark.catalog.tableExists(_table_name(path)):
        by, where = ", ".join(f"`{k}`" for k in keys), path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {_table_name(path)} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                  f"INTO {m[1]} BUCKETS LOCATION '{where}'")
    return Bucketed(spark.table(_table_name(path)), path, int(m[1]))


# ---------------------------------------------------------------- writers
def write_metadata(samples: DataFrame, path: str, buckets: int) -> Bucketed:
    """``(key, marker, ext, n)``: the samples' distinct triples; null keys have no object."""
    triples = samples.where(F.col("key").isNotNull()).groupBy(*R.TRIPLE).agg(F.count(F.lit(1)).alias("n"))
    return write_bucketed(triples, path, buckets, ["key"])


def _line_key(name: str) -> "F.Column":
    """The key in a path; a name of any other form is its own key."""
    found = K.key_of_object(name)
    return F.when(found != "", found).otherwise(F.col(name))


def write_members(archive: DataFrame, path: str, buckets: int, name_col: str = "name") -> Bucketed:
    """``(key, shard, object_key)``: the distinct members; rows without shard or name match nothing."""
    members = archive.select("shard", F.col(name_col).alias("object_key")).dropna().distinct()
    return write_bucketed(members.select(_line_key("object_key").alias("key"), "shard", "object_key"), path, buckets, ["key"])


def write_store(store: DataFrame, path: str, buckets: int, data_col: str = "data") -> Bucketed:
    """``(key, object_key, data)``; paths that no sample can name are left out."""
    keyed = store.select(K.key_of_object("object_key").alias("key"), "object_key", F.col(data_col).alias("data"))
    return write_bucketed(keyed.where("key <> ''"), path, buckets, ["key"])


def write_first_members(archive: DataFrame, path: str, buckets: int, name_col: str = "name") -> tuple[Bucketed, DataFrame]:
    """W4 once for all later J1: the first member of each ``(shard, key)`` with its payload.

    Returns the bucketed table and the rows of hot keys (``<path>-hot``), apart.
    """
    keys = ["shard", "key"]
    first = M.first_members(M.member_keys(archive.select("shard", F.col(name_col).alias("name"), "ord", "data"), "name"))
    rows = materialize(first.dropna(subset=keys), "first-members")
    counts = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "first-counts")
    hot = F.broadcast(hot_keys(counts, keys, "_n").select("_sj_hk.*").toDF("_hs", "_hk"))  # at most HOT_KEYS entries
    on = (F.col("shard") == F.col("_hs")) & (F.col("key") == F.col("_hk"))
    rows.join(hot, on, "left_semi").write.mode("overwrite").parquet(f"{path}-hot")
    cold = write_bucketed(rows.join(hot, on, "left_anti"), path, buckets, keys)
    return cold, archive.sparkSession.read.schema(rows.schema).parquet(f"{path}-hot")


# ---------------------------------------------------------------- joins
def _candidates(meta: Bucketed) -> DataFrame:
    return meta.frame.withColumn("_canon", K.canonical_key("key", "marker")) \
        .withColumn("_alt", K.alternate_key("key", "marker", "ext"))


def _resolved(triples: DataFrame, store: Bucketed, how: str) -> DataFrame:
    """Key-level J2: ``hit_ord`` of the first candidate in the store."""
    s = store.frame.select(F.col("key").alias("_hk"), F.col("object_key").alias("_obj"))
    hit = triples.join(s, (triples.key == s._hk) & s._obj.isin(triples._canon, triples._alt), how)
    order = F.when(F.col("_obj") == F.col("_canon"), 0).when(F.col("_obj") == F.col("_alt"), 1)
    best = hit.groupBy(*R.TRIPLE, "n", "_canon", "_alt").agg(F.min(order).alias("hit_ord"))
    return best.withColumn("object_key", F.when(F.col("hit_ord") == 1, F.col("_alt")).otherwise(F.col("_canon")))


def resolve_bucketed(meta: Bucketed, store: Bucketed) -> DataFrame:
    """J2 per distinct sample: ``(key, marker, ext, n, object_key, found)``, no exchange."""
    return _resolved(_candidates(meta), store, "left") \
        .select(*R.TRIPLE, "n", "object_key", F.col("hit_ord").isNotNull().alias("found"))


def missing_bucketed(meta: Bucketed, members: Bucketed, store: Bucketed, shards: list[str] | None = None,
                     kinds=None) -> DataFrame:
    """J3 / J9 per distinct sample: in a shard that has an archive, no candidate among
    that archive's members, some candidate in the store. ``(key, marker, ext, n,
    object_key)``, no exchange but the broadcast of at most 4,096 shard names."""
    t = _candidates(meta).withColumn("_shard", K.derive_shard("key"))
    if shards is not None:
        t = t.where(F.col("_shard").isin(*sorted(set(shards))))
    if kinds is not None:
        t = filter_kind(t, kinds)
    names = members.frame.select(F.col("shard").alias("_with")).where(K.is_shard_name("_with")).distinct()
    t = t.join(F.broadcast(names), F.col("_shard") == F.col("_with"), "left_semi")
    own = members.frame.where(F.col("shard") == K.derive_shard("key")) \
        .select(F.col("key").alias("_mk"), F.col("object_key").alias("_mo"))
    absent = t.join(own, (t.key == own._mk) & own._mo.isin(t._canon, t._alt), "left_anti")
    return _resolved(absent, store, "inner").select(*R.TRIPLE, "n", "object_key")


def fetch_bucketed(resolution: DataFrame, store: Bucketed) -> DataFrame:
    """``(shard, object_key, data)`` of every resolved object, once, non-empty: the
    payload is read in its bucket and crosses no exchange."""
    objects = resolution.select("key", "object_key").distinct()
    s = store.frame.select(F.col("key").alias("_hk"), F.col("object_key").alias("_obj"), "data")
    return objects.join(s, (objects.key == s._hk) & s._obj.isin(objects.object_key)) \
        .where(F.length("data") > 0).select(K.derive_shard("key").alias("shard"), "object_key", "data")


def errors_bucketed(err: DataFrame, members: Bucketed, line_col: str = "line") -> DataFrame:
    """Logged keys that are no members of their shard's archive, one row per
    ``(shard, object_key)``. Only the distinct log lines are exchanged."""
    lines = R.scan_error_lines(err, line_col).distinct().withColumn("_key", _line_key("object_key")) \
        .repartition(members.buckets, "_key")
    m = members.frame.select(F.col("key").alias("_mk"), F.struct("shard", "object_key").alias("_m"))
    absent = lines.join(m, (lines._key == m._mk) & F.struct(lines.shard, lines.object_key).isin(m._m), "left_anti")
    return absent.select("shard", "object_key")


def join_first_members(samples: DataFrame, members: Bucketed, hot: DataFrame, order: str = "src_order") -> DataFrame:
    """J1 on first members written once: the last metadata row of a key wins, the
    payload is read in its bucket. Hot keys' copies are joined salted, whole."""
    keys = ["shard", "key"]
    meta = dedupe_last(samples, keys, order) if order in samples.columns else samples
    meta = materialize(meta, "metadata")
    few = F.broadcast(materialize(hot.select(*keys).distinct(), "hot-keys"))  # at most HOT_KEYS entries
    rest = meta.join(few, keys, "left_anti").repartition(members.buckets, *keys)
    rest = rest.select(*keys, *[F.col(c).alias(f"_m_{c}") for c in rest.columns if c not in keys])
    cold = members.frame.join(rest, keys)
    cold = cold.select(*keys, *[F.col(c).alias(c[3:]) for c in rest.columns if c not in keys],
                       F.col("name").alias("member"), "data")
    # (already deduplicated: the order column makes no second choice)
    apart = M.join_metadata_blobs(meta.join(few, keys, "left_semi"), hot, order)
    return cold.union(apart)
