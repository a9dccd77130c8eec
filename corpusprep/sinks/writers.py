"""Sinks (K1-K12).

Writers are idempotent at shard granularity: partitioned by ``shard`` with
dynamic partition overwrite, so re-running a shard replaces exactly that
shard's files; a full conversion (``full=True``) replaces the whole table, so
shards that are gone from the source are gone from the output.
Data is written before the ledger; a crash between the two re-runs the shard,
and the rewrite is harmless.

Rows are brought together per folder by a rebalancing shuffle: no sampling
pass over a payload join, folders far above the advisory size are split by
map output (the same in every attempt) and small ones share a task. There are
at most (tasks + folders) files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed value (must equal the studied tool's) --------------------------
FEATURE_COMPRESSION = "gzip"         # feature store compression
# ---------------------------------------------------------------------------


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    from corpusprep.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/out/{name}-{uuid.uuid4().hex[:12]}"


def _clustered(df: DataFrame, folders: list[str], order: list[str] = ()) -> DataFrame:
    """Rows of one folder together, folders split where they are large, sorted in each task."""
    return df.hint("rebalance", *folders).sortWithinPartitions(*folders, *order)


def write_shard_jsonl(df: DataFrame, path: str, mode: str = "overwrite", order=("key",), full: bool = False) -> None:
    """K1 / K2: gzip JSON lines per shard, nulls kept, sorted by key.

    ``overwrite`` with dynamic partition overwrite replaces only the shards
    present in ``df`` (K2); other shards' files stay. With ``full``, ``df`` is
    the whole table and replaces all of it.
    """
    _clustered(df, ["shard"], list(order)).write.mode(mode) \
        .option("partitionOverwriteMode", "static" if full else "dynamic") \
        .option("compression", "gzip").option("ignoreNullFields", "false") \
        .partitionBy("shard").json(path)


def write_parquet_by_shard(df: DataFrame, path: str, mode: str = "overwrite",
                           order=("object_key",), compression: str = "zstd") -> None:
    """K3 / K6 / K8: Parquet partitioned by shard (dynamic overwrite)."""
    _clustered(df, ["shard"], list(order)).write.mode(mode) \
        .option("partitionOverwriteMode", "dynamic").option("compression", compression) \
        .partitionBy("shard").parquet(path)


def write_blobs(stored: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: found payloads ``(shard, object_key, data)`` per shard."""
    write_parquet_by_shard(stored.select("shard", "object_key", "data"), path, mode)


def write_error_log(failed: DataFrame, path: str) -> None:
    """K4: canonical keys of failed rows per shard; a re-run of a shard
    replaces its log (dynamic overwrite), it never doubles it."""
    write_parquet_by_shard(failed.select("shard", "object_key"), path, "overwrite")


def append_repaired(repaired: DataFrame, existing: DataFrame, path: str) -> DataFrame:
    """K5: add repaired objects (one row per path, as ``repaired_objects`` gives
    them) not already stored, by append (never rewrite). Returns their paths."""
    new = repaired.select("shard", "object_key", "data").where(F.length("data") > 0) \
        .join(existing.select("shard", "object_key").distinct(), ["shard", "object_key"], "left_anti")
    write_parquet_by_shard(new, path, "append")
    return new.select("shard", "object_key")


def write_missing(fetched: DataFrame, path: str) -> None:
    """K6: the audit's extra dataset (one row per path, as ``audit_objects``
    gives them); nothing is created for shards without missing members (a
    partitioned write makes no empty partitions)."""
    write_parquet_by_shard(fetched.select("shard", "object_key", "data"), path, "overwrite")


def ledger_append(shards: DataFrame, path: str) -> None:
    """K7: mark shards finished (append; readers take the distinct set)."""
    shards.select("shard").distinct().coalesce(1).write.mode("append").text(path)


def write_samples(samples: DataFrame, path: str) -> None:
    """K8: converted samples, dynamic overwrite per shard."""
    write_parquet_by_shard(samples, path, "overwrite", order=("key",))


def write_features(features: DataFrame, path: str, mode: str = "append",
                   partition_by: str | None = None) -> None:
    """K9: one float32 vector per key, gzip-compressed Parquet. Partitioned
    writes replace only the folders they hold (dynamic overwrite)."""
    out = _clustered(features, [partition_by], ["key"]) if partition_by else features
    w = out.write.mode(mode).option("compression", FEATURE_COMPRESSION).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_decode_errors(errors: DataFrame, path: str) -> None:
    """One ``(key, path)`` record per undecodable image, appended."""
    errors.select("key", "path").write.mode("append").parquet(path)


def rewrite_error_log(still_missing: DataFrame, path: str) -> None:
    """Replace a log by its distinct still-missing keys.

    Spark refuses to overwrite a path it is reading, so the caller writes a
    new version folder and switches to it (see :mod:`corpusprep.plans.jobs`).
    """
    _clustered(still_missing.select("shard", "object_key").distinct(), ["shard"], ["object_key"]) \
        .write.mode("overwrite").partitionBy("shard").parquet(path)


def dataset_manifest(prefixes: DataFrame, dataset: str = "corpus", owner: str = "owner",
                     license_name: str = "CC0-1.0") -> DataFrame:
    """``{title, id, licenses: [{name}]}`` JSON per published prefix."""
    title = F.concat(F.lit(f"{dataset}-"), F.col("prefix"))
    manifest = F.struct(
        title.alias("title"),
        F.concat(F.lit(f"{owner}/"), title).alias("id"),
        F.array(F.struct(F.lit(license_name).alias("name"))).alias("licenses"),
    )
    return prefixes.select("prefix", F.to_json(manifest).alias("manifest"))
