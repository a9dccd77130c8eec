"""Composed jobs (G1-G5): the studied tool's command-line steps as one Spark
plan each. A job writes its work list first and reads it back, so every later
step sees the same shards whatever arrives meanwhile; then data, then the
ledger. Every write is idempotent per shard, so a job killed at any point is
re-run as is. Readers pass schemas, so no job changes the caller's session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions import policy as P
from corpusprep.operators import features as FE
from corpusprep.operators import media as M
from corpusprep.operators import resolve as R
from corpusprep.operators import samples as S
from corpusprep.operators import shards as SH
from corpusprep.operators.skew import materialize
from corpusprep.sinks import writers as W
from corpusprep.sources import tables as TB

FETCH_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("object_key", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("shard", T.StringType()),
])
BLOB_SCHEMA = "object_key string, data {data}, shard string"
LOG_SCHEMA = "object_key string, shard string"
FEATURE_SCHEMA = "key string, feature array<float>, prefix string"


def job_convert_metadata(source: DataFrame, out: str, rejects: str | None = None) -> None:
    """G1: source table -> samples -> gzip JSON lines per shard.

    A full conversion: ``source`` is the whole table, and shards that it no
    longer has are cleared. Rows with a null URL have no key: they go to the
    table ``rejects``, or fail the job when there is none.
    """
    if rejects is not None:
        source, bad = S.split_rejects(source)
        bad.write.mode("overwrite").parquet(rejects)
    W.write_shard_jsonl(S.create_samples(source, strict=rejects is None), out, full=True)


def _work_meta(samples: DataFrame, work: DataFrame, kinds, predicate) -> DataFrame:
    """Samples of the work list (at most 4,096 names: a bounded broadcast), kind
    and user filters applied. Jobs take filters the optimizer can read only."""
    if predicate is not None and not isinstance(predicate, (str, Column)):
        raise TypeError("a job's filter is SQL text or a Column")
    return S.prepare_metadata(samples.join(F.broadcast(work), "shard", "left_semi"), kinds, predicate, sort=False)


def job_fetch(spark: SparkSession, samples: DataFrame, store: DataFrame, out: str,
              start: str = "000", end: str = "fff", kinds=(0, 1), predicate=None,
              shards: list[str] | None = None, data_col: str = "data") -> DataFrame:
    """Work list -> metadata -> resolve -> stored / error halves -> ledger.

    ``out/blobs`` gets each resolved object once, however many samples name
    it, with the store's own payload type and its ``size``; an empty object is
    kept as a row of size 0. ``out/fetched`` gets a row per sample with
    ``status`` (K3 = ``stored``, K4 = ``error``) as a column. Both are partitioned
    by ``shard``, and a shard fetched again replaces its rows, so no key
    is ever in two states. Then the ledger. Returns the work list that was
    processed.
    """
    finished = SH.read_ledger(spark, f"{out}/ledger")
    work = materialize(SH.select_shards(SH.present_shards(samples), finished, start, end, shards), "work")
    meta = _work_meta(samples, work, kinds, predicate)
    store = store.select("object_key", data_col)
    triples = R.distinct_triples(meta)
    res = materialize(R.resolve_triples(triples, store), "resolved")
    blobs = R.fetch_objects(res, store, data_col, empty=True) \
        .select("shard", "object_key", F.col(data_col).alias("data"), F.coalesce(F.octet_length(data_col), F.lit(0)).alias("size"))
    W.write_parquet_by_shard(blobs, f"{out}/blobs")
    # a shard without any hit now may hold blobs of an earlier fetch: only hits of this one count
    full = _sizes(spark, out).where("size > 0").select("object_key").distinct().withColumn("_full", F.lit(True))
    state = res.join(full, "object_key", "left").withColumn(
        "status", F.when(F.col("hit_ord").isNotNull() & F.col("_full"), F.lit("stored")).otherwise(F.lit("error"))).drop("_full", "hit_ord", "canonical")
    rows = R.attach(meta, state, triples)
    W.write_parquet_by_shard(rows.select("key", "object_key", "status", "shard"), f"{out}/fetched")
    W.ledger_append(work, f"{out}/ledger")
    return work


def _sizes(spark: SparkSession, out: str) -> DataFrame:
    """Names and sizes of the stored objects; a fetch without any hit writes none."""
    schema = "object_key string, size int, shard string"
    return spark.read.schema(schema).parquet(f"{out}/blobs") if TB.path_exists(spark, f"{out}/blobs") else spark.createDataFrame([], schema)


def read_blobs(spark: SparkSession, out: str) -> DataFrame:
    """``(shard, object_key, data)`` of the objects that some fetched sample has, each once."""
    fetched = read_fetched(spark, out).where("status = 'stored'").select("object_key").distinct()
    kind = spark.read.parquet(f"{out}/blobs").schema["data"].dataType.simpleString()
    stored = spark.read.schema(BLOB_SCHEMA.format(data=kind) + ", size int").parquet(f"{out}/blobs").where("size > 0")
    return stored.join(fetched, "object_key", "left_semi").select("shard", "object_key", "data")


def read_fetched(spark: SparkSession, out: str) -> DataFrame:
    if not TB.path_exists(spark, f"{out}/fetched"):
        return spark.createDataFrame([], FETCH_SCHEMA)
    return spark.read.schema(FETCH_SCHEMA).parquet(f"{out}/fetched")


def job_repair(spark: SparkSession, samples: DataFrame, store: DataFrame, blobs: str, errors: str,
               start: str = "000", end: str = "fff", data_col: str = "data",
               shards: list[str] | None = None, kinds=(0, 1), predicate=None) -> str:
    """Error table -> real errors -> retry -> append -> rewrite the log.

    ``blobs``: Parquet ``(shard, object_key, data)``; ``errors``: Parquet
    ``(shard, object_key)`` (or raw lines in ``line``). Only non-empty payloads
    count as repaired, and only stored paths leave the log. The rewritten log
    goes to a new version folder (a path being read cannot be overwritten);
    its path is returned.
    """
    kind = dict(store.dtypes)[data_col]
    stored = spark.read.schema(BLOB_SCHEMA.format(data=kind)).parquet(blobs)
    names = spark.read.parquet(errors).columns
    line = "line" if "line" in names else "object_key"
    err = spark.read.schema(f"{line} string, shard string").parquet(errors).withColumnRenamed(line, "line")
    # work list: metadata shards in range (the ledger is ignored), or the
    # caller's; every log is cleaned, but only shards of the list are retried
    present = SH.present_shards(samples)
    work = materialize(SH.select_shards(present, None, shards=shards) if shards else SH.repair_shards(present, start, end), "work")
    real = materialize(R.error_keys(err, stored.select("shard", F.col("object_key").alias("name"))), "errors")
    todo = _work_meta(samples, work, kinds, predicate)
    repaired = R.repaired_objects(todo, store, real, data_col)
    # the bytes are joined once: written under the checkpoint folder, then
    # appended, and the paths read back from there
    repaired = materialize(repaired.withColumnRenamed(data_col, "data"), "repaired")
    W.append_repaired(repaired, stored, blobs)
    still = real.join(repaired.select("shard", "object_key"), ["shard", "object_key"], "left_anti")
    new_log = f"{errors.rstrip('/')}-v{uuid.uuid4().hex[:8]}"
    W.rewrite_error_log(still, new_log)
    return new_log


def job_convert(spark: SparkSession, samples: DataFrame, members: DataFrame, out: str,
                finished: DataFrame | None = None, overwrite: bool = False,
                compress: int | None = P.DEFAULT_QUALITY, subsampling: str = P.DEFAULT_SUBSAMPLING,
                target_size: int = P.DEFAULT_TARGET_SIZE, geometry=None,
                order: str = "src_order", shards: list[str] | None = None, kinds=(0, 1), predicate=None,
                already: str | None = None, pixels: str | None = None,
                min_bytes: int = P.GATE_MIN_BYTES, min_variance: float = P.GATE_MIN_VARIANCE) -> DataFrame:
    """Metadata ⨝ archive members -> gate -> policy -> samples per shard -> ledger.

    ``kinds`` and ``predicate`` filter the metadata; an explicit ``shards`` list
    overrides the ledger. ``geometry(df) -> df`` is the caller's header decoder:
    it adds ``w`` / ``h``, and with ``pixels`` names a column of decoded gray
    rows (``array<array>``) on which the quality gate (P23) drops images that
    are small and flat, on the row, without a shuffle. ``already`` names a
    column that marks payloads re-encoded before (D12: left as they are).
    Returns the work list.
    """
    work = SH.convertible_shards(SH.present_shards(samples), members, finished, overwrite)
    if shards:
        work = SH.convertible_shards(SH.select_shards(SH.present_shards(samples), shards=shards), members)
    work = materialize(work, "work")
    meta = _work_meta(samples, work, kinds, predicate)
    joined = M.join_metadata_blobs(meta, members.join(F.broadcast(work), "shard", "left_semi"), order)
    if geometry is not None:
        joined = geometry(joined)
        if pixels is not None:
            n_bytes = F.octet_length("data")
            flat = (n_bytes < min_bytes) & (M.column_variance_p95(pixels) < min_variance)
            joined = joined.where(~((F.col("marker") == 0) & F.coalesce(flat, F.lit(False)))).drop(pixels)
        joined = M.recompress_plan(joined, compress, subsampling, target_size, already)
    converted = M.attach_payload(joined)
    W.write_samples(converted, f"{out}/samples")
    W.ledger_append(work, f"{out}/ledger")
    return work


def job_prefix_release(spark: SparkSession, vectors: DataFrame, out: str, pre_start: str,
                       pre_end: str, make_predict_fn, n_in: int, dataset: str = "corpus",
                       owner: str = "owner", key: str = "key") -> DataFrame:
    """For every two-digit prefix in range: features of its keys (K9,
    partitioned by prefix) and a manifest per prefix (K12) - one job, no loop.
    Keys already stored are not scored again; other prefixes stay as they are.
    Returns ``(prefix, start, end, n_features, manifest)``."""
    bounds = SH.prefix_bounds(spark, pre_start, pre_end)
    v = vectors.withColumn("prefix", F.substring(key, 1, 2)).join(F.broadcast(bounds.select("prefix")), "prefix", "left_semi")
    store = f"{out}/features"
    stored = spark.read.schema(FEATURE_SCHEMA).parquet(store).select(F.col("key").alias(key)) if TB.path_exists(spark, store) else None
    feats = FE.extract_embeddings(v, stored, make_predict_fn, n_in, key=key)
    feats = feats.withColumn("prefix", F.substring(key, 1, 2)).withColumnRenamed(key, "key")
    # append: the stored keys of a prefix are not in ``feats``
    W.write_features(feats, store, mode="append", partition_by="prefix")
    written = spark.read.schema(FEATURE_SCHEMA).parquet(store)
    counts = SH.count_in_domain(bounds, written, on="prefix", name="n_features")
    manifest = W.dataset_manifest(bounds.select("prefix"), dataset, owner)
    return counts.join(manifest, "prefix", "left")
