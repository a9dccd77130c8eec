"""Checked queries, part 3: sinks (read back after the write), file sources,
restartable processing and the composed jobs (K1-K12, S3, S6, S7, S11, S12,
R1-R3, G1-G5).

Each query writes into a fresh folder under the cluster's checkpoint folder
(``spark.checkpoint.dir``), then reads its output back with Spark.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators import features as FE
from corpusprep.operators import media as M
from corpusprep.operators import resolve as R
from corpusprep.operators import samples as S
from corpusprep.operators import shards as SH
from corpusprep.operators.skew import materialize
from corpusprep.plans import fixture_files as FL
from corpusprep.plans import fixtures as FX
from corpusprep.plans import jobs as J
from corpusprep.plans.catalog import register
from corpusprep.plans.queries_media import SCORER_IN, SCORER_OUT, scored
from corpusprep.sinks import published as PB
from corpusprep.sinks import writers as W
from corpusprep.sources import archive_source as ARS
from corpusprep.sources import archives as AR
from corpusprep.sources import feature_files as FF
from corpusprep.sources import images as IM
from corpusprep.sources import tables as TB
from corpusprep.streaming import incremental as INC

BLOB_SCHEMA = "object_key string, data string, shard string"
KEY_SCHEMA = "object_key string, shard string"


def _pages(spark, sf):
    return FX.table(spark, sf, "pages")


def _meta_cols(df):
    return df.drop("payload")


def _vectors(spark, sf):
    return FX.vectors(FX.table(spark, sf, "embeddings"))


def _scorer():
    return FE.integer_scorer(SCORER_IN, SCORER_OUT)


_META_SCHEMA = TB.sample_schema(T.StructType([T.StructField("page_id", T.LongType())]))


# ---------------------------------------------------------------- metadata shards
@register("write_shard_jsonl", ["coerced"], """
SELECT page_id, key, shard, downloadurl, longitude, latitude, accuracy, marker, ext FROM coerced""")
def q_write_shard_jsonl(spark, sf):
    out = W.scratch_path(spark, "k1")
    W.write_shard_jsonl(_meta_cols(S.create_samples(FX.raw_samples(_pages(spark, sf)))), out)
    back = TB.read_metadata_shards(spark, out, _META_SCHEMA)
    return back.select("page_id", "key", "shard", "downloadurl", "longitude", "latitude", "accuracy",
                       "marker", "ext")


@register("scan_metadata_shards", ["coerced"], """
SELECT shard, count(*) AS n_rows, count(accuracy) AS n_accuracy FROM coerced GROUP BY shard""")
def q_scan_metadata_shards(spark, sf):
    out = W.scratch_path(spark, "s3")
    J.job_convert_metadata(_meta_cols(FX.raw_samples(_pages(spark, sf))), out)
    back = TB.read_metadata_shards(spark, out, _META_SCHEMA)
    return back.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.count("accuracy").alias("n_accuracy"))


@register("metadata_rejects", ["coerced"], """
SELECT shard, count(*) AS n_rows, count(*) AS n_rejects, max(length(key)) + 9 AS longest FROM coerced GROUP BY shard""")
def q_metadata_rejects(spark, sf):
    """Every sample written twice: as a good line, and as one cut off in the middle."""
    out = W.scratch_path(spark, "s3-rejects")
    J.job_convert_metadata(_meta_cols(FX.raw_samples(_pages(spark, sf))), out)
    good = TB.read_metadata_shards(spark, out, _META_SCHEMA)
    good.select(F.concat(F.lit('{"key": "'), F.col("key")).alias("value"), "shard").write.mode("append").partitionBy("shard").text(out, compression="gzip")
    rows = TB.read_metadata_shards(spark, out, _META_SCHEMA, on_error="reject").groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"))
    bad = TB.metadata_rejects(spark, out, _META_SCHEMA).groupBy("shard") \
        .agg(F.count(F.lit(1)).alias("n_rejects"), F.max(F.length("line")).cast("long").alias("longest"))
    return rows.join(bad, "shard", "full")


@register("job_convert_metadata", ["coerced"], """
SELECT page_id, key, shard, CAST(NULL AS VARCHAR) AS reason FROM coerced
UNION ALL SELECT page_id, NULL AS key, NULL AS shard, 'null downloadurl' AS reason FROM pages""")
def q_job_convert_metadata(spark, sf):
    """Converted twice: first from a source with other URLs (whose shards must
    not survive), then from the real one with a null-URL copy of every row."""
    out, rejects = W.scratch_path(spark, "g1"), W.scratch_path(spark, "g1-rejects")
    raw = _meta_cols(FX.raw_samples(_pages(spark, sf)))
    J.job_convert_metadata(raw.withColumn("downloadurl", F.concat("downloadurl", F.lit("?old"))), out)
    J.job_convert_metadata(raw.unionByName(raw.withColumn("downloadurl", F.lit(None).cast("string"))), out, rejects)
    good = TB.read_metadata_shards(spark, out, _META_SCHEMA).select("page_id", "key", "shard", F.lit(None).cast("string").alias("reason"))
    bad = spark.read.parquet(rejects).select("page_id", F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("shard"), "reason")
    return good.unionByName(bad)


@register("verify_source_md5", [], """
SELECT CAST(page_id AS VARCHAR) AS name, CAST(strlen(html) AS BIGINT) AS length, md5(html) AS md5, page_id % 2 = 0 AS ok FROM pages""")
def q_verify_source_md5(spark, sf):
    """Every page written as a file and streamed; half of the expected sums are right."""
    out = W.scratch_path(spark, "s10")
    pages = _pages(spark, sf)
    name = F.col("page_id").cast("string")
    FL.write_files(pages.select(name.alias("name"), "html"), out, "name", "html").agg(F.count(F.lit(1))).collect()
    files = TB.file_checksums(spark, out).withColumn("name", F.substring_index("path", "/", -1))
    expected = pages.select(name.alias("name"), F.upper(F.when(F.col("page_id") % 2 == 0, F.md5("html")).otherwise(F.md5("url"))).alias("md5"))
    return TB.verify_checksums(files, expected, "name").select("name", "length", "md5", "ok")


@register("overwrite_shards", ["samples"], """
SELECT page_id, shard, CASE WHEN shard < '8' THEN 'new' ELSE ext END AS ext FROM samples""")
def q_overwrite_shards(spark, sf):
    out = W.scratch_path(spark, "k2")
    s = _meta_cols(FX.samples(_pages(spark, sf)))
    W.write_shard_jsonl(s, out)
    W.write_shard_jsonl(s.where(F.col("shard") < "8").withColumn("ext", F.lit("new")), out)
    return TB.read_metadata_shards(spark, out, _META_SCHEMA).select("page_id", "shard", "ext")


# ---------------------------------------------------------------- blobs / errors
def _resolved(spark, sf):
    pages = _pages(spark, sf)
    s = FX.samples(pages).select("page_id", "key", "shard", "marker", "ext")
    return R.resolve_objects(s, FX.store(pages))


@register("write_blobs", ["resolved"], """
SELECT DISTINCT shard, object_key, data FROM resolved WHERE found AND length(data) > 0""")
def q_write_blobs(spark, sf):
    out = W.scratch_path(spark, "k3")
    pages = _pages(spark, sf)
    W.write_blobs(R.successes(FX.samples(pages).select("page_id", "key", "shard", "marker", "ext"), FX.store(pages)), out)
    return spark.read.schema(BLOB_SCHEMA).parquet(out).select("shard", "object_key", "data")


@register("write_error_log", ["resolved"], """
SELECT shard, object_key FROM resolved WHERE NOT (found AND length(data) > 0)""")
def q_write_error_log(spark, sf):
    out = W.scratch_path(spark, "k4")
    failed = R.failures(_resolved(spark, sf))
    W.write_error_log(failed, out)
    W.write_error_log(failed, out)  # a re-run replaces the logs
    return spark.read.schema(KEY_SCHEMA).parquet(out).select("shard", "object_key")


def _existing_blobs(pages):
    a = FX.archive(pages).where(~F.col("data").isin("dup", "tie"))
    return a.select("shard", F.col("name").alias("object_key"), "data")


@register("append_repaired", ["archive", "repaired"], """
WITH ex AS (SELECT shard, name AS object_key, data FROM archive WHERE data NOT IN ('dup', 'tie'))
SELECT shard, object_key, data FROM ex
UNION ALL
SELECT DISTINCT r.shard, r.object_key, r.data FROM repaired r
WHERE r.found AND length(r.data) > 0 AND NOT EXISTS (SELECT 1 FROM ex WHERE ex.shard = r.shard AND ex.object_key = r.object_key)""")
def q_append_repaired(spark, sf):
    pages = _pages(spark, sf)
    out = W.scratch_path(spark, "k5")
    _existing_blobs(pages).write.partitionBy("shard").parquet(out)
    existing = spark.read.schema(BLOB_SCHEMA).parquet(out)
    errs = R.error_keys(FX.err_log(pages), FX.archive(pages))
    s = FX.samples(pages).select("page_id", "key", "shard", "marker", "ext")
    W.append_repaired(R.repaired_objects(s, FX.store(pages), errs), existing, out)
    return spark.read.schema(BLOB_SCHEMA).parquet(out).select("shard", "object_key", "data")


@register("write_missing", ["missing", "resolved", "archive"], """
SELECT DISTINCT r.shard, r.object_key, r.data FROM resolved r JOIN missing m ON m.page_id = r.page_id
WHERE r.shard IN (SELECT shard FROM archive) AND r.found AND length(r.data) > 0""")
def q_write_missing(spark, sf):
    pages = _pages(spark, sf)
    out = W.scratch_path(spark, "k6")
    s = FX.samples(pages).select("page_id", "key", "shard", "marker", "ext")
    W.write_missing(R.audit_objects(s, FX.archive(pages), FX.store(pages)), out)
    return spark.read.schema(BLOB_SCHEMA).parquet(out).select("shard", "object_key", "data")


@register("ledger_append", ["ledger", "samples"], """
SELECT DISTINCT shard FROM (SELECT shard FROM ledger UNION ALL SELECT shard FROM samples WHERE shard < '4') l""")
def q_ledger_append(spark, sf):
    pages = _pages(spark, sf)
    out = W.scratch_path(spark, "k7")
    FX.ledger(pages).write.text(out)
    done = SH.present_shards(FX.samples(pages)).where(F.col("shard") < "4")
    W.ledger_append(done, out)
    W.ledger_append(done, out)  # a repeated run appends again; readers dedupe
    return SH.read_ledger(spark, out)


@register("write_samples", ["samples"], """
SELECT page_id, key, shard, CASE WHEN marker = 0 THEN payload END AS image,
  CASE WHEN marker <> 0 THEN payload END AS video FROM samples""")
def q_write_samples(spark, sf):
    out = W.scratch_path(spark, "k8")
    s = FX.samples(_pages(spark, sf)).select("page_id", "key", "shard", "marker", F.col("payload").alias("data"))
    W.write_samples(M.attach_payload(s), out)
    return spark.read.schema("page_id bigint, key string, image string, video string, shard string") \
        .parquet(out).select("page_id", "key", "shard", "image", "video")


@register("rewrite_error_log", ["errkeys"], "SELECT shard, object_key FROM errkeys")
def q_rewrite_error_log(spark, sf):
    pages = _pages(spark, sf)
    v1 = W.scratch_path(spark, "k11")
    FX.err_log(pages).write.partitionBy("shard").parquet(v1)
    logged = spark.read.schema("line string, shard string").parquet(v1)
    still = R.error_keys(logged, FX.archive(pages))
    v2 = v1 + "-v2"
    W.rewrite_error_log(still, v2)
    return spark.read.schema(KEY_SCHEMA).parquet(v2).select("shard", "object_key")


@register("publish_error_log", ["errkeys"], "SELECT shard, object_key FROM errkeys")
def q_publish_error_log(spark, sf):
    pages, log = _pages(spark, sf), W.scratch_path(spark, "k11p")
    lines = R.scan_error_lines(FX.err_log(pages))
    PB.rewrite_published(lines, log, 0)
    logged = PB.read_published(spark, log).withColumnRenamed("object_key", "line")
    PB.rewrite_published(R.error_keys(logged, FX.archive(pages)), log, 1)
    return PB.read_published(spark, log).select("shard", "object_key")


@register("dataset_manifest", ["samples"], """
SELECT DISTINCT substr(shard, 1, 2) AS prefix,
  concat('{"title":"corpus-', substr(shard, 1, 2), '","id":"owner/corpus-', substr(shard, 1, 2),
         '","licenses":[{"name":"CC0-1.0"}]}') AS manifest
FROM samples""")
def q_dataset_manifest(spark, sf):
    p = FX.samples(_pages(spark, sf)).select(F.substring("shard", 1, 2).alias("prefix")).distinct()
    return W.dataset_manifest(p)


# ---------------------------------------------------------------- features
def _stored_features(spark, sf, out):
    v = _vectors(spark, sf)
    done = FE.extract_embeddings(v.where("already_done"), None, _scorer(), SCORER_IN)
    W.write_features(done, out, mode="overwrite")
    return v


@register("scan_feature_keys", ["vectors"], """
SELECT key FROM vectors WHERE already_done AND embedding IS NOT NULL""")
def q_scan_feature_keys(spark, sf):
    out = W.scratch_path(spark, "s12")
    _stored_features(spark, sf, out)
    return TB.scan_feature_keys(spark, out)


@register("write_features", ["features", "vectors"], """
SELECT f.key, f.y0, f.y1, f.y2, f.y3 FROM features f JOIN vectors v ON v.vec_id = f.vec_id
WHERE NOT v.already_done""")
def q_write_features(spark, sf):
    out = W.scratch_path(spark, "k9")
    v = _vectors(spark, sf)
    stored = v.where("already_done").select("key")
    W.write_features(FE.extract_embeddings(v, stored, _scorer(), SCORER_IN), out)
    back = spark.read.schema("key string, feature array<float>").parquet(out)
    return back.select("key", *scored(back))


@register("resume_features", ["vectors"], """
SELECT key, CAST(1 AS BIGINT) AS n_copies FROM vectors WHERE embedding IS NOT NULL""")
def q_resume_features(spark, sf):
    out = W.scratch_path(spark, "r3")
    v = _stored_features(spark, sf, out)
    INC.resume_features(spark, v, out, _scorer(), SCORER_IN)
    INC.resume_features(spark, v, out, _scorer(), SCORER_IN)  # second restart: nothing left
    return TB.scan_feature_keys(spark, out).groupBy("key").agg(F.count(F.lit(1)).alias("n_copies"))


@register("resume_clustered", ["vectors"], """
SELECT substr(key, 1, 1) AS digit, count(*) AS n_pending FROM vectors
WHERE embedding IS NOT NULL AND NOT already_done GROUP BY 1""")
def q_resume_clustered(spark, sf):
    out = W.scratch_path(spark, "s12c")
    v = _vectors(spark, sf)
    FF.write_clustered(FE.extract_embeddings(v.where("already_done"), None, _scorer(), SCORER_IN), out)
    todo = FE.drop_undecodable(v)
    pending = FE.pending_features(todo, FF.stored_keys_near(todo, out))
    return pending.groupBy(F.substring("key", 1, 1).alias("digit")).agg(F.count(F.lit(1)).alias("n_pending"))


@register("write_decode_errors", ["vectors"], """
SELECT key, concat('vec/', CAST(vec_id AS VARCHAR)) AS path FROM vectors WHERE embedding IS NULL""")
def q_write_decode_errors(spark, sf):
    out = W.scratch_path(spark, "k10")
    v = _vectors(spark, sf)
    W.write_decode_errors(FE.decode_errors(v, path=F.concat(F.lit("vec/"), F.col("vec_id").cast("string"))), out)
    return spark.read.schema("key string, path string").parquet(out)


# ---------------------------------------------------------------- archives and images
def _write_archives(spark, sf, out):
    pages = _pages(spark, sf)
    report = FL.write_zip_shards(FX.archive(pages), out)
    report.agg(F.count(F.lit(1))).collect()  # runs the distributed write; the report is tiny
    return pages


@register("archive_index", ["archive"], """
SELECT shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY ord, name) - 1 AS INTEGER) AS ord, name,
  CAST(strlen(data) AS BIGINT) AS size FROM archive""")
def q_archive_index(spark, sf):
    out = W.scratch_path(spark, "s6")
    _write_archives(spark, sf, out)
    return AR.archive_index(spark, out).select("shard", "ord", "name", "size")


@register("archive_source", ["archive"], """
SELECT shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY ord, name) - 1 AS INTEGER) AS ord, name,
  data, CAST(strlen(data) AS BIGINT) AS size FROM archive""")
def q_archive_source(spark, sf):
    """Members and index of all archives through the data source, in short runs."""
    out = W.scratch_path(spark, "s7-source")
    _write_archives(spark, sf, out)
    members = ARS.read_archives(spark, out, run_bytes=200_000).select("shard", "ord", "name", F.col("data").cast("string").alias("data"))
    return members.join(ARS.read_archives(spark, out, payload=False).select("shard", "ord", "name", "size"), ["shard", "ord", "name"])


@register("archive_members", ["archive"], """
SELECT shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY ord, name) - 1 AS INTEGER) AS ord, name,
  data FROM archive""")
def q_archive_members(spark, sf):
    out = W.scratch_path(spark, "s7")
    _write_archives(spark, sf, out)
    m = AR.archive_members(spark, out)
    return m.select("shard", "ord", "name", F.col("data").cast("string").alias("data"))


def _pixels_col():
    return F.transform("embedding", lambda v: F.least(F.greatest(F.floor((v.cast("double") + 1) * 127.5),
                                                                  F.lit(0)), F.lit(255)))


@register("scan_images", [], """
WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT CAST(vec_id AS VARCHAR) AS key,
  CASE WHEN vec_id % 11 = 0 THEN -1 ELSE 8 END AS height,
  CASE WHEN vec_id % 11 = 0 THEN -1 ELSE 8 END AS width,
  CASE WHEN vec_id % 11 = 0 THEN -1 ELSE 1 END AS n_channels,
  vec_id % 11 <> 0 AS valid,
  CASE WHEN vec_id % 11 = 0 THEN 0 ELSE CAST(sum(least(greatest(floor((v + 1) * 127.5), 0), 255)) AS BIGINT) END
    AS pixel_sum
FROM e GROUP BY vec_id""")
def q_scan_images(spark, sf):
    out = W.scratch_path(spark, "s11")
    _write_images(spark, sf, out)
    img = IM.scan_images(spark, out)
    psum = F.aggregate(F.transform(F.split(F.hex("data"), "(?<=\\G..)"),
                                   lambda h: F.conv(h, 16, 10).cast("bigint")),
                       F.lit(0).cast("bigint"), lambda a, b: a + F.coalesce(b, F.lit(0).cast("bigint")))
    return img.select("key", "height", "width", "n_channels", "valid",
                      F.when(F.col("valid"), psum).otherwise(F.lit(0).cast("bigint")).alias("pixel_sum"))


def _write_images(spark, sf, out):
    emb = FX.table(spark, sf, "embeddings")
    px = F.when(F.col("vec_id") % 11 != 0, _pixels_col())
    FL.write_gray_images(emb.select("vec_id", px.alias("px")), out, "vec_id", "px", 8, 8).agg(F.count(F.lit(1))).collect()
    return emb


@register("extract_embeddings", [], """
WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
z AS (SELECT vec_id, i, (least(greatest(floor((v + 1) * 127.5), 0), 255) / CAST(255 AS DOUBLE) - 0.5) / 0.5 AS z FROM e)
SELECT CAST(vec_id AS VARCHAR) AS key,
  CAST(sum(((i * 7 + 0 * 13) % 5 - 2) * floor(z * 1000)) AS BIGINT) AS y0,
  CAST(sum(((i * 7 + 1 * 13) % 5 - 2) * floor(z * 1000)) AS BIGINT) AS y1,
  CAST(sum(((i * 7 + 2 * 13) % 5 - 2) * floor(z * 1000)) AS BIGINT) AS y2,
  CAST(sum(((i * 7 + 3 * 13) % 5 - 2) * floor(z * 1000)) AS BIGINT) AS y3
FROM z WHERE vec_id % 11 <> 0 AND vec_id % 3 <> 0 GROUP BY vec_id""")
def q_extract_embeddings(spark, sf):
    """Image files -> decode -> normalise -> score -> store; every image comes
    twice, undecodable and stored ones are skipped."""
    files, out = W.scratch_path(spark, "f4-img"), W.scratch_path(spark, "f4-out")
    emb = _write_images(spark, sf, files)
    img = materialize(IM.scan_images(spark, files), "images")  # decoded once, although every row comes twice
    stored = emb.where("vec_id % 3 = 0").select(F.col("vec_id").cast("string").alias("key"))
    W.write_features(FE.embed_images(img.unionByName(img), stored, _scorer(), SCORER_IN), out)
    back = spark.read.schema("key string, feature array<float>").parquet(out)
    return back.select("key", *scored(back))


# ---------------------------------------------------------------- restartable runs
@register("resume_shards", ["resolved"], """
SELECT 'stored' AS status, shard, object_key FROM resolved WHERE found AND length(data) > 0
UNION ALL SELECT 'error' AS status, shard, object_key FROM resolved WHERE NOT (found AND length(data) > 0)""")
def q_resume_shards(spark, sf):
    pages = _pages(spark, sf)
    out = W.scratch_path(spark, "r1")
    s = FX.samples(pages).drop("payload")
    store = FX.store(pages)
    J.job_fetch(spark, s, store, out, "000", "7ff")      # "interrupted" after half the range
    J.job_fetch(spark, s, store, out, "000", "fff")      # restart: finished shards are skipped
    return J.read_fetched(spark, out).select("status", "shard", "object_key")


@register("incremental_ingest", ["coerced"], "SELECT page_id, key, shard FROM coerced")
def q_incremental_ingest(spark, sf):
    pages = _pages(spark, sf)
    src, sink, ck = (W.scratch_path(spark, n) for n in ("r2-in", "r2-out", "r2-ck"))
    raw = _meta_cols(FX.raw_samples(pages))
    schema = raw.schema

    def transform(df):
        return S.create_samples(df).select("page_id", "key", "shard")

    raw.where(F.col("page_id") % 2 == 0).write.parquet(f"{src}/part=a")
    INC.incremental_ingest(spark, src, schema, sink, ck, transform)
    INC.incremental_ingest(spark, src, schema, sink, ck, transform)   # nothing new: no batch
    raw.where(F.col("page_id") % 2 == 1).write.parquet(f"{src}/part=b")
    INC.incremental_ingest(spark, src, schema, sink, ck, transform)
    return INC.read_ingested(spark, sink, T.StructType([T.StructField("page_id", T.LongType()),
                                                        T.StructField("key", T.StringType()),
                                                        T.StructField("shard", T.StringType())])) \
        .select("page_id", "key", "shard")


@register("ingest_once", ["coerced"], "SELECT page_id, key, shard FROM coerced")
def q_ingest_once(spark, sf):
    """Three deliveries over three runs, each holding rows of the one before: every row comes out once."""
    src, sink, ck = (W.scratch_path(spark, n) for n in ("r2-in", "r2-out", "r2-ck"))
    raw = _meta_cols(FX.raw_samples(_pages(spark, sf)))
    for name, rows in (("a", raw.where("page_id % 3 < 2")), ("b", raw.where("page_id % 3 > 0")), ("c", raw)):
        rows.write.parquet(f"{src}/part={name}")
        INC.incremental_ingest(spark, src, raw.schema, sink, ck, lambda df: S.create_samples(df).select("page_id", "key", "shard"), once_by=["page_id"])
    return INC.read_ingested(spark, sink, T.StructType([T.StructField("page_id", T.LongType()), T.StructField("key", T.StringType()),
                                                        T.StructField("shard", T.StringType())])).select("page_id", "key", "shard")


# ---------------------------------------------------------------- jobs
@register("job_fetch", ["resolved", "samples"], """
SELECT 'stored' AS kind, shard, object_key FROM resolved WHERE found AND length(data) > 0
UNION ALL SELECT 'error' AS kind, shard, object_key FROM resolved WHERE NOT (found AND length(data) > 0)
UNION ALL SELECT DISTINCT 'ledger' AS kind, shard, NULL AS object_key FROM samples""")
def q_job_fetch(spark, sf):
    """Fetched twice: from a store without any payload, then, with an explicit
    list of all shards, from the real one. No key may be in two states."""
    pages = _pages(spark, sf)
    out = W.scratch_path(spark, "g2")
    s, store = FX.samples(pages).drop("payload"), FX.store(pages)
    J.job_fetch(spark, s, store.withColumn("data", F.lit("")), out)
    J.job_fetch(spark, s, store, out, shards=[r.shard for r in SH.present_shards(s).collect()])  # at most 4,096 names
    f = J.read_fetched(spark, out).select(F.col("status").alias("kind"), "shard", "object_key")
    led = SH.read_ledger(spark, f"{out}/ledger").select(F.lit("ledger").alias("kind"), "shard",
                                                        F.lit(None).cast("string").alias("object_key"))
    return f.unionByName(led)


@register("job_repair", ["archive", "repaired", "errkeys"], """
WITH ex AS (SELECT shard, name AS object_key FROM archive WHERE data NOT IN ('dup', 'tie')),
rep AS (SELECT DISTINCT r.shard, r.object_key FROM repaired r WHERE r.found AND length(r.data) > 0
        AND NOT EXISTS (SELECT 1 FROM ex WHERE ex.shard = r.shard AND ex.object_key = r.object_key)),
blobs AS (SELECT shard, object_key FROM ex UNION ALL SELECT shard, object_key FROM rep)
SELECT 'blob' AS kind, shard, object_key FROM blobs
UNION ALL
SELECT 'error' AS kind, e.shard, e.object_key FROM errkeys e
WHERE NOT EXISTS (SELECT 1 FROM blobs b WHERE b.shard = e.shard AND b.object_key = e.object_key)""")
def q_job_repair(spark, sf):
    """The store also holds an empty object for every path it lacks: empty
    payloads are not repaired and stay in the log. Run twice: the second run
    has nothing to add."""
    pages = _pages(spark, sf)
    blobs, errors = W.scratch_path(spark, "g3-blobs"), W.scratch_path(spark, "g3-err")
    _existing_blobs(pages).write.partitionBy("shard").parquet(blobs)
    FX.err_log(pages).write.partitionBy("shard").parquet(errors)
    s = FX.samples(pages).select("page_id", "key", "shard", "marker", "ext")
    store = FX.store(pages)
    lacking = FX.candidates(pages).where("page_id % 4 = 1").select("object_key").distinct() \
        .join(store.select("object_key"), "object_key", "left_anti").withColumn("data", F.lit(""))
    store = store.unionByName(lacking)
    new_log = J.job_repair(spark, s, store, blobs, errors)
    new_log = J.job_repair(spark, s, store, blobs, new_log)
    b = spark.read.schema(BLOB_SCHEMA).parquet(blobs).select(F.lit("blob").alias("kind"), "shard", "object_key")
    e = spark.read.schema(KEY_SCHEMA).parquet(new_log).select(F.lit("error").alias("kind"), "shard", "object_key")
    return b.unionByName(e)


def _geometry(df):
    """Stand-in for the caller's header decoder: sizes and two gray rows from the byte count."""
    n = F.octet_length(F.coalesce(F.col("data"), F.lit("")))
    rows = F.array(F.array((n % 251).cast("double"), (n % 7).cast("double")), F.array((n * 3 % 251).cast("double"), (n % 7).cast("double")))
    return df.withColumn("w", 1 + n % 1200).withColumn("h", 1 + (n * 7) % 900).withColumn("gray", rows)


@register("job_convert", ["samples", "members", "first_members", "ledger"], """
WITH j AS (SELECT s.page_id, s.key, s.shard, s.marker, m.data, strlen(m.data) AS n, s.page_id % 9 = 0 AS already,
        1 + strlen(m.data) % 1200 AS w, 1 + (strlen(m.data) * 7) % 900 AS h
      FROM samples s JOIN first_members f ON f.shard = s.shard AND f.key = s.key
      JOIN members m ON m.shard = f.shard AND m.key = f.key AND m.ord = f.f.o AND m.name = f.f.n
      WHERE s.shard NOT IN (SELECT shard FROM ledger) AND s.ext <> 'png'),
g AS (SELECT *, (marker = 0 AND w * h > 93750.0 AND NOT already) AS r FROM j
      WHERE NOT (marker = 0 AND n < 20000 AND 0.95 * ((n % 251 - n * 3 % 251) / 2.0) ** 2 < 50))
SELECT page_id, key, shard, r AS recompress,
  CASE WHEN r AND w * h > 281250.0 THEN CAST(round_even(CAST(500 AS DOUBLE) / greatest(w, h) * w, 0) AS BIGINT) ELSE w END AS new_w,
  CASE WHEN r AND w * h > 281250.0 THEN CAST(round_even(CAST(500 AS DOUBLE) / greatest(w, h) * h, 0) AS BIGINT) ELSE h END AS new_h,
  CASE WHEN r THEN '422' END AS subsampling,
  CASE WHEN marker = 0 THEN data END AS image, CASE WHEN marker <> 0 THEN data END AS video
FROM g""")
def q_job_convert(spark, sf):
    pages = _pages(spark, sf)
    out = W.scratch_path(spark, "g4")
    s = FX.samples(pages).select("page_id", "key", "shard", "marker", "ext", F.col("page_id").alias("src_order"),
                                 (F.col("page_id") % 9 == 0).alias("already"))
    J.job_convert(spark, s, FX.archive(pages), out, finished=SH.scan_ledger(FX.ledger(pages)),
                  geometry=_geometry, kinds=("images", "videos"), predicate="ext <> 'png'", already="already", pixels="gray")
    schema = ("page_id bigint, key string, recompress boolean, new_w bigint, new_h bigint, subsampling string, "
              "image string, video string, shard string")
    back = spark.read.schema(schema).parquet(f"{out}/samples")
    return back.select("page_id", "key", "shard", "recompress", "new_w", "new_h", "subsampling", "image", "video")


@register("job_prefix_release", ["features"], """
WITH p AS (SELECT substr(lpad(lower(hex(i)), 3, '0'), 2) AS prefix FROM range(0, 256) t(i)),
c AS (SELECT substr(key, 1, 2) AS prefix, count(*) AS n FROM features GROUP BY 1)
SELECT p.prefix, concat(p.prefix, '0') AS "start", concat(p.prefix, 'f') AS "end",
  COALESCE(c.n, 0) AS n_features,
  concat('{"title":"corpus-', p.prefix, '","id":"owner/corpus-', p.prefix, '","licenses":[{"name":"CC0-1.0"}]}')
    AS manifest
FROM p LEFT JOIN c ON c.prefix = p.prefix""")
def q_job_prefix_release(spark, sf):
    """Released in two ranges, the second one twice: the first range stays, and
    no key is stored twice."""
    out = W.scratch_path(spark, "g5")
    v = _vectors(spark, sf)
    J.job_prefix_release(spark, v, out, "00", "7f", _scorer(), SCORER_IN)
    J.job_prefix_release(spark, v, out, "80", "ff", _scorer(), SCORER_IN)
    return J.job_prefix_release(spark, v, out, "00", "ff", _scorer(), SCORER_IN)
