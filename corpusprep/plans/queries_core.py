"""Checked queries, part 1: keys, samples, shards, resolve/audit/repair,
windows, sorts and set operations (SURVEY §2.1-§2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions import keys as K
from corpusprep.functions import policy as P
from corpusprep.operators import bucketed as B
from corpusprep.operators import media as M
from corpusprep.operators import resolve as R
from corpusprep.operators import samples as S
from corpusprep.operators import shards as SH
from corpusprep.operators.windows import row_number_within
from corpusprep.plans import fixtures as FX
from corpusprep.plans.catalog import register
from corpusprep.sinks.writers import scratch_path
from corpusprep.sources import tables as TB

DOMAIN_SQL = "(SELECT lpad(lower(hex(i)), 3, '0') AS shard FROM range(4096) t(i))"


def _pages(spark, sf):
    return FX.table(spark, sf, "pages")


def _samples(spark, sf):
    return FX.samples(_pages(spark, sf))


def _coerced(spark, sf):
    return S.create_samples(FX.raw_samples(_pages(spark, sf)))


def _resolve_input(spark, sf):
    return _samples(spark, sf).select("page_id", "key", "shard", "marker", "ext")


def _bench_shards(spark, sf):
    return FX.bench_keys(FX.table(spark, sf, "lineitem")).withColumn("shard", K.derive_shard("key"))


# ---------------------------------------------------------------- flagship
@register("corpus_flagship", ["coerced"], """
SELECT substr(key, 1, 1) AS prefix, count(*) AS n_rows, count(DISTINCT shard) AS n_shards,
  count(CASE WHEN marker = 0 THEN 1 END) AS n_images,
  count(CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN 1 END) AS n_geo
FROM coerced GROUP BY 1""")
def q_corpus_flagship(spark, sf):
    return SH.corpus_flagship(_coerced(spark, sf))


# ---------------------------------------------------------------- sources
@register("scan_samples", ["raw_samples"], "SELECT * FROM raw_samples")
def q_scan_samples(spark, sf):
    return FX.raw_samples(TB.scan_table(spark, f"{sf}/pages.parquet"))


_RAW_COLS = ["page_id", "downloadurl", "longitude", "latitude", "accuracy", "marker", "ext", "payload"]


@register("describe_columns", ["raw_samples"], "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS name, count({c}) AS n_non_null FROM raw_samples"
    for i, c in enumerate(_RAW_COLS)))
def q_describe_columns(spark, sf):
    raw = FX.raw_samples(_pages(spark, sf))
    schema = TB.describe_columns(raw).select("position", "name")       # from the schema alone
    counts = TB.profile_columns(raw).select("position", "n_non_null")  # one pass over the table
    return schema.join(counts, "position").select("position", "name", "n_non_null")


@register("list_meta_shards", ["samples"], f"""
SELECT DISTINCT shard FROM samples WHERE shard IN {DOMAIN_SQL}""")
def q_list_meta_shards(spark, sf):
    return SH.present_shards(_samples(spark, sf))


@register("list_output_shards", ["archive"], f"""
SELECT DISTINCT shard FROM archive WHERE shard IN {DOMAIN_SQL}""")
def q_list_output_shards(spark, sf):
    return SH.present_shards(FX.archive(_pages(spark, sf)))


@register("scan_error_log", ["err_log"], """
SELECT shard, trim(line) AS object_key FROM err_log WHERE trim(line) <> ''""")
def q_scan_error_log(spark, sf):
    return R.scan_error_lines(FX.err_log(_pages(spark, sf)))


@register("scan_ledger", ["ledger"], """
SELECT DISTINCT trim(shard) AS shard FROM ledger WHERE trim(shard) <> ''""")
def q_scan_ledger(spark, sf):
    return SH.scan_ledger(FX.ledger(_pages(spark, sf)))


# ---------------------------------------------------------------- projections
@register("derive_key", ["raw_samples"], """
SELECT page_id, downloadurl, @key(downloadurl) AS key,
  CAST(length(@key(downloadurl)) AS BIGINT) AS key_len
FROM raw_samples""")
def q_derive_key(spark, sf):
    r = FX.raw_samples(_pages(spark, sf))
    return r.select("page_id", "downloadurl", K.derive_key("downloadurl").alias("key")) \
        .withColumn("key_len", F.length("key").cast("bigint"))


@register("derive_shard", ["samples"], "SELECT page_id, key, substr(key, 1, 3) AS shard FROM samples")
def q_derive_shard(spark, sf):
    return _samples(spark, sf).select("page_id", "key", K.derive_shard("key").alias("shard"))


@register("create_samples", ["coerced"], """
SELECT page_id, downloadurl, longitude, latitude, accuracy, marker, ext, key, shard FROM coerced""")
def q_create_samples(spark, sf):
    return _coerced(spark, sf).drop("payload")


@register("coerce_float", ["raw_samples"], """
SELECT page_id,
  CASE WHEN longitude IS NULL OR longitude = '' THEN NULL ELSE CAST(longitude AS DOUBLE) END AS lon,
  CASE WHEN latitude IS NULL OR latitude = 0 THEN NULL ELSE latitude END AS lat,
  CASE WHEN accuracy IS NULL OR accuracy = 0 THEN NULL ELSE CAST(accuracy AS DOUBLE) END AS acc
FROM raw_samples""")
def q_coerce_float(spark, sf):
    r = FX.raw_samples(_pages(spark, sf))
    t = {f.name: f.dataType for f in r.schema.fields}
    return r.select("page_id", P.coerce_float("longitude", t["longitude"]).alias("lon"),
                    P.coerce_float("latitude", t["latitude"]).alias("lat"),
                    P.coerce_float("accuracy", t["accuracy"]).alias("acc"))


@register("coerce_int", ["raw_samples"], """
SELECT page_id,
  CASE WHEN accuracy IS NULL OR accuracy = 0 THEN NULL ELSE accuracy END AS acc,
  CASE WHEN longitude IS NULL OR longitude = '' THEN NULL ELSE CAST(longitude AS BIGINT) END AS lon,
  CASE WHEN latitude IS NULL OR latitude = 0 THEN NULL ELSE CAST(trunc(latitude) AS BIGINT) END AS lat
FROM raw_samples""")
def q_coerce_int(spark, sf):
    r = FX.raw_samples(_pages(spark, sf))
    t = {f.name: f.dataType for f in r.schema.fields}
    return r.select("page_id", P.coerce_int("accuracy", t["accuracy"]).alias("acc"),
                    P.coerce_int("longitude", t["longitude"]).alias("lon"),
                    P.coerce_int("latitude", t["latitude"]).alias("lat"))


@register("filter_kind", ["samples"], "SELECT page_id, key, marker FROM samples WHERE marker IN (0)")
def q_filter_kind(spark, sf):
    return S.filter_kind(_samples(spark, sf), kinds=("images",)).select("page_id", "key", "marker")


@register("filter_user", ["coerced"], """
SELECT page_id, key FROM coerced WHERE accuracy > 5 AND ext = 'jpg'""")
def q_filter_user(spark, sf):
    return S.filter_user(_coerced(spark, sf), "accuracy > 5 AND ext = 'jpg'").select("page_id", "key")


@register("prepare_metadata", ["samples"], """
SELECT page_id, key, shard, marker FROM samples WHERE marker IN (0, 1) AND ext <> 'png'""")
def q_prepare_metadata(spark, sf):
    return S.prepare_metadata(_samples(spark, sf), kinds=("images", "videos"),
                              predicate="ext <> 'png'").select("page_id", "key", "shard", "marker")


@register("candidate_keys", ["candidates"], """
SELECT page_id, key, ord, canonical, object_key FROM candidates""")
def q_candidate_keys(spark, sf):
    return R.candidate_keys(_resolve_input(spark, sf)).select("page_id", "key", "ord", "canonical",
                                                               "object_key")


@register("split_success_failure", ["resolved"], """
SELECT page_id, object_key,
  CASE WHEN data IS NOT NULL AND length(data) > 0 THEN 'stored' ELSE 'error' END AS status
FROM resolved""")
def q_split_success_failure(spark, sf):
    pages = _pages(spark, sf)
    res = R.resolve_objects(_resolve_input(spark, sf), FX.store(pages))
    return R.split_success_failure(res).select("page_id", "object_key", "status")


@register("filter_shard_range", ["samples"], """
SELECT page_id, shard FROM samples WHERE shard BETWEEN '3a0' AND 'c3f'""")
def q_filter_shard_range(spark, sf):
    return _samples(spark, sf).where(K.in_hex_range("shard", "3A0", "c3f")).select("page_id", "shard")


@register("attach_payload", ["samples"], """
SELECT page_id, CASE WHEN marker = 0 THEN payload END AS image,
  CASE WHEN marker <> 0 THEN payload END AS video FROM samples""")
def q_attach_payload(spark, sf):
    s = _samples(spark, sf).select("page_id", "marker", F.col("payload").alias("data"))
    return M.attach_payload(s).select("page_id", "image", "video")


@register("member_key", ["archive"], """
SELECT shard, ord, name,
  CASE WHEN regexp_matches(rbase, '^.+[.][^.]+$') THEN regexp_extract(rbase, '^(.+)[.][^.]+$', 1)
       ELSE rbase END AS stem_last,
  split_part(base, '.', 1) AS stem_first
FROM (SELECT shard, ord, name, regexp_extract(name, '([^/]*)$', 1) AS base,
        regexp_extract(regexp_replace(name, '/+$', ''), '([^/]*)$', 1) AS rbase FROM
      (SELECT shard, ord, CASE WHEN ord >= 1000 THEN concat(name, '.bak') ELSE name END AS name FROM archive) a) b""")
def q_member_key(spark, sf):
    a = FX.archive(_pages(spark, sf))
    a = a.withColumn("name", F.when(F.col("ord") >= 1000, F.concat("name", F.lit(".bak"))).otherwise(F.col("name")))
    return a.select("shard", "ord", "name", K.stem_last_suffix("name").alias("stem_last"),
                    K.stem_first_dot("name").alias("stem_first"))


@register("archive_shard", ["samples"], """
SELECT DISTINCT concat('/store/out/', shard, '.zip') AS archive_path, shard AS shard_of_archive,
  concat(shard, '.err') AS err_file, concat(shard, '.zip') AS archive_of_err
FROM samples""")
def q_archive_shard(spark, sf):
    s = SH.present_shards(_samples(spark, sf))
    zp = F.concat(F.lit("/store/out/"), F.col("shard"), F.lit(".zip"))
    err = F.concat(F.col("shard"), F.lit(".err"))
    out = s.select(zp.alias("archive_path"), err.alias("err_file"))
    return out.select("archive_path", K.file_shard("archive_path").alias("shard_of_archive"), "err_file",
                      F.concat(K.file_shard("err_file"), F.lit(".zip")).alias("archive_of_err"))


@register("kind_code", ["samples"], """
SELECT page_id, CASE WHEN marker = 0 THEN 'images' ELSE 'videos' END AS kind, marker AS code FROM samples""")
def q_kind_code(spark, sf):
    s = _samples(spark, sf).select("page_id", F.when(F.col("marker") == 0, F.lit("images"))
                                   .otherwise(F.lit("videos")).alias("kind"))
    return s.select("page_id", "kind", K.kind_code("kind").alias("code"))


# ---------------------------------------------------------------- joins
@register("resolve_objects", ["resolved"], """
SELECT page_id, key, object_key, found, data FROM resolved""")
def q_resolve_objects(spark, sf):
    pages = _pages(spark, sf)
    return R.resolve_objects(_resolve_input(spark, sf), FX.store(pages)) \
        .select("page_id", "key", "object_key", "found", "data")


@register("object_exists", ["resolved"], "SELECT page_id, key, found AS \"exists\" FROM resolved")
def q_object_exists(spark, sf):
    pages = _pages(spark, sf)
    return R.object_exists(_resolve_input(spark, sf), FX.store(pages)).select("page_id", "key", "exists")


@register("find_missing", ["missing"], "SELECT page_id, key, shard FROM missing")
def q_find_missing(spark, sf):
    pages = _pages(spark, sf)
    return R.find_missing(_resolve_input(spark, sf), FX.archive(pages), FX.store(pages)) \
        .select("page_id", "key", "shard")


@register("audit_shards", ["missing", "resolved", "archive"], """
SELECT r.shard, r.object_key, r.data FROM resolved r
JOIN missing m ON m.page_id = r.page_id
WHERE r.shard IN (SELECT shard FROM archive) AND r.found AND length(r.data) > 0""")
def q_audit_shards(spark, sf):
    pages = _pages(spark, sf)
    return R.audit_shards(_resolve_input(spark, sf), FX.archive(pages), FX.store(pages)) \
        .select("shard", "object_key", "data")


@register("error_keys", ["errkeys"], "SELECT shard, object_key FROM errkeys")
def q_error_keys(spark, sf):
    pages = _pages(spark, sf)
    return R.error_keys(FX.err_log(pages), FX.archive(pages))


@register("distinct_errors", ["errkeys"], "SELECT DISTINCT object_key FROM errkeys")
def q_distinct_errors(spark, sf):
    pages = _pages(spark, sf)
    return R.distinct_errors(FX.err_log(pages), FX.archive(pages))


@register("error_stats", ["err_log", "archive"], """
WITH l AS (SELECT shard, trim(line) AS object_key FROM err_log WHERE trim(line) <> ''),
m AS (SELECT DISTINCT shard, name FROM archive)
SELECT count(*) AS n_lines, count(m.name) AS n_stale,
  count(DISTINCT CASE WHEN m.name IS NULL THEN l.object_key END) AS n_errors
FROM l LEFT JOIN m ON m.shard = l.shard AND m.name = l.object_key""")
def q_error_stats(spark, sf):
    pages = _pages(spark, sf)
    return R.error_stats(FX.err_log(pages), FX.archive(pages))


# the same joins over tables written once, bucketed by key (repeated audits)
def _buckets(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@register("audit_bucketed", ["missing", "resolved", "archive"], """
SELECT DISTINCT r.shard, r.object_key, r.data FROM resolved r
JOIN missing m ON m.page_id = r.page_id
WHERE r.shard IN (SELECT shard FROM archive) AND r.found AND length(r.data) > 0""")
def q_audit_bucketed(spark, sf):
    pages, n = _pages(spark, sf), _buckets(spark)
    meta = B.write_metadata(_resolve_input(spark, sf), scratch_path(spark, "b-meta"), n)
    members = B.write_members(FX.archive(pages), scratch_path(spark, "b-members"), n)
    store = B.write_store(FX.store(pages), scratch_path(spark, "b-store"), n)
    return B.fetch_bucketed(B.missing_bucketed(meta, members, store), store)


@register("resolve_bucketed", ["resolved", "samples"], """
SELECT r.key, s.marker, s.ext, count(*) AS n, r.object_key, r.found
FROM resolved r JOIN samples s ON s.page_id = r.page_id GROUP BY ALL""")
def q_resolve_bucketed(spark, sf):
    n = _buckets(spark)
    meta = B.write_metadata(_resolve_input(spark, sf), scratch_path(spark, "b-meta"), n)
    return B.resolve_bucketed(meta, B.write_store(FX.store(_pages(spark, sf)), scratch_path(spark, "b-store"), n))


@register("errors_bucketed", ["errkeys"], "SELECT shard, object_key FROM errkeys")
def q_errors_bucketed(spark, sf):
    pages = _pages(spark, sf)
    members = B.write_members(FX.archive(pages), scratch_path(spark, "b-members"), _buckets(spark))
    return B.errors_bucketed(FX.err_log(pages), members)


@register("join_bucketed", ["samples", "members", "first_members"], """
SELECT s.page_id, s.key, m.name AS member, m.data
FROM samples s JOIN first_members f ON f.shard = s.shard AND f.key = s.key
JOIN members m ON m.shard = f.shard AND m.key = f.key AND m.ord = f.f.o AND m.name = f.f.n""")
def q_join_bucketed(spark, sf):
    meta = _samples(spark, sf).select("page_id", "key", "shard", "marker", F.col("page_id").alias("src_order"))
    first, hot = B.write_first_members(FX.archive(_pages(spark, sf)), scratch_path(spark, "b-first"), _buckets(spark))
    return B.join_first_members(meta, first, hot).select("page_id", "key", "member", "data")


@register("repair_candidates", ["repaired"], "SELECT page_id, object_key, found FROM repaired")
def q_repair_candidates(spark, sf):
    pages = _pages(spark, sf)
    errs = R.error_keys(FX.err_log(pages), FX.archive(pages))
    return R.repair_candidates(_resolve_input(spark, sf), FX.store(pages), errs) \
        .select("page_id", "object_key", "found")


@register("join_metadata_blobs", ["samples", "members", "first_members"], """
SELECT s.page_id, s.key, m.name AS member, m.data
FROM samples s JOIN first_members f ON f.shard = s.shard AND f.key = s.key
JOIN members m ON m.shard = f.shard AND m.key = f.key AND m.ord = f.f.o AND m.name = f.f.n""")
def q_join_metadata_blobs(spark, sf):
    pages = _pages(spark, sf)
    meta = _samples(spark, sf).select("page_id", "key", "shard", "marker",
                                      F.col("page_id").alias("src_order"))
    return M.join_metadata_blobs(meta, FX.archive(pages)).select("page_id", "key", "member", "data")


@register("locate_member", ["samples", "archive"], """
WITH idx AS (SELECT split_part(regexp_extract(name, '([^/]*)$', 1), '.', 1) AS k, max(shard) AS archive
             FROM archive GROUP BY 1)
SELECT s.page_id, s.key, idx.archive FROM samples s LEFT JOIN idx ON idx.k = s.key""")
def q_locate_member(spark, sf):
    pages = _pages(spark, sf)
    idx = M.archive_index(FX.archive(pages))
    return M.locate_member(_samples(spark, sf).select("page_id", "key"), idx)


# ---------------------------------------------------------------- aggregations
@register("bucket_by_shard", ["bench_keys"], """
SELECT substr(key, 1, 3) AS shard, count(*) AS n_rows FROM bench_keys GROUP BY 1""")
def q_bucket_by_shard(spark, sf):
    return SH.bucket_by_shard(_bench_shards(spark, sf))


@register("validate_row_count", ["samples"], """
SELECT count(*) AS n_rows, (SELECT count(*) FROM pages) AS expected,
  count(*) = (SELECT count(*) FROM pages) AS ok FROM samples""")
def q_validate_row_count(spark, sf):
    expected = _pages(spark, sf).select(F.count(F.lit(1))).scalar()
    return S.validate_row_count(_samples(spark, sf), expected)


@register("keys_per_archive", ["archive"], """
SELECT shard AS archive, name AS member, row_number() OVER (PARTITION BY shard ORDER BY name) AS pos FROM archive""")
def q_keys_per_archive(spark, sf):
    return M.keys_per_archive(M.archive_index(FX.archive(_pages(spark, sf))))


_DEDUPE_IN = """
WITH u AS (SELECT key, page_id AS src, ext FROM samples
           UNION ALL SELECT key, page_id + 1000000 AS src, 'dup' AS ext FROM samples WHERE page_id % 5 = 0)"""


def _dedupe_input(spark, sf):
    s = _samples(spark, sf)
    a = s.select("key", F.col("page_id").alias("src"), "ext")
    b = s.where(F.col("page_id") % 5 == 0).select("key", (F.col("page_id") + 1000000).alias("src"),
                                                   F.lit("dup").alias("ext"))
    return a.unionByName(b)


@register("dedupe_metadata", ["samples"], _DEDUPE_IN + """
SELECT key, max(src) AS src, arg_max(ext, src) AS ext FROM u GROUP BY key""")
def q_dedupe_metadata(spark, sf):
    return S.dedupe_last(_dedupe_input(spark, sf), "key", "src")


_MEMBER_INDEX = """
WITH ix AS (SELECT name AS member, shard AS archive FROM archive
            UNION ALL SELECT name AS member, concat(shard, '-b') AS archive FROM archive WHERE shard < '4')"""


def _member_index(spark, sf):
    idx = M.archive_index(FX.archive(_pages(spark, sf)))
    extra = idx.where(F.col("archive") < "4").withColumn("archive", F.concat("archive", F.lit("-b")))
    return idx.unionByName(extra)


@register("dedupe_members", ["archive"], _MEMBER_INDEX + """
SELECT member, max(archive) AS archive FROM ix GROUP BY member""")
def q_dedupe_members(spark, sf):
    return M.dedupe_members(_member_index(spark, sf))


@register("shard_progress", ["samples", "ledger"], """
WITH p AS (SELECT DISTINCT shard FROM samples), f AS (SELECT DISTINCT shard FROM ledger),
pend AS (SELECT shard FROM p WHERE shard NOT IN (SELECT shard FROM f))
SELECT (SELECT count(*) FROM p) AS n_present, (SELECT count(*) FROM f) AS n_finished,
  (SELECT count(*) FROM pend) AS n_pending, (SELECT min(shard) FROM f) AS first_finished,
  (SELECT max(shard) FROM f) AS last_finished, (SELECT min(shard) FROM pend) AS first_pending,
  (SELECT max(shard) FROM pend) AS last_pending""")
def q_shard_progress(spark, sf):
    pages = _pages(spark, sf)
    return SH.shard_progress(SH.present_shards(FX.samples(pages)), SH.scan_ledger(FX.ledger(pages)))


@register("shard_sizes", ["archive", "samples"], """
WITH a AS (SELECT shard, count(*) AS n FROM archive GROUP BY shard),
s AS (SELECT shard, count(*) AS n FROM samples GROUP BY shard)
SELECT COALESCE(a.shard, s.shard) AS shard, COALESCE(a.n, 0) AS n_members, COALESCE(s.n, 0) AS n_samples
FROM a FULL OUTER JOIN s ON a.shard = s.shard""")
def q_shard_sizes(spark, sf):
    pages = _pages(spark, sf)
    return SH.shard_sizes(FX.archive(pages), FX.samples(pages))


# ---------------------------------------------------------------- windows
@register("assign_devices", ["samples"], """
WITH s AS (SELECT DISTINCT shard FROM samples),
r AS (SELECT shard, row_number() OVER (ORDER BY shard) AS rn, count(*) OVER () AS total FROM s)
SELECT shard, CAST(least((rn - 1) // greatest(total // 4, 1), 3) AS BIGINT) AS device FROM r""")
def q_assign_devices(spark, sf):
    return SH.assign_devices(SH.present_shards(_samples(spark, sf)), 4)


@register("assign_batches", ["bench_keys"], """
SELECT key, shard, rn, (rn - 1) // 64 AS batch FROM (
  SELECT key, substr(key, 1, 3) AS shard,
    row_number() OVER (PARTITION BY substr(key, 1, 3) ORDER BY key) AS rn FROM bench_keys) b""")
def q_assign_batches(spark, sf):
    out = row_number_within(_bench_shards(spark, sf), ["shard"], ["key"])
    return out.withColumn("batch", F.floor((F.col("rn") - 1) / 64).cast("bigint"))


_CHUNK_SQL = """
SELECT key, src, rn, (rn - 1) // 100 AS chunk FROM (
  SELECT key, src, row_number() OVER (PARTITION BY substr(key, 1, 3) ORDER BY src, key) AS rn FROM (
    SELECT @key(concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-',
      CAST(l_partkey AS STRING))) AS key, l_orderkey * 8 + l_linenumber AS src FROM lineitem) a) b"""


@register("assign_chunks", [], _CHUNK_SQL)
def q_assign_chunks(spark, sf):
    li = FX.table(spark, sf, "lineitem")
    rk = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"),
                  F.lit("-"), F.col("l_partkey").cast("string"))
    rows = li.select(K.derive_key(rk).alias("key"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("src"))
    rows = rows.withColumn("shard", K.derive_shard("key"))
    out = row_number_within(rows, ["shard"], ["src", "key"])
    return out.select("key", "src", "rn", F.floor((F.col("rn") - 1) / 100).cast("bigint").alias("chunk"))


@register("first_match", ["members", "first_members"], """
SELECT m.shard, m.key, m.name, m.ord, m.data FROM members m
JOIN first_members f ON f.shard = m.shard AND f.key = m.key AND f.f.o = m.ord AND f.f.n = m.name""")
def q_first_match(spark, sf):
    members = M.member_keys(FX.archive(_pages(spark, sf)))
    return M.first_members(members).select("shard", "key", "name", "ord", "data")


# ---------------------------------------------------------------- sorts / sets
@register("sort_by_key", ["samples"], """
SELECT page_id, shard, key, row_number() OVER (PARTITION BY shard ORDER BY key) AS rn FROM samples""")
def q_sort_by_key(spark, sf):
    s = _samples(spark, sf).select("page_id", "shard", "key")
    return S.sort_by_key(s, position="rn")


@register("sorted_shards", ["samples"], """
SELECT shard, row_number() OVER (ORDER BY shard) AS pos FROM (SELECT DISTINCT shard FROM samples) s""")
def q_sorted_shards(spark, sf):
    out = SH.sorted_positions(SH.present_shards(_samples(spark, sf)), ["shard"])
    return out.withColumn("pos", F.col("pos").cast("bigint"))


@register("sorted_images", ["archive"], """
SELECT shard, name, ord, row_number() OVER (ORDER BY name, ord) AS pos FROM archive""")
def q_sorted_images(spark, sf):
    a = FX.archive(_pages(spark, sf)).select("shard", "name", "ord")
    return row_number_within(a, [], ["name", "ord"], name="pos")


@register("select_shards", ["samples", "ledger"], """
SELECT DISTINCT shard FROM samples WHERE shard BETWEEN '100' AND 'dff'
  AND shard NOT IN (SELECT shard FROM ledger)""")
def q_select_shards(spark, sf):
    pages = _pages(spark, sf)
    return SH.select_shards(SH.present_shards(FX.samples(pages)), SH.scan_ledger(FX.ledger(pages)),
                            "100", "dff")


@register("convertible_shards", ["samples", "archive", "ledger"], """
SELECT DISTINCT shard FROM samples WHERE shard IN (SELECT shard FROM archive)
  AND shard NOT IN (SELECT shard FROM ledger)""")
def q_convertible_shards(spark, sf):
    pages = _pages(spark, sf)
    return SH.convertible_shards(SH.present_shards(FX.samples(pages)), FX.archive(pages),
                                 SH.scan_ledger(FX.ledger(pages)))


@register("repair_shards", ["samples"], """
SELECT DISTINCT shard FROM samples WHERE shard BETWEEN '3a0' AND 'c3f'""")
def q_repair_shards(spark, sf):
    return SH.repair_shards(SH.present_shards(_samples(spark, sf)), "3a0", "c3f")


@register("archives_in_range", ["archive"], """
SELECT DISTINCT concat(shard, '.zip') AS archive_file, shard FROM archive WHERE shard BETWEEN '100' AND '7ff'""")
def q_archives_in_range(spark, sf):
    files = FX.archive(_pages(spark, sf)).select(F.concat("shard", F.lit(".zip")).alias("archive_file"))
    return SH.archives_in_range(files, "100", "7ff")


@register("union_index", ["archive"], "SELECT DISTINCT name AS member, shard AS archive FROM archive")
def q_union_index(spark, sf):
    a = FX.archive(_pages(spark, sf))
    # two sets of archives read apart: the later repeats, and all of them
    return M.union_index(M.archive_index(a.where(F.col("ord") >= 1000)), M.archive_index(a))


@register("prefix_coverage", ["samples"], """
WITH pre AS (SELECT CAST(i AS VARCHAR) AS prefix FROM range(5) t(i)
             UNION ALL SELECT lower(hex(i)) FROM range(80, 224) t(i)
             UNION ALL SELECT 'e' UNION ALL SELECT 'f'),
s AS (SELECT DISTINCT shard FROM samples)
SELECT s.shard, max(pre.prefix) AS prefix, count(pre.prefix) AS n_cover
FROM s LEFT JOIN pre ON pre.prefix = substr(s.shard, 1, 1) OR pre.prefix = substr(s.shard, 1, 2)
GROUP BY s.shard""")
def q_prefix_coverage(spark, sf):
    return SH.prefix_coverage(SH.present_shards(_samples(spark, sf)), SH.published_prefixes(spark))


# ---------------------------------------------------------------- scalar functions
@register("hex_range_table", ["bench_keys"], """
WITH r AS (SELECT lpad(lower(hex(i)), 3, '0') AS shard FROM range(240, 768) t(i)),
c AS (SELECT substr(key, 1, 3) AS shard, count(*) AS n FROM bench_keys GROUP BY 1)
SELECT r.shard, COALESCE(c.n, 0) AS n_samples FROM r LEFT JOIN c ON c.shard = r.shard""")
def q_hex_range_table(spark, sf):
    return SH.count_in_domain(K.hex_range(spark, "0f0", "2ff"), _bench_shards(spark, sf))


@register("hex_range_prefixes", ["bench_keys"], """
WITH p AS (SELECT substr(lpad(lower(hex(i)), 3, '0'), 2) AS prefix FROM range(82, 96) t(i)),
c AS (SELECT substr(key, 1, 2) AS prefix, count(*) AS n FROM bench_keys GROUP BY 1)
SELECT p.prefix, concat(p.prefix, '0') AS "start", concat(p.prefix, 'f') AS "end", COALESCE(c.n, 0) AS n_samples
FROM p LEFT JOIN c ON c.prefix = p.prefix""")
def q_hex_range_prefixes(spark, sf):
    b = _bench_shards(spark, sf).select(F.substring("shard", 1, 2).alias("prefix"))
    return SH.count_in_domain(SH.prefix_bounds(spark, "52", "5f"), b, on="prefix")


@register("shard_domain", ["bench_keys"], """
WITH d AS (SELECT lpad(lower(hex(i)), 3, '0') AS shard FROM range(4096) t(i)),
c AS (SELECT substr(key, 1, 3) AS shard, count(*) AS n FROM bench_keys GROUP BY 1)
SELECT d.shard, concat(d.shard, '.gz') AS meta_file, concat(d.shard, '.zip') AS archive_file,
  COALESCE(c.n, 0) AS n_samples FROM d LEFT JOIN c ON c.shard = d.shard""")
def q_shard_domain(spark, sf):
    return SH.count_in_domain(K.shard_domain(spark), _bench_shards(spark, sf))


@register("json_roundtrip", ["coerced"], """
SELECT page_id, key, longitude, latitude, accuracy, ext, accuracy IS NULL AS acc_null FROM coerced""")
def q_json_roundtrip(spark, sf):
    s = _coerced(spark, sf).select("page_id", "key", "longitude", "latitude", "accuracy", "ext")
    schema = s.schema
    js = s.select(F.to_json(F.struct(*s.columns), {"ignoreNullFields": "false"}).alias("j"))
    back = js.select(F.from_json("j", schema).alias("r"),
                     F.col("j").contains('"accuracy":null').alias("acc_null")).select("r.*", "acc_null")
    return back


@register("payload_bytes", ["samples"], """
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS n_bytes FROM samples""")
def q_payload_bytes(spark, sf):
    return _samples(spark, sf).select("page_id", F.octet_length("payload").cast("bigint").alias("n_bytes"))
