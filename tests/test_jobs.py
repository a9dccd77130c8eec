import json

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import features as FE
from corpusprep.operators import resolve as R
from corpusprep.operators import shards as SH
from corpusprep.plans import fixtures as FX
from corpusprep.plans import jobs as J

SF = "/root/testdata/sf0.001"


def _inputs(spark):
    pages = FX.table(spark, SF, "pages")
    return pages, FX.samples(pages).drop("payload"), FX.store(pages)


def _fetched(spark, out):
    return sorted(tuple(r) for r in J.read_fetched(spark, out).select("status", "shard", "object_key").collect())


def test_fetch_resume_equals_full_run(spark, tmp_dir):
    _, s, store = _inputs(spark)
    J.job_fetch(spark, s, store, f"{tmp_dir}/full")
    J.job_fetch(spark, s, store, f"{tmp_dir}/part", "000", "5ff")   # stopped half way
    J.job_fetch(spark, s, store, f"{tmp_dir}/part")                 # restart skips finished shards
    assert _fetched(spark, f"{tmp_dir}/full") == _fetched(spark, f"{tmp_dir}/part")
    # a third run finds nothing to do and changes nothing
    left = J.job_fetch(spark, s, store, f"{tmp_dir}/part")
    assert left.count() == 0
    assert _fetched(spark, f"{tmp_dir}/full") == _fetched(spark, f"{tmp_dir}/part")


def test_explicit_shards_rerun_is_idempotent(spark, tmp_dir):
    _, s, store = _inputs(spark)
    one = s.select("shard").first().shard
    J.job_fetch(spark, s, store, tmp_dir)
    before = _fetched(spark, tmp_dir)
    J.job_fetch(spark, s, store, tmp_dir, shards=[one])   # D11: explicit list overrides the ledger
    assert _fetched(spark, tmp_dir) == before


def test_fetch_stores_a_binary_object_once(spark, tmp_dir):
    _, s, store = _inputs(spark)
    raw = store.withColumn("data", F.unhex(F.lit("FF00D8FE")))
    J.job_fetch(spark, s.union(s).union(s), raw, tmp_dir)      # every sample three times
    blobs = J.read_blobs(spark, tmp_dir)
    assert dict(blobs.dtypes)["data"] == "binary"
    rows = blobs.collect()
    assert rows and len({r.object_key for r in rows}) == len(rows) and {bytes(r.data) for r in rows} == {b"\xff\x00\xd8\xfe"}
    fetched = J.read_fetched(spark, tmp_dir)
    assert fetched.count() == 3 * s.count()
    assert {r.object_key for r in rows} == {r.object_key for r in fetched.where("status = 'stored'").collect()}
    # fetched again from a store of empty objects: nothing counts as stored
    J.job_fetch(spark, s, raw.withColumn("data", F.unhex(F.lit(""))), tmp_dir, shards=[r.shard for r in s.select("shard").distinct().collect()])
    assert J.read_blobs(spark, tmp_dir).count() == 0 and {r[0] for r in _fetched(spark, tmp_dir)} == {"error"}


def test_refetch_with_another_store_leaves_one_state_per_key(spark, tmp_dir):
    _, s, store = _inputs(spark)
    J.job_fetch(spark, s, store.where("false"), tmp_dir)          # nothing stored yet: all errors
    assert {r[0] for r in _fetched(spark, tmp_dir)} == {"error"}
    J.job_fetch(spark, s, store, tmp_dir, shards=[r.shard for r in s.select("shard").distinct().collect()])
    rows = _fetched(spark, tmp_dir)
    assert len(rows) == s.count() and len({r[1:] for r in rows}) == len(rows)
    J.job_fetch(spark, s, store, f"{tmp_dir}/once")
    assert rows == _fetched(spark, f"{tmp_dir}/once")


def test_a_shard_that_arrives_during_the_fetch_is_not_marked_finished(spark, tmp_dir):
    """The ledger gets the work list that was read at the start."""
    _, s, store = _inputs(spark)
    path = f"{tmp_dir}/in"
    s.where("shard < '8'").write.parquet(path)
    live = spark.read.schema(s.schema).parquet(path)
    work = J.job_fetch(spark, live, store, f"{tmp_dir}/out")
    s.where("shard >= '8'").write.mode("append").parquet(path)
    done = {r.shard for r in SH.read_ledger(spark, f"{tmp_dir}/out/ledger").collect()}
    assert done == {r.shard for r in work.collect()} and max(done) < "8"


def test_empty_payloads_are_not_repaired(spark, tmp_dir):
    pages, s, store = _inputs(spark)
    blobs, errors = f"{tmp_dir}/blobs", f"{tmp_dir}/err"
    FX.archive(pages).where("data not in ('dup', 'tie')").select("shard", F.col("name").alias("object_key"), "data") \
        .write.partitionBy("shard").parquet(blobs)
    FX.err_log(pages).write.partitionBy("shard").parquet(errors)
    before = spark.read.parquet(blobs).count()
    real = R.error_keys(FX.err_log(pages), FX.archive(pages)).count()
    log = J.job_repair(spark, s, store.withColumn("data", F.lit("")), blobs, errors)
    assert spark.read.parquet(blobs).count() == before
    assert spark.read.parquet(log).count() == real


def test_jobs_leave_the_session_as_it_was(spark, tmp_dir):
    _, s, store = _inputs(spark)
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        J.job_fetch(spark, s, store, tmp_dir)
        assert spark.conf.get(key) == "true"
        assert sorted(r[1] for r in _fetched(spark, tmp_dir)) == sorted(r.shard for r in s.select("shard").collect())
    finally:
        spark.conf.set(key, was)


def test_jobs_take_no_python_filters(spark, tmp_dir):
    _, s, store = _inputs(spark)
    with pytest.raises(TypeError, match="SQL text or a Column"):
        J.job_fetch(spark, s, store, tmp_dir, predicate=lambda row: True)


def test_null_urls_go_to_the_reject_table(spark, tmp_dir):
    raw = FX.raw_samples(FX.table(spark, SF, "pages")).drop("payload")
    bad = raw.withColumn("downloadurl", F.when(F.col("page_id") % 3 != 0, F.col("downloadurl")))
    J.job_convert_metadata(bad, f"{tmp_dir}/m", f"{tmp_dir}/rejects")
    lost = spark.read.parquet(f"{tmp_dir}/rejects")
    kept = spark.read.schema("page_id bigint, shard string").json(f"{tmp_dir}/m")
    assert {r.page_id for r in lost.collect()} == {r.page_id for r in raw.where("page_id % 3 = 0").collect()}
    assert kept.count() + lost.count() == raw.count() and {r.reason for r in lost.collect()} == {"null downloadurl"}


def test_archive_missing_unavailable_partition_samples(spark):
    pages, s, store = _inputs(spark)
    archive = FX.archive(pages)
    cands = R.candidate_keys(s.select("page_id", "key", "shard", "marker", "ext"))
    in_archive = cands.join(archive.select("shard", F.col("name").alias("object_key")),
                            ["shard", "object_key"], "left_semi").select("page_id").distinct()
    missing = R.find_missing(s, archive, store).select("page_id")
    in_store = cands.join(store.select("object_key"), "object_key", "left_semi").select("page_id").distinct()
    unavailable = s.select("page_id").join(in_archive, "page_id", "left_anti") \
        .join(in_store, "page_id", "left_anti")
    a, m, u = (set(r.page_id for r in d.collect()) for d in (in_archive, missing, unavailable))
    assert not (a & m) and not (a & u) and not (m & u)
    assert len(a | m | u) == s.count()


def test_repair_twice_equals_once(spark, tmp_dir):
    pages, s, store = _inputs(spark)
    blobs, errors = f"{tmp_dir}/blobs", f"{tmp_dir}/err"
    FX.archive(pages).where("data not in ('dup', 'tie')").select("shard", F.col("name").alias("object_key"), "data") \
        .write.partitionBy("shard").parquet(blobs)
    FX.err_log(pages).write.partitionBy("shard").parquet(errors)
    log1 = J.job_repair(spark, s, store, blobs, errors)
    n1 = spark.read.parquet(blobs).count()
    e1 = sorted(tuple(r) for r in spark.read.parquet(log1).select("shard", "object_key").collect())
    log2 = J.job_repair(spark, s, store, blobs, log1)
    assert spark.read.parquet(blobs).count() == n1
    e2 = sorted(tuple(r) for r in spark.read.parquet(log2).select("shard", "object_key").collect())
    assert e1 == e2


def test_convert_skips_finished_shards(spark, tmp_dir):
    pages, s, _ = _inputs(spark)
    meta = s.select("page_id", "key", "shard", "marker", F.col("page_id").alias("src_order"))
    work = J.job_convert(spark, meta, FX.archive(pages), tmp_dir)
    n = spark.read.parquet(f"{tmp_dir}/samples").count()
    assert n > 0 and work.count() > 0
    again = J.job_convert(spark, meta, FX.archive(pages), tmp_dir,
                          finished=SH.read_ledger(spark, f"{tmp_dir}/ledger"))
    assert again.count() == 0 and spark.read.parquet(f"{tmp_dir}/samples").count() == n


def test_convert_filters_gate_flag_and_explicit_shards(spark, tmp_dir):
    rows = [(i, f"{i:03x}key", f"{i:03x}", i % 2 if i > 5 else 0, "jpg" if i != 4 else "png", i, i == 3) for i in range(8)]
    meta = spark.createDataFrame(rows, "page_id long, key string, shard string, marker int, ext string, src_order long, already boolean")
    members = spark.createDataFrame([(f"{i:03x}", 0, f"p/{i:03x}key.jpg", "x" * (10 + i)) for i in range(8)],
                                    "shard string, ord int, name string, data string")

    def decode(df):  # image 1 is flat, image 2 cannot be decoded
        flat, busy = "array(array(5d, 5d), array(5d, 5d))", "array(array(0d, 0d), array(200d, 200d))"
        gray = F.expr(f"case when page_id = 1 then {flat} when page_id = 2 then null else {busy} end")
        return df.withColumn("w", F.lit(1000)).withColumn("h", F.lit(700)).withColumn("gray", gray)

    J.job_convert(spark, meta, members, tmp_dir, geometry=decode, kinds=("images",), predicate="ext <> 'png'", already="already", pixels="gray")
    out = {r.page_id: r for r in spark.read.parquet(f"{tmp_dir}/samples").collect()}
    assert sorted(out) == [0, 2, 3, 5, 6]        # 1 flat, 4 filtered, 7 a video
    assert out[0].recompress and (out[0].new_w, out[0].new_h) == (500, 350)
    assert not out[3].recompress and (out[3].new_w, out[3].new_h) == (1000, 700)   # re-encoded before
    done = SH.read_ledger(spark, f"{tmp_dir}/ledger")
    again = J.job_convert(spark, meta, members, tmp_dir, finished=done, shards=["006"])
    assert [r.shard for r in again.collect()] == ["006"]


def test_second_release_keeps_the_first_and_scores_no_key_twice(spark, tmp_dir):
    v = FX.vectors(FX.table(spark, SF, "embeddings"))
    v = v.unionByName(v)  # every key twice
    for a, z in (("50", "5f"), ("60", "6f"), ("50", "6f")):
        out = J.job_prefix_release(spark, v, tmp_dir, a, z, FE.integer_scorer(64, 4), 64)
    keys = [r.key for r in spark.read.schema(J.FEATURE_SCHEMA).parquet(f"{tmp_dir}/features").collect()]
    want = v.where("embedding is not null and substr(key, 1, 2) between '50' and '6f'").select("key").distinct().count()
    assert len(keys) == len(set(keys)) == want == sum(r.n_features for r in out.collect())


def test_prefix_release_manifest(spark, tmp_dir):
    v = FX.vectors(FX.table(spark, SF, "embeddings"))
    out = J.job_prefix_release(spark, v, tmp_dir, "50", "5f", FE.integer_scorer(64, 4), 64).collect()
    assert len(out) == 16
    m = json.loads(out[0].manifest)
    assert m == {"title": f"corpus-{out[0].prefix}", "id": f"owner/corpus-{out[0].prefix}",
                 "licenses": [{"name": "CC0-1.0"}]}
    assert sum(r.n_features for r in out) == v.where("embedding is not null") \
        .where(F.substring("key", 1, 2).between("50", "5f")).count()
