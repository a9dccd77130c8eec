import gzip
import hashlib
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators import samples as S
from corpusprep.operators import shards as SH
from corpusprep.plans import fixture_files as FL
from corpusprep.sinks import writers as W
from corpusprep.sources import archives as AR
from corpusprep.sources import images as IM
from corpusprep.sources import tables as TB
from corpusprep.streaming import incremental as INC


def _samples(spark, n=50):
    rows = [(f"http://h/{i}.jpg", "" if i % 3 == 0 else str(i), float(i % 4), i % 5, i % 2, "jpg")
            for i in range(n)]
    df = spark.createDataFrame(rows, "downloadurl string, longitude string, latitude double, "
                                     "accuracy bigint, marker int, ext string")
    return S.create_samples(df)


def test_jsonl_roundtrip_keeps_nulls(spark, tmp_dir):
    s = _samples(spark)
    W.write_shard_jsonl(s, f"{tmp_dir}/meta")
    part = next(p for p in os.listdir(f"{tmp_dir}/meta") if p.startswith("shard="))
    f = next(x for x in os.listdir(f"{tmp_dir}/meta/{part}") if x.endswith(".gz"))
    first = json.loads(gzip.open(f"{tmp_dir}/meta/{part}/{f}", "rt").readline())
    assert "longitude" in first  # null fields are written, not dropped
    back = TB.read_metadata_shards(spark, f"{tmp_dir}/meta")
    a = sorted(tuple(r) for r in s.select("key", "longitude", "accuracy", "shard").collect())
    b = sorted(tuple(r) for r in back.select("key", "longitude", "accuracy", "shard").collect())
    assert a == b


def test_dynamic_overwrite_keeps_other_shards(spark, tmp_dir):
    s = _samples(spark)
    W.write_shard_jsonl(s, f"{tmp_dir}/m")
    one = s.select("shard").first().shard
    W.write_shard_jsonl(s.where(F.col("shard") == one).withColumn("ext", F.lit("new")), f"{tmp_dir}/m")
    back = TB.read_metadata_shards(spark, f"{tmp_dir}/m")
    assert back.count() == s.count()
    assert {r.ext for r in back.where(F.col("shard") == one).collect()} == {"new"}


def test_flat_multi_member_gzip_shards(spark, tmp_dir):
    d = f"{tmp_dir}/flat"
    os.makedirs(d)
    with open(f"{d}/abc.gz", "wb") as fh:
        for chunk in range(3):  # appended gzip members, as the studied tool writes them
            body = "\n".join(json.dumps({"key": f"abc{chunk}{i}", "downloadurl": "u", "marker": 0})
                             for i in range(100)) + "\n"
            fh.write(gzip.compress(body.encode()))
    with open(f"{d}/notashard.gz", "wb") as fh:
        fh.write(gzip.compress(b'{"key": "x"}\n'))
    back = TB.read_metadata_shards(spark, f"{d}/*.gz", layout="flat")
    assert back.count() == 300 and {r.shard for r in back.select("shard").distinct().collect()} == {"abc"}


def test_ledger_absent_is_empty_and_dedupes(spark, tmp_dir):
    assert SH.read_ledger(spark, f"{tmp_dir}/none").count() == 0
    sh = spark.createDataFrame([("001",), ("002",)], "shard string")
    W.ledger_append(sh, f"{tmp_dir}/ledger")
    W.ledger_append(sh, f"{tmp_dir}/ledger")
    assert SH.read_ledger(spark, f"{tmp_dir}/ledger").count() == 2


def test_zip_archives_roundtrip_and_junk(spark, tmp_dir):
    members = spark.createDataFrame(
        [("abc", 0, "p/abc1.jpg", "one"), ("abc", 1, "p/abc2.jpg", "two"), ("abc", 2, "shared.jpg", "s1"),
         ("def", 0, "p/def1.jpg", "three"), ("def", 1, "shared.jpg", "s2"), ("def", 2, "p/def3.jpg", "four")],
        "shard string, ord int, name string, data string")
    rep = FL.write_zip_shards(members, f"{tmp_dir}/z").collect()
    assert sorted((r.shard, r.n_members) for r in rep) == [("abc", 3), ("def", 3)]
    with zipfile.ZipFile(f"{tmp_dir}/z/abc.zip") as z:
        assert z.namelist() == ["p/abc1.jpg", "p/abc2.jpg", "shared.jpg"]
    idx = AR.archive_index(spark, f"{tmp_dir}/z")
    assert sorted((r.shard, r.ord, r.name) for r in idx.collect())[:3] == [
        ("abc", 0, "p/abc1.jpg"), ("abc", 1, "p/abc2.jpg"), ("abc", 2, "shared.jpg")]
    mem = AR.archive_members(spark, f"{tmp_dir}/z")
    assert {r.name: bytes(r.data) for r in mem.where("shard = 'def'").collect()}["shared.jpg"] == b"s2"


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members:
            z.writestr(name, data)


def test_unreadable_archives_fail_or_are_rejected_with_a_reason(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/z")
    _zip(f"{tmp_dir}/z/abc.zip", [("a.jpg", b"1"), ("b.jpg", b"2")])
    whole = open(f"{tmp_dir}/z/abc.zip", "rb").read()
    with open(f"{tmp_dir}/z/bad.zip", "wb") as fh:
        fh.write(whole[:len(whole) // 2])  # truncated
    for scan in (AR.archive_index, AR.archive_members):
        with pytest.raises(Exception, match="cannot read archive"):
            scan(spark, f"{tmp_dir}/z").collect()
        assert {r.shard for r in scan(spark, f"{tmp_dir}/z", on_error="reject").collect()} == {"abc"}
    (bad,) = AR.archive_rejects(spark, f"{tmp_dir}/z").collect()
    assert bad.shard == "bad" and "BadZipFile" in bad.error


def test_many_archives_use_many_tasks(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/z")
    for i in range(300):
        _zip(f"{tmp_dir}/z/{i:03x}.zip", [(f"{i}.jpg", b"x" * i)])
    for scan in (AR.archive_index, AR.archive_members):
        tasks = scan(spark, f"{tmp_dir}/z").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(tasks) >= 8 and max(t["count"] for t in tasks) < 100
    assert AR.archive_index(spark, f"{tmp_dir}/z").count() == 300


def test_large_archives_are_read_in_runs_and_bounded_batches(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/z")
    members = [(f"m{i}.bin", bytes([i % 256]) * (1000 + i)) for i in range(200)]
    _zip(f"{tmp_dir}/z/abc.zip", members)
    got = AR.archive_members(spark, f"{tmp_dir}/z", run_bytes=20_000, batch_bytes=3_000)
    assert {r.ord: (r.name, bytes(r.data)) for r in got.collect()} == dict(enumerate(members))
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 3


def test_writers_make_few_files_and_replace_on_rerun(spark, tmp_dir):
    rows = spark.range(0, 20000, 1, 16).select(F.format_string("%03x", F.col("id") % 64).alias("shard"),
                                               F.concat(F.lit("k"), F.col("id")).alias("object_key"))
    for _ in range(2):
        W.write_error_log(rows, f"{tmp_dir}/log")
    assert spark.read.schema("object_key string, shard string").parquet(f"{tmp_dir}/log").count() == 20000
    files = [f for _, _, names in os.walk(f"{tmp_dir}/log") for f in names if f.endswith(".parquet")]
    assert len(files) <= 64 + 16
    W.rewrite_error_log(rows, f"{tmp_dir}/log2")
    files = [f for _, _, names in os.walk(f"{tmp_dir}/log2") for f in names if f.endswith(".parquet")]
    assert len(files) <= 64 + 16


def test_full_conversion_clears_shards_that_are_gone(spark, tmp_dir):
    s = _samples(spark)
    W.write_shard_jsonl(s, f"{tmp_dir}/m", full=True)
    half = s.where(F.col("shard") < "8")
    W.write_shard_jsonl(half, f"{tmp_dir}/m", full=True)
    back = TB.read_metadata_shards(spark, f"{tmp_dir}/m")
    assert sorted(r.key for r in back.collect()) == sorted(r.key for r in half.collect())


def test_partitioned_features_keep_other_prefixes(spark, tmp_dir):
    df = lambda p, n: spark.createDataFrame([(f"{p}{i}", [1.0], p) for i in range(n)], "key string, feature array<float>, prefix string")
    W.write_features(df("50", 3), f"{tmp_dir}/f", "overwrite", "prefix")
    W.write_features(df("60", 4), f"{tmp_dir}/f", "overwrite", "prefix")
    back = spark.read.schema("key string, feature array<float>, prefix string").parquet(f"{tmp_dir}/f")
    assert {r.prefix: r["count"] for r in back.groupBy("prefix").count().collect()} == {"50": 3, "60": 4}


def test_image_scan_flags_junk(spark, tmp_dir):
    df = spark.createDataFrame([("a", list(range(64))), ("b", None)], "name string, px array<int>")
    FL.write_gray_images(df, f"{tmp_dir}/img", "name", "px", 8, 8).collect()
    rows = {r.key: r for r in IM.scan_images(spark, f"{tmp_dir}/img").collect()}
    assert rows["a"].valid and rows["a"].height == 8 and bytes(rows["a"].data) == bytes(range(64))
    assert not rows["b"].valid


def test_image_scan_reads_many_files_in_a_task(spark, tmp_dir):
    df = spark.createDataFrame([(f"i{i}", [i % 256] * 64) for i in range(300)], "name string, px array<int>")
    FL.write_gray_images(df, f"{tmp_dir}/img", "name", "px", 8, 8).collect()
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # one file a split
    try:
        img = IM.scan_images(spark, f"{tmp_dir}/img")
        tasks = max(8, 2 * spark.sparkContext.defaultParallelism)
        assert img.rdd.getNumPartitions() <= tasks < 300
        assert {r.key: r.data[0] for r in img.collect()} == {f"i{i}": i % 256 for i in range(300)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_checksums(spark, tmp_dir):
    p = f"{tmp_dir}/f.bin"
    with open(p, "wb") as fh:
        fh.write(b"hello")
    files = TB.file_checksums(spark, tmp_dir)
    path = files.first().path
    exp = spark.createDataFrame([(path, hashlib.md5(b"hello").hexdigest().upper())], "path string, md5 string")
    assert TB.verify_checksums(files, exp).first().ok
    with open(p, "wb") as fh:
        fh.write(b"abc" * 100_000)
    assert TB.file_checksums(spark, tmp_dir, chunk_bytes=1000).first().md5 == hashlib.md5(b"abc" * 100_000).hexdigest()


def test_incremental_ingest_once(spark, tmp_dir):
    schema = T.StructType([T.StructField("v", T.LongType())])
    src, sink, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    spark.range(0, 100).withColumnRenamed("id", "v").write.parquet(f"{src}/part=a")
    assert INC.incremental_ingest(spark, src, schema, sink, ck) == 1
    assert INC.incremental_ingest(spark, src, schema, sink, ck) == 0
    spark.range(100, 107).withColumnRenamed("id", "v").write.parquet(f"{src}/part=b")
    assert INC.incremental_ingest(spark, src, schema, sink, ck) == 1
    out = INC.read_ingested(spark, sink, schema)
    assert out.select("batch").distinct().count() == 2
    assert out.count() == 107 and out.select("v").distinct().count() == 107


def test_incremental_ingest_counts_all_its_batches(spark, tmp_dir):
    """More batches than the progress buffer holds."""
    schema = T.StructType([T.StructField("v", T.LongType())])
    src = f"{tmp_dir}/in"
    spark.range(0, 115, 1, 115).withColumnRenamed("id", "v").write.parquet(src)
    n = INC.incremental_ingest(spark, src, schema, f"{tmp_dir}/out", f"{tmp_dir}/ck", max_files_per_trigger=1)
    assert n == 115
    assert INC.read_ingested(spark, f"{tmp_dir}/out", schema).count() == 115


def test_describe_columns(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert [(r.position, r.name, r.type) for r in TB.describe_columns(df).collect()] == [(0, "a", "int"),
                                                                                         (1, "b", "string")]


def test_error_log_files_and_pending_shards(spark, tmp_dir):
    d = f"{tmp_dir}/errs"
    os.makedirs(d)
    with open(f"{d}/abc.err", "w") as fh:
        fh.write("data/images/abc/def/abcdef1.jpg\n  data/images/abc/def/abcdef2.jpg \n\n")
    with open(f"{d}/0f0.err", "w") as fh:
        fh.write("data/images/0f0/000/0f0000.jpg")
    from corpusprep.operators import resolve as R
    lines = R.scan_error_lines(TB.read_error_logs(spark, d))
    got = sorted(tuple(r) for r in lines.collect())
    assert got == [("0f0", "data/images/0f0/000/0f0000.jpg"), ("abc", "data/images/abc/def/abcdef1.jpg"),
                   ("abc", "data/images/abc/def/abcdef2.jpg")]
    present = spark.createDataFrame([("0f0",), ("abc",), ("fff",)], "shard string")
    ledger = spark.createDataFrame([("abc",), ("abc ",)], "shard string")
    assert sorted(r.shard for r in INC.pending_shards(present, ledger).collect()) == ["0f0", "fff"]
