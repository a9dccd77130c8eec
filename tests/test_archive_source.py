import os
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusprep.sources import archive_source as ARS
from corpusprep.sources import archives as AR

PUSH = "spark.sql.python.filterPushdown.enabled"


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members:
            z.writestr(name, data)


@pytest.fixture()
def shards(tmp_dir):
    os.makedirs(f"{tmp_dir}/z")
    for shard in ("0ab", "0ac", "f00"):
        _zip(f"{tmp_dir}/z/{shard}.zip", [(f"p/{shard}{i}.jpg", bytes([i]) * (200 + i)) for i in range(40)])
    _zip(f"{tmp_dir}/z/eee.zip", [])
    return f"{tmp_dir}/z"


@pytest.fixture()
def pushing(spark):
    spark.conf.set(PUSH, "true")
    yield spark
    spark.conf.unset(PUSH)


def test_same_rows_as_the_scan(spark, shards):
    key = ["shard", "ord", "name"]
    want = {(r.shard, r.ord, r.name): bytes(r.data) for r in AR.archive_members(spark, shards).collect()}
    got = ARS.read_archives(spark, shards)
    assert {(r.shard, r.ord, r.name): bytes(r.data) for r in got.collect()} == want and len(want) == 120
    index = ARS.read_archives(spark, shards, payload=False)
    assert index.columns == ["shard", "archive", "ord", "name", "size"]
    assert sorted(map(tuple, index.select(*key, "size").collect())) == sorted(map(tuple, AR.archive_index(spark, shards).select(*key, "size").collect()))


def test_one_archive_is_read_by_many_tasks(spark, shards):
    got = ARS.read_archives(spark, shards, run_bytes=2_000, batch_bytes=500).where("shard = '0ab'")
    assert got.count() == 40
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() >= 4
    assert got.agg(F.count_distinct("ord")).first()[0] == 40


def test_shard_filters_reach_the_reader(pushing, shards):
    with open(f"{shards}/f01.zip", "wb") as fh:
        fh.write(b"not an archive")  # opened by no task that the filter leaves
    for test, n in (("shard = '0ab'", 40), ("shard in ('0ab', 'f00')", 80), ("shard like '0a%'", 80), ("shard = '123'", 0)):
        got = ARS.read_archives(pushing, shards).where(test)
        assert got.count() == n
    plan = ARS.read_archives(pushing, shards).where("shard = '0ab'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter " not in plan  # none is left to Spark
    both = ARS.read_archives(pushing, shards, on_error="reject").where("shard = '0ab' and ord < 5")
    assert both.count() == 5


def test_unreadable_archives(spark, shards):
    with open(f"{shards}/bad.zip", "wb") as fh:
        fh.write(b"PK\x03\x04 cut off")
    with pytest.raises(Exception, match="cannot read archive"):
        ARS.read_archives(spark, shards).collect()
    assert ARS.read_archives(spark, shards, on_error="reject").count() == 120


def test_from_sql_and_empty_folder(spark, shards, tmp_dir):
    ARS.read_archives(spark, shards, payload=False).createOrReplaceTempView("members")
    assert spark.sql("select shard, count(*) n from members group by shard order by shard").collect() == [("0ab", 40), ("0ac", 40), ("f00", 40)]
    os.makedirs(f"{tmp_dir}/none")
    assert ARS.read_archives(spark, f"{tmp_dir}/none").count() == 0
