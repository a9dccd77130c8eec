import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators import features as FE
from corpusprep.operators import resolve as R
from corpusprep.sources import tables as TB
from corpusprep.streaming import incremental as INC

SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("accuracy", T.LongType())])


def _lines(spark, path, rows):
    spark.createDataFrame(rows, "value string, shard string").write.mode("append").partitionBy("shard").text(path, compression="gzip")


def test_malformed_lines_fail_or_are_named(spark, tmp_dir):
    good = [(f'{{"key": "k{i}", "accuracy": {i}}}', "0ab" if i % 2 else "00f") for i in range(10)]
    bad = [('{"key": "cut', "0ab"), ('[1, 2', "00f"), ('{"key": "x", "accuracy": "many"}', "00f"), ("", "00f"), ("  ", "0ab")]
    _lines(spark, f"{tmp_dir}/s", good + bad)
    with pytest.raises(Exception, match="(?i)malformed"):
        TB.read_metadata_shards(spark, f"{tmp_dir}/s", SCHEMA).collect()
    back = TB.read_metadata_shards(spark, f"{tmp_dir}/s", SCHEMA, on_error="reject")
    assert back.columns == ["key", "accuracy", "shard"] and back.count() == 10
    assert {(r.key, r.accuracy, r.shard) for r in back.collect()} == {(f"k{i}", i, "0ab" if i % 2 else "00f") for i in range(10)}
    rejects = TB.metadata_rejects(spark, f"{tmp_dir}/s", SCHEMA)
    assert {(r.shard, r.line) for r in rejects.collect()} == {(s, v) for v, s in bad if v.strip()} and rejects.count() == 3
    assert all(f"shard={r.shard}" in r.file for r in rejects.collect())


def test_flat_shards_reject_too(spark, tmp_dir):
    import gzip
    import os
    os.makedirs(f"{tmp_dir}/f")
    with gzip.open(f"{tmp_dir}/f/0ab.gz", "wt") as fh:
        fh.write('{"key": "a", "accuracy": null}\n{"key": \n')
    assert [tuple(r) for r in TB.read_metadata_shards(spark, f"{tmp_dir}/f", SCHEMA, "flat", "reject").collect()] == [("a", None, "0ab")]
    assert TB.metadata_rejects(spark, f"{tmp_dir}/f", SCHEMA, "flat").first().line == '{"key": '


V = T.StructType([T.StructField("v", T.LongType()), T.StructField("at", T.TimestampType())])


def _deliver(spark, path, values, day=1):
    spark.createDataFrame([(v,) for v in values], "v long").withColumn("at", F.to_timestamp(F.lit(f"2024-01-{day:02d} 00:00:00"))).write.parquet(path)


def test_rows_delivered_again_come_out_once(spark, tmp_dir):
    src, sink, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    for name, values in (("a", [1, 2, 2, 3]), ("b", [2, 3, 4]), ("c", [1, 4, 5])):
        _deliver(spark, f"{src}/part={name}", values)
        INC.incremental_ingest(spark, src, V, sink, ck, once_by=["v"])
    assert sorted(r.v for r in INC.read_ingested(spark, sink, V).collect()) == [1, 2, 3, 4, 5]


def test_a_killed_batch_is_replayed_once(spark, tmp_dir):
    src, sink, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _deliver(spark, f"{src}/part=a", [1, 2])
    INC.incremental_ingest(spark, src, V, sink, ck, once_by=["v"])
    _deliver(spark, f"{src}/part=b", [2, 3])

    def dies(df):
        raise RuntimeError("lost")
    with pytest.raises(Exception, match="lost"):
        INC.incremental_ingest(spark, src, V, sink, ck, dies, once_by=["v"])
    _deliver(spark, f"{src}/part=c", [3, 4])
    INC.incremental_ingest(spark, src, V, sink, ck, once_by=["v"])
    assert sorted(r.v for r in INC.read_ingested(spark, sink, V).collect()) == [1, 2, 3, 4]


def test_state_expires_with_the_watermark(spark, tmp_dir):
    """After the delay a row may come again: its state is gone."""
    src, sink, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    for name, values, day in (("a", [1], 1), ("b", [2], 20), ("c", [3], 21), ("d", [1, 2], 22)):
        _deliver(spark, f"{src}/part={name}", values, day)
        INC.incremental_ingest(spark, src, V, sink, ck, once_by=["v"], event_time="at", delay="3 days")
    assert sorted(r.v for r in INC.read_ingested(spark, sink, V).collect()) == [1, 1, 2, 3]


def test_scoring_places_tasks_by_profile(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "id long, embedding array<float>")

    def make(device):
        return lambda x: np.stack([x.sum(axis=1), np.full(len(x), len(device))], axis=1)
    out = FE.score_on_devices(df, make, 2, batch_size=3).collect()  # no profile: any local mode
    assert {r.id: list(r.feature) for r in out} == {i: [i + 1.0, 3.0] for i in range(10)}
    profile = FE.device_profile(per_executor=2, per_task=0.5)
    assert profile.taskResources["gpu"].amount == 0.5 and profile.executorResources["gpu"].amount == 2
    assert FE.task_device() == "cpu"
    with pytest.raises(Exception, match="(?i)resource ?profile|stage level|dynamic allocation"):
        FE.score_on_devices(df, make, 2, profile=profile).collect()  # a cluster schedules it, local mode says that it cannot


def test_shard_names_are_broadcast_whatever_the_threshold(spark):
    """The payload side has one exchange, on the object, also where nothing is small enough to be broadcast by size."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        samples = spark.createDataFrame([("0abc1", 0, "jpg"), ("f00d2", 0, "jpg")], "key string, marker int, ext string")
        store = spark.createDataFrame([("data/images/0ab/c1/0abc1.jpg", b"x")], "object_key string, data binary")
        plan = R.resolve_objects(samples, store)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(substring(" not in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
