"""Published log versions: a kill before publishing changes nothing, and of two writers one wins."""
import pytest

from corpusprep.sinks import published as PB


def _log(spark, *keys):
    return spark.createDataFrame([(k[:3], k) for k in keys], "shard string, object_key string")


def _keys(df):
    return sorted(r.object_key for r in df.collect())


def test_versions(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    assert PB.current(spark, path) == 0 and PB.read_published(spark, path).count() == 0
    assert PB.rewrite_published(_log(spark, "00fa", "00fa", "1e5b"), path, 0) == 1
    assert _keys(PB.read_published(spark, path)) == ["00fa", "1e5b"]
    # killed between the write and its publication
    PB.write_version(_log(spark, "00fa"), path)
    assert PB.current(spark, path) == 1 and _keys(PB.read_published(spark, path)) == ["00fa", "1e5b"]
    # a version may be computed from the one that is read
    old = PB.read_published(spark, path)
    assert PB.rewrite_published(old.where("shard = '1e5'"), path, 1) == 2
    assert _keys(PB.read_published(spark, path)) == ["1e5b"]


def test_two_writers(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    a, b = PB.write_version(_log(spark, "00fa"), path), PB.write_version(_log(spark, "1e5b"), path)
    PB.publish(spark, path, a, 0)
    with pytest.raises(PB.Outdated):
        PB.publish(spark, path, b, 0)
    assert _keys(PB.read_published(spark, path)) == ["00fa"]
