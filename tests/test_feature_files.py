"""Clustered feature store: a resume opens only files whose key range it meets, and finds the same keys."""
from pyspark.sql import functions as F

from corpusprep.operators import features as FE
from corpusprep.sources import feature_files as FF
from corpusprep.sources import tables as TB


def _features(spark, a, b):
    return spark.range(a, b).select(F.md5(F.col("id").cast("string")).alias("key"), F.array(F.lit(1.0).cast("float")).alias("feature"))


def _rows(df):
    return sorted(r[0] for r in df.select("key").collect())


def test_one_prefix_opens_few_files(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    FF.write_clustered(_features(spark, 0, 4000), path, 32)
    FF.write_clustered(_features(spark, 4000, 6000), path, 32)
    stored = TB.scan_feature_keys(spark, path).inputFiles()
    todo = _features(spark, 3000, 9000).where(F.col("key").startswith("3a")).select("key")
    near = FF.stored_keys_near(todo, path)
    assert len(stored) == 64 and 1 <= len(near.inputFiles()) <= 6
    want = _rows(FE.pending_features(todo, TB.scan_feature_keys(spark, path)))
    assert _rows(FE.pending_features(todo, near)) == want and want
    # over all prefixes nothing is skipped, and nothing is missing
    everything = _features(spark, 0, 9000).select("key")
    assert _rows(FE.pending_features(everything, FF.stored_keys_near(everything, path))) == \
        _rows(_features(spark, 6000, 9000))


def test_files_without_a_record_are_read(spark, tmp_dir):
    """A run lost after its data and before its record; the next index mends it."""
    path = f"{tmp_dir}/store"
    FF.write_clustered(_features(spark, 0, 500), path, 8)
    _features(spark, 500, 600).repartition(2).write.mode("append").parquet(path)
    todo = _features(spark, 0, 600).where(F.col("key").startswith("7")).select("key")
    lost = set(FF._unlisted(spark, path))
    assert len(lost) == 2 and lost <= set(FF.files_for(todo, path))
    assert FE.pending_features(todo, FF.stored_keys_near(todo, path)).count() == 0
    assert FF.index_files(spark, path) == 2 and FF.index_files(spark, path) == 0


def test_keys_of_other_forms_nulls_and_empty(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    one = spark.createDataFrame([("3a1b",)], "key string")
    assert FF.stored_keys_near(one, path).count() == 0
    odd = spark.createDataFrame([("zz", [1.0]), ("3a1b", [1.0]), ("ABC", [1.0])], "key string, feature array<float>")
    FF.write_clustered(odd, path, 4)
    assert FE.pending_features(one, FF.stored_keys_near(one, path)).count() == 0
    assert _rows(FF.stored_keys_near(spark.createDataFrame([("zz",), (None,)], "key string"), path)) == ["3a1b", "ABC", "zz"]
    assert FF.files_for(spark.createDataFrame([(None,)], "key string"), path) == []
