import pytest
from pyspark.sql import functions as F

from corpusprep.operators import samples as S


def test_falsy_coercion_depends_on_type(spark):
    df = spark.createDataFrame(
        [("u1", "", 0.0, 0), ("u2", "0", 1.5, 3), ("u3", None, None, None), ("u4", "2.5", -0.5, -2)],
        "downloadurl string, longitude string, latitude double, accuracy bigint")
    rows = {r.downloadurl: r for r in S.create_samples(df).collect()}
    assert rows["u1"].longitude is None and rows["u1"].latitude is None and rows["u1"].accuracy is None
    assert rows["u2"].longitude == 0.0 and rows["u2"].latitude == 1.5 and rows["u2"].accuracy == 3
    assert rows["u3"].longitude is None
    assert rows["u4"].longitude == 2.5 and rows["u4"].latitude == -0.5 and rows["u4"].accuracy == -2


def test_int_coercion_truncates_toward_zero(spark):
    df = spark.createDataFrame([("u", 2.7), ("v", -2.7), ("w", 0.4)], "downloadurl string, accuracy double")
    got = {r.downloadurl: r.accuracy for r in S.create_samples(df).collect()}
    assert got == {"u": 2, "v": -2, "w": 0}


def test_null_url_fails_or_is_rejected(spark):
    df = spark.createDataFrame([("a",), (None,)], "downloadurl string")
    with pytest.raises(Exception, match="sample has no key"):
        S.create_samples(df).collect()
    good, bad = S.split_rejects(df)
    assert [r.downloadurl for r in S.create_samples(good).collect()] == ["a"]
    assert [tuple(r) for r in bad.collect()] == [(None, "null downloadurl")]


def test_other_columns_pass_through(spark):
    df = spark.createDataFrame([("a", "x", 7)], "downloadurl string, title string, marker int")
    out = S.create_samples(df)
    assert out.columns == ["downloadurl", "title", "marker", "key", "shard"]


def test_dedupe_last_and_first(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, "c"), ("k", 2, "b"), ("j", 5, "z")],
                               "key string, src int, v string")
    last = {r.key: r.v for r in S.dedupe_last(df, "key", "src").collect()}
    first = {r.key: r.v for r in S.dedupe_first(df, "key", "src").collect()}
    assert last == {"k": "c", "j": "z"} and first == {"k": "a", "j": "z"}


def test_dedupe_hot_key_is_combined_map_side(spark):
    hot = spark.range(0, 200000).select(F.lit("hot").alias("key"), F.col("id").alias("src"))
    out = S.dedupe_last(hot, "key", "src")
    assert out.collect()[0].src == 199999
    # the aggregate below the exchange is the partial one: one row per key and task is shuffled
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "partial_max_by" in below and "Window" not in plan


def test_filters(spark):
    df = spark.createDataFrame([(0, 1), (1, 2), (0, 3)], "marker int, accuracy int")
    assert S.filter_kind(df, ["images"]).count() == 2
    assert S.filter_user(df, "accuracy >= 2").count() == 2
    assert S.filter_user(df, F.col("accuracy") == 1).count() == 1
    assert S.validate_row_count(df, 3).first().ok
