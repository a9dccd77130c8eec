from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.operators.windows import row_number_within


def _check(df, group, order, parts):
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    got = row_number_within(df, group, order, num_partitions=parts)
    j = got.join(ref, [*df.columns])
    assert got.count() == df.count()
    assert j.where(F.col("rn") != F.col("ref")).count() == 0


def test_hot_group_spans_partitions(spark):
    # one group holds 90% of the rows: it must span several range partitions
    df = spark.range(0, 30000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(F.lit(99))
                                      .alias("g"), F.col("id").alias("o"))
    _check(df, ["g"], ["o"], 16)


def test_single_group_and_many_groups(spark):
    one = spark.range(0, 5000).select(F.lit(1).alias("g"), (F.col("id") * 7 % 5000).alias("o"))
    _check(one, ["g"], ["o"], 7)
    many = spark.range(0, 5000).select((F.col("id") % 1000).alias("g"), F.col("id").alias("o"))
    _check(many, ["g"], ["o"], 5)


def test_null_group_keys(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2)
                                     .alias("g"), F.col("id").alias("o"))
    _check(df, ["g"], ["o"], 6)


def test_copies_of_one_row_spread_and_number(spark):
    # a third of the table is the same row: ties on (g, o) must still split
    copies = spark.range(0, 9000).select(F.lit(5).alias("g"), F.lit(1).alias("o"))
    others = spark.range(0, 18000).select((F.col("id") % 50).alias("g"), F.col("id").alias("o"))
    df = copies.unionByName(others)
    got = row_number_within(df, ["g"], ["o"], num_partitions=12)
    hot = got.where("g = 5")
    assert sorted(r.rn for r in hot.collect()) == list(range(1, 9000 + 18000 // 50 + 1))
    from corpusprep.operators.windows import cluster_sorted
    parts = cluster_sorted(copies, ["g", "o"], 6).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_payload_columns_are_kept_without_exchange_reuse(spark):
    """A column outside group and order, pruned from one branch only, must not
    change which rows meet (rows were lost when both branches re-sampled)."""
    for wide in (1, 5, 20):
        for reuse in ("true", "false"):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            try:
                df = spark.range(0, 60000, 1, 16).select(
                    F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).alias("g"),
                    F.xxhash64("id").alias("o"), *[(F.col("id") + k).alias(f"x{k}") for k in range(wide)])
                got = row_number_within(df, ["g"], ["o"], num_partitions=8)
                agg = got.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("rn").alias("m"),
                                           F.countDistinct("rn").alias("d"))
                assert got.count() == 60000
                assert agg.where("n <> m or n <> d").count() == 0
            finally:
                spark.conf.set("spark.sql.exchange.reuse", "true")
