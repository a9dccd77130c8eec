"""Plan-shape checks: pruning, pushdown, and no cross products."""
from pyspark.sql import functions as F

from corpusprep.functions import keys as K
from corpusprep.operators import samples as S
from corpusprep.session import scale_settings


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hex_range_prunes_partitions(spark, tmp_dir):
    K.hex_range(spark, "380", "3bf").withColumn("v", F.lit(1)).write.partitionBy("shard").parquet(f"{tmp_dir}/d")
    df = spark.read.parquet(f"{tmp_dir}/d").where(K.in_hex_range("shard", "3a0", "3af"))
    plan = _plan(df)
    # the shard predicate is a partition filter (pruned at planning), not a data filter
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert df.count() == 16


def test_sql_string_filter_is_pushed_to_parquet(spark, tmp_dir):
    spark.range(0, 100).select(F.col("id").alias("accuracy"), F.lit("jpg").alias("ext")) \
        .write.parquet(f"{tmp_dir}/p")
    df = S.filter_user(spark.read.parquet(f"{tmp_dir}/p"), "accuracy > 5 AND ext = 'jpg'").select("accuracy")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(accuracy), IsNotNull(ext), GreaterThan(accuracy,5), EqualTo(ext,jpg)]" in plan
    assert "ReadSchema: struct<accuracy:bigint>" in plan or "ReadSchema: struct<accuracy:bigint,ext:string>" in plan


def test_scale_settings():
    s = scale_settings(100 << 40, 8000)  # 100 TiB on 8,000 cores
    # 100 TiB / 256 MiB = 409,600, rounded up to a multiple of the cores
    assert int(s["spark.sql.shuffle.partitions"]) == 416000
    assert int(s["spark.sql.shuffle.partitions"]) % 8000 == 0
    assert s["spark.sql.adaptive.enabled"] == "true"


def test_no_query_plans_a_cross_product(spark):
    """No registered query pairs rows without an equi-key (no cartesian or
    nested-loop join, which emit all pairs)."""
    import __spark_entry__ as E
    bad = []
    for name, fn in sorted(E.queries().items()):
        plan = _plan(fn(spark, "/root/testdata/sf0.001"))
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
            bad.append(name)
    assert bad == []
