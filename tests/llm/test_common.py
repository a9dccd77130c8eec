from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusprep.llm import common
from corpusprep.llm.components import connected_components


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=0, max_size=40, unique=True))
def test_range_of_counts_the_bounds_below(spark, bounds):
    bounds = sorted(bounds)
    df = spark.range(-55, 56).withColumnRenamed("id", "x")
    got = {r.x: r.g for r in df.select("x", common.range_of(bounds, "x").alias("g")).collect()}
    assert got == {x: sum(b <= x for b in bounds) for x in range(-55, 56)}


def test_chained_sum_against_a_plain_running_sum(shipped):
    rows = [(None if i % 5 == 0 else f"g{i % 3}", i * 7919 % 1000, i % 11) for i in range(1000)]
    df = shipped.createDataFrame(rows, "g string, o int, v int").repartition(6)
    got = common.chained_sum(df, ["g"], F.floor(F.col("o") / 37).cast("int"), [F.col("o")], "v", "before").collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["g", "o", "v", "before"]
    for g in (None, "g0", "g1", "g2"):
        run = 0
        for r in sorted((r for r in got if r.g == g), key=lambda r: r.o):
            assert r.before == run
            run += r.v


def test_lookup_join_spreads_a_hot_key(shipped):
    facts = shipped.range(0, 40000, 1, 8).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    counts = facts.groupBy("k").count()
    table = counts.select("k", (F.col("count") * 2).alias("w"))
    hot = common.hot_keys(counts, "k", "count", 40000)
    assert [r[0] for r in hot.collect()] == ["hot"]
    out = common.lookup_join(facts, table, "k", hot, F.xxhash64("id"))
    assert out.count() == 40000 and out.where("w is null").count() == 0


def test_components_of_chains_stars_and_rings(shipped):
    chain = [(i, i + 1) for i in range(1000, 1400)]
    star = [(5000, 5000 + i) for i in range(1, 800)]
    ring = [(9000 + i, 9000 + (i + 1) % 50) for i in range(50)]
    noise = [(1, 1), (None, 3), (2, None), (7, 8), (8, 7), (7, 8)]
    edges = shipped.createDataFrame(chain + star + ring + noise, "a long, b long").repartition(5)
    got = {r.id: r.component for r in connected_components(edges).collect()}
    want = {i: 1000 for i in range(1000, 1401)} | {5000 + i: 5000 for i in range(800)} | {9000 + i: 9000 for i in range(50)} | {7: 7, 8: 7}
    assert got == want
    assert connected_components(shipped.createDataFrame([], "a long, b long")).count() == 0
