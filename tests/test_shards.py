
from corpusprep.functions import keys as K
from corpusprep.operators import shards as SH


def _shards(spark, names):
    return spark.createDataFrame([(n,) for n in names], "shard string")


def test_assign_devices_remainder_to_last(spark):
    s = _shards(spark, [f"{i:03x}" for i in range(18)])
    counts = [r[1] for r in sorted(SH.assign_devices(s, 4).groupBy("device").count().collect())]
    assert counts == [4, 4, 4, 6]          # not ntile's [5, 5, 4, 4]
    few = SH.assign_devices(_shards(spark, ["000", "001"]), 4)
    assert sorted(r.device for r in few.collect()) == [0, 1]


def test_prefix_coverage_covers_domain_once(spark):
    prefixes = SH.published_prefixes(spark)
    assert prefixes.count() == 151
    cov = SH.prefix_coverage(K.shard_domain(spark), prefixes)
    assert cov.where("n_cover != 1").count() == 0 and cov.count() == 4096


def test_shard_progress_empty_sets(spark):
    empty = spark.createDataFrame([], "shard string")
    r = SH.shard_progress(empty, empty).first()
    assert (r.n_present, r.n_finished, r.n_pending, r.first_pending) == (0, 0, 0, None)
    r = SH.shard_progress(_shards(spark, ["001", "002", "003"]), _shards(spark, ["002", "002"])).first()
    assert (r.n_present, r.n_finished, r.n_pending, r.first_pending, r.last_pending) == (3, 1, 2, "001", "003")


def test_select_shards_range_ledger_and_explicit_list(spark):
    present = _shards(spark, ["0ff", "100", "101", "7ff", "800"])
    done = _shards(spark, ["101"])
    got = sorted(r.shard for r in SH.select_shards(present, done, "100", "7ff").collect())
    assert got == ["100", "7ff"]
    assert [r.shard for r in SH.select_shards(present, done, shards=["abc"]).collect()] == ["abc"]


def test_partition_names_stay_strings(spark, tmp_dir):
    df = spark.createDataFrame([("00f", 1), ("1e5", 2), ("001", 3)], "shard string, v int")
    df.write.partitionBy("shard").parquet(f"{tmp_dir}/p")
    back = spark.read.parquet(f"{tmp_dir}/p")
    assert sorted(r.shard for r in back.collect()) == ["001", "00f", "1e5"]


def test_hex_prefix_bounds(spark):
    b = SH.prefix_bounds(spark, "52", "5f").collect()
    assert b[0].prefix == "52" and b[0].start == "520" and b[-1].end == "5ff" and len(b) == 14


def test_sorted_positions_and_wide_hex_ranges(spark):
    names = [f"{i * 37 % 4096:03x}" for i in range(4096)]
    out = SH.sorted_positions(_shards(spark, names), ["shard"]).collect()
    assert {r.shard: r.pos for r in out} == {f"{i:03x}": i + 1 for i in range(4096)}
    wide = K.hex_range(spark, "0", "3ffff")
    assert wide.count() == 0x40000 and wide.rdd.getNumPartitions() == 4
