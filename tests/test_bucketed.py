"""Bucketed audits: same rows as the joins that shuffle, and no exchange on a repeated audit."""
import pytest
from pyspark.sql import functions as F

from corpusprep.operators import bucketed as B
from corpusprep.operators import media as M
from corpusprep.operators import resolve as R
from corpusprep.plans import fixtures as FX

SF = "/root/testdata/sf0.001"
STORE = "key string, object_key string, data string"


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def pages(spark):
    return FX.table(spark, SF, "pages")


def _archive(pages):
    """An archive per shard, some of whose members were lost."""
    a = FX.archive(pages)
    note = FX.samples(pages).select("shard").distinct().select("shard", F.lit(0).alias("ord"), F.lit("notes.txt").alias("name"), F.lit("").alias("data"))
    return a.where(F.crc32("name") % 3 != 0).unionByName(note)


def _tables(pages, path):
    return (B.write_metadata(FX.samples(pages), f"{path}/meta", 16), B.write_members(_archive(pages), f"{path}/members", 16),
            B.write_store(FX.store(pages), f"{path}/store", 16))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_repeated_audit_has_no_exchange(spark, pages, tmp_dir, no_broadcast):
    meta, members, store = _tables(pages, tmp_dir)
    missing = B.missing_bucketed(meta, members, store)
    # the shard names are brought together for their broadcast; nothing is dealt by key
    assert "hashpartitioning(key" not in _plan(missing) and "hashpartitioning(_hk" not in _plan(missing)
    assert _plan(missing).count("Exchange hashpartitioning") <= 1
    assert "Bucketed: true" in _plan(missing)
    fetched = _plan(B.fetch_bucketed(missing, store))
    assert fetched.count("Exchange hashpartitioning") <= 1 and "BroadcastNestedLoop" not in fetched
    resolved = _plan(B.resolve_bucketed(meta, store))
    assert "Exchange" not in resolved and "SortMergeJoin" in resolved
    # decisions do not read the payload
    assert "data:string" not in _plan(missing) and "data:string" not in resolved


def test_log_lines_alone_are_exchanged(spark, pages, tmp_dir, no_broadcast):
    members = B.write_members(FX.archive(pages), f"{tmp_dir}/members", 16)
    plan = _plan(B.errors_bucketed(FX.err_log(pages), members))
    assert "Bucketed: true" in plan
    scan = plan[plan.rindex("FileScan parquet spark_catalog"):] if "FileScan parquet spark_catalog" in plan else ""
    assert "object_key" in scan
    side = plan[plan.index("SortMergeJoin"):]
    assert "hashpartitioning(_key" in side and "hashpartitioning(_mk" not in side


def test_same_rows_as_the_joins_that_shuffle(spark, pages, tmp_dir):
    meta, members, store = _tables(pages, tmp_dir)
    s, a, st = FX.samples(pages), _archive(pages), FX.store(pages)
    missing = B.missing_bucketed(meta, members, store)
    in_archive = R.shards_with_archive(s, a)
    assert missing.agg(F.sum("n")).first()[0] == R.find_missing(in_archive, a, st).count() > 0
    assert _rows(B.fetch_bucketed(missing, store)) == _rows(R.audit_objects(s, a, st))
    some = ["00f", *[r[0] for r in a.select("shard").distinct().orderBy("shard").limit(40).collect()]]
    part = B.missing_bucketed(meta, members, store, shards=some, kinds=["images"])
    assert _rows(B.fetch_bucketed(part, store)) == _rows(R.audit_objects(s, a, st, shards=some, kinds=["images"]))
    assert _rows(B.errors_bucketed(FX.err_log(pages), members)) == _rows(R.error_keys(FX.err_log(pages), a))
    want = R.resolve_objects(s.drop("payload"), st).select("key", "marker", "ext", "object_key", "found").distinct()
    assert _rows(B.resolve_bucketed(meta, store).drop("n")) == _rows(want)


def test_first_members_with_a_hot_member(spark, pages, tmp_dir):
    """A member copied until it holds most rows is joined whole, and not in its bucket."""
    a = FX.archive(pages)
    one = a.where("ord < 1000 and data <> 'tie'").orderBy("name").limit(1)
    a = a.unionByName(one.crossJoin(spark.range(2000)).drop("id"))
    meta = FX.samples(pages).select("page_id", "key", "shard", "marker", F.col("page_id").alias("src_order"),
                                    F.lit("x").alias("name"))
    cold, hot = B.write_first_members(a, f"{tmp_dir}/first", 16)
    assert hot.count() == 2001 and cold.frame.where(F.col("name") == one.first()["name"]).count() == 0
    got = B.join_first_members(meta, cold, hot)
    want = M.join_metadata_blobs(meta, a)
    assert got.columns == want.columns
    assert _rows(got) == _rows(want)


def test_payload_stays_in_its_bucket(spark, pages, tmp_dir, no_broadcast):
    cold, hot = B.write_first_members(FX.archive(pages), f"{tmp_dir}/first", 16)
    meta = FX.samples(pages).select("page_id", "key", "shard", "marker", F.col("page_id").alias("src_order"))
    plan = _plan(B.join_first_members(meta, cold, hot))
    join = plan[plan.index("SortMergeJoin"):]
    scan = next(x for x in join.splitlines() if "FileScan" in x)
    above = join[:join.index(scan)]
    assert "data:string" in scan and "Bucketed: true" in scan and "Exchange" not in above


def test_opened_again_by_its_folder(spark, pages, tmp_dir):
    meta, members, store = _tables(pages, tmp_dir)
    want = _rows(B.fetch_bucketed(B.missing_bucketed(meta, members, store), store))
    assert want
    spark.sql(f"DROP TABLE {B._table_name(store.path)}")  # as in a new session: files stay
    again = B.open_bucketed(spark, store.path, STORE, ["key"])
    assert again.buckets == 16
    assert _rows(B.fetch_bucketed(B.missing_bucketed(meta, members, again), again)) == want
    with pytest.raises(ValueError):
        B.open_bucketed(spark, f"{tmp_dir}/store", STORE, ["key"])


def test_empty_tables_nulls_and_other_forms(spark, tmp_dir):
    s = spark.createDataFrame([(None, 0, "jpg", "0ab")], "key string, marker int, ext string, shard string")
    a = spark.createDataFrame([(None, "x", 1, "d"), ("0ab", None, 1, "d"), ("0ab", "odd name", 1, "d")],
                              "shard string, name string, ord int, data string")
    st = spark.createDataFrame([(None, "d"), ("no/such/form", "d")], "object_key string, data string")
    meta, members, store = (B.write_metadata(s, f"{tmp_dir}/m", 8), B.write_members(a, f"{tmp_dir}/a", 8),
                            B.write_store(st, f"{tmp_dir}/s", 8))
    assert B.resolve_bucketed(meta, store).count() == 0
    assert B.fetch_bucketed(B.missing_bucketed(meta, members, store), store).count() == 0
    err = spark.createDataFrame([("0ab", " odd name "), ("0ab", "other"), ("0ac", "odd name"), ("0ab", " ")], "shard string, line string")
    assert _rows(B.errors_bucketed(err, members)) == [("0ab", "other"), ("0ac", "odd name")]
    empty = B.open_bucketed(spark, store.path, STORE, ["key"])
    assert empty.frame.count() == 0


def test_buckets_for():
    assert B.buckets_for(0) == 8
    assert B.buckets_for(11 << 40) == 65536  # 11 TiB at 256 MiB a bucket, rounded up
