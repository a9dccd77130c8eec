import numpy as np

from corpusprep.operators import features as FE
from corpusprep.operators import media as M
from corpusprep.functions import policy as P
from corpusprep.plans import fixture_files as FL
from corpusprep.plans import fixtures as FX
from corpusprep.sources import images as IM
from corpusprep.streaming import incremental as INC

SF = "/root/testdata/sf0.001"


def test_scorer_matches_numpy(spark):
    emb = FX.table(spark, SF, "embeddings").limit(50)
    out = FE.score_model(emb, FE.integer_scorer(64, 4), 64).collect()
    w = np.array([[(i * 7 + j * 13) % 5 - 2 for i in range(64)] for j in range(4)], dtype=np.float64)
    for r in out:
        x = np.floor(np.asarray(r.embedding, dtype=np.float32).astype(np.float64) * 1000)
        assert list(r.feature) == list((x @ w.T).astype(np.float32))


def test_pooling_rules(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0]], None), (None, [9.0, 8.0])],
                               "tok array<array<double>>, flat array<double>")
    got = [r[0] for r in df.select(FE.pool_by_rank("tok", "flat")).collect()]
    assert got == [[1.0, 2.0], [9.0, 8.0]]
    ch = df.where("tok is not null").select(FE.channel_zero("tok")).first()[0]
    assert ch == [1.0, 3.0]


def test_normalize_pixels(spark):
    df = spark.createDataFrame([([0, 255, 51],)], "px array<int>")
    z = df.select(FE.normalize_pixels("px", (0.5, 0.5, 0.5), (0.5, 0.5, 0.25))).first()[0]
    assert np.allclose(z, [-1.0, 1.0, (51 / 255 - 0.5) / 0.25])


def test_resume_features_twice_equals_once(spark, tmp_dir):
    v = FX.vectors(FX.table(spark, SF, "embeddings"))
    store = f"{tmp_dir}/features"
    INC.resume_features(spark, v.where("already_done"), store, FE.integer_scorer(64, 4), 64)
    INC.resume_features(spark, v, store, FE.integer_scorer(64, 4), 64)
    INC.resume_features(spark, v, store, FE.integer_scorer(64, 4), 64)
    keys = spark.read.parquet(store).groupBy("key").count()
    assert keys.where("count > 1").count() == 0
    assert keys.count() == v.where("embedding is not null").count()


def test_quality_gate_keeps_big_or_busy(spark):
    flat, busy = [[0.0] * 4, [0.0] * 4, [0.0] * 4, [1.0] * 4], [[0.0] * 4, [100.0] * 4, [0.0] * 4, [100.0] * 4]
    df = spark.createDataFrame([(1, 100, flat), (2, 100, busy), (3, 100, None), (4, 100, []), (5, 50000, flat)],
                               "id long, n_bytes long, rows array<array<double>>")
    out = M.quality_gate(df)
    assert sorted(r.id for r in out.collect()) == [2, 5]  # 1 is small and flat; 3 and 4 have no pixels
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_row_gate_equals_the_pixel_table(spark):
    rng = np.random.default_rng(0)
    images = [(i, 1, rng.integers(0, 255, (int(rng.integers(2, 9)), 7)).astype(float).tolist()) for i in range(20)]
    px = [(i, x, y, v) for i, _, rows in images for y, row in enumerate(rows) for x, v in enumerate(row)]
    table = M.variance_p95(M.column_variance(spark.createDataFrame(px, "id long, x long, y long, v double")))
    want = {r.id: r.p95 for r in table.collect()}
    df = spark.createDataFrame(images, "id long, n_bytes long, rows array<array<double>>")
    got = {r.id: r.p for r in df.select("id", M.column_variance_p95("rows").alias("p")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_one_vector_per_key_and_pending_keys(spark):
    rows = [(f"k{i % 10}", [float(i % 10)] * 4) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, embedding array<float>").repartition(7)
    stored = spark.createDataFrame([("k1",), ("k1",), ("zz",)], "key string")
    pending = FE.pending_features(df, stored)
    assert pending.count() == 180 and pending.where("key = 'k1'").count() == 0
    out = FE.extract_embeddings(df, stored, FE.integer_scorer(4, 2), 4).collect()
    assert sorted(r.key for r in out) == [f"k{i}" for i in (0, 2, 3, 4, 5, 6, 7, 8, 9)]


def test_one_per_key_reads_its_input_once_and_keeps_the_smallest_hash(spark):
    rows = [(None if i % 11 == 0 else f"k{i % 11}", [float(i % 5)] * 4) for i in range(500)] + [("hot", [1.0] * 4)] * 500
    df = spark.createDataFrame(rows, "key string, embedding array<float>").repartition(7)
    read = spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    out = FE.one_per_key(df.mapInArrow(watch, df.schema))
    assert out.columns == df.columns
    found = out.collect()
    got = {r.key: list(r.embedding) for r in found}
    first = {}
    for r in df.selectExpr("key", "embedding", "xxhash64(key, embedding) AS h").orderBy("h").collect():
        first.setdefault(r.key, list(r.embedding))
    assert got == first and len(found) == 12
    assert read.value == 1000


def test_embed_images_decodes_every_image_once(spark, tmp_dir):
    rows = [(f"i{i}", None if i % 10 == 0 else [i] * 64) for i in range(40)]
    FL.write_gray_images(spark.createDataFrame(rows, "name string, px array<int>"), f"{tmp_dir}/img", "name", "px", 8, 8).collect()
    images, decoded = IM.scan_images(spark, f"{tmp_dir}/img"), spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            decoded.add(b.num_rows)
            yield b
    stored = spark.createDataFrame([("i1",), ("i2",)], "key string")
    out = FE.embed_images(images.mapInArrow(watch, images.schema), stored, FE.integer_scorer(64, 4), 64).collect()
    assert sorted(r.key for r in out) == sorted(n for n, px in rows if px is not None and n not in ("i1", "i2"))
    w = np.array([[(i * 7 + j * 13) % 5 - 2 for i in range(64)] for j in range(4)], dtype=np.float64)
    for r in out:
        x = np.floor(np.full(64, (int(r.key[1:]) / 255.0 - 0.5) / 0.5) * 1000)
        assert list(r.feature) == list((x @ w.T).astype(np.float32))
    assert decoded.value == 40


def test_resize_half_even(spark):
    df = spark.createDataFrame([(1000, 501), (4, 4), (1001, 1000)], "w long, h long")
    got = [tuple(r[0]) for r in df.select(P.resize_policy("w", "h", 500)).collect()]
    assert got == [(500, 250), (4, 4), (500, 500)]  # 250.5 -> 250, 499.5... -> 500
