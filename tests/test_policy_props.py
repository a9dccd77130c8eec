"""Policy, coercion and name rules: expected values worked out by hand, and
properties that hold for any input."""
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusprep.functions import keys as K
from corpusprep.functions import policy as P
from corpusprep.operators import samples as S

# width, height, target -> new width, new height
RESIZED = [
    (1000, 501, 500, 500, 250),    # 250.5: half goes to even
    (1000, 503, 500, 500, 252),    # 251.5: half goes to even
    (501, 1000, 500, 250, 500),
    (750, 375, 500, 750, 375),     # exactly 1.5 times the target's pixels: as it is
    (751, 375, 500, 500, 250),     # one column more: 249.67
    (4, 4, 500, 4, 4),
    (6000, 1, 500, 6000, 1),       # few pixels, however long
    (2000, 2000, 500, 500, 500),
    (300, 40, 100, 100, 13),       # target 100 x 75: 12,000 pixels are too many; 13.33
    (150, 75, 100, 150, 75),       # 11,250 pixels: the limit
]


def test_resize_table(spark):
    for w, h, t, nw, nh in RESIZED:
        got = spark.createDataFrame([(w, h)], "w long, h long").select(P.resize_policy("w", "h", t)).first()[0]
        assert tuple(got) == (nw, nh), (w, h, t)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6000), st.integers(1, 6000)), min_size=1, max_size=50), st.sampled_from([100, 333, 500, 1024]))
def test_resize_bounds_and_symmetry(spark, dims, t):
    df = spark.createDataFrame([(w, h) for w, h in dims] + [(h, w) for w, h in dims], "w long, h long")
    got = [tuple(r[0]) for r in df.select(P.resize_policy("w", "h", t)).collect()]
    n = len(dims)
    for (w, h), (a, b), (c, d) in zip(dims, got[:n], got[n:], strict=True):
        assert (a, b) == (d, c)                               # turning an image turns its result
        assert (a, b) == (w, h) or max(a, b) == t             # untouched, or the long side is the target
        assert (a >= b) == (w >= h) or a == b


GATED = [  # marker, width, height, already, re-encoded, chroma kept in full
    (0, 500, 375, False, True, False), (0, 250, 375, False, False, True), (0, 251, 375, False, True, False),
    (1, 500, 375, False, False, False), (0, 500, 375, True, False, False), (0, 500, 375, None, True, False), (0, 1, 1, False, False, True),
]


def test_gate_and_subsampling_table(spark):
    df = spark.createDataFrame([r[:4] for r in GATED], "marker int, w long, h long, already boolean")
    out = df.select(P.recompress_gate("marker", "w", "h", 85, F.col("already"), 500).alias("g"),
                    P.subsampling_policy("w", "h", "420", 500).alias("s")).collect()
    assert [r.g for r in out] == [r[4] for r in GATED]
    assert [r.s for r in out] == ["444" if r[5] else "420" for r in GATED]
    assert not df.select(P.recompress_gate("marker", "w", "h", None).alias("g")).where("g").count()


def test_float_coercion_tables(spark):
    numbers = [(None, None), (0.0, None), (-0.0, None), (0.5, 0.5), (-7.25, -7.25), (1e300, 1e300)]
    df = spark.createDataFrame([("u", i, v) for i, (v, _) in enumerate(numbers)], "downloadurl string, i int, latitude double")
    got = {r.i: r.latitude for r in S.create_samples(df, strict=False).collect()}
    assert got == {i: w for i, (_, w) in enumerate(numbers)}
    texts = [(None, None), ("", None), ("0", 0.0), ("0.0", 0.0), ("-12", -12.0), ("3.5", 3.5)]
    df = spark.createDataFrame([("u", i, v) for i, (v, _) in enumerate(texts)], "downloadurl string, i int, longitude string")
    got = {r.i: r.longitude for r in S.create_samples(df, strict=False).collect()}
    assert got == {i: w for i, (_, w) in enumerate(texts)}


@settings(max_examples=10, deadline=None)
@given(st.integers(0, 0xfff), st.integers(0, 64))
def test_hex_ranges_are_sorted_complete_and_fixed_width(spark, a, span):
    b = min(a + span, 0xfff)
    got = [r.shard for r in K.hex_range(spark, format(a, "x"), format(b, "X")).collect()]
    assert got == sorted(got) and len(got) == b - a + 1
    assert all(len(s) == 3 and s == s.lower() for s in got)
    assert int(got[0], 16) == a and int(got[-1], 16) == b


def test_hex_range_filter_takes_shard_names_only(spark):
    names = ["39f", "3a0", "3zz", "4g1", "3A1", "c3f", "c40", "03a0", "3a", "", None, "abc", "+3b"]
    df = spark.createDataFrame([(n,) for n in names], "shard string")
    assert [r.shard for r in df.where(K.in_hex_range("shard", "3a0", "C3F")).collect()] == ["3a0", "c3f", "abc"]
    assert df.where(K.in_hex_range("shard", "500", "400")).count() == 0
    assert df.where(K.in_hex_range("shard", "1000", "2000")).count() == 0


STEMS = [  # name, up to the first dot, without the last suffix
    ("data/images/abc/abc123.jpg", "abc123", "abc123"), ("abc.tar.gz", "abc", "abc.tar"), (".hidden", "", ".hidden"), ("a.", "a", "a."),
    ("a.b.", "a", "a.b."), ("dir.d/name", "name", "name"), ("noext", "noext", "noext"), ("x/.b.c", "", ".b"), ("a/b.c/", "", "b"),
    ("..b", "", "."), ("a b.c", "a b", "a b"),
]


def test_stem_table(spark):
    df = spark.createDataFrame([(n,) for n, _, _ in STEMS], "n string")
    got = [tuple(r) for r in df.select("n", K.stem_first_dot("n"), K.stem_last_suffix("n")).collect()]
    assert got == STEMS


def test_filter_user_callable(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "n int, s string")
    assert sorted(r.n for r in S.filter_user(df, lambda row: row["n"] % 2 == 1).collect()) == [1, 3]
