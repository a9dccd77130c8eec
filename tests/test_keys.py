import hashlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusprep.functions import keys as K


def py_key(url: str) -> str:
    # the rule: every MD5 byte printed as %x (no zero padding)
    return "".join("%x" % b for b in hashlib.md5(url.encode("utf-8")).digest())


URLS = ["", "a", "http://x.y/z.jpg", "ünïcødé/路径", "0" * 100]


def test_key_matches_python_rule(spark):
    # strings chosen to include MD5 bytes below 16 (leading zero nibbles)
    urls = URLS + [f"u{i}" for i in range(300)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = dict(df.select("url", K.derive_key("url").alias("k")).collect())
    for u in urls:
        assert got[u] == py_key(u)
    assert any(len(v) < 32 for v in got.values())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=40), min_size=1, max_size=20))
def test_key_property(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    for u, k in df.select("url", K.derive_key("url")).collect():
        assert k == py_key(u)
        assert 16 <= len(k) <= 32


def test_null_url_has_no_key(spark):
    df = spark.createDataFrame([(None,)], "url string")
    assert df.select(K.derive_key("url")).first()[0] is None


def test_shard_and_candidates(spark):
    df = spark.createDataFrame([("abcdef0123", 0, "png"), ("abcdef0123", 1, "jpg")],
                               "key string, marker int, ext string")
    rows = df.select(F.posexplode(K.candidate_struct("key", "marker", "ext"))).collect()
    paths = [(r.pos, r.col.object_key) for r in rows]
    assert paths == [(0, "data/images/abc/def/abcdef0123.jpg"), (1, "data/images/abc/def/abcdef0123.png"),
                     (0, "data/videos/mp4/abc/def/abcdef0123.mp4"), (1, "data/videos/mp4/abc/def/abcdef0123.jpg")]
    assert df.select(K.derive_shard("key")).first()[0] == "abc"


def test_key_of_object_inverts_candidates(spark):
    df = spark.createDataFrame([("abcdef0123", 0, "weird.ext/x"), ("0123456789", 1, "mp4")],
                               "key string, marker int, ext string")
    for k, c, a in df.select("key", K.key_of_object(K.canonical_key("key", "marker")),
                             K.key_of_object(K.alternate_key("key", "marker", "ext"))).collect():
        assert k == c == a


def test_hex_range_inclusive_and_padded(spark):
    names = [r.shard for r in K.hex_range(spark, "500", "50F").collect()]
    assert names == [f"50{c}" for c in "0123456789abcdef"]
    assert K.hex_range(spark, "5", "7").collect()[0].shard == "005"
    assert K.hex_range(spark, "fff", "ffe").count() == 0
    assert K.shard_domain(spark).count() == 4096
    # past fff the name is longer than 3 chars, never truncated
    assert [r.shard for r in K.hex_range(spark, "fff", "1000").collect()] == ["fff", "1000"]


def test_in_hex_range_filter(spark):
    df = K.shard_domain(spark)
    assert df.where(K.in_hex_range("shard", "3a0", "3AF")).count() == 16
    assert df.where(K.in_hex_range("shard", "f00", "fff")).count() == 256


def test_stem_rules(spark):
    df = spark.createDataFrame([("x/y/a.b.jpg",), ("k.jpg",), (".hidden",), ("noext",)], "n string")
    got = df.select(K.stem_last_suffix("n"), K.stem_first_dot("n")).collect()
    assert [tuple(r) for r in got] == [("a.b", "a"), ("k", "k"), (".hidden", ""), ("noext", "noext")]


def test_kind_codes(spark):
    assert K.kinds_to_codes(["images", "videos", 1]) == [0, 1, 1]
    df = spark.createDataFrame([("images",), ("videos",), ("other",)], "k string")
    assert [r[0] for r in df.select(K.kind_code("k")).collect()] == [0, 1, None]
