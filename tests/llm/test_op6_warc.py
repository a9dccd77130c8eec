import os

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import warc

SCHEMA = "record_id long, kind string, url string, time long, status int, etag string, last_modified string, digest string, headers map<string,string>"


def response(i, url, time, etag=None, modified=None, digest=None, headers=None, status=200):
    return (i, "response", url, time, status, etag, modified, digest, headers)


def revisit(i, url, time, etag=None, modified=None, digest=None, headers=None):
    return (i, "revisit", url, time, 304, etag, modified, digest, headers)


def run(spark, rows, **kw):
    return {r.record_id: r for r in warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA).repartition(3), **kw).collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_report_against_sql(spark, sf):
    path = f"/root/testdata/{sf}/pages.parquet"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{path}'")
    want = sorted(con.sql(warc.ORACLE_SQL).fetchall())
    got = sorted(tuple(r) for r in warc.revisit_report(spark.read.parquet(path)).collect())
    assert got == want and os.path.exists(path)
    assert {r[2] for r in got} >= {"resolved", "no-response", "mismatch"}


def test_canonical_urls(shipped):
    cases = {
        "HTTP://www.Example.COM:80/a//b/?utm_source=x&b=2&a=1#top": "example.com/a/b?a=1&b=2",
        "https://user:pw@example.com:443/": "example.com",
        "https://example.com:8080/x?ref=1": "example.com:8080/x",
        "http://www2.example.com?q=1": "example.com?q=1",
        "http://m.example.com/A/": "m.example.com/A", "": "",
    }
    df = shipped.createDataFrame([(u,) for u in cases], "u string")
    assert {r[0]: r[1] for r in df.select("u", warc.canonical_url(F.col("u"))).collect()} == cases


def test_latest_earlier_response_and_ties(shipped):
    rows = [
        response(1, "http://a/x", 10, "e1"), response(2, "https://a/x/", 20, "e2"), response(3, "http://a/x", 20, "e3"), response(4, "http://a/x", 20, "e0", status=404),
        revisit(10, "http://a/x#f", 10, "e1"), revisit(11, "http://a/x", 11, "e1"), revisit(12, "http://a/x", 20, "W/e1"), revisit(13, "http://a/x", 21, "e3"),
        revisit(14, "http://a/x", 21, "e2"), revisit(15, "http://a/y", 99, "e1"), revisit(16, None, 99, "e1"), revisit(17, "http://a/x", None, "e1"),
        revisit(13, "http://a/x", 21, "e3"),
    ]
    for ranges in (1, 4, 64):
        got = run(shipped, rows, time_ranges=ranges)
        assert {i: (r.outcome, r.response_id) for i, r in got.items()} == {
            10: ("no-response", None), 11: ("resolved", 1), 12: ("resolved", 1), 13: ("resolved", 3), 14: ("mismatch", None),
            15: ("no-response", None), 16: ("no-response", None), 17: ("no-response", None)}
    assert warc.resolve_revisits(shipped.createDataFrame(rows, SCHEMA)).count() == 9


def test_validators(shipped):
    rows = [response(1, "u", 1, "e", "m", "d"), response(2, "v", 1)]
    rows += [revisit(10, "u", 2), revisit(11, "u", 2, "e"), revisit(12, "u", 2, None, "m"), revisit(13, "u", 2, None, None, "d"), revisit(14, "u", 2, "e", "n"),
             revisit(15, "u", 2, "f", "m", "d"), revisit(16, "v", 2, "e", "m", "d"), revisit(17, "u", 2, "W/e", "m", "d")]
    got = run(shipped, rows)
    assert {i: r.outcome for i, r in got.items()} == {10: "no-validator", 11: "resolved", 12: "resolved", 13: "resolved", 14: "mismatch",
                                                     15: "mismatch", 16: "no-validator", 17: "resolved"}


def test_headers(shipped):
    stored = {"Content-Type": "text/html", "Content-Length": "9", "Date": "1", "X-A": "a", "x-a": "b", "ETag": "e"}
    rows = [response(1, "u", 1, "e", headers=stored), response(2, "v", 1, "e"),
            revisit(10, "u", 2, "e", headers={"DATE": "2", "content-length": "0", "X-New": None, "Transfer-Encoding": "chunked"}),
            revisit(11, "u", 2, "e"), revisit(12, "v", 2, "e", headers={"Date": "3"})]
    got = run(shipped, rows)
    assert got[10].headers == {"content-type": "text/html", "content-length": "9", "date": "2", "x-a": "a", "etag": "e", "x-new": None}
    assert got[11].headers == {"content-type": "text/html", "content-length": "9", "date": "1", "x-a": "a", "etag": "e"}
    assert got[12].headers == {"date": "3"}


def test_one_hot_url_against_a_scan(shipped):
    import random
    rng = random.Random(3)
    rows, i = [], 0
    for _ in range(1500):
        i += 1
        t = rng.randrange(400)
        url = "http://hot/" if rng.random() < 0.7 else f"http://cold/{rng.randrange(9)}"
        rows.append(response(i, url, t, "e", status=rng.choice([200, 200, 304])) if rng.random() < 0.3 else revisit(i, url, t, "e"))
    got = run(shipped, rows, time_ranges=16)
    for r in rows:
        if r[1] == "revisit":
            best = max(((q[3], q[0]) for q in rows if q[1] == "response" and q[4] == 200 and q[2] == r[2] and q[3] < r[3]), default=None)
            assert got[r[0]].response_id == (best[1] if best else None)


def test_payload_empty_and_clashing(shipped):
    empty = shipped.createDataFrame([], SCHEMA)
    assert warc.resolve_revisits(empty).count() == 0
    df = shipped.createDataFrame([response(1, "u", 1, "e"), revisit(2, "u", 2, "e"), revisit(3, "w", 2, "e")], SCHEMA) \
        .withColumn("payload", F.concat(F.lit("body "), F.col("record_id"))).withColumn("outcome", F.lit(1)).withColumn("canonical_url", F.lit("x"))
    got = {r.record_id: r.payload for r in warc.with_payload(warc.resolve_revisits(df), df).collect()}
    assert got == {2: "body 1", 3: None}
