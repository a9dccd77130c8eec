"""WARC: resolving not-modified revisits.

A revisit record stands for a capture whose server answered "not modified"; its
content is that of an earlier full response. ``resolve_revisits`` finds, for
each revisit, the latest full response (status 200) of the same canonical URL
with an earlier time, checks the validators both records carry, and merges the
headers a not-modified answer may update into those of the response.

* Canonical URL: no scheme, user, fragment or default port, host in lower case
  without a leading ``www``, single slashes in the path and none at its end,
  query parameters sorted, tracking parameters left out.
* As-of join: the records of a URL are ordered by time in windows, one for each
  range of time (``time_ranges`` fixed bounds over all records); the last
  response of earlier ranges comes from a grouped aggregate. A URL with a
  third of all records is thus spread over the ranges. Of responses of one
  time the largest record id counts as the latest.
* Validators: entity tags (compared weakly), modification dates, payload
  digests. A pair that both records carry must agree; at least one must be
  there. Outcomes: ``resolved``, ``no-response``, ``mismatch``, ``no-validator``.
* Headers: names in lower case; the answer's win, but for those describing the
  message or its body, which a not-modified answer cannot update.

Payloads are not moved: the result names the response (``response_id``);
``with_payload`` joins its payload where it is wanted.

Edge cases: a revisit with a null URL or time has no response; null validators
are not carried; null headers are no headers; repeated records each give a row;
an empty table gives no rows; columns other than the record's are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import hot_keys, lookup_join, range_bounds, range_of, shuffle_partitions

#: Ranges of time, at least; as many as shuffle partitions where those are more.
TIME_RANGES = 64
#: Query parameters that do not change a page, headers a
#: not-modified answer does not update.
TRACKING = r"^(utm_[a-z]+|ref|gclid|fbclid|sessionid)(=|$)"
KEPT_HEADERS = ("connection", "content-encoding", "content-length", "content-location", "content-range", "content-type",
                "keep-alive", "proxy-authenticate", "te", "trailer", "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    site = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), r"^.*@", "")
    site = F.regexp_replace(F.regexp_replace(site, r":(80|443)?$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*(/[^?]*)", 1), r"/+", "/"), r"/$", "")
    params = F.array_sort(F.filter(F.split(F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(site, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(F.lit("")))


def _lower_keys(headers: Column) -> Column:
    pairs = F.transform(F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))),
                        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(pairs, lambda e: e["key"]))
    # of names that differ in case only, the first in code point order
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("key"), F.get(F.filter(pairs, lambda e: e["key"] == n), F.lit(0))["value"].alias("value"))))


def merge_headers(stored: Column, update: Column) -> Column:
    """``stored`` updated by the permitted headers of ``update`` (names in lower case)."""
    permitted = F.map_filter(update, lambda k, _: ~k.isin(*KEPT_HEADERS))
    return F.map_concat(F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(permitted), k)), permitted)


def resolve_revisits(records: DataFrame, time_ranges: int | None = None) -> DataFrame:
    """One row per revisit of ``records(record_id, kind, url, time, status, etag,
    last_modified, digest, headers)``: ``record_id, canonical_url, outcome,
    response_id, response_time, headers``."""
    own = ["record_id", "time", "etag", "last_modified", "digest", "headers"]
    r = records.select(F.col("record_id").cast("long").alias("record_id"), "kind", canonical_url(F.col("url")).alias("canonical_url"),
                       F.col("time").cast("long").alias("time"), F.col("status").cast("int").alias("status"),
                       "etag", "last_modified", "digest", _lower_keys(F.col("headers")).alias("headers"))
    ranges = time_ranges or max(TIME_RANGES, shuffle_partitions(records.sparkSession))
    place = range_of(range_bounds(r, "time", ranges), "time")
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("time").isNotNull() & F.col("record_id").isNotNull()
    revisit = F.col("kind") == "revisit"
    # revisits without URL or time are kept apart, spread by id
    lost = F.when(F.col("canonical_url").isNull() | F.col("time").isNull(), F.xxhash64("record_id"))
    r = r.withColumn("_range", F.when(F.col("time").isNotNull(), place)).withColumn("_lost", lost) \
        .withColumn("_full", F.coalesce(full & F.col("_lost").isNull(), F.lit(False))).where(revisit | F.col("_full")) \
        .withColumn("_resp", F.when(F.col("_full"), F.struct(*own)))
    keys = ["canonical_url", "_lost", "_range"]
    lasts = r.where("_full").groupBy("canonical_url", "_range").agg(F.max_by("_resp", F.struct("time", "record_id")).alias("_last"))
    # a row for every range of a URL that has revisits, to carry responses of earlier ranges to
    asked = r.where(revisit & F.col("_lost").isNull()).select("canonical_url", "_range").distinct()
    chain = lasts.join(asked, ["canonical_url", "_range"], "full")
    before = Window.partitionBy("canonical_url").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = chain.select(F.col("canonical_url").alias("_u"), F.col("_range").alias("_r"), F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    inside = Window.partitionBy(*keys).orderBy("time", "_full", "record_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = r.withColumn("_near", F.last("_resp", ignorenulls=True).over(inside)).where(revisit)
    hit = near.join(carry, (F.col("canonical_url") == F.col("_u")) & (F.col("_range") == F.col("_r")), "left") \
        .withColumn("_hit", F.coalesce("_near", "_carry"))

    weak = lambda tag: F.regexp_replace(tag, "^W/", "")
    checks = F.array_compact(F.array(weak(F.col("etag")) == weak(F.col("_hit.etag")), F.col("last_modified") == F.col("_hit.last_modified"),
                                     F.col("digest") == F.col("_hit.digest")))
    outcome = F.when(F.col("_hit").isNull(), "no-response").when(F.size(checks) == 0, "no-validator") \
        .when(F.forall(checks, lambda c: c), "resolved").otherwise("mismatch")
    done = hit.withColumn("outcome", outcome)
    ok = F.col("outcome") == "resolved"
    return done.select("record_id", "canonical_url", "outcome", F.when(ok, F.col("_hit.record_id")).alias("response_id"),
                       F.when(ok, F.col("_hit.time")).alias("response_time"),
                       F.when(ok, merge_headers(F.col("_hit.headers"), F.col("headers"))).alias("headers"))


def with_payload(resolved: DataFrame, records: DataFrame, payload_col: str = "payload") -> DataFrame:
    """``resolved`` with its response's payload: one shuffle of the payloads;
    a response that many revisits name is salted."""
    counts = resolved.where("response_id is not null").groupBy("response_id").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(counts, "response_id", "n", resolved.count())
    payloads = records.where(F.col("kind") == "response").dropDuplicates(["record_id"]) \
        .select(F.col("record_id").alias("response_id"), F.col(payload_col).alias("payload"))
    return lookup_join(resolved, payloads, "response_id", hot, F.xxhash64("record_id"))


def header_text(headers: Column) -> Column:
    """``name=value`` pairs by name, ``&`` between them."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat_ws("=", e["key"], e["value"])), "&")


def page_records(pages: DataFrame) -> DataFrame:
    """Capture records of a crawl over ``pages(page_id, url, html)``: for each
    page the response that brought it and a later (of every 13th an earlier)
    revisit under another spelling of its address."""
    p = F.col("page_id")
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"'))
    digest = F.concat(F.lit("md5:"), F.md5("html"))
    at = p * 60 + 1_700_000_000
    then = F.when(p % 13 == 0, at - 30).otherwise(at + 90 * (1 + p % 7))
    modified = F.when(p % 2 == 0, F.concat(F.lit("day-"), (p % 365).cast("string")))
    text = lambda c: c.cast("string")
    response = F.struct(
        (p * 2).alias("record_id"), F.lit("response").alias("kind"), F.col("url"), at.alias("time"),
        F.when(p % 11 == 0, 404).otherwise(200).alias("status"),
        F.when(p % 5 != 0, F.when(p % 3 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag)).alias("etag"),
        modified.alias("last_modified"), digest.alias("digest"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), text(F.length("html")),
                     F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Date"), text(at)).alias("headers"))
    spelled = F.concat(F.regexp_replace(F.regexp_replace("url", "^http://", "HTTPS://"), "#.*$", ""), F.lit("#again"))
    revisit = F.struct(
        (p * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), spelled.alias("url"), then.alias("time"), F.lit(304).alias("status"),
        F.when(p % 5 != 0, F.when(p % 7 == 0, F.lit('"changed"')).otherwise(tag)).alias("etag"),
        F.when(p % 4 == 0, modified).alias("last_modified"), F.when(p % 6 == 0, digest).alias("digest"),
        F.create_map(F.lit("cache-control"), F.lit("max-age=120"), F.lit("content-length"), F.lit("0"), F.lit("date"), text(then),
                     F.lit("x-cache"), F.lit("hit")).alias("headers"))
    return pages.select(F.explode(F.array(response, revisit)).alias("r")).select("r.*")


def revisit_report(pages: DataFrame) -> DataFrame:
    out = resolve_revisits(page_records(pages))
    return out.select("record_id", "canonical_url", "outcome", "response_id", "response_time", header_text(F.col("headers")).alias("headers"))


#: DuckDB SQL of ``revisit_report``.
ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id AS p, url, length(html) AS n, '"' || substr(md5(html), 1, 16) || '"' AS tag, 'md5:' || md5(html) AS digest,
         CASE WHEN page_id % 2 = 0 THEN 'day-' || (page_id % 365) END AS modified,
         page_id * 60 + 1700000000 AS at_, CASE WHEN page_id % 13 = 0 THEN page_id * 60 + 1700000000 - 30
                                           ELSE page_id * 60 + 1700000000 + 90 * (1 + page_id % 7) END AS then_ FROM pages),
s AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') AS rest FROM p),
t AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)?$', ''), '^www[0-9]*\.', '')
         || regexp_replace(regexp_replace(regexp_extract(rest, '^[^/?]*(/[^?]*)', 1), '/+', '/', 'g'), '/$', '') AS site,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'),
                               lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid|sessionid)(=|$)'))) AS params FROM s),
u AS (
  SELECT *, site || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS cu FROM t),
v AS (
  SELECT u.p * 2 + 1 AS record_id, u.cu AS canonical_url, u.then_, u.modified, u.tag, u.digest, u.p,
         (SELECT max(struct_pack(t := w.at_, id := w.p)) FROM u w WHERE w.cu = u.cu AND w.at_ < u.then_ AND w.p % 11 <> 0).id AS hit FROM u),
c AS (
  SELECT v.*, w.at_ AS rt, w.n AS rn,
    CASE WHEN v.p % 5 <> 0 AND w.p % 5 <> 0 THEN (CASE WHEN v.p % 7 = 0 THEN '"changed"' ELSE v.tag END) = w.tag END AS c1,
    CASE WHEN v.p % 4 = 0 THEN v.modified = w.modified END AS c2,
    CASE WHEN v.p % 6 = 0 THEN v.digest = w.digest END AS c3
  FROM v LEFT JOIN u w ON v.hit = w.p),
o AS (
  SELECT *, CASE WHEN hit IS NULL THEN 'no-response' WHEN c1 IS NULL AND c2 IS NULL AND c3 IS NULL THEN 'no-validator'
                 WHEN coalesce(c1, true) AND coalesce(c2, true) AND coalesce(c3, true) THEN 'resolved' ELSE 'mismatch' END AS outcome FROM c)
SELECT record_id, canonical_url, outcome, CASE WHEN outcome = 'resolved' THEN hit * 2 END AS response_id,
       CASE WHEN outcome = 'resolved' THEN rt END AS response_time,
       CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=120&content-length=' || rn || '&content-type=text/html&date=' || then_ || '&x-cache=hit' END AS headers
FROM o
"""
