"""Document fingerprints from prefix polynomial hashes.

``Prefix`` holds, for one text, the modular prefix sums of its code points
times falling powers of a base, for two primes. From them any span's hash is
one subtraction and one product, whatever its place, so two spans compare in
constant time and the longest common extension is a binary search.

A fingerprint is the whole text's hash and length and the ``SKETCH`` smallest
hashes of its spans of ``SPAN`` code points (a shorter text is one span). A text
of under ``8 * SPAN`` points has a second sketch, of narrower spans: an eighth of
its length, rounded down to a power of two, and 2 at least (1 below 4 points).
The likeness of two texts estimates the share of spans they have in common
(2 |A and B| / (|A| + |B|)) from the smallest hashes of the union; both are cut
into spans of the shorter text's width, so a text that keeps half of its points,
or all but one, also keeps spans.

``edited_report`` compares every text with the next one and with an edited text
made of both. Neighbours by descending id are found without a global sort in
one task: rows are dealt to ``buckets`` id ranges whose bounds are fixed numbers,
each range is sorted, and the first row of each range is also sent to the
range before it (at most one extra row a range).

Edge cases: a null text is an empty one; an empty text has no spans, is 1 like
another empty text and 0 like any other; rows with a null id come last, ordered
by text hash; rows with one id are ordered by text hash (full copies: any
order); a single row is its own next; an empty table gives no rows; columns
other than id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import range_bounds, range_of, shuffle_partitions

PRIME = np.uint64((1 << 31) - 1)
BASES = (1_000_003, 814_279_211)
SPAN = 32
SKETCH = 64
DIGITS = 10
CHUNK = 1 << 16
RANGES_PER_PARTITION = 6


def _reduce(x: np.ndarray) -> np.ndarray:
    """Below 2**32, and then below the prime 2**31 - 1, from any 63-bit number."""
    x = (x & PRIME) + (x >> np.uint64(31))
    x = (x & PRIME) + (x >> np.uint64(31))
    return np.where(x >= PRIME, x - PRIME, x)


def _powers(base: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < CHUNK:
        out = np.concatenate([out, _reduce(out * np.uint64(pow(base, len(out), int(PRIME))))])
    return out[:CHUNK]


class _Field:
    """Powers of a base and of its inverse, a chunk at a time."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, int(PRIME))
        self.up, self.down = _powers(base), _powers(self.inverse)

    def rising(self, start: int, n: int) -> np.ndarray:
        return _reduce(self.up[:n] * np.uint64(pow(self.base, start, int(PRIME)))) if start else self.up[:n]

    def falling(self, start: int, n: int) -> np.ndarray:
        return _reduce(self.down[:n] * np.uint64(pow(self.inverse, start, int(PRIME)))) if start else self.down[:n]


_FIELDS: list[_Field] = []


def _fields() -> list[_Field]:
    if not _FIELDS:
        _FIELDS.extend(map(_Field, BASES))
    return _FIELDS


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Prefix:
    """Prefix hashes of code points; ``of`` another's first ``keep`` points, if given, then ``points``."""

    def __init__(self, points: np.ndarray, of: Prefix | None = None, keep: int = 0):
        n = keep + len(points)
        self.n = n
        self.sums = []
        for k, f in enumerate(_fields()):
            s = np.zeros(n + 1, np.uint32)
            if keep:
                s[:keep + 1] = of.sums[k][:keep + 1]
            for a in range(0, len(points), CHUNK):
                part = points[a:a + CHUNK].astype(np.uint64) + np.uint64(1)
                term = _reduce(part * f.falling(keep + a, len(part)))
                s[keep + a + 1:keep + a + 1 + len(part)] = _reduce(np.cumsum(term) + np.uint64(s[keep + a]))
            self.sums.append(s)

    def spans(self, starts: int, ends: int, width: int) -> np.ndarray:
        """64-bit hashes of the spans of ``width`` points that start in ``starts..ends``."""
        out = np.zeros(max(0, ends - starts), np.uint64)
        for a in range(starts, ends, CHUNK):
            z = min(ends, a + CHUNK)
            both = []
            for s, f in zip(self.sums, _fields(), strict=True):
                diff = s[a + width:z + width].astype(np.uint64) + PRIME - s[a:z]
                both.append(_reduce(_reduce(diff) * f.rising(a, z - a)))
            out[a - starts:z - starts] = _mix((both[0] << np.uint64(31)) ^ both[1])
        return out

    def span(self, start: int, end: int) -> int:
        """Hash of one span (equal spans of equal length: equal hashes)."""
        v = 0
        for s, f in zip(self.sums, _fields(), strict=True):
            p = int(PRIME)
            v = (v << 31) | (int(s[end]) - int(s[start])) * pow(f.base, start, p) % p
        return v

    def extension(self, start: int, other: Prefix, at: int) -> int:
        """Longest common extension: how far the texts agree from ``start`` and ``at`` on."""
        low, high = 0, min(self.n - start, other.n - at)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(start, start + mid) == other.span(at, at + mid):
                low = mid
            else:
                high = mid - 1
        return low

    def sketch(self, width: int = SPAN) -> np.ndarray:
        """The ``SKETCH`` smallest distinct span hashes (top 40 bits), ascending."""
        if not self.n:
            return np.zeros(0, np.uint64)
        width = min(width, self.n)
        h = self.spans(0, self.n - width + 1, width) >> np.uint64(64 - 4 * DIGITS)
        return smallest(h)


def span_width(n: int) -> int:
    """Width of the spans by which a text of ``n`` points is compared."""
    return 1 if n < 4 else min(SPAN, max(2, 1 << (n // 8).bit_length() >> 1))


def smallest(h: np.ndarray) -> np.ndarray:
    limit, n = SKETCH, len(h)
    if n > 8 * limit:  # a first cut that holds enough, unless spans repeat a lot
        few = np.unique(h[h < np.uint64((1 << (4 * DIGITS)) * 3 * limit // n)])
        if len(few) >= limit:
            return few[:limit]
    return np.unique(h)[:limit]


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits, so that the smallest hashes are a fair sample."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hex(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - DIGITS // 2:].tobytes().hex()


def fingerprint(p: Prefix, sketch: np.ndarray) -> str:
    """Hash and length of the whole text, then the sketch, in hex; of a short
    text also ``:`` and the sketch of its narrower spans."""
    width = span_width(p.n)
    return f"{p.span(0, p.n):016x}{p.n:08x}{_hex(sketch)}" + (f":{_hex(p.sketch(width))}" if width < SPAN else "")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of spans two sketches have in common, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.unique(np.concatenate([a, b]))[:SKETCH if len(a) >= SKETCH or len(b) >= SKETCH else None]
    same = np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)
    j = float(same.sum()) / len(both)
    return 2 * j / (1 + j)


def near(p: Prefix, a: np.ndarray, q: Prefix, b: np.ndarray) -> float:
    """Likeness of two texts with sketches ``a`` and ``b``, by spans of the shorter one's width."""
    width = span_width(min(p.n, q.n))
    return likeness(a, b) if width == SPAN or not p.n or not q.n else likeness(p.sketch(width), q.sketch(width))


class _Doc:
    __slots__ = ("bucket", "name", "points", "prefix", "sketch")

    def __init__(self, bucket, name, text):
        self.bucket, self.name, self.points = bucket, name, code_points(text)
        self.prefix = Prefix(self.points)
        self.sketch = self.prefix.sketch()


def _compare(doc: _Doc, following: _Doc) -> tuple:
    n = doc.prefix.n
    half = n // 2
    donor = following.points[:half]
    edited = Prefix(donor, doc.prefix, n - half)
    sketch = edited.sketch()
    text = np.concatenate([doc.points[:n - half], donor]).tobytes().decode("utf-32-le", "surrogatepass")
    return (doc.name, n, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
            fingerprint(doc.prefix, doc.sketch), fingerprint(edited, sketch),
            near(doc.prefix, doc.sketch, edited, sketch), near(doc.prefix, doc.sketch, following.prefix, following.sketch), doc.prefix.extension(0, edited, 0))


_OUT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("edit_start", pa.int64())]


def _neighbours(batches):
    """Of rows ``(range, own, doc_id, text)`` in order, each own row against the one after it."""
    last = None
    for b in batches:
        rows = []
        for bucket, own, name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
            now = _Doc(bucket, name, text.as_py() or "")
            if last is not None and last.bucket == bucket:
                rows.append(_compare(last, now))
            last = now if own else None
        cols = zip(*rows, strict=True) if rows else [()] * len(_OUT)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _OUT, strict=True)], names=[n for n, _ in _OUT])


def edited_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, edit_start`` (the first place
    where the edited text differs, or its end)."""
    spark = docs.sparkSession
    # several ranges a partition, so that partitions come out even
    n = buckets or RANGES_PER_PARTITION * shuffle_partitions(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    bounds = range_bounds(src, "doc_id", n)
    h = F.xxhash64("text")
    # ranges in order of descending id; null ids after them, by hash
    place = F.when(F.col("doc_id").isNull(), F.shiftrightunsigned(h, 60).cast("int") + len(bounds) + 1).otherwise(F.lit(len(bounds)) - range_of(bounds, "doc_id"))
    rows = src.withColumn("_h", h).withColumn("_range", place.cast("int"))
    firsts = sorted(rows.groupBy("_range").agg(F.max(F.struct("doc_id", F.bitwise_not("_h").alias("h"))).alias("f"))
                    .select("_range", "f.doc_id", F.bitwise_not("f.h").alias("h")).collect())  # at most one row a range
    if not firsts:
        return spark.createDataFrame([], ", ".join(f"{c} {'long' if t == pa.int64() else 'double' if t == pa.float64() else 'string'}" for c, t in _OUT))
    # each range is followed by the next range's first row, the last one by the first range's
    follow = spark.createDataFrame([(firsts[i - 1][0], f[0], f[1], f[2]) for i, f in enumerate(firsts)], "_before int, _at int, _id long, _fh long")
    extra = rows.join(F.broadcast(follow), (F.col("_range") == F.col("_at")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_fh"))) \
        .dropDuplicates(["_at"]).select(F.col("_before").alias("_range"), F.lit(False).alias("_own"), "doc_id", "text", "_h")
    dealt = rows.select("_range", F.lit(True).alias("_own"), "doc_id", "text", "_h").unionByName(extra) \
        .repartition(max(1, n // RANGES_PER_PARTITION), "_range").sortWithinPartitions("_range", F.desc("_own"), F.desc_nulls_last("doc_id"), "_h")
    schema = ", ".join(f"{c} {'long' if t == pa.int64() else 'double' if t == pa.float64() else 'string'}" for c, t in _OUT)
    return dealt.select("_range", "_own", "doc_id", "text").mapInArrow(_neighbours, schema)
