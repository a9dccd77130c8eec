"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: lower-cased ASCII letters, words are runs of anything but ASCII
white space, shingles of ``shingle`` words (fewer words: the whole sequence;
none: fingerprint zero), XXH64 with seed 42 of each; a bit is set where over
half of the hashes have it set.

Search: every bit position gets a nonzero code of ``radius + 1`` bits; each
nonzero vector ``v`` of as many bits gives one mask, the positions whose code
has an odd product with ``v``. Up to ``radius`` differing positions span at
most ``radius`` dimensions, so some ``v`` is orthogonal to all of their codes,
and its mask leaves all of them out: the pair meets in that table, always.
A bucket with more than ``BUCKET_ROWS`` distinct fingerprints is dealt again by
the same construction over the positions its mask left free, as long as more
than ``FREE`` are: fewer would not span all dimensions, and pairs would be lost.
After ``levels`` rounds so few positions are free that a bucket of *distinct*
fingerprints is bounded (2 ** free): no bucket needs a cap.

Edge cases: null and empty texts have fingerprint zero and link like others;
a null id never names a group (a group of null ids only has component null);
repeated rows share a fingerprint and so a group; an empty table gives no
rows. Columns of the input other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import hot_keys, lookup_join, materialize, sealed, spread_hash
from corpusprep.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BUCKET_ROWS = 1024
#: Positions over which no bucket is dealt again, however few rows it may have (``2 ** radius``: all codes' dimensions).
FREE = 8
CHUNK = 1 << 16


def fingerprint(data: bytes | None, shingle: int = SHINGLE_WORDS) -> bytes:
    """The 8 fingerprint bytes (most significant first) of one UTF-8 text."""
    words = data.lower().split() if data else []
    if not words:
        return bytes(8)
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        end = min(n, at + CHUNK)
        if len(words) <= shingle:
            joined = [b" ".join(words)]
        else:
            joined = map(b" ".join, zip(*(words[at + k:end + k] for k in range(shingle)), strict=True))
        h = np.array([digest(s, SEED) for s in joined], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def simhash_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id long, fp long)``, one row per input row; one narrow Arrow pass."""
    return _prints(docs, id_col, text_col, shingle).select("doc_id", "fp")


def _prints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(doc_id long, h long, fp long)``, ``h`` a hash of the text as it is."""
    def run(batches):
        for b in batches:
            texts = b.column(2).cast(pa.binary())
            fps = b"".join(fingerprint(t.as_py(), shingle) for t in texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.frombuffer(fps, ">i8").astype("i8"))], names=["doc_id", "h", "fp"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("h"),
                      F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, h long, fp long")


def covering_masks(free: list[int], radius: int) -> list[int]:
    """One mask per nonzero vector of ``radius + 1`` bits over the positions in ``free``."""
    top = (1 << (radius + 1)) - 1
    code = {p: 1 + i % top for i, p in enumerate(free)}
    return [sum(1 << p for p in free if bin(code[p] & v).count("1") % 2) for v in range(1, top + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _edges(radius: int):
    """Of each bucket (a row with ``fps`` and ``ids``) a spanning forest of its links."""
    def run(batches):
        for b in batches:
            left, right = [], []
            for fps, ids in zip(b.column(0), b.column(1), strict=True):
                x = np.array(fps.values.to_numpy(), dtype=np.int64).view(np.uint64)
                names = ids.values.to_numpy()
                order = np.argsort(names)
                x, names = x[order], names[order]
                todo = np.ones(len(x), bool)
                while todo.any():  # breadth-first from the smallest id left
                    root = int(np.argmax(todo))
                    todo[root] = False
                    front = [root]
                    while front:
                        i = front.pop()
                        near = np.flatnonzero(todo & (np.bitwise_count(x ^ x[i]) <= radius))
                        todo[near] = False
                        front.extend(near.tolist())
                        left.extend([names[root]] * len(near))
                        right.extend(names[near].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
    return run


def simhash_links(classes: DataFrame, radius: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges ``(a, b)`` between class ids whose components are those of all
    pairs of ``classes(fp, rep)`` at ``radius`` or fewer differing bits."""
    spark = classes.sparkSession
    full = (1 << 64) - 1
    masks = covering_masks(list(range(64)), radius)
    keyed = classes.select("fp", "rep", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    parts = None
    while True:
        keyed = keyed.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        # distinct masks may leave the same positions free; a bucket is named by mask and key
        free = {m: [p for p in range(64) if not (m & full) >> p & 1] for m in masks}
        stop = max(FREE, 1 << radius, bucket_rows.bit_length() - 1)  # 2 ** free <= bucket_rows, or all dimensions are in need
        masks = [m for m in masks if len(free[m]) > stop]
        wide = F.broadcast(spark.createDataFrame([(_signed(m),) for m in masks], "mask long"))
        big = keyed.join(wide, "mask", "left_semi").groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows)
        last = not masks
        deal = False if last else (big := materialize(big, "simhash-big")).limit(1).count() > 0
        fits = keyed.join(big, ["mask", "key"], "left_anti") if deal else keyed
        buckets = fits.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"), F.collect_list("rep").alias("ids")) \
            .where(F.size("fps") > 1).select("fps", "ids")
        edges = buckets.mapInArrow(_edges(radius), "a long, b long").distinct()
        parts = edges if parts is None else parts.union(edges)
        if not deal:
            return parts
        finer = [(_signed(m), _signed(m | s)) for m in masks for s in covering_masks(free[m], radius)]
        masks = [m & full for m in {b for _, b in finer}]
        table = F.broadcast(spark.createDataFrame(finer, "mask long, finer long"))  # 15 ** level rows
        keyed = keyed.join(big, ["mask", "key"], "left_semi").join(table, "mask") \
            .select("fp", "rep", F.col("finer").alias("mask")).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                       radius: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row."""
    fps = materialize(simhash_fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    classes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "simhash-class")
    comp = connected_components(simhash_links(classes.where("rep is not null").select("fp", "rep"), radius, bucket_rows))
    named = classes.join(comp.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("fp", F.coalesce("component", "rep").alias("component_id"))
    hot = hot_keys(classes, "fp", "n", fps.count())
    return lookup_join(fps, named, "fp", hot, spread_hash("doc_id")) \
        .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                         radius: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group: that of its smallest id (of rows
    repeating it, one). Rows are named by id and text, so different texts that
    share an id are in one group only if they are near. Rows with a null id
    cannot be named and stay."""
    src, (id_col, text_col), restore = sealed(docs, id_col, text_col)
    # groups of fingerprints, not of ids; each is named by its first id and text
    named = _prints(src.where(F.col(id_col).isNotNull()), id_col, text_col, shingle)
    classes = materialize(named.groupBy("fp").agg(F.min(F.struct("doc_id", "h")).alias("first")), "simhash-class")
    comp = connected_components(simhash_links(classes.select("fp", F.col("fp").alias("rep")), radius))
    kept = classes.join(comp.withColumnRenamed("id", "fp"), "fp", "left") \
        .groupBy(F.coalesce("component", "fp")).agg(F.min("first").alias("first")) \
        .select(F.col("first.doc_id").alias("_kept"), F.col("first.h").alias("_text"))
    h = F.xxhash64(F.col(text_col).cast("string"))
    one = Window.partitionBy(F.col(id_col), "_h").orderBy(F.lit(0))
    rows = src.withColumn("_h", h)
    out = rows.join(kept, (F.col(id_col).cast("long") == F.col("_kept")) & (F.col("_h") == F.col("_text")), "left_semi") \
        .withColumn("_copy", F.row_number().over(one)).where("_copy = 1").drop("_copy", "_h")
    return restore(out.unionByName(src.where(F.col(id_col).isNull())))
