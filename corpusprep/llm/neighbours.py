"""Approximate nearest neighbours by an adaptive dimension scan of inverted lists.

Index. Vectors are scaled to length one and turned by a fixed random rotation,
so that any ``d`` of the turned dimensions are a random projection.
Centroids are fitted on a bounded sample (``SAMPLE_BYTES`` of vectors, chosen by
hash); every vector joins the list of its nearest centroid. A list is cut into chunks
of at most ``CHUNK_BYTES``; a chunk is stored as one row that holds its turned vectors
column block by column block (``BLOCK`` dimensions each), with the originals beside them. Equal
vectors are one entry, with the smallest ``k + 1`` ids: no other id of theirs can be
among any query's ``k`` nearest.

Search. A query scans its nearest list first, then the other lists it probes, with
the distance of its ``k``-th nearest so far. In a chunk, distances grow block by block. After ``d`` of
``D`` dimensions, a candidate is given up where ``sqrt(partial * D / d)`` is above
``(1 + EPSILON / sqrt(d))`` times that distance: a test of the hypothesis that the whole distance is below it
(the share of a random projection strays further only rarely). What
survives all blocks is scored exactly, in double precision, on the original vectors.

Lists to probe. Centroids are fitted on one half of the sample; the other half says how
many lists to probe: up to ``PROBE_QUERIES`` of its vectors are taken as queries, and the
smallest number of lists that holds ``PROBE_SHARE`` of their exact neighbours in
that half is taken. The whole table's neighbours are nearer than these, so their
share is not lower. Lists go on until they hold more than ``k`` vectors, so no query comes out short. Vectors without structure need nearly all lists; then the
scan is what saves work.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components, and
rows with a null id, take no part; vectors of different lengths are never compared; a repeated id
stands for one vector if the vectors are equal, else for several, none of which is a candidate of
another; equal scores rank by id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import materialize
from corpusprep.llm.embeddings import rotation

NEAREST = 5
EVERY = 50
MAX_LISTS = 1024
SAMPLE_BYTES = 32 << 20
SAMPLE_PER_LIST = 32
#: Tables of up to this many vectors (of one length) are one list.
ONE_LIST = 1024
FIT_ROUNDS = 8
PROBE_QUERIES = 256
PROBE_SHARE = 0.95
BLOCK = 16
EPSILON = 2.1
CHUNK_BYTES = 4 << 20
#: Queries that scan a chunk in one task; more are dealt to several copies of it.
TILE_QUERIES = 256
ROWS_AT_ONCE = 256


def units(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


# ---------------------------------------------------------------- fit

def fit_lists(sample: np.ndarray, lists: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Centroids of length one, by rounds of assigning and averaging."""
    centres = sample[:lists].copy()
    for _ in range(rounds):
        own = _nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([np.argmax(x[i:i + 4096] @ centres.T, axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int, share: float, queries: int = PROBE_QUERIES) -> int:
    """The smallest number of lists that holds ``share`` of the sample's own neighbours."""
    own = _nearest(sample, centres)
    depth = []
    for i in range(min(queries, len(sample))):
        score = sample @ sample[i]
        score[i] = -2
        best = np.argpartition(-score, min(k, len(score) - 1))[:k]
        place = np.empty(len(centres), np.int64)
        place[np.argsort(-(centres @ sample[i]), kind="stable")] = np.arange(len(centres))
        depth.extend(place[own[best]].tolist())
    return int(np.quantile(depth, share, method="higher")) + 1 if depth else 1


class Lists:
    """What a fit leaves: per vector length, the centroids and the lists to probe."""

    def __init__(self, centres: dict[int, np.ndarray], probes: dict[int, int]):
        self.centres, self.probes, self.sizes = centres, probes, {}

    def own(self, x: np.ndarray) -> np.ndarray:
        c = self.centres.get(x.shape[1])
        return _nearest(x, c) if c is not None else np.zeros(len(x), np.int64)

    def probed(self, x: np.ndarray, least: int) -> list[np.ndarray]:
        """Per query, its lists, nearest first: as many as the fit asks for, and on until they hold ``least`` vectors."""
        dim = x.shape[1]
        c = self.centres.get(dim)
        if c is None:
            return [np.zeros(1, np.int64)] * len(x)
        sizes = self.sizes[dim]
        out = []
        for row in np.argsort(-(x @ c.T), axis=1, kind="stable"):
            row = row[sizes[row] > 0]
            out.append(row[:max(self.probes[dim], int(np.searchsorted(np.cumsum(sizes[row]), least)) + 1)])
        return out


def _fit(classes: DataFrame, k: int, max_lists: int, sample_bytes: int, one_list: int, share: float) -> Lists:
    # lengths with a table of more than one_list vectors; all others are one list each
    many = classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > one_list).collect()
    centres, probes = {}, {}
    for dim, n in many:
        room = max(one_list, sample_bytes // (4 * dim))
        lists = max(1, min(max_lists, math.isqrt(n), room // (2 * SAMPLE_PER_LIST)))
        rows = classes.where(F.col("dim") == dim).orderBy("key").limit(min(room, 2 * SAMPLE_PER_LIST * lists)).select("vec").toArrow()
        sample = (units(_matrix(rows.column("vec"), dim)) @ rotation(dim).T).astype(np.float32)
        centres[dim] = fit_lists(sample[::2], min(lists, len(sample[::2])))
        probes[dim] = probes_needed(sample[1::2], centres[dim], k, share)  # of vectors that did not shape the centroids
    return Lists(centres, probes)


# ---------------------------------------------------------------- index

def _by_length(table: pa.Table):
    dims = table.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, table.take(pa.array(np.flatnonzero(dims == dim)))


def _assign(model):
    def run(batches):
        for b in batches:
            for dim, part in _by_length(pa.Table.from_batches([b])):
                own = model.value.own((units(_matrix(part.column("vec"), dim)) @ rotation(dim).T).astype(np.float32))
                yield from part.append_column("list", pa.array(own.astype(np.int32))).combine_chunks().to_batches()
    return run


def _store(table: pa.Table) -> pa.Table:
    """A chunk as one row: turned vectors by column blocks, originals, ids."""
    dim = table.column("dim")[0].as_py()
    raw = _matrix(table.column("vec"), dim).astype(np.float64)
    turned = (units(raw) @ rotation(dim).T).astype(np.float32)
    blocks = [np.ascontiguousarray(turned[:, i:i + BLOCK]).tobytes() for i in range(0, dim, BLOCK)]
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "list": table.column("list")[:1], "chunk": table.column("chunk")[:1],
        "blocks": pa.array([blocks], pa.list_(pa.binary())), "raw": pa.array([raw.tobytes()], pa.binary()),
        "ids": pa.array([table.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64())))})


# ---------------------------------------------------------------- scan

def scan_chunk(turned_q: np.ndarray, unit_q: np.ndarray, limit: np.ndarray, blocks: list[np.ndarray], unit: np.ndarray,
               lead: np.ndarray, top: int, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """``(query, row, cosine)`` of each query's ``top`` best rows of a chunk (ties to smaller ``lead``) that are within
    ``limit`` (a distance, one a query), and the number of values read."""
    dim = turned_q.shape[1]
    limit = limit.astype(np.float64).copy()
    best: list[list[tuple[float, int, int]]] = [[] for _ in range(len(turned_q))]
    read = 0
    for a in range(0, len(unit), ROWS_AT_ONCE):
        z = min(a + ROWS_AT_ONCE, len(unit))
        partial = np.zeros((len(turned_q), z - a), np.float32)
        q, r = None, None  # the pairs still in, once they are few
        for j, block in enumerate(blocks):
            x, y = block[a:z], turned_q[:, j * BLOCK:(j + 1) * BLOCK]
            d = min(dim, (j + 1) * BLOCK)
            bound = (limit * (1 + epsilon / math.sqrt(d))) ** 2 * (d / dim) + 1e-5 if d < dim else limit ** 2 + 1e-5
            if q is None:
                partial += (x * x).sum(axis=1)[None, :] + (y * y).sum(axis=1)[:, None] - 2 * (y @ x.T)
                read += partial.size * x.shape[1]
                inside = partial <= bound[:, None]
                if inside.sum() * 4 < partial.size:
                    q, r = np.nonzero(inside)
                    partial = partial[q, r]
            else:
                step = x[r] - y[q]
                partial = partial + np.einsum("ij,ij->i", step, step)
                read += step.size
                inside = partial <= bound[q]
                q, r, partial = q[inside], r[inside], partial[inside]
        if q is None:
            q, r = np.nonzero(inside)
        cosine = np.empty(len(q))
        for s in range(0, len(q), 1 << 14):
            cosine[s:s + (1 << 14)] = np.einsum("ij,ij->i", unit_q[q[s:s + (1 << 14)]], unit[a + r[s:s + (1 << 14)]])
        order = np.lexsort((lead[a + r], -cosine, q))
        q, r, cosine = q[order], r[order], cosine[order]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        for i, row, c in zip(q[rank < top].tolist(), r[rank < top].tolist(), cosine[rank < top].tolist(), strict=True):
            best[i].append((-c, int(lead[a + row]), a + row))
        for i in np.unique(q).tolist():
            best[i] = sorted(best[i])[:top]
            if len(best[i]) == top:
                limit[i] = min(limit[i], math.sqrt(max(0.0, 2 + 2 * best[i][-1][0])) + 1e-6)
    out = [(i, row, -c) for i, own in enumerate(best) for c, _, row in own]
    q, r, c = (np.array(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return q, r, c, read


def _scan(top: int, epsilon: float):
    def run(chunk: pa.Table, asks: pa.Table) -> pa.Table:
        names, kinds = ["query_id", "q", "score", "ids"], [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64())]
        if not chunk.num_rows or not asks.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        dim = chunk.column("dim")[0].as_py()
        blocks = [np.frombuffer(x.as_py(), np.float32).reshape(-1, min(BLOCK, dim - j * BLOCK)) for j, x in enumerate(chunk.column("blocks")[0])]
        unit = units(np.frombuffer(chunk.column("raw")[0].as_py(), np.float64).reshape(-1, dim))
        ids = chunk.column("ids")[0].as_py()
        unit_q = units(_matrix(asks.column("vec"), dim))
        turned = (unit_q @ rotation(dim).T).astype(np.float32)
        q, r, score, _ = scan_chunk(turned, unit_q, asks.column("limit").to_numpy(), blocks, unit, np.array([x[0] for x in ids]), top, epsilon)
        rows = [asks.column(c).take(pa.array(q, pa.int64())).combine_chunks() for c in ("query_id", "q")]
        return pa.table([*rows, pa.array(score, pa.float64()), pa.array([ids[x] for x in r.tolist()], kinds[3])], names=names)
    return run


def _probe(model, least: int):
    """``rank`` 0 is a query's nearest list."""
    def run(batches):
        for b in batches:
            for dim, part in _by_length(pa.Table.from_batches([b])):
                lists = model.value.probed((units(_matrix(part.column("vec"), dim)) @ rotation(dim).T).astype(np.float32), least)
                row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                out = part.take(pa.array(row)).append_column("list", pa.array(np.concatenate(lists).astype(np.int32))) \
                    .append_column("rank", pa.array(np.concatenate([np.arange(len(x)) for x in lists]).astype(np.int32)))
                yield from out.combine_chunks().to_batches(max_chunksize=10_000)
    return run


def nearest_neighbours(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = NEAREST, every: int = EVERY,
                       max_lists: int = MAX_LISTS, sample_bytes: int = SAMPLE_BYTES, one_list: int = ONE_LIST, epsilon: float = EPSILON,
                       share: float = PROBE_SHARE, chunk_bytes: int = CHUNK_BYTES, tile: int = TILE_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every id divisible by ``every``."""
    spark = vectors.sparkSession
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.coalesce(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    usable = F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    key = F.concat(F.hex(F.xxhash64("vec")), F.hex(F.xxhash64(F.lit(1), "vec")))
    rows = materialize(src.where(usable).withColumn("key", key).withColumn("dim", F.size("vec")), "ann-rows")

    # of equal vectors, the smallest ids: cut before and after the shuffle, whatever their number
    salted = Window.partitionBy("key", "_salt").orderBy("vec_id")
    few = rows.select("key", "vec_id").withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(64))).distinct() \
        .withColumn("_at", F.row_number().over(salted)).where(F.col("_at") <= k + 1)
    ids = few.groupBy("key").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids"))  # of at most 64 * (k + 1)
    one = rows.groupBy("key").agg(F.first("vec").alias("vec"), F.first("dim").alias("dim"))
    classes = materialize(one.join(ids, "key"), "ann-classes")

    model = _fit(classes, k, max_lists, sample_bytes, one_list, share)
    held = spark.sparkContext.broadcast(model)  # at most max_lists centroids a vector length
    assigned = materialize(classes.mapInArrow(_assign(held), "key string, vec array<double>, dim int, ids array<long>, list int"), "ann-lists")
    sizes = materialize(assigned.groupBy("dim", "list").agg(F.count(F.lit(1)).alias("n")), "ann-sizes")
    for dim, c in model.centres.items():
        model.sizes[dim] = np.zeros(len(c), np.int64)
        for r in sizes.where(F.col("dim") == dim).collect():  # at most max_lists
            model.sizes[dim][r["list"]] = r["n"]
    held = spark.sparkContext.broadcast(model)

    # a list's chunks, of bounded bytes, and its queries' tiles
    per = F.greatest(F.lit(64), F.floor(F.lit(chunk_bytes) / (F.col("dim") * 12)))
    cut = sizes.select("dim", "list", F.ceil(F.col("n") / per).cast("int").alias("chunks"))
    chunked = assigned.join(cut, ["dim", "list"]).withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
    schema = "dim int, list int, chunk int, blocks array<binary>, raw binary, ids array<array<long>>"
    index = materialize(chunked.select("dim", "list", "chunk", "vec", "ids").groupBy("dim", "list", "chunk").applyInArrow(_store, schema), "ann-index")

    # a query is an id and its vector
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id", "key").agg(F.first("vec").alias("vec"), F.first("dim").alias("dim"))
    asked = asked.select(F.col("vec_id").alias("query_id"), F.xxhash64("vec_id", "key").alias("q"), "vec", "dim")
    asked = materialize(asked.mapInArrow(_probe(held, k + 1), "query_id long, q long, vec array<double>, dim int, list int, rank int"), "ann-probes")
    top = k + 1  # the query's own entry is among them
    by_query = Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0])

    def scanned(asks: DataFrame, name: str) -> DataFrame:
        load = asks.groupBy("dim", "list").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
        to = asks.join(load.join(cut, ["dim", "list"]), ["dim", "list"]).withColumn("tile", F.pmod(F.xxhash64("q"), F.col("tiles")).cast("int")) \
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        copies = index.join(load, ["dim", "list"]).withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        at = ["dim", "list", "chunk", "tile"]
        found = copies.select(*at, "blocks", "raw", "ids").groupBy(*at).cogroup(to.select(*at, "query_id", "q", "vec", "limit").groupBy(*at)) \
            .applyInArrow(_scan(top, epsilon), "query_id long, q long, score double, ids array<long>")
        return materialize(found, name)

    home = scanned(asked.where("rank = 0").withColumn("limit", F.lit(2.0)), "ann-home")
    best = home.withColumn("_at", F.row_number().over(by_query)).where(F.col("_at") == top)
    reach = best.select("q", (F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score"))) + 1e-6).alias("limit"))
    rest = asked.where("rank > 0").join(reach, "q", "left").withColumn("limit", F.coalesce("limit", F.lit(2.0)))
    near = home.union(scanned(rest, "ann-rest")).withColumn("_at", F.row_number().over(by_query)).where(F.col("_at") <= top)
    each = near.select("query_id", "q", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id") \
        .groupBy("query_id", "q", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
