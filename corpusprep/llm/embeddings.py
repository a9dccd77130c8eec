"""Embedding near-duplicates over randomised-rotation binary codes.

Every vector is scaled to length one and rotated by a fixed random rotation. Its
code is the signs of the rotated components; its stored correction factor is
``f``, the inner product of the vector with its code (scaled to length one).
``<code, q> / f`` is an unbiased estimate of ``<vector, q>``; it is off by at
most ``sqrt(1 - f**2) / f * sqrt(1 - <vector, q>**2)``. A pair whose estimate
stays below ``cosine`` by more than that bound cannot be a link; all others are
recomputed exactly, in double precision.

Candidate pairs come from buckets, without all pairs of a label: a vector's home
is the first ``k`` bits of its code (``k`` grows with the logarithm of its
label's vectors). Where two vectors at distance ``r`` differ in the bits ``S``,
``sum_S x_i**2 + sum_S y_i**2 <= r**2``, so one of them has
``sum_S x_i**2 <= r**2 / 2``. Each vector therefore also visits the buckets
reached by flipping any set of its first bits whose squares sum to at most
``r**2 / 2``: every pair within the radius meets, with certainty.

Equal vectors are one class (by label and two 64-bit hashes) and never expand
into pairs. A bucket with more than ``TILE`` vectors is dealt into tiles of home
rows against visitors. A tile returns link counts per class and a spanning
forest, never its pairs.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components, and rows with a null label, link with nothing and are their own
component; vectors of different lengths never link; repeated rows count as
vectors of their own; a null id links with nothing, its component is null and
it is not kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import hot_keys, lookup_join, materialize
from corpusprep.llm.components import connected_components

COSINE = 0.98
BUCKET_ROWS = 256
TILE = 2048
MAX_KEY_BITS = 40
SEED = 11
_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(dim: int) -> np.ndarray:
    """The fixed random rotation of ``dim`` dimensions."""
    if dim not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng([SEED, dim]).normal(size=(dim, dim)))
        _ROTATIONS[dim] = q * np.sign(np.diag(r))
    return _ROTATIONS[dim]


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one, rotated, in double precision."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)) @ rotation(x.shape[1]).T


def _home(y: np.ndarray, bits: int) -> np.ndarray:
    return (y[:, :bits] >= 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(y), np.int64)


def visits(y: np.ndarray, bits: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """``(row, flipped bits)`` of every bucket each row visits, its home first."""
    limit = (1 - cosine) + 1e-9  # r**2 / 2
    row, mask, cost = np.arange(len(y)), np.zeros(len(y), np.int64), np.zeros(len(y))
    for j in range(bits):
        more = cost + y[row, j] ** 2
        ok = more <= limit
        row, mask, cost = np.concatenate([row, row[ok]]), np.concatenate([mask, mask[ok] | (1 << j)]), np.concatenate([cost, more[ok]])
    return row, mask


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _deal(cosine: float):
    """Bucket rows ``(label, dim, bits, bucket, home, rep, n, vec)`` of classes."""
    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            kinds = np.stack([b.column("dim").to_numpy(), b.column("bits").to_numpy()])
            for dim, bits in sorted(set(map(tuple, kinds.T.tolist()))):
                at = np.flatnonzero((kinds[0] == dim) & (kinds[1] == bits))
                part = t.take(pa.array(at))
                y = rotated(_matrix(part.column("vec")))
                home = _home(y, bits)
                row, mask = visits(y, bits, cosine)
                out = part.take(pa.array(row))
                out = out.append_column("bucket", pa.array(home[row] ^ mask)).append_column("home", pa.array(mask == 0))
                yield from out.select(["label", "dim", "bits", "bucket", "home", "rep", "n", "vec"]).combine_chunks().to_batches()
    return run


def _links(cosine: float):
    """Of a tile: link counts ``(rep, links, null)`` and a spanning forest ``(rep, null, other)``."""
    def run(tile: pa.Table) -> pa.Table:
        role, rep, n = (tile.column(c).to_numpy() for c in ("role", "rep", "n"))
        bits = int(tile.column("bits")[0].as_py())
        vec = _matrix(tile.column("vec")).astype(np.float64)
        unit = vec / np.abs(vec).max(axis=1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        y = rotated(vec)
        homes, asks = np.flatnonzero(role != 1), np.flatnonzero(role != 0)
        at_home = tile.column("home").to_numpy(zero_copy_only=False)
        root = np.sqrt(y.shape[1])
        code = np.where(y[homes] >= 0, 1.0, -1.0).astype(np.float32) / np.float32(root)
        f = np.abs(y[homes]).sum(axis=1) / root
        low = cosine - np.sqrt(np.maximum(0, 1 - f * f)) / f * np.sqrt(1 - cosine * cosine) - 1e-5
        limit = (1 - cosine) + 1e-9
        links = np.zeros(len(rep), np.int64)
        lead = rep.copy()  # smallest class reached so far

        for a in range(0, len(asks), 1024):
            q = asks[a:a + 1024]
            estimate = (code @ y[q].T.astype(np.float32)) / f[:, None].astype(np.float32)
            h, k = np.nonzero(estimate >= low[:, None])  # the pairs to recompute
            h, k = homes[h], q[k]
            other = rep[h] != rep[k]
            h, k = h[other], k[other]
            exact = np.empty(len(h))
            for s in range(0, len(h), 1 << 16):
                exact[s:s + (1 << 16)] = np.einsum("ij,ij->i", unit[h[s:s + (1 << 16)]], unit[k[s:s + (1 << 16)]])
            ok = exact >= cosine
            h, k = h[ok], k[ok]
            np.add.at(links, k, n[h])
            # a visitor also credits the home row, unless that row visits the visitor's home too
            far = ~at_home[k]
            if far.any():
                hv, kv = h[far], k[far]
                differ = (y[hv, :bits] >= 0) != (y[kv, :bits] >= 0)
                back = np.where(differ, y[hv, :bits] ** 2, 0).sum(axis=1) <= limit
                np.add.at(links, hv[~back], n[kv[~back]])
            if not len(k):
                continue
            order = np.argsort(k, kind="stable")
            h, k = h[order], k[order]
            cuts = np.flatnonzero(np.diff(k, prepend=-1))
            for x, z in zip(cuts, [*cuts[1:], len(k)], strict=True):  # one visitor and all its partners
                met = np.append(lead[h[x:z]], lead[k[x]])
                low_lead = met.min()
                if (met != low_lead).any():
                    lead[np.isin(lead, np.unique(met))] = low_lead
        joined = np.flatnonzero(lead != rep)
        tree = np.unique(np.stack([rep[joined], lead[joined]], axis=1), axis=0)
        some = np.flatnonzero(links)
        return pa.table({
            "rep": pa.array(np.concatenate([rep[some], tree[:, 0]])),
            "links": pa.array([*links[some].tolist(), *[None] * len(tree)], pa.int64()),
            "other": pa.array([*[None] * len(some), *tree[:, 1].tolist()], pa.int64())})
    return run


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                           cosine: float = COSINE, bucket_rows: int = BUCKET_ROWS, tile: int = TILE) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``."""
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    finite = F.coalesce(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    usable = finite & F.exists("vec", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    key = F.when(F.coalesce(usable, F.lit(False)), F.concat_ws(":", F.hex(F.xxhash64("label", "vec")), F.hex(F.xxhash64(F.lit(SEED), "vec", "label"))))
    rows = materialize(src.withColumn("key", key), "vectors")

    classes = materialize(
        rows.where("key is not null").groupBy("key")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec"))
        .withColumn("dim", F.size("vec")).withColumn("group", F.xxhash64("label", "dim")), "vector-classes")
    sizes = materialize(classes.groupBy("group").agg(F.count(F.lit(1)).alias("size")), "vector-groups")
    n_classes = classes.count()
    sized = lookup_join(classes, sizes, "group", hot_keys(sizes, "group", "size", n_classes), F.xxhash64("rep"))
    bits = F.least(F.lit(MAX_KEY_BITS), F.col("dim"), F.greatest(F.lit(0), F.ceil(F.log2(F.col("size") / bucket_rows)))).cast("int")
    kind = dict(classes.dtypes)
    cls = sized.select("label", "dim", bits.alias("bits"), "rep", "n", "vec")
    dealt = cls.mapInArrow(_deal(cosine), f"label {kind['label']}, dim int, bits int, bucket long, home boolean, rep long, n long, vec {kind['vec']}")
    dealt = materialize(dealt, "vector-buckets")

    # buckets above a tile are dealt into tiles: chunks of home rows x chunks of visitors
    where = ["label", "dim", "bucket"]
    big = dealt.groupBy(*where).agg(F.sum(F.col("home").cast("long")).alias("h"), F.count(F.lit(1)).alias("q")) \
        .where((F.col("h") > 0) & (F.col("q") > 1))
    big = big.select(*where, F.ceil(F.col("h") / tile).cast("int").alias("hs"), F.ceil(F.col("q") / tile).cast("int").alias("qs"))
    tiled = dealt.join(big, where)  # also drops buckets without a home row, or with one row
    chunk = F.xxhash64("rep")
    hc, qc = F.pmod(chunk, F.col("hs")).cast("int"), F.pmod(chunk, F.col("qs")).cast("int")
    place = lambda h, q, role: F.struct(h.cast("int").alias("hi"), q.cast("int").alias("qi"), F.lit(role).alias("role"))
    ask = F.transform(F.sequence(F.lit(0), F.col("hs") - 1), lambda i: place(i, qc, 1))
    be = F.transform(F.sequence(F.lit(0), F.col("qs") - 1), lambda i: place(hc, i, 0))
    single = (F.col("hs") == 1) & (F.col("qs") == 1)
    places = F.when(~F.col("home"), ask).when(single, F.array(place(F.lit(0), F.lit(0), 2))).otherwise(F.concat(ask, be))
    tiles = tiled.withColumn("place", F.explode(places)).select(*where, "bits", "home", "rep", "n", "vec", "place.*")
    found = materialize(tiles.groupBy(*where, "hi", "qi").applyInArrow(_links(cosine), "rep long, links long, other long"), "vector-links")

    links = found.where("links is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    comp = connected_components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    named = classes.select("key", "rep", "n").join(links, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    hot = hot_keys(classes, "key", "n", rows.count())
    out = lookup_join(rows.select("vec_id", "key"), named, "key", hot, F.xxhash64("vec_id"))
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
