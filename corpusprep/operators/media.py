"""Archives, payload join, quality gate and re-compression policy
(J1, W4, A3, A5, A6, A8, J8, P13, P19-P23, U5, K8 input).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import keys as K
from corpusprep.functions import policy as P
from corpusprep.operators.skew import hot_keys, materialize, salted_join


def member_keys(archive: DataFrame, name_col: str = "name", rule: str = "last_suffix") -> DataFrame:
    """Archive member -> sample key (``last_suffix`` = ``Path.stem``,
    ``first_dot`` = up to the first dot)."""
    f = K.stem_last_suffix if rule == "last_suffix" else K.stem_first_dot
    return archive.withColumn("key", f(name_col))


def _first(members: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """Per key the first member by ``(order, name)`` and the member count,
    written once: both the join and its hot keys read it."""
    return materialize(members.groupBy(*keys).agg(F.min(F.struct(order, name)).alias("_first"), F.count(F.lit(1)).alias("_n")), "first")


def first_members(archive: DataFrame, key_cols=("shard", "key"), order: str = "ord", name_col: str = "name") -> DataFrame:
    """The first archive entry of each key: smallest ``order``, then name.

    The winner is found on keys only (a partial aggregate, combined map-side,
    so copies of one key collapse before the shuffle); the payload rows are
    then kept with one salted semi-join on the keys, ``(order, name) = first``
    being a residual. Payload rows never enter an aggregate buffer, and a
    member repeated millions of times is spread over several tasks. Entries
    that tie in both (full copies of one entry) all stay.
    """
    keys = list(key_cols)
    first = _first(archive, keys, order, name_col)
    hot = hot_keys(first, keys, "_n")
    lookup = first.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_first")
    return salted_join(archive, lookup, keys, [f"_k_{k}" for k in keys], "left_semi", hot,
                       extra=F.struct(order, name_col) == F.col("_first"))


def attach_payload(df: DataFrame, data_col: str = "data", marker: str = "marker") -> DataFrame:
    """Put the bytes in ``image`` (marker 0) or ``video`` (otherwise)."""
    return df.withColumn(K.DATAKEYS[0], F.when(F.col(marker) == 0, F.col(data_col))) \
        .withColumn(K.DATAKEYS[1], F.when(F.col(marker) != 0, F.col(data_col))) \
        .drop(data_col)


def join_metadata_blobs(samples: DataFrame, archive: DataFrame, order: str = "src_order",
                        name_col: str = "name") -> DataFrame:
    """Metadata ⨝ archive members on (shard, key).

    Repeated metadata keys: the last row in source order wins (A7). Repeated
    members: the first in archive order wins, then by name (W4). Unmatched
    rows on either side are dropped.

    Everything but the payload is key-level: the first member per key (partial
    aggregate) is joined with the deduplicated metadata into one lookup row
    per key. The payload rows then meet that lookup in a single salted join
    (``(ord, name) = first`` as a residual): the payload is shuffled once, and
    copies of one member never pile into one task.
    """
    from corpusprep.operators.samples import dedupe_last
    keys = ["shard", "key"]
    meta = dedupe_last(samples, keys, order) if order in samples.columns else samples
    members = member_keys(archive.select("shard", name_col, "ord", "data"), name_col)
    first = _first(members, keys, "ord", name_col)
    hot = hot_keys(first, keys, "_n")
    lookup = first.join(meta, keys, "inner").drop("_n")
    lookup = lookup.select(*[F.col(c).alias(f"_m_{c}") for c in lookup.columns])
    out = salted_join(members, lookup, keys, [f"_m_{k}" for k in keys], "inner", hot,
                      extra=F.struct("ord", name_col) == F.col("_m__first"))
    meta_cols = [c for c in meta.columns if c not in keys]
    return out.select(*keys, *[F.col(f"_m_{c}").alias(c) for c in meta_cols],
                      F.col(name_col).alias("member"), "data")


def column_variance(pixels: DataFrame, id_col: str = "id") -> DataFrame:
    """A5: population variance of each pixel column ``x`` of each image.

    ``var_pop`` is an algebraic aggregate: combined map-side, so even one
    enormous image never ships its pixels to a single task.
    """
    return pixels.groupBy(id_col, "x").agg(F.var_pop("v").alias("cv"))


def variance_p95(colvar: DataFrame, id_col: str = "id", q: float = P.GATE_PERCENTILE) -> DataFrame:
    """Exact, linearly interpolated percentile of the column variances.

    The group is one image's columns (bounded by its width), so the exact
    percentile buffer is bounded too.
    """
    return colvar.groupBy(id_col).agg(F.percentile("cv", q).alias("p95"))


def column_variance_p95(rows_col: str, q: float = P.GATE_PERCENTILE) -> Column:
    """A5 + A6 on the row: percentile of the column variances of one decoded
    image (``array<array>`` of gray rows, all of one width). All of an image's
    pixels are in its row, so nothing is shuffled; null where there are none."""
    @F.pandas_udf("double")
    def p95(images: pd.Series) -> pd.Series:
        def one(rows):
            if rows is None or len(rows) == 0 or len(rows[0]) == 0:
                return None
            return float(np.percentile(np.stack([np.asarray(r, np.float64) for r in rows]).var(axis=0), 100 * q))
        return images.map(one).astype("float64")
    return p95(F.col(rows_col))


def quality_gate(images: DataFrame, rows_col: str = "rows", min_bytes: int = P.GATE_MIN_BYTES,
                 min_variance: float = P.GATE_MIN_VARIANCE, bytes_col: str = "n_bytes") -> DataFrame:
    """Keep an image unless it is small (< ``min_bytes``) *and* flat
    (p95 of column variance < ``min_variance``). Adds ``p95``; images without
    pixels are dropped (nothing to decode). One pass, no shuffle."""
    scored = images.withColumn("p95", column_variance_p95(rows_col)).where(F.col("p95").isNotNull())
    return scored.where(~((F.col(bytes_col) < min_bytes) & (F.col("p95") < min_variance)))


def recompress_plan(images: DataFrame, compress: int | None = P.DEFAULT_QUALITY,
                    subsampling: str = P.DEFAULT_SUBSAMPLING,
                    target_size: int = P.DEFAULT_TARGET_SIZE,
                    already: str | None = None) -> DataFrame:
    """Per image: whether it is re-encoded, to which size, with which
    chroma subsampling. One projection, no shuffle."""
    short, pixels = P.target_geometry(target_size)
    gate = P.recompress_gate("marker", "w", "h", compress,
                             F.col(already) if already else None, target_size)
    size = P.resize_policy("w", "h", target_size)
    return images.withColumn("recompress", gate) \
        .withColumn("new_w", F.when(gate, size["w"]).otherwise(F.col("w").cast("bigint"))) \
        .withColumn("new_h", F.when(gate, size["h"]).otherwise(F.col("h").cast("bigint"))) \
        .withColumn("subsampling", F.when(gate, P.subsampling_policy("w", "h", subsampling, target_size))) \
        .withColumn("quality", F.when(gate, F.lit(compress)))


def archive_index(archive: DataFrame, name_col: str = "name") -> DataFrame:
    """S6 shape: (member, archive) pairs over all archives."""
    return archive.select(F.col(name_col).alias("member"), F.col("shard").alias("archive"))


def union_index(*indexes: DataFrame) -> DataFrame:
    """Several ``(member, archive)`` indexes (of archive sets read apart) as
    one, each pair once; nulls are kept."""
    out = indexes[0]
    for other in indexes[1:]:
        out = out.unionByName(other)
    return out.distinct()


def dedupe_members(index: DataFrame) -> DataFrame:
    """One archive per member, last wins; archive order is by name here
    (the studied tool's order came from a set, so ties break by name)."""
    return index.groupBy("member").agg(F.max("archive").alias("archive"))


def keys_per_archive(index: DataFrame) -> DataFrame:
    """A3: archive -> its members, as rows ``(archive, member, pos)`` sorted by
    member (``pos`` from 1). The mapping as rows, not as one list per archive:
    no task has to hold an archive's list, however long."""
    from corpusprep.operators.windows import row_number_within
    return row_number_within(index.select("archive", "member"), ["archive"], ["member"], "pos")


def locate_member(keys: DataFrame, index: DataFrame, key_col: str = "key") -> DataFrame:
    """Key -> its archive (null when not in any archive).

    Members are reduced to their key first (``split('/')[-1].split('.')[0]``)
    and deduplicated last-wins per key before the join.
    """
    idx = index.withColumn("_k", K.stem_first_dot("member")) \
        .groupBy("_k").agg(F.max("archive").alias("archive"))
    counts = materialize(keys.groupBy(key_col).agg(F.count(F.lit(1)).alias("_n")), "counts")
    return salted_join(keys, idx, [key_col], ["_k"], "left", hot_keys(counts, [key_col], "_n")).drop("_k")
