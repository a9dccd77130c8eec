"""Metadata rows to samples: key, shard, coercion, filters, dedupe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import keys as K
from corpusprep.functions import policy as P

URL_COL = "downloadurl"


def with_key(df: DataFrame, url: str = URL_COL) -> DataFrame:
    """P1 + P2: append ``key`` and ``shard`` (one projection, no shuffle)."""
    return df.withColumn("key", K.derive_key(url)).withColumn("shard", K.derive_shard("key"))


def create_samples(df: DataFrame, url: str = URL_COL, strict: bool = True) -> DataFrame:
    """Source row -> sample.

    Adds ``key`` and ``shard``, coerces ``longitude``/``latitude`` to double and
    ``accuracy`` to bigint with the falsy-to-null rule (the rule depends on the
    column's source type, read from the schema). Every other column passes
    through untouched. A null URL has no key: with ``strict`` the job fails on
    that row (lazily, at run time) instead of emitting a keyless sample.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    key = K.derive_key(url)
    if strict:
        key = F.when(F.col(url).isNull(), F.raise_error(F.lit(f"null {url}: sample has no key"))) \
            .otherwise(key)
    out = df.withColumn("key", key)
    coerced = {}
    for name in ("longitude", "latitude"):
        if name in types:
            coerced[name] = P.coerce_float(name, types[name])
    if "accuracy" in types:
        coerced["accuracy"] = P.coerce_int("accuracy", types["accuracy"])
    if coerced:
        out = out.withColumns(coerced)
    return out.withColumn("shard", K.derive_shard("key"))


def split_rejects(df: DataFrame, url: str = URL_COL) -> tuple[DataFrame, DataFrame]:
    """``(rows with a URL, rows without)``: one bad row need not stop a job of a
    hundred million. Both are filters of the same scan."""
    return df.where(F.col(url).isNotNull()), df.where(F.col(url).isNull()) \
        .withColumn("reason", F.lit(f"null {url}"))


def filter_kind(df: DataFrame, kinds=(0, 1), marker: str = "marker") -> DataFrame:
    """Keep rows whose marker is one of ``kinds`` (names or codes)."""
    return df.where(F.col(marker).isin(K.kinds_to_codes(kinds)))


def filter_user(df: DataFrame, predicate=None) -> DataFrame:
    """Caller predicate as a Column, a SQL expression string, or a
    Python callable on the row as a dict.

    Never ``eval``: a SQL string goes through Spark's parser, so it is also
    pushed down to the scan when it only touches stored columns. A callable is
    the slow path (an Arrow-batched Python UDF over the row's columns, opaque
    to the optimizer); prefer a Column or SQL text.
    """
    if predicate is None:
        return df
    if isinstance(predicate, str):
        return df.where(F.expr(predicate))
    if isinstance(predicate, Column):
        return df.where(predicate)
    if callable(predicate):
        from pyspark.sql.types import BooleanType
        fn = predicate

        def keep(row) -> bool:
            return bool(fn(row.asDict(recursive=True)))
        udf = F.udf(keep, BooleanType(), useArrow=True)
        return df.where(udf(F.struct(*[F.col(c) for c in df.columns])))
    raise TypeError(f"unsupported predicate: {type(predicate).__name__}")


def prepare_metadata(df: DataFrame, kinds=(0, 1), predicate=None,
                     sort: bool = True) -> DataFrame:
    """Kind filter, user filter, then key order within each shard.

    The order is a per-shard key order (range clustering, then
    ``sortWithinPartitions``), which is what the studied tool's per-shard sort
    was for; no single task has to hold a whole shard.
    """
    out = filter_user(filter_kind(df, kinds), predicate)
    if sort:
        out = sort_by_key(out)
    return out


def sort_by_key(df: DataFrame, position: str | None = None) -> DataFrame:
    """O1: cluster by shard, sort each partition by (shard, key).

    Range partitioning (with a per-row tiebreak) keeps a shard's rows in
    contiguous key order across tasks; a hot shard spans several tasks. With
    ``position``, each row also gets its 1-based place in its shard.
    """
    from corpusprep.operators.windows import cluster_sorted, row_number_within
    if position is not None:
        return row_number_within(df, ["shard"], ["key"], position)
    return cluster_sorted(df, ["shard", "key"])


def validate_row_count(df: DataFrame, expected: int | Column) -> DataFrame:
    """A2: total rows over all shards against the expected total."""
    exp = expected if isinstance(expected, Column) else F.lit(int(expected))
    return df.agg(F.count(F.lit(1)).alias("n_rows")) \
        .withColumn("expected", exp.cast("bigint")) \
        .withColumn("ok", F.col("n_rows") == F.col("expected"))


def dedupe_last(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """One row per key, the one with the greatest ``order`` wins.

    ``max_by`` is a plain aggregate, so rows are combined map-side before the
    shuffle: a key repeated a hundred million times still ships one row per
    map task. (A window would ship every copy to one task.)
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    packed = F.max_by(F.struct(*[F.col(c) for c in others]), F.col(order)).alias("_row")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def dedupe_first(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """Like :func:`dedupe_last`, the smallest ``order`` wins (first match)."""
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    packed = F.min_by(F.struct(*[F.col(c) for c in others]), F.col(order)).alias("_row")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])
