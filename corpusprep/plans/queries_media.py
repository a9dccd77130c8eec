"""Checked queries, part 2: pooling, re-compression policy, quality gate and
embedding extraction (P10, P16-P23, A5, A6, A11, J7, F3-F5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions import policy as P
from corpusprep.operators import features as FE
from corpusprep.operators import media as M
from corpusprep.plans import fixtures as FX
from corpusprep.plans.catalog import register

SCORER_IN, SCORER_OUT = 64, 4
GATE_VARIANCE = 0.02   # FIXTURES.md: the 0-255 gate of 50 rescaled to these values


def _vectors(spark, sf):
    return FX.vectors(FX.table(spark, sf, "embeddings"))


def _images(spark, sf):
    return FX.images(FX.table(spark, sf, "documents"))


def _d(c):
    return c.cast("double")


def scored(df, col="feature"):
    """Scorer output as four exact integers (y0..y3)."""
    return [F.col(col)[j].cast("bigint").alias(f"y{j}") for j in range(SCORER_OUT)]


# ---------------------------------------------------------------- pooling
@register("drop_undecodable", ["vectors"], "SELECT vec_id, key FROM vectors WHERE embedding IS NOT NULL")
def q_drop_undecodable(spark, sf):
    return FE.drop_undecodable(_vectors(spark, sf)).select("vec_id", "key")


@register("cls_token", ["vectors"], """
SELECT vec_id, CAST(len(embedding[1:8]) AS BIGINT) AS n, CAST(embedding[1] AS DOUBLE) AS first_value,
  CAST(embedding[8] AS DOUBLE) AS last_value FROM vectors WHERE embedding IS NOT NULL""")
def q_cls_token(spark, sf):
    v = FE.drop_undecodable(_vectors(spark, sf))
    c = FE.cls_token(FX.tokens("embedding"))
    return v.select("vec_id", F.size(c).cast("bigint").alias("n"),
                    _d(F.element_at(c, 1)).alias("first_value"), _d(F.element_at(c, -1)).alias("last_value"))


@register("channel_zero", ["vectors"], """
SELECT vec_id, CAST(8 AS BIGINT) AS n, CAST(embedding[9] AS DOUBLE) AS second_value,
  CAST(embedding[57] AS DOUBLE) AS last_value FROM vectors WHERE embedding IS NOT NULL""")
def q_channel_zero(spark, sf):
    v = FE.drop_undecodable(_vectors(spark, sf))
    c = FE.channel_zero(FX.tokens("embedding"))
    return v.select("vec_id", F.size(c).cast("bigint").alias("n"),
                    _d(F.element_at(c, 2)).alias("second_value"), _d(F.element_at(c, -1)).alias("last_value"))


@register("pool_by_rank", ["vectors"], """
SELECT vec_id, CAST(CASE WHEN vec_id % 2 = 0 THEN 8 ELSE len(embedding) END AS BIGINT) AS n,
  CAST(embedding[1] AS DOUBLE) AS first_value,
  CAST(CASE WHEN vec_id % 2 = 0 THEN embedding[8] ELSE embedding[len(embedding)] END AS DOUBLE) AS last_value
FROM vectors WHERE embedding IS NOT NULL""")
def q_pool_by_rank(spark, sf):
    v = FE.drop_undecodable(_vectors(spark, sf))
    even = F.col("vec_id") % 2 == 0
    v = v.withColumn("tok", F.when(even, FX.tokens("embedding"))) \
        .withColumn("flat", F.when(~even, F.col("embedding")))
    p = FE.pool_by_rank("tok", "flat")
    return v.select("vec_id", F.size(p).cast("bigint").alias("n"),
                    _d(F.element_at(p, 1)).alias("first_value"), _d(F.element_at(p, -1)).alias("last_value"))


# ---------------------------------------------------------------- policy
_BIG = 1.5 * P.target_geometry(500)[1]
_SMALL = 0.5 * P.target_geometry(500)[1]


@register("resize_policy", ["images"], f"""
SELECT doc_id,
  CASE WHEN w * h > {_BIG} THEN CAST(round_even(CAST(500 AS DOUBLE) / greatest(w, h) * w, 0) AS BIGINT)
       ELSE w END AS new_w,
  CASE WHEN w * h > {_BIG} THEN CAST(round_even(CAST(500 AS DOUBLE) / greatest(w, h) * h, 0) AS BIGINT)
       ELSE h END AS new_h
FROM images""")
def q_resize_policy(spark, sf):
    r = P.resize_policy("w", "h", 500)
    return _images(spark, sf).select("doc_id", r["w"].alias("new_w"), r["h"].alias("new_h"))


@register("subsampling_policy", ["images"], f"""
SELECT doc_id, CASE WHEN w * h <= {_SMALL} THEN '444' ELSE '420' END AS subsampling FROM images""")
def q_subsampling_policy(spark, sf):
    return _images(spark, sf).select("doc_id", P.subsampling_policy("w", "h", "420", 500).alias("subsampling"))


@register("recompress_gate", ["images"], f"""
SELECT doc_id, (marker = 0 AND w * h > {_SMALL} AND NOT (doc_id % 7 = 0)) AS recompress FROM images""")
def q_recompress_gate(spark, sf):
    im = _images(spark, sf)
    return im.select("doc_id", P.recompress_gate("marker", "w", "h", 85, F.col("doc_id") % 7 == 0, 500)
                     .alias("recompress"))


@register("target_geometry", ["images"], """
SELECT doc_id, t AS target, CAST(ceil(CAST(t AS DOUBLE) / 4 * 3) AS BIGINT) AS short_side,
  t * CAST(ceil(CAST(t AS DOUBLE) / 4 * 3) AS BIGINT) AS target_pixels,
  w * h > t * CAST(ceil(CAST(t AS DOUBLE) / 4 * 3) AS BIGINT) AS over_target
FROM (SELECT *, 100 * (1 + doc_id % 6) AS t FROM images) i""")
def q_target_geometry(spark, sf):
    im = _images(spark, sf).withColumn("target", 100 * (1 + F.col("doc_id") % 6))
    g = P.target_geometry_col("target")
    return im.select("doc_id", "target", g["short_side"].alias("short_side"),
                     g["target_pixels"].alias("target_pixels"),
                     ((F.col("w") * F.col("h")) > g["target_pixels"]).alias("over_target"))


# ---------------------------------------------------------------- gate
@register("column_variance", ["pixels"], """
SELECT vec_id, x, round(var_pop(v), 9) AS cv FROM pixels GROUP BY vec_id, x""")
def q_column_variance(spark, sf):
    px = FX.pixels(FX.table(spark, sf, "embeddings"))
    cv = M.column_variance(px, "vec_id")
    return cv.select("vec_id", "x", F.round("cv", 9).alias("cv"))


@register("variance_p95", ["pixels"], """
SELECT vec_id, round(quantile_cont(cv, 0.95), 9) AS p95
FROM (SELECT vec_id, x, var_pop(v) AS cv FROM pixels GROUP BY vec_id, x) c GROUP BY vec_id""")
def q_variance_p95(spark, sf):
    px = FX.pixels(FX.table(spark, sf, "embeddings"))
    p = M.variance_p95(M.column_variance(px, "vec_id"), "vec_id")
    return p.select("vec_id", F.round("p95", 9).alias("p95"))


@register("quality_gate", ["pixels"], f"""
WITH p AS (SELECT vec_id, quantile_cont(cv, 0.95) AS p95
           FROM (SELECT vec_id, x, var_pop(v) AS cv FROM pixels GROUP BY vec_id, x) c GROUP BY vec_id)
SELECT vec_id, 1000 * (vec_id % 40) AS n_bytes FROM p
WHERE NOT (1000 * (vec_id % 40) < {P.GATE_MIN_BYTES} AND p95 < {GATE_VARIANCE})""")
def q_quality_gate(spark, sf):
    images = FX.table(spark, sf, "embeddings").select(
        "vec_id", (1000 * (F.col("vec_id") % 40)).alias("n_bytes"), FX.gray_rows().alias("rows"))
    return M.quality_gate(images, min_variance=GATE_VARIANCE).select("vec_id", "n_bytes")


# ---------------------------------------------------------------- features
@register("feature_summary", ["vectors"], """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n, CAST(embedding[1] AS DOUBLE) AS head_first,
  CAST(embedding[10] AS DOUBLE) AS head_last, CAST(embedding[len(embedding) - 9] AS DOUBLE) AS tail_first,
  CAST(embedding[len(embedding)] AS DOUBLE) AS tail_last
FROM vectors WHERE embedding IS NOT NULL""")
def q_feature_summary(spark, sf):
    v = FE.feature_summary(FE.drop_undecodable(_vectors(spark, sf)), "embedding")
    return v.select("vec_id", F.col("n").cast("bigint").alias("n"),
                    _d(F.element_at("first_values", 1)).alias("head_first"),
                    _d(F.element_at("first_values", -1)).alias("head_last"),
                    _d(F.element_at("last_values", 1)).alias("tail_first"),
                    _d(F.element_at("last_values", -1)).alias("tail_last"))


@register("pending_features", ["vectors"], """
SELECT vec_id, key FROM vectors WHERE embedding IS NOT NULL
  AND key NOT IN (SELECT key FROM vectors WHERE already_done)""")
def q_pending_features(spark, sf):
    v = _vectors(spark, sf)
    stored = v.where("already_done").select("key")
    return FE.pending_features(FE.drop_undecodable(v), stored).select("vec_id", "key")


@register("score_model", ["features"], "SELECT vec_id, y0, y1, y2, y3 FROM features")
def q_score_model(spark, sf):
    v = FE.drop_undecodable(_vectors(spark, sf))
    out = FE.score_model(v, FE.integer_scorer(SCORER_IN, SCORER_OUT), SCORER_IN)
    return out.select("vec_id", *scored(out))


@register("normalize_pixels", [], """
WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) - 1 AS i
           FROM embeddings),
z AS (SELECT vec_id, i, (floor((v + 1) * 127.5) / CAST(255 AS DOUBLE) - 0.5) / 0.5 AS z FROM e)
SELECT vec_id, count(*) AS n, max(CASE WHEN i = 0 THEN z END) AS first_value,
  max(CASE WHEN i = 63 THEN z END) AS last_value, max(z) AS max_value FROM z GROUP BY vec_id""")
def q_normalize_pixels(spark, sf):
    emb = FX.table(spark, sf, "embeddings")
    px = F.transform("embedding", lambda v: F.floor((v.cast("double") + 1) * 127.5))
    z = FE.normalize_pixels(px)
    out = emb.select("vec_id", z.alias("z"))
    return out.select("vec_id", F.size("z").cast("bigint").alias("n"), F.element_at("z", 1).alias("first_value"),
                      F.element_at("z", -1).alias("last_value"), F.array_max("z").alias("max_value"))
