"""Mixing sources to target weights over a time-varying curriculum, in
DataFrame functions only.

* Targets: sources in code point order (null last) take the weights of
  ``weights`` in turn and share all words by weight; a target stops at
  ``max_repeats`` times its source's words, and the excess is shared again by
  weight until none is above. Each round is one aggregate over the one-row-per-
  source table; only two sums reach the driver.
* Curriculum: each weight has a schedule, a piecewise-linear rate over training
  time 0..1, scaled so that its integral is the weight. A source's cumulative
  demand is the integral of its schedule; the word stream of the source
  (its documents in hash order, epoch after epoch) is laid along that demand,
  and inverting the integral gives each copy's training position.
* What is taken: ``target div source words`` whole epochs, then the stream's
  next words up to the target: the report takes the last document in part, so that
  takes meet targets to the word; the stream of documents takes it whole or not
  at all. No document is taken more than ``max_repeats`` times.

Running sums within a source go over buckets of a hash (``chained_sum``), so a
source with a third of all rows is spread over as many tasks as any other.

Edge cases: a null or white-space text has size 0 and takes nothing; a null
source is a source of its own; a source of size 0 has target 0; repeated rows
each count (rows are ordered by a hash of id and text, so ties are equal in both);
a null id is ordered like the text "null", a null text like the empty one; an empty table gives no rows. Input
columns of any name pass through ``mix_documents`` as they are; ``mix_report``
reads id, text and source only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import chained_sum, materialize, sealed
from corpusprep.operators.windows import row_number_within

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
#: Rate knots (time, rate) of each weight's schedule: the light sources lead, the heavy ones close.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.25, 1.0), (1.0, 1.25)),
)
#: Hex digits of the order hash that name a bucket of a source.
BUCKET_DIGITS = 3
WORD = "[^ \\t-\\r]++"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, source_size, weight, rank, target)`` from ``(source, source_size)``."""
    ordered = sizes.withColumn("_null", F.col("source").isNull())
    ranked = row_number_within(ordered, [], ["_null", "source"], "rank").drop("_null") \
        .withColumn("rank", (F.col("rank") - 1).cast("long"))
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod("rank", F.lit(len(weights))).cast("int"))
    t = materialize(ranked.withColumn("weight", weight), "mix-sources")
    cap = (F.col("source_size") * max_repeats).cast("double")
    total = t.agg(F.sum("source_size")).first()[0] or 0
    level, was = 0.0, -1.0
    while level != was and total:
        above = F.lit(was >= 0) & (cap < F.col("weight") * F.lit(level))
        capped, open_weight = t.agg(F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)),
                                    F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        was, level = level, (total - capped) / open_weight if open_weight else level
    share = F.col("weight") * F.lit(level)
    return t.withColumn("target", F.when(cap < share, cap).otherwise(share))


def _invert(knots, share: Column) -> Column:
    """Time at which the integral of the piecewise-linear rate reaches ``share``
    (0..1) of its whole: in the segment that holds it, the root of a quadratic."""
    segments, done = [], 0.0
    for (t0, r0), (t1, r1) in zip(knots, knots[1:], strict=False):
        segments.append((t0, r0, (r1 - r0) / (t1 - t0), done))
        done += (t1 - t0) * (r0 + r1) / 2
    y, out = share * F.lit(done), None
    for t0, r0, slope, before in segments:  # each segment overrides the ones before it
        rest = y - F.lit(before)
        here = F.lit(t0) + F.lit(2.0) * rest / (F.lit(r0) + F.sqrt(F.lit(r0 * r0) + F.lit(2 * slope) * rest))
        out = here if out is None else F.when(rest >= 0, here).otherwise(out)
    return out


def position(rank: Column, share: Column, schedules=SCHEDULES) -> Column:
    """Training position (0..1) at which a source's demand reaches ``share`` of its target."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        out = F.when(F.pmod(rank, F.lit(len(schedules))) == k, _invert(knots, share)).otherwise(out)
    return out


def _order_key(id_col: str, text_col: str) -> Column:
    """The order of a source's rows: a hash of id and text, so that rows tie only where both are equal."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def _plan(sized: DataFrame, source_col: str, weights, max_repeats: int) -> DataFrame:
    """``sized`` (with ``size`` and ``_key``) plus the columns of :func:`mix_plan`."""
    base = sized.withColumn("_source", F.col(source_col))
    sizes = base.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeats)
    bucket = F.conv(F.substring("_key", 1, BUCKET_DIGITS), 16, 10).cast("int")
    flow = chained_sum(base, ["_source"], bucket, [F.col("_key")], "size", "_before")
    t = targets.select(F.col("source").alias("_t"), "source_size", "target", F.col("rank").alias("_rank"))
    # one row per source: AQE broadcasts it when its measured size is small
    joined = flow.join(t, F.col("_source").eqNullSafe(F.col("_t"))).drop("_t", "_source", "_key")
    goal = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return joined.withColumn("_epochs", epochs) \
        .withColumn("_extra", F.greatest(F.lit(0), F.least(F.col("size"), goal - F.col("_epochs") * F.col("source_size") - F.col("_before")))) \
        .withColumn("taken", F.col("_epochs") * F.col("size") + F.col("_extra"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``docs`` plus ``size, source_size, target, taken`` and ``_rank, _before,
    _epochs, _extra``: whole epochs taken, and words of one more."""
    sized = docs.withColumn("size", word_count(F.col(text_col))).withColumn("_key", _order_key(id_col, text_col))
    return _plan(sized, source_col, weights, max_repeats)


def _share(epoch: Column) -> Column:
    return (epoch * F.col("source_size") + F.col("_before")) / F.col("target")


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document, range-sorted by the training position of its first
    copy (null, and first, where nothing of it is taken). Texts are read once."""
    sized = materialize(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                    word_count(F.col(text_col)).alias("size"), _order_key(id_col, text_col).alias("_key")), "mix-sizes")
    plan = _plan(sized, "source", WEIGHTS, MAX_REPEATS)
    first = F.when(F.col("taken") > 0, position(F.col("_rank"), _share(F.lit(0))))
    out = plan.select("doc_id", "size", "source_size", "target", "taken", F.round(first, 9).alias("position"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(n, "position", "doc_id").sortWithinPartitions("position", "doc_id")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The training stream: a row of ``docs`` for each copy taken, range-sorted
    by training position. Documents are never cut: of the one at which a source
    reaches its target, the last copy is taken whole where that is at least as near the target, else not."""
    src, (id_col, text_col, source_col), restore = sealed(docs, id_col, text_col, source_col)
    plan = mix_plan(src, id_col, text_col, source_col)
    copies = F.col("_epochs") + F.when(2 * F.col("_extra") >= F.col("size"), 1).otherwise(0)
    rows = plan.where((F.col("size") > 0) & (copies > 0)) \
        .withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    rows = rows.withColumn("_position", position(F.col("_rank"), _share(F.col("_epoch"))))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return restore(rows.repartitionByRange(n, "_position", id_col).sortWithinPartitions("_position", id_col))


#: DuckDB SQL of ``mix_report`` with the parameters above.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')) AS k FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rnk FROM s),
w AS (
  SELECT *, (rnk % 3 + 1)::INTEGER AS weight, 3.0::DOUBLE * source_size AS cap FROM r),
o AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS capped,
         sum(weight) OVER (ORDER BY cap / weight DESC, rnk DESC)::DOUBLE AS open_weight, cap / weight AS ratio FROM w),
l AS (
  SELECT lvl FROM (
    SELECT ((SELECT sum(source_size) FROM s)::DOUBLE - capped) / open_weight AS lvl, ratio, rnk FROM o)
  WHERE ratio >= lvl ORDER BY ratio, rnk LIMIT 1),
t AS (
  SELECT w.*, CASE WHEN cap < weight * lvl THEN cap ELSE weight * lvl END AS target FROM w, l),
f AS (
  SELECT d.*, t.source_size, t.target, t.rnk, round(t.target)::BIGINT AS goal,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS bef
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS ep FROM f),
h AS (
  SELECT *, ep * size + greatest(0, least(size, goal - ep * source_size - bef)) AS taken,
         bef::DOUBLE / target AS y FROM g)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
  CASE WHEN taken > 0 THEN round(CASE rnk % 3
    WHEN 0 THEN CASE WHEN y * 1.0 >= 0.625 THEN 0.5 + 2.0 * (y * 1.0 - 0.625) / (1.0 + sqrt(1.0 + -2.0 * (y * 1.0 - 0.625)))
                     ELSE 0.0 + 2.0 * y / (1.5 + sqrt(2.25 + -2.0 * y)) END
    WHEN 1 THEN 2.0 * y / (1.0 + sqrt(1.0))
    ELSE CASE WHEN y * 1.03125 >= 0.1875
              THEN 0.25 + 2.0 * (y * 1.03125 - 0.1875) / (1.0 + sqrt(1.0 + (2.0 / 3.0) * (y * 1.03125 - 0.1875)))
              ELSE 0.0 + 2.0 * (y * 1.03125) / (0.5 + sqrt(0.25 + 4.0 * (y * 1.03125))) END END, 9) END AS position
FROM h
"""
