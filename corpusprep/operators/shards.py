"""Shard work lists, ledger and progress.

Work lists are sets of at most 4,096 shard names. They are computed from the
data with a partial aggregation (``distinct`` on the shard column runs
map-side first), so the data is never shuffled to build them, and anything
joined to the 4,096-name domain is bounded by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusprep.functions import keys as K

# --- fixed values (must equal the studied tool's) -------------------------
# Published embedding sets, by shard prefix: five one-digit prefixes 0-4,
# every two-digit prefix from 50 to df, and the one-digit prefixes e and f.
PUBLISHED_ONE_DIGIT = ("0", "1", "2", "3", "4", "e", "f")
PUBLISHED_TWO_DIGIT_RANGE = ("50", "df")
# Default shard range of the command line tools.
DEFAULT_RANGE = ("000", "fff")
# ---------------------------------------------------------------------------


def present_shards(df: DataFrame, shard: str = "shard") -> DataFrame:
    """Distinct shard names in a table that are valid shard names."""
    return df.select(F.col(shard).alias("shard")).where(K.is_shard_name("shard")).distinct()


def bucket_by_shard(df: DataFrame, shard: str = "shard") -> DataFrame:
    """A1: rows per shard (map-side partial counts, at most 4,096 groups)."""
    return df.groupBy(F.col(shard).alias("shard")).agg(F.count(F.lit(1)).alias("n_rows"))


def corpus_flagship(samples: DataFrame) -> DataFrame:
    """Per first key character: rows, distinct shards, images, geotagged.

    Expects coerced samples (P3): ``longitude``/``latitude`` null when absent.
    """
    return samples.groupBy(F.substring("key", 1, 1).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("shard").alias("n_shards"),
        F.count(F.when(F.col("marker") == 0, 1)).alias("n_images"),
        F.count(F.when(F.col("longitude").isNotNull() & F.col("latitude").isNotNull(), 1)).alias("n_geo"),
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Finished shards from a ledger folder; empty when it does not exist."""
    from corpusprep.sources.tables import read_text_lines
    return scan_ledger(read_text_lines(spark, path, "shard"))


def scan_ledger(ledger: DataFrame) -> DataFrame:
    """The ledger as a set of shard names (repeats and blanks dropped)."""
    return ledger.select(F.trim(F.col("shard")).alias("shard")).where(F.col("shard") != "").distinct()


def select_shards(present: DataFrame, finished: DataFrame | None = None,
                  start: str = DEFAULT_RANGE[0], end: str = DEFAULT_RANGE[1],
                  shards: list[str] | None = None) -> DataFrame:
    """(present ∩ range) − finished; an explicit list overrides both."""
    if shards:
        spark = present.sparkSession
        return spark.createDataFrame([(s,) for s in sorted(set(shards))], "shard string")
    out = present.where(K.in_hex_range("shard", start, end)).select("shard").distinct()
    if finished is not None:
        out = out.join(finished.select("shard").distinct(), "shard", "left_anti")
    return out


def convertible_shards(meta: DataFrame, blobs: DataFrame, finished: DataFrame | None = None,
                       overwrite: bool = False) -> DataFrame:
    """Metadata shards that have blobs, minus finished unless overwriting."""
    out = meta.select("shard").distinct().join(blobs.select("shard").distinct(), "shard", "left_semi")
    if finished is not None and not overwrite:
        out = out.join(finished.select("shard").distinct(), "shard", "left_anti")
    return out


def repair_shards(present: DataFrame, start: str = DEFAULT_RANGE[0],
                  end: str = DEFAULT_RANGE[1]) -> DataFrame:
    """Present ∩ range; the ledger is ignored by repair."""
    spark = present.sparkSession
    rng = K.hex_range(spark, start, end)
    return present.select("shard").distinct().intersect(rng)


def archives_in_range(archive_files: DataFrame, start: str, end: str,
                      file_col: str = "archive_file") -> DataFrame:
    """U4: existing archive files ∩ the expected ``<shard>.zip`` names in range."""
    spark = archive_files.sparkSession
    expected = K.hex_range(spark, start, end).select(F.concat("shard", F.lit(".zip")).alias(file_col))
    return archive_files.select(file_col).distinct().intersect(expected) \
        .withColumn("shard", K.file_shard(file_col))


def sorted_positions(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """O2 / O3: 1-based position in a global order (range-partitioned: no task
    holds the whole list)."""
    from corpusprep.operators.windows import row_number_within
    return row_number_within(df, [], order, name)


def shard_progress(present: DataFrame, finished: DataFrame) -> DataFrame:
    """One row: present, finished and pending shard counts, and the first
    and last finished / pending names (nulls when a set is empty: D5)."""
    p = present.select("shard").distinct().withColumn("_p", F.lit(True))
    f = finished.select("shard").distinct().withColumn("_f", F.lit(True))
    j = p.join(f, "shard", "full")
    pending = F.col("_p") & F.col("_f").isNull()
    return j.agg(
        F.count("_p").alias("n_present"),
        F.count("_f").alias("n_finished"),
        F.count(F.when(pending, 1)).alias("n_pending"),
        F.min(F.when(F.col("_f"), F.col("shard"))).alias("first_finished"),
        F.max(F.when(F.col("_f"), F.col("shard"))).alias("last_finished"),
        F.min(F.when(pending, F.col("shard"))).alias("first_pending"),
        F.max(F.when(pending, F.col("shard"))).alias("last_pending"),
    )


def shard_sizes(archive: DataFrame, samples: DataFrame) -> DataFrame:
    """A10: members per archive and samples per shard (0 when absent)."""
    a = archive.groupBy("shard").agg(F.count(F.lit(1)).alias("n_members"))
    s = samples.groupBy("shard").agg(F.count(F.lit(1)).alias("n_samples"))
    return a.join(s, "shard", "full").select(
        "shard", F.coalesce("n_members", F.lit(0)).alias("n_members"),
        F.coalesce("n_samples", F.lit(0)).alias("n_samples"))


def assign_devices(shards: DataFrame, n_devices: int) -> DataFrame:
    """Sorted shards in equal contiguous runs, the remainder to the last
    device (not ``ntile``, which spreads the remainder over the first ones).

    With fewer shards than devices each shard gets its own device (D10).
    Only valid shard names count (at most 4,096), so one ordered window is
    bounded.
    """
    w = Window.orderBy("shard")
    total = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    per = F.greatest(F.floor(total / n_devices), F.lit(1))
    return present_shards(shards) \
        .withColumn("_rn", F.row_number().over(w)).withColumn("_per", per) \
        .select("shard", F.least(F.floor((F.col("_rn") - 1) / F.col("_per")),
                                 F.lit(n_devices - 1)).cast("bigint").alias("device"))


def published_prefixes(spark: SparkSession) -> DataFrame:
    """The 151 published prefixes, built from the rule (not listed by hand)."""
    lo, hi = (int(x, 16) for x in PUBLISHED_TWO_DIGIT_RANGE)
    two = spark.range(lo, hi + 1, 1, 1).select(F.lower(F.hex("id")).alias("prefix"))
    one = spark.createDataFrame([(p,) for p in PUBLISHED_ONE_DIGIT], "prefix string")
    return one.unionByName(two)


def prefix_coverage(shards: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The published prefix that covers each shard (null if none).

    ``startswith`` is turned into an equi-join: a shard's possible prefixes
    are its first one and first two characters. The prefix table is the
    151-row published list, so broadcasting it is bounded.
    """
    s = shards.select("shard").distinct()
    cand = s.select("shard", F.explode(F.array(F.substring("shard", 1, 1), F.substring("shard", 1, 2)))
                    .alias("prefix"))
    hit = cand.join(F.broadcast(prefixes.select("prefix").distinct()), "prefix", "inner")
    covered = hit.groupBy("shard").agg(F.max("prefix").alias("prefix"), F.count(F.lit(1)).alias("n_cover"))
    return s.join(covered, "shard", "left").select(
        "shard", "prefix", F.coalesce("n_cover", F.lit(0)).alias("n_cover"))


def prefix_bounds(spark: SparkSession, pre_start: str, pre_end: str) -> DataFrame:
    """Two-digit prefixes between bounds with their ``…0`` / ``…f`` shards.

    As in the studied release loop, the bounds go through the 3-digit hex
    range and the first character is dropped.
    """
    rng = K.hex_range(spark, pre_start, pre_end, "h")
    return rng.select(F.expr("substring(h, 2)").alias("prefix")) \
        .select("prefix", F.concat("prefix", F.lit("0")).alias("start"),
                F.concat("prefix", F.lit("f")).alias("end"))


def count_in_domain(domain: DataFrame, data: DataFrame, on: str = "shard",
                    name: str = "n_samples") -> DataFrame:
    """Left join a bounded name table with per-name counts of a data table."""
    counts = data.groupBy(on).agg(F.count(F.lit(1)).alias(name))
    return domain.join(counts, on, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))
