"""Table and file scans.

Every reader passes an explicit schema where files are involved: shard
directories such as ``00f`` or ``1e5`` must stay strings, and JSON inference
would scan the data twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions import keys as K

SAMPLE_TYPES = {
    "downloadurl": T.StringType(), "longitude": T.DoubleType(), "latitude": T.DoubleType(),
    "accuracy": T.LongType(), "marker": T.IntegerType(), "ext": T.StringType(), "key": T.StringType(),
}


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Full scan of a source table (Parquet by default; any Spark format,
    e.g. ``jdbc`` with ``partitionColumn`` / ``numPartitions`` for databases)."""
    return spark.read.format(fmt).options(**options).load(path) if fmt != "jdbc" \
        else spark.read.format("jdbc").options(**options).load()


def describe_columns(df: DataFrame) -> DataFrame:
    """Column names and types of a table, from its schema alone (the
    ``limit 0`` probe of the studied tool; no job runs)."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string")


def profile_columns(df: DataFrame) -> DataFrame:
    """S2 with data: ``(position, name, n_non_null)`` for every column, in one
    pass (one partial aggregate per column, then an unpivot of one row)."""
    names = df.columns
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)])
    pairs = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.col(f"c{i}").alias("n_non_null"))
             for i, c in enumerate(names)]
    return counts.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def sample_schema(extra: T.StructType | None = None) -> T.StructType:
    fields = [T.StructField(n, t, True) for n, t in SAMPLE_TYPES.items()]
    if extra is not None:
        known = set(SAMPLE_TYPES)
        fields += [f for f in extra.fields if f.name not in known]
    return T.StructType(fields)


def read_metadata_shards(spark: SparkSession, path: str, schema: T.StructType | None = None,
                         layout: str = "partitioned", on_error: str = "raise") -> DataFrame:
    """S3: metadata shards as gzip JSON lines.

    ``partitioned``: ``shard=<name>/`` directories written by K1 (the shard
    column is declared a string, never inferred). ``flat``: one ``<shard>.gz``
    file per shard, the shard taken from the file name. Multi-member gzip
    files read whole. A line that is no JSON object of the schema fails the scan;
    with ``on_error="reject"`` it is left out, and :func:`metadata_rejects` names it.
    """
    schema = schema or sample_schema()
    if on_error == "reject":
        return _parsed_lines(spark, path, schema, layout).where(f"_row.{CORRUPT} is null") \
            .select(*[F.col(f"_row.`{f.name}`").alias(f.name) for f in schema.fields], "shard")
    if layout == "partitioned":
        full = T.StructType(schema.fields + [T.StructField("shard", T.StringType(), True)])
        return spark.read.schema(full).option("mode", "FAILFAST").json(path)
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return df.withColumn("shard", K.file_shard(F.col("_metadata.file_name"))) \
        .where(K.is_shard_name("shard"))


#: Name of the parser's column for a line that it cannot read.
CORRUPT = "_corrupt_line"


def _parsed_lines(spark: SparkSession, path: str, schema: T.StructType, layout: str) -> DataFrame:
    """``(shard, file, line, _row)`` of every line that is not blank."""
    if layout == "partitioned":
        lines = spark.read.schema("value string, shard string").text(path).select("shard", F.col("_metadata.file_path").alias("file"), "value")
    else:
        lines = spark.read.text(path).select(K.file_shard(F.col("_metadata.file_name")).alias("shard"), F.col("_metadata.file_path").alias("file"), "value") \
            .where(K.is_shard_name("shard"))
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    row = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.where(F.trim("value") != "").withColumn("_row", row).withColumnRenamed("value", "line")


def metadata_rejects(spark: SparkSession, path: str, schema: T.StructType | None = None, layout: str = "partitioned") -> DataFrame:
    """S3's reject table: ``(shard, file, line)`` of the lines that cannot be read."""
    return _parsed_lines(spark, path, schema or sample_schema(), layout).where(f"_row.{CORRUPT} is not null").select("shard", "file", "line")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist on its (Hadoop) file system - a metadata call only."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))
    except Exception:  # noqa: BLE001 - no JVM handle: ask Spark to list it
        try:
            spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
            return True
        except Exception:  # noqa: BLE001
            return False


def read_text_lines(spark: SparkSession, path: str, col: str = "line",
                    with_shard: bool = False) -> DataFrame:
    """Text lines of all files under ``path``; empty result if it is absent."""
    if not path_exists(spark, path):
        schema = f"{col} string" + (", shard string" if with_shard else "")
        return spark.createDataFrame([], schema)
    df = spark.read.text(path).withColumnRenamed("value", col)
    if with_shard:
        df = df.withColumn("shard", K.file_shard(F.col("_metadata.file_name")))
    return df


def read_error_logs(spark: SparkSession, path: str) -> DataFrame:
    """All ``<shard>.err`` files: (shard, line) with the shard from the name."""
    return read_text_lines(spark, path, "line", with_shard=True)


def scan_feature_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys already in the feature store - a key-only (pruned) scan."""
    return spark.read.schema("key string, feature array<float>").parquet(path).select("key")


def file_checksums(spark: SparkSession, path: str, chunk_bytes: int = 16 << 20) -> DataFrame:
    """S10 source: ``(path, length, md5)`` of every file under ``path``.

    Only the listing is a table; each task streams its files in pieces of
    ``chunk_bytes``, so a file may be larger than a row can hold.
    """
    import hashlib

    import pandas as pd

    from corpusprep.sources.archives import _open

    def digest(batches):
        for pdf in batches:
            rows = []
            for name, length in zip(pdf["path"], pdf["length"], strict=True):
                h = hashlib.md5()
                with _open(name) as fh:
                    while piece := fh.read(chunk_bytes):
                        h.update(piece)
                rows.append((name, length, h.hexdigest()))
            yield pd.DataFrame(rows, columns=["path", "length", "md5"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = spark.read.format("binaryFile").load(path).select("path", "length").repartition(n, "path")
    return files.mapInPandas(digest, "path string, length bigint, md5 string")


def verify_checksums(files: DataFrame, expected: DataFrame, on: str = "path") -> DataFrame:
    """Compare computed MD5s with an expected table; ``ok`` per file."""
    e = expected.select(F.col(on), F.lower(F.col("md5")).alias("expected_md5"))
    return files.join(e, on, "left").withColumn(
        "ok", F.coalesce(F.col("md5") == F.col("expected_md5"), F.lit(False)))
