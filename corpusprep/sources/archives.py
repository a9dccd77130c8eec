"""Zip archive shards as tables.

The file listing comes from the ``binaryFile`` source with only ``path``
selected, so no archive is loaded into a row (a 27,000-image shard is larger
than a JVM byte array). The index pass reads the central directories, one
archive per row of the listing, the listing dealt to an explicit number of
partitions (which AQE does not fold back into one task). The payload pass
reads *runs* of members cut from the index, of at most ``run_bytes`` each, so
one huge archive is read by many tasks; a task holds one Arrow batch of at
most ``batch_bytes`` (or one member) at a time.

An archive that cannot be read fails the scan. With ``on_error="reject"`` it
has no members, and :func:`archive_rejects` names it and the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions import keys as K

INDEX_SCHEMA = "shard string, archive string, ord int, name string, size bigint, error string"
MEMBER_SCHEMA = "shard string, archive string, ord int, name string, data binary"
RUN_BYTES = 64 << 20
BATCH_BYTES = 8 << 20


def list_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """Archive files under ``path``: (archive path, shard from the file name)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path) \
        .select(F.col("path").alias("archive")) \
        .withColumn("shard", K.file_shard("archive"))


def _open(path: str):
    """Seekable handle on an archive: local files directly, other file
    systems (HDFS, object stores) through Arrow's file system layer."""
    if path.startswith("file:"):
        return open(path[len("file:"):], "rb")
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs as pafs
    filesystem, inner = pafs.FileSystem.from_uri(path)
    return filesystem.open_input_file(inner)


def _read_index(reject: bool):
    def run(batches):
        import zipfile

        import pandas as pd
        cols = ["shard", "archive", "ord", "name", "size", "error"]
        for pdf in batches:
            for shard, archive in zip(pdf["shard"], pdf["archive"], strict=True):
                try:
                    with zipfile.ZipFile(_open(archive), "r") as zf:
                        infos = zf.infolist()
                except (zipfile.BadZipFile, OSError) as e:
                    if not reject:
                        raise RuntimeError(f"cannot read archive {archive}: {e}") from e
                    yield pd.DataFrame([(shard, archive, None, None, None, f"{type(e).__name__}: {e}")], columns=cols)
                    continue
                for at in range(0, len(infos), 10_000):
                    part = infos[at:at + 10_000]
                    yield pd.DataFrame([(shard, archive, at + i, f.filename, f.file_size, None) for i, f in enumerate(part)], columns=cols)
    return run


def _index(spark: SparkSession, path: str, glob: str, reject: bool) -> DataFrame:
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return list_archives(spark, path, glob).repartition(n, "archive").mapInPandas(_read_index(reject), INDEX_SCHEMA)


def archive_index(spark: SparkSession, path: str, glob: str = "*.zip", on_error: str = "raise") -> DataFrame:
    """(shard, archive, ord, name, size) for every member; no bytes read."""
    return _index(spark, path, glob, on_error == "reject").where("error is null").drop("error")


def archive_rejects(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """``(shard, archive, error)`` of the archives that cannot be read."""
    return _index(spark, path, glob, True).where("error is not null").select("shard", "archive", "error")


def _read_runs(batch_bytes: int):
    def run(batches):
        import zipfile

        import pandas as pd
        cols = ["shard", "archive", "ord", "name", "data"]
        for pdf in batches:
            for shard, archive, first, last in zip(pdf["shard"], pdf["archive"], pdf["first"], pdf["last"], strict=True):
                rows, held = [], 0
                with zipfile.ZipFile(_open(archive), "r") as zf:
                    infos = zf.infolist()
                    for i in range(int(first), int(last) + 1):
                        data = zf.read(infos[i])
                        if rows and held + len(data) > batch_bytes:
                            yield pd.DataFrame(rows, columns=cols)
                            rows, held = [], 0
                        rows.append((shard, archive, i, infos[i].filename, data))
                        held += len(data)
                if rows:
                    yield pd.DataFrame(rows, columns=cols)
    return run


def archive_members(spark: SparkSession, path: str, glob: str = "*.zip", on_error: str = "raise",
                    run_bytes: int = RUN_BYTES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(shard, archive, ord, name, data) of every member."""
    from pyspark.sql import Window
    index = archive_index(spark, path, glob, on_error)
    # an archive's directory is at most its member count of small rows
    before = Window.partitionBy("archive").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.floor(F.coalesce(F.sum("size").over(before), F.lit(0)) / F.lit(run_bytes))
    runs = index.withColumn("_run", cut).groupBy("shard", "archive", "_run") \
        .agg(F.min("ord").alias("first"), F.max("ord").alias("last"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(n, "archive", "_run").drop("_run").mapInPandas(_read_runs(batch_bytes), MEMBER_SCHEMA)
