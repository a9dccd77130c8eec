"""Zip archive shards as a Spark data source (S6, S7, F2): ``spark.read.format("zip_shards")``.

``partitions()`` lists the archives and cuts each by the size of its file into
ranges of ``run_bytes``; no archive is opened on the driver. A task opens its archive, reads the
central directory and serves the members whose headers begin in its range, so one huge
archive is read by many tasks. Filters on ``shard`` are pushed into the
listing: archives of other shards are neither listed as partitions nor opened.
With ``payload=false`` the source is an index that never reads a member.

Register it with :func:`register`. Spark takes filters from a Python source only where
``spark.sql.python.filterPushdown.enabled`` is set; elsewhere the same source
is registered without, and Spark filters its rows.

Options: ``path``; ``payload`` (true); ``run_bytes``, ``batch_bytes``; ``on_error`` (``raise``, or
``reject``: an archive that cannot be read has no members here,
and ``archives.archive_rejects`` names it).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith

from corpusprep.sources.archives import BATCH_BYTES, RUN_BYTES, _open

FORMAT = "zip_shards"
INDEX = "shard string, archive string, ord int, name string, size bigint"


@dataclass
class Run(InputPartition):
    """Bytes ``first`` to ``last`` (exclusive) of one archive."""
    shard: str
    archive: str
    first: int
    last: int


def _listing(path: str) -> list[tuple[str, str, int]]:
    """``(shard, archive, file size)`` of the archives under ``path``, from names and sizes alone."""
    from pyarrow import fs
    if path.startswith("file:") and not path.startswith("file://"):
        path = path[len("file:"):]
    files, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    store = path[:-len(inner)] if path.endswith(inner) else path.split("://", 1)[0] + "://"
    found = files.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted((f.base_name.split(".")[0], store + f.path, f.size) for f in found if f.is_file and f.base_name.endswith(".zip"))


class ArchiveReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.schema = options["path"], schema
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.run_bytes, self.batch_bytes = int(options.get("run_bytes", RUN_BYTES)), int(options.get("batch_bytes", BATCH_BYTES))
        self.reject = options.get("on_error", "raise") == "reject"
        self.shards: list = []  # tests that a shard must pass

    def partitions(self):
        kept = [x for x in _listing(self.path) if all(test(x[0]) for test in self.shards)]
        return [Run(shard, archive, at, at + self.run_bytes) for shard, archive, size in kept for at in range(0, max(size, 1), self.run_bytes)] \
            or [Run("", "", 0, 0)]

    def read(self, run: Run):
        import zipfile

        import pyarrow as pa
        if not run.archive:
            return
        names = self.schema.names
        rows, held = [], 0

        def batch():
            kinds = {"ord": pa.int32(), "size": pa.int64(), "data": pa.binary()}
            cols = [pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows, strict=True), strict=True)]
            return pa.RecordBatch.from_arrays(cols, names=names)
        try:
            archive = zipfile.ZipFile(_open(run.archive), "r")
        except (zipfile.BadZipFile, OSError) as e:
            if self.reject:
                return
            raise RuntimeError(f"cannot read archive {run.archive}: {e}") from e
        with archive:
            for i, info in enumerate(archive.infolist()):
                if not run.first <= info.header_offset < run.last:
                    continue
                last = archive.read(info) if self.payload else info.file_size
                rows.append((run.shard, run.archive, i, info.filename, last))
                held += info.file_size if self.payload else 0
                if held >= self.batch_bytes or len(rows) >= 10_000:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()


class PushedArchiveReader(ArchiveReader):
    """The reader of sessions that push filters into Python sources."""

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("shard",):
                self.shards.append(lambda shard, v=f.value: shard == v)
            elif isinstance(f, In) and f.attribute == ("shard",):
                self.shards.append(lambda shard, v=frozenset(f.value): shard in v)
            elif isinstance(f, StringStartsWith) and f.attribute == ("shard",):
                self.shards.append(lambda shard, v=f.value: shard.startswith(v))
            elif not (isinstance(f, IsNotNull) and f.attribute == ("shard",)):  # a shard is never null
                yield f


class ArchiveSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        payload = str(self.options.get("payload", "true")).lower() != "false"
        return INDEX.replace("size bigint", "data binary") if payload else INDEX

    def reader(self, schema):
        return ArchiveReader(self.options, schema)


class PushedArchiveSource(ArchiveSource):
    def reader(self, schema):
        return PushedArchiveReader(self.options, schema)


def register(spark: SparkSession) -> None:
    """Makes ``spark.read.format("zip_shards")`` known to ``spark``, with pushed filters where the session has them."""
    from corpusprep.session import ship_package
    ship_package(spark)
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true"
    spark.dataSource.register(PushedArchiveSource if pushed else ArchiveSource)


def read_archives(spark: SparkSession, path: str, payload: bool = True, **options) -> DataFrame:
    """S6 (``payload=False``) and S7 through the data source."""
    register(spark)
    return spark.read.format(FORMAT).option("payload", str(payload).lower()).options(**options).load(path)
