"""Fixture files: zip shards and image files made from the driver tables, so that
the archive and image sources have something to read. Not part of the library.

Rows are clustered by shard and sorted inside each task, then streamed into
one file per shard with ``mapInPandas``: memory per task is one Arrow batch,
never a whole shard, and every task writes its own shards in parallel. The
emitted rows (one per file) are the write report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_SCHEMA = "shard string, path string, n_members bigint"


class _Replacing:
    """A local file written under a temporary name and renamed when it is
    complete: two attempts of one task never write into one file."""

    def __init__(self, path: str):
        import os
        import uuid
        os.makedirs(os.path.dirname(path), exist_ok=True)
        self.path, self.temporary = path, f"{os.path.dirname(path)}/.{uuid.uuid4().hex}.part"
        self.fh = open(self.temporary, "wb")

    def __getattr__(self, name):
        return getattr(self.fh, name)

    def close(self):
        import os
        if not self.fh.closed:
            self.fh.close()
            os.replace(self.temporary, self.path)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


def _open_out(path: str):
    if path.startswith("file:"):
        path = path[len("file:"):]
    if "://" not in path:
        return _Replacing(path)
    from pyarrow import fs as pafs
    filesystem, inner = pafs.FileSystem.from_uri(path)
    return filesystem.open_output_stream(inner)


def write_zip_shards(members: DataFrame, path: str, name_col: str = "name",
                     data_col: str = "data", order: str = "ord") -> DataFrame:
    """Write ``<path>/<shard>.zip`` from ``(shard, ord, name, data)`` rows.

    Returns a lazy report ``(shard, path, n_members)``; the files are written
    when it is evaluated (``.collect()`` of the small report, or ``count``).
    """
    base = path.rstrip("/")

    def run(batches):
        import warnings
        import zipfile
        import pandas as pd
        # repeated member names are legal in a zip (readers take the first);
        # the archives being reproduced contain them
        warnings.filterwarnings("ignore", message="Duplicate name", category=UserWarning)
        cur, zf, fh, n, out = None, None, None, 0, []

        def close():
            if zf is not None:
                zf.close()
                fh.close()
                out.append((cur, f"{base}/{cur}.zip", n))

        for pdf in batches:
            for shard, name, data in zip(pdf["shard"], pdf[name_col], pdf[data_col]):
                if shard != cur:
                    close()
                    cur, n = shard, 0
                    fh = _open_out(f"{base}/{shard}.zip")
                    zf = zipfile.ZipFile(fh, "w")
                payload = data if isinstance(data, (bytes, bytearray)) else str(data).encode("utf-8")
                zf.writestr(name, payload)
                n += 1
        close()
        if out:
            yield pd.DataFrame(out, columns=["shard", "path", "n_members"])

    ordered = members.select("shard", name_col, data_col, order) \
        .repartition("shard").sortWithinPartitions("shard", order, name_col)
    return ordered.drop(order).mapInPandas(run, REPORT_SCHEMA)


def write_files(df: DataFrame, path: str, name_col: str, data_col: str) -> DataFrame:
    """Write one file per row. Returns a lazy report."""
    base = path.rstrip("/")

    def run(batches):
        import pandas as pd
        for pdf in batches:
            rows = []
            for name, data in zip(pdf[name_col], pdf[data_col], strict=True):
                with _open_out(f"{base}/{name}") as fh:
                    fh.write(data if isinstance(data, (bytes, bytearray)) else str(data).encode("utf-8"))
                rows.append((name, f"{base}/{name}", 1))
            yield pd.DataFrame(rows, columns=["shard", "path", "n_members"])

    return df.select(name_col, data_col).mapInPandas(run, REPORT_SCHEMA)


def png_gray(width: int, height: int, pixels: bytes) -> bytes:
    """Encode 8-bit grayscale pixels (row-major) as a PNG file."""
    import struct
    import zlib

    def chunk(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body) & 0xFFFFFFFF)

    raw = b"".join(b"\x00" + pixels[r * width:(r + 1) * width] for r in range(height))
    ihdr = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def write_gray_images(df: DataFrame, path: str, name_col: str, pixels_col: str,
                      width: int, height: int) -> DataFrame:
    """Write one PNG per row (``pixels_col`` = array of 0-255 ints, or null for
    an undecodable file, written as junk bytes). Returns a lazy report."""
    base = path.rstrip("/")

    def run(batches):
        import pandas as pd
        for pdf in batches:
            rows = []
            for name, px in zip(pdf[name_col], pdf[pixels_col]):
                target = f"{base}/{name}.png"
                with _open_out(target) as fh:
                    if px is None:
                        fh.write(b"not an image")
                    else:
                        fh.write(png_gray(width, height, bytes(int(v) for v in px)))
                rows.append((name, target, 1))
            if rows:
                yield pd.DataFrame(rows, columns=["shard", "path", "n_members"])

    return df.select(F.col(name_col).cast("string").alias(name_col), pixels_col).mapInPandas(run, REPORT_SCHEMA)
