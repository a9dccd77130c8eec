"""Key, shard and object-path Column builders (all JVM-side expressions).

Nothing here triggers a job: every function returns a ``Column`` or a
DataFrame built from ``spark.range`` / a projection, so Catalyst keeps the
expressions inside whole-stage codegen and pushes filters on them down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values (must equal the studied tool's) -------------------------
# Object path prefix per marker (0 = image, 1 = video).
PREFIX = ("data/images", "data/videos/mp4")
# Standard file extension per marker.
EXTENSION = ("jpg", "mp4")
# Name of the payload column per marker.
DATAKEYS = ("image", "video")
# Shard names are the first SHARD_CHARS characters of the key.
SHARD_CHARS = 3
# Kind names accepted on the command line of the studied tool.
KIND_CODES = {"images": 0, "videos": 1}
# ---------------------------------------------------------------------------

# One MD5 byte as two hex characters; a leading zero nibble is dropped, so a
# byte prints as `%x` and not `%02x`. Every match consumes exactly two
# characters, which keeps the byte alignment.
_UNPAD = r"0([0-9a-f])|([1-9a-f][0-9a-f])"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def derive_key(url: Column | str) -> Column:
    """Unpadded lower-case hex MD5 of the UTF-8 URL (16 to 32 chars)."""
    return F.regexp_replace(F.md5(F.encode(_c(url), "UTF-8")), _UNPAD, "$1$2")


def derive_shard(key: Column | str) -> Column:
    """The shard of a key is its first three characters."""
    return F.substring(_c(key), 1, SHARD_CHARS)


def by_marker(marker: Column | str, values: tuple[str, str]) -> Column:
    """Pick ``values[0]`` for images (marker 0) and ``values[1]`` otherwise."""
    return F.when(_c(marker) == 0, F.lit(values[0])).otherwise(F.lit(values[1]))


def object_stem(key: Column | str, marker: Column | str) -> Column:
    """``prefix/h[:3]/h[3:6]/h.`` - shared start of both candidate paths."""
    k = _c(key)
    return F.concat(by_marker(marker, PREFIX), F.lit("/"), F.substring(k, 1, 3),
                    F.lit("/"), F.substring(k, 4, 3), F.lit("/"), k, F.lit("."))


def canonical_key(key: Column | str, marker: Column | str) -> Column:
    """Candidate 0: the stem plus the standard extension of the kind."""
    return F.concat(object_stem(key, marker), by_marker(marker, EXTENSION))


def alternate_key(key: Column | str, marker: Column | str, ext: Column | str) -> Column:
    """Candidate 1: the stem plus the sample's own extension."""
    return F.concat(object_stem(key, marker), _c(ext))


def key_of_object(object_key: Column | str) -> Column:
    """Sample key embedded in an object path (the name between the last
    directory and the first dot).

    For every candidate path built by :func:`object_stem` this returns the
    sample's key exactly (keys are hex: no ``/`` and no ``.``), whatever the
    extension holds. It is the hash key the store is partitioned on, so a
    store listing and a sample table meet in one co-partitioned join.
    """
    prefixes = "|".join(p.replace("/", r"\/") for p in PREFIX)
    return F.regexp_extract(_c(object_key), rf"^(?:{prefixes})/[^/]*/[^/]*/([^/.]*)\.", 1)


def candidate_struct(key: Column | str, marker: Column | str, ext: Column | str) -> Column:
    """The two ordered candidates as ``array<struct<canonical, object_key>>``.

    ``posexplode`` of this gives ``(ord, cand)``; ord 0 is the canonical path,
    ord 1 the path with the original extension.
    """
    canon = canonical_key(key, marker)
    return F.array(
        F.struct(canon.alias("canonical"), canon.alias("object_key")),
        F.struct(canon.alias("canonical"), alternate_key(key, marker, ext).alias("object_key")),
    )


def stem_last_suffix(name: Column | str) -> Column:
    """``Path(name).stem`` - the base name without its last suffix.

    As in Python's path rule: trailing slashes are ignored, and the last dot
    splits only when it is neither the first nor the last character of the
    base name (``.hidden``, ``a.`` and ``a.b.`` keep their names).
    """
    base = F.regexp_extract(F.regexp_replace(_c(name), "/+$", ""), r"([^/]*)$", 1)
    return F.when(base.rlike(r"^.+\.[^.]+$"), F.regexp_extract(base, r"^(.+)\.[^.]+$", 1)).otherwise(base)


def stem_first_dot(name: Column | str) -> Column:
    """``name.split('/')[-1].split('.')[0]`` - up to the first dot."""
    return F.substring_index(F.substring_index(_c(name), "/", -1), ".", 1)


def file_shard(path: Column | str) -> Column:
    """``basename(path).split('.')[0]`` - archive or log file to shard."""
    return stem_first_dot(path)


def normalize_hex(bound: str) -> str:
    """A hex bound as the studied tool prints it: lower case, padded to 3."""
    return format(int(bound, 16), "x").zfill(SHARD_CHARS)


def hex_name(n: Column) -> Column:
    """Lower-case hex of an integer, zero-padded to 3 (never truncated)."""
    h = F.lower(F.hex(n))
    return F.when(F.length(h) < SHARD_CHARS, F.lpad(h, SHARD_CHARS, "0")).otherwise(h)


def in_hex_range(shard: Column | str, start: str, end: str) -> Column:
    """Inclusive hex range on fixed-width lower-case names.

    Fixed-width lower-case hex sorts like the integers it encodes, so a plain
    ``BETWEEN`` on the partition column is exact and prunes partitions.
    """
    lo, hi = int(start, 16), int(end, 16)
    s = _c(shard)
    if lo > hi:
        return F.lit(False)
    lo_s, hi_s = normalize_hex(start), normalize_hex(end)
    cond = is_shard_name(s)  # names like `3zz` sort into a range but are no shards
    if len(lo_s) > SHARD_CHARS:
        return F.lit(False)
    if len(hi_s) > SHARD_CHARS:
        return cond & (s >= lo_s)
    return cond & s.between(lo_s, hi_s)


def hex_range(spark: SparkSession, start: str, end: str, name: str = "shard") -> DataFrame:
    """Table of hex names from ``start`` to ``end`` inclusive, padded to 3."""
    lo, hi = int(start, 16), int(end, 16)
    parts = max(1, -(-(hi + 1 - lo) // 65536))  # one for shard names, more for wider ranges
    return spark.range(lo, hi + 1, 1, parts).select(hex_name(F.col("id")).alias(name))


def shard_domain(spark: SparkSession) -> DataFrame:
    """All 4,096 shard names with their metadata and archive file names."""
    return hex_range(spark, "000", "fff").select(
        "shard",
        F.concat("shard", F.lit(".gz")).alias("meta_file"),
        F.concat("shard", F.lit(".zip")).alias("archive_file"),
    )


def is_shard_name(name: Column | str) -> Column:
    """Valid shard name: exactly three lower-case hex digits."""
    return _c(name).rlike(r"^[0-9a-f]{3}$")


def kind_code(kind: Column | str) -> Column:
    """``images``/``videos`` to 0/1; anything else null."""
    k = _c(kind)
    expr = None
    for name, code in KIND_CODES.items():
        expr = F.when(k == name, F.lit(code)) if expr is None else expr.when(k == name, F.lit(code))
    return expr


def kinds_to_codes(kinds) -> list[int]:
    """Accept kind names or codes (fixes the argument-order defect D3)."""
    out = []
    for k in kinds:
        out.append(KIND_CODES[k] if isinstance(k, str) else int(k))
    return out
