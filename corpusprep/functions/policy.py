"""Value coercion and image re-compression policy as Column builders.

The policy decides *what* happens to an image (resize target, chroma
subsampling, whether it is re-encoded at all); the pixel codec itself is the
caller's. Every rule is a JVM expression, so it stays in codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values (must equal the studied tool's) -------------------------
# Default re-compression settings.
DEFAULT_QUALITY = 85
DEFAULT_SUBSAMPLING = "422"
DEFAULT_TARGET_SIZE = 500          # long side of a re-encoded image
FULL_CHROMA = "444"                # used for small images
SMALL_FACTOR = 0.5                 # pixels <= 0.5 * target -> small image
LARGE_FACTOR = 1.5                 # pixels > 1.5 * target -> downscale
# Quality gate: a payload below this many bytes whose 95th percentile of
# column variance is below the threshold is garbage.
GATE_MIN_BYTES = 20000
GATE_PERCENTILE = 0.95
GATE_MIN_VARIANCE = 50.0
SUBSAMPLING_CHOICES = ("444", "422", "411", "420")
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def coerce_float(col, dtype: T.DataType) -> Column:
    """Falsy -> null, else double.

    Falsiness depends on the source type: numeric 0 / 0.0 and SQL NULL are
    falsy, and so is the empty string; the strings ``'0'`` and ``'0.0'`` are
    not (they become 0.0).
    """
    c = _c(col)
    if isinstance(dtype, T.StringType):
        return F.when(c.isNull() | (c == ""), F.lit(None).cast("double")).otherwise(c.cast("double"))
    if isinstance(dtype, T.BooleanType):
        return F.when(c.isNull() | ~c, F.lit(None).cast("double")).otherwise(F.lit(1.0))
    return F.when(c.isNull() | (c == 0), F.lit(None).cast("double")).otherwise(c.cast("double"))


def coerce_int(col, dtype: T.DataType) -> Column:
    """P5: falsy -> null, else a 64-bit integer (numbers truncate toward 0)."""
    c = _c(col)
    if isinstance(dtype, T.StringType):
        return F.when(c.isNull() | (c == ""), F.lit(None).cast("bigint")).otherwise(c.cast("bigint"))
    if isinstance(dtype, T.BooleanType):
        return F.when(c.isNull() | ~c, F.lit(None).cast("bigint")).otherwise(F.lit(1).cast("bigint"))
    return F.when(c.isNull() | (c == 0), F.lit(None).cast("bigint")).otherwise(c.cast("bigint"))


def target_geometry(target_size: int = DEFAULT_TARGET_SIZE) -> tuple[int, int]:
    """Short side = ceil(t/4*3); target pixels = t * short side."""
    short = int(math.ceil(target_size / 4 * 3))
    return short, target_size * short


def target_geometry_col(target) -> Column:
    """P22 for a per-row target: ``struct<short_side, target_pixels>``."""
    t = _c(target)
    short = F.ceil(t / 4 * 3).cast("bigint")
    return F.struct(short.alias("short_side"), (t.cast("bigint") * short).alias("target_pixels"))


def resize_policy(w, h, target_size: int = DEFAULT_TARGET_SIZE) -> Column:
    """New ``struct<w, h>``; images over 1.5x the target pixels get a long
    side of ``target_size``, the other side scaled and rounded half-even."""
    w, h = _c(w), _c(h)
    _, pixels = target_geometry(target_size)
    r = F.lit(float(target_size)) / F.greatest(w, h).cast("double")
    big = (w * h) > F.lit(LARGE_FACTOR * pixels)
    return F.struct(
        F.when(big, F.bround(r * w, 0).cast("bigint")).otherwise(w.cast("bigint")).alias("w"),
        F.when(big, F.bround(r * h, 0).cast("bigint")).otherwise(h.cast("bigint")).alias("h"),
    )


def subsampling_policy(w, h, subsampling: str = DEFAULT_SUBSAMPLING,
                       target_size: int = DEFAULT_TARGET_SIZE) -> Column:
    """P20: small images (pixels <= half the target) keep full chroma."""
    if subsampling not in SUBSAMPLING_CHOICES:
        raise ValueError(f"subsampling must be one of {SUBSAMPLING_CHOICES}")
    _, pixels = target_geometry(target_size)
    small = (_c(w) * _c(h)) <= F.lit(SMALL_FACTOR * pixels)
    return F.when(small, F.lit(FULL_CHROMA)).otherwise(F.lit(subsampling))


def recompress_gate(marker, w, h, compress: int | None = DEFAULT_QUALITY,
                    already: Column | None = None,
                    target_size: int = DEFAULT_TARGET_SIZE) -> Column:
    """Re-encode only images, only when a quality is set, only when the
    payload was not already re-encoded, and only above half the target."""
    if not compress:
        return F.lit(False)
    _, pixels = target_geometry(target_size)
    gate = (_c(marker) == 0) & ((_c(w) * _c(h)) > F.lit(SMALL_FACTOR * pixels))
    if already is not None:
        gate = gate & ~F.coalesce(already, F.lit(False))
    return gate
