"""Colour histograms and histogram distance (P24 HSV, A7, A8, A9).

Pixels are rows ``(frame_id, x, y, b, g, r)`` produced inside the task that
decoded the frame (``operators.images.pixels``), so the per-frame histogram is
a partial aggregate *before* any shuffle: at most 128 rows per frame leave a
map task, never the 4,096 pixels of a thumbnail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# hue/saturation bin counts and ranges of the variety histogram.
H_BINS, S_BINS = 16, 8
H_RANGE, S_RANGE = 180, 256
FLT_EPSILON = 1.1920928955078125e-07
# 8-bit HSV conversion uses 12-bit fixed-point reciprocal tables.
HSV_SHIFT = 12


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _recip(numer: int, denom: Column) -> Column:
    """round(numer * 2^12 / denom) as the integer table entry (0 when denom is 0), half up:
    a quotient of such small integers is never near a half but on it."""
    return F.when(denom == 0, F.lit(0)).otherwise(
        F.floor(F.lit(float(numer << HSV_SHIFT)) / denom.cast("double") + 0.5).cast("int"))


def bgr_to_hsv(b, g, r) -> Column:
    """8-bit BGR → HSV struct (H in [0,180), S and V in [0,255]).

    Fixed-point form of the public 8-bit convention: S = diff·(255/V),
    H = hue sextant · (180/6·diff), both via 12-bit reciprocal tables."""
    b, g, r = _c(b).cast("int"), _c(g).cast("int"), _c(r).cast("int")
    v = F.greatest(b, g, r)
    vmin = F.least(b, g, r)
    diff = v - vmin
    half = F.lit(1 << (HSV_SHIFT - 1))
    s = F.shiftright(diff * _recip(255, v) + half, HSV_SHIFT)
    hraw = F.when(v == r, g - b).when(v == g, b - r + diff * 2).otherwise(r - g + diff * 4)
    h = F.shiftright(hraw * _recip(180, diff * 6) + half, HSV_SHIFT)
    h = F.when(h < 0, h + 180).otherwise(h)
    return F.struct(h.alias("h"), s.alias("s"), v.alias("v"))


def hs_bin(h, s) -> Column:
    """Flat bin index hbin*8 + sbin of a 16×8 hue/saturation histogram."""
    hb = F.floor(_c(h) * H_BINS / H_RANGE).cast("int")
    sb = F.floor(_c(s) * S_BINS / S_RANGE).cast("int")
    return hb * S_BINS + sb


def hs_histogram(pixels: DataFrame) -> DataFrame:
    """A7 sparse form: (frame_id, hbin, sbin, n) for non-empty bins."""
    hsv = pixels.select("frame_id", bgr_to_hsv("b", "g", "r").alias("hsv"))
    binned = hsv.select("frame_id",
                        F.floor(F.col("hsv.h") * H_BINS / H_RANGE).cast("int").alias("hbin"),
                        F.floor(F.col("hsv.s") * S_BINS / S_RANGE).cast("int").alias("sbin"))
    return binned.groupBy("frame_id", "hbin", "sbin").agg(F.count(F.lit(1)).alias("n"))


def dense_histogram(sparse: DataFrame, n_bins: int = H_BINS * S_BINS) -> DataFrame:
    """Sparse counts → (frame_id, hist ARRAY<DOUBLE>[128]) with zeros filled."""
    per = sparse.groupBy("frame_id").agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("hbin") * S_BINS + F.col("sbin")).alias("k"),
                                                   F.col("n").cast("double").alias("v")))).alias("m"))
    return per.select("frame_id", F.transform(F.sequence(F.lit(0), F.lit(n_bins - 1)),
                                              lambda i: F.coalesce(F.try_element_at(F.col("m"), i),
                                                                   F.lit(0.0))).alias("hist"))


def array_sum(arr) -> Column:
    """Left-fold sum of a double array (fixed order, bit-reproducible)."""
    return F.aggregate(_c(arr), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def minmax_normalize(arr) -> Column:
    """(x − min)/(max − min); a constant array → all zeros."""
    a = _c(arr)
    lo = F.array_min(a)
    hi = F.array_max(a)
    return F.when(hi > lo, F.transform(a, lambda x: (x - lo) / (hi - lo))) \
            .otherwise(F.transform(a, lambda x: F.lit(0.0)))


def bhattacharyya(a, b) -> Column:
    """sqrt(max(0, 1 − Σ√(a·b) · 1/√(Σa·Σb))); factor 1 when Σa·Σb ≈ 0."""
    a, b = _c(a), _c(b)
    s = array_sum(F.zip_with(a, b, lambda x, y: F.sqrt(x * y)))
    p = array_sum(a) * array_sum(b)
    scale = F.when(F.abs(p) > FLT_EPSILON, F.lit(1.0) / F.sqrt(p)).otherwise(F.lit(1.0))
    return F.sqrt(F.greatest(F.lit(1.0) - s * scale, F.lit(0.0)))
