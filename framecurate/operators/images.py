"""Frame pixels (X2, P25), crops (P9), colour conversion (P24) and detection.

Decoded frames are Spark ``image`` structs (BGR bytes, row-major).  The only
numpy steps are (a) turning the bytes of one frame into its 64×64 thumbnail
pixels (X2+P25: 4,096 rows per frame leave Python instead of millions) and
(b) the user's detection model (X1).  Everything downstream is Column/SQL.
"""

from __future__ import annotations

from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from framecurate.schemas import DETECTIONS

THUMB_SIZE = (64, 64)
PIXEL_SCHEMA = "frame_id long, x int, y int, b int, g int, r int"


def _as_bgr(buf: bytes, h: int, w: int, c: int) -> np.ndarray:
    """Image bytes → H×W×3 BGR (grey → replicated, BGRA → alpha dropped)."""
    a = np.frombuffer(buf, dtype=np.uint8).reshape(h, w, c)
    if c == 1:
        return np.repeat(a, 3, axis=2)
    return a[:, :, :3]


def bilinear_resize(img: np.ndarray, out_w: int, out_h: int) -> np.ndarray:
    """P25: bilinear sampling at (i + 0.5)·scale − 0.5, edges clamped, no anti-alias."""
    h, w = img.shape[:2]
    sx, sy = w / out_w, h / out_h
    fx = (np.arange(out_w) + 0.5) * sx - 0.5
    fy = (np.arange(out_h) + 0.5) * sy - 0.5
    x0 = np.floor(fx).astype(int)
    y0 = np.floor(fy).astype(int)
    ax = fx - x0
    ay = fy - y0
    x0c, x1c = np.clip(x0, 0, w - 1), np.clip(x0 + 1, 0, w - 1)
    y0c, y1c = np.clip(y0, 0, h - 1), np.clip(y0 + 1, 0, h - 1)
    ax = np.where(x0 < 0, 0.0, np.where(x0 + 1 > w - 1, 0.0, ax))
    ay = np.where(y0 < 0, 0.0, np.where(y0 + 1 > h - 1, 0.0, ay))
    f = img.astype(np.float64)
    top = f[y0c][:, x0c] * (1 - ax)[None, :, None] + f[y0c][:, x1c] * ax[None, :, None]
    bot = f[y1c][:, x0c] * (1 - ax)[None, :, None] + f[y1c][:, x1c] * ax[None, :, None]
    out = top * (1 - ay)[:, None, None] + bot * ay[:, None, None]
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def thumbnail_pixels(frames: DataFrame, size: tuple[int, int] = THUMB_SIZE) -> DataFrame:
    """(frame_id, image) → thumbnail pixel rows (frame_id, x, y, b, g, r).

    Image bytes are read inside the task that scanned them; only the compact
    thumbnail rows continue.  Rows with undecodable images (width < 1) emit nothing."""
    out_w, out_h = size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = []
            for fid, img in zip(pdf["frame_id"].to_numpy(), pdf["image"]):
                if img is None or img["width"] is None or img["width"] < 1:
                    continue
                a = _as_bgr(img["data"], int(img["height"]), int(img["width"]), int(img["nChannels"]))
                t = bilinear_resize(a, out_w, out_h)
                yy, xx = np.mgrid[0:out_h, 0:out_w]
                parts.append(pd.DataFrame({"frame_id": np.full(out_w * out_h, fid, dtype=np.int64),
                                           "x": xx.ravel().astype(np.int32), "y": yy.ravel().astype(np.int32),
                                           "b": t[:, :, 0].ravel().astype(np.int32),
                                           "g": t[:, :, 1].ravel().astype(np.int32),
                                           "r": t[:, :, 2].ravel().astype(np.int32)}))
            if parts:
                yield pd.concat(parts, ignore_index=True)

    return frames.select("frame_id", "image").mapInPandas(run, PIXEL_SCHEMA)


def hs_counts(thumb: np.ndarray) -> np.ndarray:
    """A7 of one H×W×3 BGR thumbnail: the 128 bin counts that
    ``histogram.hs_histogram`` gives for its pixels."""
    from framecurate.operators.histogram import H_BINS, H_RANGE, HSV_SHIFT, S_BINS, S_RANGE
    b, g, r = (thumb[..., i].ravel().astype(np.int64) for i in range(3))
    v, low = np.maximum(np.maximum(b, g), r), np.minimum(np.minimum(b, g), r)
    diff = v - low

    def recip(numer, denom):
        return np.where(denom == 0, 0, np.floor((numer << HSV_SHIFT) / np.where(denom == 0, 1, denom) + 0.5)).astype(np.int64)

    half = 1 << (HSV_SHIFT - 1)
    s = (diff * recip(255, v) + half) >> HSV_SHIFT
    hue = np.where(v == r, g - b, np.where(v == g, b - r + 2 * diff, r - g + 4 * diff))
    h = (hue * recip(180, 6 * diff) + half) >> HSV_SHIFT
    h = np.where(h < 0, h + 180, h)
    flat = (h * H_BINS // H_RANGE) * S_BINS + s * S_BINS // S_RANGE
    return np.bincount(flat, minlength=H_BINS * S_BINS).astype(np.float64)


def frame_histogram(image, size: tuple[int, int] = THUMB_SIZE, normalized: bool = False) -> Column:
    """X2 + A7 (+ A8) as a column: the 128 hue/saturation counts of each frame's
    thumbnail, computed where the image is held; NULL for undecodable frames."""
    out_w, out_h = size

    @pandas_udf("array<double>")
    def hist(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for pdf in batches:
            out = []
            for d, h, w, c in zip(pdf["data"], pdf["height"], pdf["width"], pdf["nChannels"]):
                if d is None or w is None or pd.isna(w) or w < 1:
                    out.append(None)
                    continue
                n = hs_counts(bilinear_resize(_as_bgr(d, int(h), int(w), int(c)), out_w, out_h))
                if normalized:
                    n = (n - n.min()) / (n.max() - n.min()) if n.max() > n.min() else np.zeros_like(n)
                out.append(n)
            yield pd.Series(out, dtype=object)

    img = F.col(image) if isinstance(image, str) else image
    return hist(F.struct(img["data"].alias("data"), img["height"].alias("height"),
                         img["width"].alias("width"), img["nChannels"].alias("nChannels")))


def crop_pixels(image, bbox) -> Column:
    """Bytes of ``image[y1:y2, x1:x2]`` (half-open, box already clamped).

    One substring per source row, joined linearly (hex round trip)."""
    img = F.col(image) if isinstance(image, str) else image
    b = F.col(bbox) if isinstance(bbox, str) else bbox
    c = img["nChannels"]
    w = img["width"]
    rows = F.sequence(b["y1"], b["y2"] - 1)
    piece = F.transform(rows, lambda y: F.hex(F.substring(img["data"], (y * w + b["x1"]) * c + 1,
                                                          (b["x2"] - b["x1"]) * c)))
    return F.when((b["x2"] > b["x1"]) & (b["y2"] > b["y1"]), F.unhex(F.array_join(piece, "")))


# ------------------------------------------------------------------ P24 (float form)
def _srgb_to_linear(v: Column) -> Column:
    return F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, 2.4))


def _f_lab(t: Column) -> Column:
    return F.when(t > 0.008856, F.pow(t, 1.0 / 3.0)).otherwise(7.787 * t + 16.0 / 116.0)


def bgr_to_lab(b, g, r) -> Column:
    """8-bit BGR → 8-bit Lab struct (L·255/100, a+128, b+128), D65 white point."""
    bl, gl, rl = (_srgb_to_linear(F.col(c).cast("double") / 255.0) if isinstance(c, str)
                  else _srgb_to_linear(c.cast("double") / 255.0) for c in (b, g, r))
    x = (0.412453 * rl + 0.357580 * gl + 0.180423 * bl) / 0.950456
    y = 0.212671 * rl + 0.715160 * gl + 0.072169 * bl
    z = (0.019334 * rl + 0.119193 * gl + 0.950227 * bl) / 1.088754
    fx, fy, fz = _f_lab(x), _f_lab(y), _f_lab(z)
    lum = F.when(y > 0.008856, 116.0 * fy - 16.0).otherwise(903.3 * y)
    clamp = lambda v: F.least(F.greatest(F.round(v), F.lit(0.0)), F.lit(255.0)).cast("int")
    return F.struct(clamp(lum * 255.0 / 100.0).alias("l"), clamp(500.0 * (fx - fy) + 128.0).alias("a"),
                    clamp(200.0 * (fy - fz) + 128.0).alias("b"))


def lab_to_bgr(l, a, b) -> Column:
    """Inverse of :func:`bgr_to_lab` (8-bit in, 8-bit BGR out)."""
    L = (F.col(l) if isinstance(l, str) else l).cast("double") * 100.0 / 255.0
    A = (F.col(a) if isinstance(a, str) else a).cast("double") - 128.0
    B = (F.col(b) if isinstance(b, str) else b).cast("double") - 128.0
    fy = (L + 16.0) / 116.0
    fx = fy + A / 500.0
    fz = fy - B / 200.0

    def finv(t):
        return F.when(t > 0.206893, F.pow(t, 3.0)).otherwise((t - 16.0 / 116.0) / 7.787)

    x, y, z = finv(fx) * 0.950456, finv(fy), finv(fz) * 1.088754
    rl = 3.240479 * x - 1.53715 * y - 0.498535 * z
    gl = -0.969256 * x + 1.875991 * y + 0.041556 * z
    bl = 0.055648 * x - 0.204043 * y + 1.057311 * z

    def to8(v):
        s = F.when(v <= 0.0031308, 12.92 * v).otherwise(1.055 * F.pow(F.greatest(v, F.lit(0.0)), 1 / 2.4) - 0.055)
        return F.least(F.greatest(F.round(s * 255.0), F.lit(0.0)), F.lit(255.0)).cast("int")

    return F.struct(to8(bl).alias("b"), to8(gl).alias("g"), to8(rl).alias("r"))


# ------------------------------------------------------------------------- X1
# Loaded models of this Python worker process (workers are reused across tasks).
_MODELS: dict = {}


def load_model(key: str, make_predict_fn: Callable):
    """The worker's model of that key, made at its first use."""
    if key not in _MODELS:
        _MODELS[key] = make_predict_fn()
    return _MODELS[key]


def detect(frames: DataFrame, make_predict_fn: Callable, batch_size: int = 16,
           model_key: str | None = None) -> DataFrame:
    """Batched inference with a user model, loaded once per Python worker.

    ``make_predict_fn()`` returns ``predict(list[np.ndarray BGR]) -> list[np.ndarray
    (n, 6)]`` with rows (x1, y1, x2, y2, confidence, class_id) as floats.  Boxes
    become int (truncation, P4); missing output → empty array, as for frames
    that cannot be decoded, which the model does not see.  Confidence and class
    filters (F1, F2) are applied afterwards as Column expressions.  Models are
    told apart by the factory with all it holds, or by ``model_key``."""
    import hashlib

    from pyspark import cloudpickle
    key = model_key or hashlib.sha256(cloudpickle.dumps(make_predict_fn)).hexdigest()

    @pandas_udf(DETECTIONS)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        # the imported module outlives the task; this function's own globals do not
        from framecurate.operators import images as own
        fn = own.load_model(key, make_predict_fn)
        for pdf in batches:
            out: list = [[] for _ in range(len(pdf))]
            good = [i for i, (d, w) in enumerate(zip(pdf["data"], pdf["width"]))
                    if d is not None and w is not None and not pd.isna(w) and w > 0]
            cells = list(zip(pdf["data"], pdf["height"], pdf["width"], pdf["nChannels"]))
            for at in range(0, len(good), batch_size):
                chunk = good[at:at + batch_size]
                imgs = [_as_bgr(d, int(h), int(w), int(c)) for d, h, w, c in (cells[i] for i in chunk)]
                for i, p in zip(chunk, fn(imgs)):
                    rows = [] if p is None else np.asarray(p, dtype=np.float64).reshape(-1, 6)
                    out[i] = [{"bbox": {"x1": int(r[0]), "y1": int(r[1]), "x2": int(r[2]), "y2": int(r[3])},
                               "confidence": float(r[4]), "class_id": int(r[5])} for r in rows]
            yield pd.Series(out, dtype=object)

    img = F.col("image")
    return frames.withColumn("detections", run(F.struct(img["data"].alias("data"), img["height"].alias("height"),
                                                        img["width"].alias("width"),
                                                        img["nChannels"].alias("nChannels"))))


# ----------------------------------------------- P24 numpy twins (per-frame path)
def _srgb_to_linear_np(v):
    return np.where(v <= 0.04045, v / 12.92, np.power((v + 0.055) / 1.055, 2.4))


def _f_lab_np(t):
    return np.where(t > 0.008856, np.power(np.maximum(t, 0.0), 1.0 / 3.0), 7.787 * t + 16.0 / 116.0)


def bgr_to_lab_np(img: np.ndarray) -> np.ndarray:
    """Same formulas as :func:`bgr_to_lab`, for a whole H×W×3 frame."""
    f = img.astype(np.float64) / 255.0
    bl, gl, rl = (_srgb_to_linear_np(f[..., i]) for i in range(3))
    x = (0.412453 * rl + 0.357580 * gl + 0.180423 * bl) / 0.950456
    y = 0.212671 * rl + 0.715160 * gl + 0.072169 * bl
    z = (0.019334 * rl + 0.119193 * gl + 0.950227 * bl) / 1.088754
    fx, fy, fz = _f_lab_np(x), _f_lab_np(y), _f_lab_np(z)
    lum = np.where(y > 0.008856, 116.0 * fy - 16.0, 903.3 * y)

    def clamp(v):
        # Spark round() is half-up; floor(v + 0.5) reproduces it for these ranges
        return np.clip(np.floor(v + 0.5), 0, 255).astype(np.uint8)

    return np.stack([clamp(lum * 255.0 / 100.0), clamp(500.0 * (fx - fy) + 128.0),
                     clamp(200.0 * (fy - fz) + 128.0)], axis=-1)


def lab_to_bgr_np(lab: np.ndarray) -> np.ndarray:
    """Same formulas as :func:`lab_to_bgr`, for a whole H×W×3 Lab frame."""
    L = lab[..., 0].astype(np.float64) * 100.0 / 255.0
    A = lab[..., 1].astype(np.float64) - 128.0
    B = lab[..., 2].astype(np.float64) - 128.0
    fy = (L + 16.0) / 116.0
    fx, fz = fy + A / 500.0, fy - B / 200.0

    def finv(t):
        return np.where(t > 0.206893, np.power(t, 3.0), (t - 16.0 / 116.0) / 7.787)

    x, y, z = finv(fx) * 0.950456, finv(fy), finv(fz) * 1.088754
    rl = 3.240479 * x - 1.53715 * y - 0.498535 * z
    gl = -0.969256 * x + 1.875991 * y + 0.041556 * z
    bl = 0.055648 * x - 0.204043 * y + 1.057311 * z

    def to8(v):
        s = np.where(v <= 0.0031308, 12.92 * v, 1.055 * np.power(np.maximum(v, 0.0), 1 / 2.4) - 0.055)
        return np.clip(np.floor(s * 255.0 + 0.5), 0, 255).astype(np.uint8)

    return np.stack([to8(bl), to8(gl), to8(rl)], axis=-1)


def equalize_frames(frames: DataFrame, clip_limit: float = 2.0, grid: tuple[int, int] = (8, 8),
                    enabled: bool = True) -> DataFrame:
    """A10 preprocessing of full-resolution frames (X3 ``preprocess``).

    Each frame is equalised inside the task that holds its bytes (L channel of
    Lab only, a/b untouched), with the same computation as the relational
    operator in ``operators.equalize`` (tested bit-identical on the L plane),
    so millions of pixels per frame never become rows.  Disabled → identity."""
    if not enabled:
        return frames
    from framecurate.operators.equalize import equalize_plane

    schema = frames.schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            imgs = []
            for img in pdf["image"]:
                if img is None or img["width"] is None or img["width"] < 1:
                    imgs.append(img)
                    continue
                a = _as_bgr(img["data"], int(img["height"]), int(img["width"]), int(img["nChannels"]))
                lab = bgr_to_lab_np(a)
                lab[..., 0] = equalize_plane(lab[..., 0], clip_limit, grid)
                out = lab_to_bgr_np(lab)
                imgs.append({"origin": img["origin"], "height": out.shape[0], "width": out.shape[1],
                             "nChannels": 3, "mode": 16, "data": out.tobytes()})
            pdf = pdf.copy()
            pdf["image"] = imgs
            yield pdf

    return frames.mapInPandas(run, schema)
