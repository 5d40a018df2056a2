"""Bounding-box column functions (P1-P5, P8, P10, P11) and box predicates.

Every function takes and returns ``Column`` expressions, so they stay inside
whole-stage codegen and can be used in ``select``/``filter``/``transform``.
A bbox is ``STRUCT<x1 INT, y1 INT, x2 INT, y2 INT>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
CAT_CLASS_ID = 15          # default class of a detection (COCO "cat")
COCO_CLASS_COUNT = 80      # a model with exactly this many classes is the stock one
CAPTURE_CONFIDENCE = 0.4   # confidence threshold of the capture loop
DEBUG_CONFIDENCE = 0.1     # confidence threshold of the all-classes debug listing
MIN_CROP_PX = 32           # smallest crop side that is written


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def box_area(bbox) -> Column:
    """max(0, x2-x1) * max(0, y2-y1) as BIGINT (degenerate boxes → 0)."""
    b = _c(bbox)
    w = F.greatest(b["x2"].cast("long") - b["x1"].cast("long"), F.lit(0).cast("long"))
    h = F.greatest(b["y2"].cast("long") - b["y1"].cast("long"), F.lit(0).cast("long"))
    return w * h


def box_center(bbox) -> Column:
    """Integer centre with floor division (shiftright floors negatives like Python //)."""
    b = _c(bbox)
    return F.struct(
        F.shiftright(b["x1"].cast("long") + b["x2"].cast("long"), 1).alias("cx"),
        F.shiftright(b["y1"].cast("long") + b["y2"].cast("long"), 1).alias("cy"),
    )


def cat_count(detections) -> Column:
    return F.size(_c(detections))


def has_cats(detections) -> Column:
    return F.size(_c(detections)) > 0


def to_int_box(x1, y1, x2, y2) -> Column:
    """Float xyxy → int bbox, truncating toward zero (Python ``int()``)."""
    return F.struct(*[_c(v).cast("int").alias(n) for v, n in
                      zip((x1, y1, x2, y2), ("x1", "y1", "x2", "y2"))])


def round_confidence(conf, digits: int = 4) -> Column:
    return F.round(_c(conf), digits)


def clamp_box(bbox, width, height) -> Column:
    """Clamp a box to the image: x1,y1 ≥ 0, x2 ≤ width, y2 ≤ height."""
    b = _c(bbox)
    return F.struct(
        F.greatest(F.lit(0), b["x1"]).alias("x1"),
        F.greatest(F.lit(0), b["y1"]).alias("y1"),
        F.least(_c(width), b["x2"]).alias("x2"),
        F.least(_c(height), b["y2"]).alias("y2"),
    )


def crop_eligible(clamped, min_px: int = MIN_CROP_PX) -> Column:
    """both sides of the *clamped* box are at least ``min_px``."""
    b = _c(clamped)
    return ((b["x2"] - b["x1"]) >= min_px) & ((b["y2"] - b["y1"]) >= min_px)


def box_to_percent(bbox, width, height) -> Column:
    """Pixel box → top-left + size in percent, unrounded and not clamped.

    Operation order is ``x1 / w * 100`` so the doubles are bit-identical."""
    b = _c(bbox)
    w = _c(width).cast("double")
    h = _c(height).cast("double")
    return F.struct(
        (b["x1"].cast("double") / w * 100).alias("x"),
        (b["y1"].cast("double") / h * 100).alias("y"),
        ((b["x2"] - b["x1"]).cast("double") / w * 100).alias("width"),
        ((b["y2"] - b["y1"]).cast("double") / h * 100).alias("height"),
    )


def percent_to_yolo(x, y, w, h, digits: int = 6) -> Column:
    """Percent top-left box → normalised centre box, each rounded to 6 dp."""
    x, y, w, h = (_c(v).cast("double") for v in (x, y, w, h))
    return F.struct(
        F.round((x + w / 2) / 100, digits).alias("cx"),
        F.round((y + h / 2) / 100, digits).alias("cy"),
        F.round(w / 100, digits).alias("w"),
        F.round(h / 100, digits).alias("h"),
    )


def confidence_filter(detections, threshold: float = CAPTURE_CONFIDENCE) -> Column:
    """keep detections with confidence ≥ threshold (order preserved)."""
    return F.filter(_c(detections), lambda d: d["confidence"] >= F.lit(threshold))


def class_scope(detections, num_classes, target: int = CAT_CLASS_ID) -> Column:
    """restrict to ``target`` only when the model is the 80-class stock model."""
    d = _c(detections)
    n = num_classes if isinstance(num_classes, Column) else F.lit(num_classes)
    return F.when(n == COCO_CLASS_COUNT,
                  F.filter(d, lambda x: x["class_id"] == F.lit(target))).otherwise(d)
