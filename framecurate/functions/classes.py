"""Class dictionaries (P15-P17, J5) and detection presentation rows.

Class lists are always parameters; the dictionaries below are only defaults.
Small dimension tables are broadcast explicitly: their size is bounded by the
number of classes of a model (≤ a few hundred rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference) --------------------------------
# Label-tool names of the fine-tuned classes and of the stock "cat" class.
CLASS_ID_TO_LABEL = {0: "salo", 1: "taro", 15: "cat"}
DEFAULT_LABEL = "cat"
# Class names of the fine-tuned model, in class-id order.
CLASS_NAMES = ["salo", "taro"]
# Box colours (BGR) by class id for preview overlays, and the fallback colour.
CLASS_COLORS = {0: (0, 165, 255), 1: (255, 255, 0), 15: (0, 255, 0)}
DEFAULT_COLOR = (0, 255, 255)
OVERLAY_TEXT_DY = -8
# The 80 class names of the public COCO detection dataset, in id order 0..79.
COCO_NAMES = [
    "person", "bicycle", "car", "motorcycle", "airplane", "bus", "train", "truck", "boat",
    "traffic light", "fire hydrant", "stop sign", "parking meter", "bench", "bird", "cat",
    "dog", "horse", "sheep", "cow", "elephant", "bear", "zebra", "giraffe", "backpack",
    "umbrella", "handbag", "tie", "suitcase", "frisbee", "skis", "snowboard", "sports ball",
    "kite", "baseball bat", "baseball glove", "skateboard", "surfboard", "tennis racket",
    "bottle", "wine glass", "cup", "fork", "knife", "spoon", "bowl", "banana", "apple",
    "sandwich", "orange", "broccoli", "carrot", "hot dog", "pizza", "donut", "cake", "chair",
    "couch", "potted plant", "bed", "dining table", "toilet", "tv", "laptop", "mouse",
    "remote", "keyboard", "cell phone", "microwave", "oven", "toaster", "sink",
    "refrigerator", "book", "clock", "vase", "scissors", "teddy bear", "hair drier",
    "toothbrush",
]
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _int_map(d: dict) -> Column:
    items = []
    for k, v in sorted(d.items()):
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def label_for_class(class_id, mapping: dict | None = None, default: str = DEFAULT_LABEL) -> Column:
    """Label-tool name of a class id; unknown and NULL ids → ``default``."""
    m = _int_map(mapping or CLASS_ID_TO_LABEL)
    return F.coalesce(F.try_element_at(m, _c(class_id)), F.lit(default))


def class_for_label(label, classes: list[str] | None = None) -> Column:
    """Index of ``label`` in ``classes``; NULL when unknown."""
    arr = F.array(*[F.lit(c) for c in (classes or CLASS_NAMES)])
    return (F.nullif(F.array_position(arr, _c(label)), F.lit(0)) - 1).cast("int")


def class_names_df(spark: SparkSession, names=None) -> DataFrame:
    """Dimension table (class_id, name) from a list or an {id: name} dict."""
    names = COCO_NAMES if names is None else names
    items = sorted(names.items()) if isinstance(names, dict) else list(enumerate(names))
    return spark.createDataFrame(items, "class_id int, name string")


def class_name_fallback(name) -> Column:
    """P17 post-join: ``class_{id}`` when the id is not in the names table."""
    return F.coalesce(_c(name), F.concat(F.lit("class_"), F.col("class_id").cast("string")))


def attach_class_names(df: DataFrame, names_df: DataFrame, id_col: str = "class_id") -> DataFrame:
    """Left join of the class dimension + P17 fallback.  Spark broadcasts
    the dimension while its size is under the session's threshold."""
    dim = names_df.select(F.col("class_id").alias("__cid"), "name")
    out = df.join(dim, F.col(id_col) == F.col("__cid"), "left").drop("__cid")
    return out.withColumn("name", F.coalesce(F.col("name"),
                                             F.concat(F.lit("class_"), F.col(id_col).cast("string"))))


def best_confidence(df: DataFrame, names_df: DataFrame, min_confidence: float) -> DataFrame:
    """Per frame and class name the best confidence of at least the minimum."""
    ex = df.select("frame_id", F.explode("detections").alias("d")).where(F.col("d.confidence") >= min_confidence)
    named = attach_class_names(ex.select("frame_id", F.col("d.class_id").alias("class_id"),
                                         F.col("d.confidence").alias("confidence")), names_df)
    return named.groupBy("frame_id", "name").agg(F.max("confidence").alias("best_confidence"))


def ranked_detections(df: DataFrame) -> DataFrame:
    """Detections of each frame by confidence, descending; ties by index."""
    idx = F.transform("detections", lambda x, i: F.struct((-x["confidence"]).alias("c"), i.alias("det_idx"),
                                                          x["confidence"].alias("confidence")))
    return df.select("frame_id", F.posexplode(F.array_sort(idx)).alias("r", "e")).select(
        "frame_id", (F.col("r") + 1).alias("rank"), F.col("e.det_idx").alias("det_idx"),
        F.col("e.confidence").alias("confidence"))


def class_color(class_id) -> Column:
    """BGR overlay colour by class id as an array<int>[3]."""
    m = F.create_map(*sum(([F.lit(k), F.array(*[F.lit(c) for c in v])]
                           for k, v in sorted(CLASS_COLORS.items())), []))
    return F.coalesce(F.try_element_at(m, _c(class_id)), F.array(*[F.lit(c) for c in DEFAULT_COLOR]))


def overlay_rows(df: DataFrame, names_df: DataFrame) -> DataFrame:
    """One drawing instruction per detection (rectangle, colour, caption)."""
    ex = df.select("frame_id", F.posexplode("detections").alias("det_idx", "d"))
    ex = ex.select("frame_id", "det_idx", F.col("d.bbox").alias("bbox"),
                   F.col("d.confidence").alias("confidence"), F.col("d.class_id").alias("class_id"))
    ex = attach_class_names(ex, names_df)
    conf2 = F.round("confidence", 2)
    return ex.select(
        "frame_id", "det_idx",
        F.col("bbox.x1").alias("x1"), F.col("bbox.y1").alias("y1"),
        F.col("bbox.x2").alias("x2"), F.col("bbox.y2").alias("y2"),
        class_color("class_id").alias("color_bgr"),
        F.col("name"), conf2.alias("conf2"),
        F.format_string("%s %.2f", F.col("name"), conf2).alias("caption"),
        F.col("bbox.x1").alias("text_x"),
        (F.col("bbox.y1") + OVERLAY_TEXT_DY).alias("text_y"),
    )


def debug_summary(found) -> Column:
    """``name: 0.87, …`` by confidence desc (ties by name), or ``no detections``.

    ``found`` is an ``array<struct<name string, confidence double>>``."""
    srt = F.array_sort(_c(found), lambda a, b: F.when(a["confidence"] > b["confidence"], -1)
                       .when(a["confidence"] < b["confidence"], 1)
                       .when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0))
    txt = F.array_join(F.transform(srt, lambda e: F.format_string("%s: %.2f", e["name"], e["confidence"])), ", ")
    return F.when(F.size(_c(found)) > 0, txt).otherwise(F.lit("no detections"))
