"""Queue captures for labeling (E2a: J1, J2, J4, P10, P12, P15, P18, A4, K4).

Inputs are three tables: capture metadata ``(full_frame, detections)``, the
image inventory ``(path, width, height)`` and the set of already-labeled
filenames.  Both lookups are left joins with a flag column, so one pass
classifies every capture as exported / skipped / error; AQE turns either join
into a broadcast only when the measured side is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecurate.functions.boxes import box_to_percent
from framecurate.functions.classes import label_for_class
from framecurate.functions.naming import file_name, image_url

# Fixed values of the annotation-tool task format.
FROM_NAME = "label"
TO_NAME = "image"
RESULT_TYPE = "rectanglelabels"


def classify_captures(meta: DataFrame, inventory: DataFrame, labeled: DataFrame,
                      document_root: str | None = None) -> DataFrame:
    """Adds (width, height, filename, outcome) with outcome ∈ error | skipped | exported.

    Order matters: a missing image is an error even when its name is already
    labeled (J1), a labeled image is skipped without being opened (J2), and
    only then is an unreadable image an error, or, with ``document_root``, one
    outside the root (no task URL possible, P12).  A capture stays one row
    however often its image or name is listed; of several sizes listed for an
    image the greatest counts."""
    inv = inventory.groupBy(F.col("path").alias("full_frame")).agg(F.max(F.struct("width", "height")).alias("__s")) \
        .select("full_frame", "__s.width", "__s.height", F.lit(True).alias("__found"))
    lab = labeled.select(F.col("filename").alias("__lab_name")).distinct().withColumn("__labeled", F.lit(True))
    m = meta.join(inv, "full_frame", "left").withColumn("filename", file_name("full_frame"))
    m = m.join(lab, F.col("filename") == F.col("__lab_name"), "left").drop("__lab_name")
    bad = F.coalesce(F.col("width") <= 0, F.lit(True))
    if document_root is not None:
        bad = bad | image_url("full_frame", document_root).isNull()
    outcome = F.when(F.col("__found").isNull(), F.lit("error")) \
               .when(F.col("__labeled").isNotNull(), F.lit("skipped")) \
               .when(bad, F.lit("error")).otherwise(F.lit("exported"))
    return m.withColumn("outcome", outcome).drop("__found", "__labeled")


def unlabeled(images: DataFrame, labeled: DataFrame) -> DataFrame:
    """J2 alone: rows whose ``filename`` is not labeled yet."""
    return images.join(labeled.select("filename"), "filename", "left_anti")


def annotation_results(detections, width, height):
    """Detections (bbox array<int>[4]) → annotation-tool rectangle results."""
    def one(d):
        b = d["bbox"]
        box = F.struct(F.get(b, 0).alias("x1"), F.get(b, 1).alias("y1"),
                       F.get(b, 2).alias("x2"), F.get(b, 3).alias("y2"))
        pct = box_to_percent(box, width, height)
        return F.struct(
            F.lit(RESULT_TYPE).alias("type"), F.lit(FROM_NAME).alias("from_name"),
            F.lit(TO_NAME).alias("to_name"),
            width.alias("original_width"), height.alias("original_height"),
            F.struct(pct["x"].alias("x"), pct["y"].alias("y"), pct["width"].alias("width"),
                     pct["height"].alias("height"),
                     F.array(label_for_class(d["class_id"])).alias("rectanglelabels")).alias("value"))
    return F.transform(detections, one)


def build_tasks(classified: DataFrame, document_root: str, base_url: str = "",
                keep: tuple[str, ...] = ("frame_id",)) -> DataFrame:
    """Exported captures → (full_frame, image_url, results, task_json).

    ``annotations`` is omitted from the JSON when there are no boxes (a NULL
    field is dropped by ``to_json``)."""
    ex = classified.where(F.col("outcome") == "exported")
    results = annotation_results(F.coalesce("detections", F.array()), F.col("width"), F.col("height"))
    keep = [c for c in keep if c in ex.columns]
    ex = ex.select(*keep, "full_frame", image_url("full_frame", document_root, base_url).alias("image_url"),
                   results.alias("results"))
    task = F.struct(F.struct(F.col("image_url").alias("image")).alias("data"),
                    F.when(F.size("results") > 0, F.array(F.struct(F.col("results").alias("result"))))
                     .alias("annotations"))
    return ex.withColumn("task_json", F.to_json(task))


def export_summary(classified: DataFrame) -> DataFrame:
    """A4: exported / skipped / errors counts in one aggregate."""
    return classified.agg(F.count_if(F.col("outcome") == "exported").alias("exported"),
                          F.count_if(F.col("outcome") == "skipped").alias("skipped"),
                          F.count_if(F.col("outcome") == "error").alias("errors"))
