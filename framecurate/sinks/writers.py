"""Sinks (K1, K2, K4-K7).  K3 lives in ``sources.captures``; K8/K9 in ``plans.splitting``.

All writers are plain DataFrame writes (parquet / JSON-lines / text),
partitioned where a reader prunes on it; nothing is funnelled through the
driver or a single task unless a single-file output is explicitly asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecurate.functions.boxes import MIN_CROP_PX, clamp_box, crop_eligible
from framecurate.functions.naming import capture_stem
from framecurate.operators.dedup import dedup_last
from framecurate.operators.images import crop_pixels
from framecurate.session import stage


def _write_batch(df: DataFrame, path: str, batch_id, by: tuple[str, ...] = ()) -> None:
    """Append; with a ``batch_id`` into a folder of the batch's own, which a
    retry of the batch replaces."""
    w = df.write.mode("append" if batch_id is None else "overwrite").partitionBy(*by)
    w.parquet(path if batch_id is None else f"{path}/batch_id={batch_id}")


def write_captures(captures: DataFrame, path: str, batch_id: int | str | None = None) -> None:
    """K1: saved frames (the *preprocessed* image) partitioned by day and kind.

    ``captures`` has camera_id, frame_id, ts, kind, image, detections.  A cats
    frame without detections is not saved."""
    n = F.size(F.coalesce(F.col("detections"), F.array()))
    out = captures.where(F.col("image").isNotNull() & (
        F.col("kind").isin("background", "manual_background") | ((F.col("kind") == "cats") & (n > 0))))
    out = out.withColumn("dt", F.to_date("ts")).withColumn(
        "stem", capture_stem("ts", F.size(F.coalesce("detections", F.array())), F.col("kind"), "camera_id"))
    _write_batch(out, path, batch_id, ("dt", "kind"))


def crops(captures: DataFrame, min_px: int = MIN_CROP_PX) -> DataFrame:
    """K2 rows: one crop per eligible detection, ``{stem}_crop_{i}`` with the
    original detection index (gaps stay when small crops are skipped)."""
    img = F.col("image")
    boxes = F.transform("detections", lambda d, i: F.struct(
        i.alias("i"), clamp_box(d["bbox"], img["width"], img["height"]).alias("box")))
    # cut out before the explode, so an image is not copied for each detection
    cut = F.transform(F.filter(boxes, lambda k: crop_eligible(k["box"], min_px)), lambda k: F.struct(
        k["i"].alias("i"), k["box"].alias("box"), crop_pixels(img, k["box"]).alias("data")))
    stem = capture_stem("ts", F.size("detections"), F.lit("cats"), "camera_id")
    c = captures.where(F.col("kind") == "cats").select("camera_id", "frame_id", stem.alias("stem"), F.explode(cut).alias("k"))
    return c.select("camera_id", "frame_id",
                    F.concat("stem", F.lit("_crop_"), F.col("k.i").cast("string")).alias("crop_name"),
                    (F.col("k.box.x2") - F.col("k.box.x1")).alias("width"),
                    (F.col("k.box.y2") - F.col("k.box.y1")).alias("height"), F.col("k.data").alias("data"))


def write_crops(captures: DataFrame, path: str, min_px: int = MIN_CROP_PX, save_crops: bool = True,
                batch_id: int | str | None = None) -> None:
    """K2; nothing when ``save_crops`` is off."""
    if save_crops:
        _write_batch(crops(captures, min_px), path, batch_id)


SHARD_TASKS = 50_000     # readers take a shard whole


def _write_json_rows(df: DataFrame, col: str, path: str, order: tuple[str, ...] = ()) -> bool:
    """JSON-lines shards (one task per line, written in parallel), read back by
    ``read_annotation_files``.  Returns False and writes nothing when there are
    no rows.  The upstream runs once: its rows are staged, looked at and then
    written.  A single JSON-array file would funnel every task through one
    writer, so it is not offered."""
    rows = stage(df.select(*order, F.col(col).alias("value")), "task-rows")
    if rows.isEmpty():
        return False
    rows = rows.orderBy(*order) if order else rows
    rows.select("value").write.mode("overwrite").option("maxRecordsPerFile", SHARD_TASKS).text(path)
    return True


def write_annotation_import(tasks: DataFrame, path: str) -> bool:
    """K4: annotation-tool import (``task_json`` column); nothing when empty."""
    return _write_json_rows(tasks, "task_json", path)


def write_merged_tasks(merged: DataFrame, path: str) -> bool:
    """K5: merged tasks, whole payload, in first-appearance order (file, pos):
    a range-partitioned sort, so shard i holds tasks before shard i+1."""
    m = merged.select("file", "pos", F.to_json(F.col("task")).alias("task_json"))
    return _write_json_rows(m, "task_json", path, ("file", "pos"))


def write_label_text(labels: DataFrame, path: str) -> None:
    """K6: (stem, label_text) table; empty text = negative sample."""
    labels.select("stem", "label_text").write.mode("overwrite").parquet(path)


def materialize_labeled(labels: DataFrame, images: DataFrame | None, path: str) -> None:
    """K7: (stem, image_name, image_path[, image]) of every image to copy; see
    :func:`labeled_images`."""
    out = labeled_images(labels)
    if images is not None:
        chosen = out.select(F.col("image_path").alias("path")).distinct()
        one = images.join(chosen, "path", "left_semi").groupBy(F.col("path").alias("image_path")).agg(F.first("image").alias("image"))
        out = out.join(one, "image_path", "left")
    out.write.mode("overwrite").parquet(path)


def labeled_images(converted: DataFrame) -> DataFrame:
    """One row per image name, of the last task (file, pos) that has it;
    tasks without an existing image have none.  ``converted`` is the output of
    ``convert_tasks`` or of ``label_files``."""
    c = converted.where(F.col("status") == "ok") if "status" in converted.columns else converted
    last = dedup_last(c.select("stem", "file", "pos", "image_name", F.col("src_path").alias("image_path")),
                      key="image_name", order=["file", "pos"])
    return last.select("stem", "image_name", "image_path")
