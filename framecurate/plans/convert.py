"""Convert annotation tasks to training labels (E2d: F5-F8, J1, P14, P16, P19, P20, W2, A3).

Input: task rows ``(file, pos, task VARIANT, image_url)`` from
``sources.annotations`` and an image inventory ``(path)``.  Everything is
row-local Column work except two joins: the image-existence lookup (a
left join on ``path``; AQE picks broadcast only when the inventory measures
small) and the last-wins label dedup (a ``max_by`` aggregate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framecurate.functions.boxes import percent_to_yolo
from framecurate.functions.classes import CLASS_NAMES
from framecurate.functions.labels import label_text, yolo_line
from framecurate.functions.naming import file_name, file_stem, image_path
from framecurate.operators.dedup import dedup_last
from framecurate.schemas import TASK_RESULT

RESULT_ARRAY = T.ArrayType(TASK_RESULT).simpleString()


def _first_label(r: Column) -> Column:
    return F.get(r["value"]["rectanglelabels"], 0)


def typed_results(tasks: DataFrame) -> DataFrame:
    """F8: ``all_results`` = results of the first annotation set (NULL when none)."""
    return tasks.withColumn("all_results",
                            F.try_variant_get("task", "$.annotations[0].result", RESULT_ARRAY))


def result_rows(typed: DataFrame) -> DataFrame:
    """(file, pos, box_idx, r): one row a result of ``all_results``.

    The list is exploded as an expression: of a plain column Spark infers that it
    has elements and works the list out of the task anew for each such filter."""
    results = F.coalesce(F.col("all_results"), F.array().cast(RESULT_ARRAY))
    return typed.select("file", "pos", F.posexplode(results).alias("box_idx", "r"))


def rectangles(results) -> Column:
    """the rectangle results of a result list (empty for NULL)."""
    return F.filter(F.coalesce(F.col(results), F.array().cast(RESULT_ARRAY)),
                    lambda r: F.coalesce(r["type"] == "rectanglelabels", F.lit(False)))


def existing_images(tasks: DataFrame, inventory: DataFrame) -> DataFrame:
    """Tasks whose ``path`` is in the inventory."""
    return tasks.join(inventory.select("path"), "path", "left_semi")


def missing_images(tasks: DataFrame, inventory: DataFrame) -> DataFrame:
    """Tasks whose ``path`` is not in the inventory."""
    return tasks.join(inventory.select("path"), "path", "left_anti")


def convert_tasks(tasks: DataFrame, inventory: DataFrame, classes=None,
                  document_root: str = ".") -> DataFrame:
    """One row per task with status, stem, YOLO lines and per-box problems.

    status: ``no_url`` | ``missing`` | ``ok``.  ``all_results`` is the first
    annotation set (F8), ``rects`` its rectangle results (F5)."""
    classes = list(classes or CLASS_NAMES)
    t = tasks.select(
        "file", "pos", "image_url",
        F.try_variant_get("task", "$.annotations[0].result", RESULT_ARRAY).alias("all_results"))
    t = t.withColumn("src_path", F.when(F.coalesce(F.col("image_url"), F.lit("")) != "",
                                        image_path("image_url", document_root)))
    inv = inventory.select(F.col("path").alias("src_path")).distinct().withColumn("exists", F.lit(True))
    t = t.join(inv, "src_path", "left")
    status = F.when(F.col("src_path").isNull(), F.lit("no_url")) \
              .when(F.col("exists").isNull(), F.lit("missing")).otherwise(F.lit("ok"))
    rects = rectangles("all_results")

    def placed(r):
        v = r["value"]
        return v["x"].isNotNull() & v["y"].isNotNull() & v["width"].isNotNull() & v["height"].isNotNull()

    def is_valid(r):
        return F.coalesce(_first_label(r).isin(classes) & placed(r), F.lit(False))

    def to_line(r):
        v = r["value"]
        yolo = percent_to_yolo(v["x"], v["y"], v["width"], v["height"])
        # comparisons with literals: in a lambda, which Spark interprets, array functions cost several times as much
        cid = F.coalesce(*[F.when(_first_label(r) == c, F.lit(i)) for i, c in enumerate(classes)])
        return yolo_line(cid, yolo["cx"], yolo["cy"], yolo["w"], yolo["h"])

    t = t.select("file", "pos", "image_url", "src_path", status.alias("status"),
                 file_name("src_path").alias("image_name"), file_stem("src_path").alias("stem"),
                 "all_results", rects.alias("rects"))
    ok = F.col("status") == "ok"
    lines = F.when(ok, F.transform(F.filter("rects", is_valid), to_line)) \
             .otherwise(F.array().cast("array<string>"))
    def problem(r):
        lab = _first_label(r)
        return F.when(lab.isNull(), F.concat(F.col("stem"), F.lit(": box with no label, skipping"))) \
                .when(lab.isin(classes),
                      F.concat(F.col("stem"), F.lit(": box without coordinates, skipping"))) \
                .otherwise(F.concat(F.col("stem"), F.lit(": unknown label '"), lab, F.lit("', skipping")))

    problems = F.when(ok, F.transform(F.filter("rects", lambda r: ~is_valid(r)), problem)) \
                .otherwise(F.array().cast("array<string>"))
    # n_boxes counts valid boxes without formatting them, so queries that only
    # need counts never evaluate the text (column pruning drops `lines`)
    n_boxes = F.when(ok, F.size(F.filter("rects", is_valid))).otherwise(F.lit(0))
    return t.withColumn("lines", lines) \
            .withColumn("n_boxes", n_boxes) \
            .withColumn("label_text", label_text("lines")) \
            .withColumn("box_problems", problems)


def convert_warnings(converted: DataFrame) -> DataFrame:
    """F6 + F7 side output: one row per task failure or rejected box.

    Columns (stage, file, pos, seq, reason); seq −1 marks a task-level reason.
    One pass over the converted tasks (no union of two re-computations)."""
    task_reason = F.when(F.col("status") == "no_url", F.lit("Task has no image URL, skipping")) \
                   .otherwise(F.concat(F.lit("Image not found: "), F.col("src_path")))
    ws = F.when(F.col("status") != "ok",
                F.array(F.struct(F.lit(-1).alias("seq"), task_reason.alias("reason")))) \
          .otherwise(F.transform("box_problems", lambda x, i: F.struct(i.alias("seq"), x.alias("reason"))))
    return converted.select(F.lit("convert").alias("stage"), "file", "pos", F.inline(ws))


def label_files(converted: DataFrame) -> DataFrame:
    """One label text per stem; a later task overwrites an earlier one."""
    ok = converted.where(F.col("status") == "ok").select("stem", "file", "pos", "image_name", "src_path", "label_text",
                                                      "n_boxes")
    # status 'ok' implies a non-NULL path, hence a non-NULL stem
    return dedup_last(ok, key="stem", order=["file", "pos"], keys_not_null=True)


def convert_summary(converted: DataFrame, classes=None) -> DataFrame:
    """A3: tasks, boxes, background (every 0-box task, incl. failures)."""
    return converted.agg(
        F.count(F.lit(1)).alias("tasks"),
        F.coalesce(F.sum("n_boxes"), F.lit(0)).cast("long").alias("boxes"),
        F.count_if(F.col("n_boxes") == 0).alias("background_count"))


def class_box_counts(converted: DataFrame, classes=None) -> DataFrame:
    """A3 class counts: over tasks with ≥1 written box, every result of the first
    set whose first label is a class (type NOT checked); every class reported.

    Results are exploded and counted per label (partial aggregate, ≤ #classes
    rows leave each task); zero rows for every class are unioned in so absent
    classes still appear."""
    classes = list(classes or CLASS_NAMES)
    cls_arr = F.array(*[F.lit(c) for c in classes])
    res = F.coalesce(F.col("all_results"), F.array().cast(RESULT_ARRAY))
    labels = converted.where(F.col("n_boxes") > 0).select(F.explode(res).alias("r")) \
                      .select(_first_label(F.col("r")).alias("class_name"))
    counted = labels.where(F.col("class_name").isin(classes)).groupBy("class_name") \
                    .agg(F.count(F.lit(1)).alias("boxes"))
    zeros = converted.sparkSession.createDataFrame([(c, 0) for c in classes], "class_name string, boxes long")
    total = counted.unionByName(zeros).groupBy("class_name").agg(F.sum("boxes").cast("long").alias("boxes"))
    return total.select((F.array_position(cls_arr, F.col("class_name")) - 1).cast("int").alias("class_id"),
                        "class_name", "boxes")
