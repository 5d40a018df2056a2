"""Annotation-task sources.

An export file is one JSON document: a list of tasks, or an object wrapping
the list under one of a few keys.  Files are read whole (one row per file,
``wholetext``) so Spark parallelises across files; the JSON is parsed once
into ``VARIANT`` and exploded into one row per task with its position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framecurate.functions.naming import image_filename

# Keys under which exports may wrap their task list, in order.
MERGE_WRAPPER_KEYS = ("tasks", "annotations", "results")
CONVERT_WRAPPER_KEYS = ("tasks", "annotations")


#: Task shards written by the sinks: one task a line, in order.
SHARD_NAME = r"/part-[^/]*\.txt$"


def read_annotation_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) for every export file at ``path``, read whole.

    A directory means its ``*.json`` files and task shards (not recursive); a
    file or glob means what it matches.  Raises when nothing matches."""
    from pyspark.errors import AnalysisException
    inside = f"{path.rstrip('/')}/{{*.json,part-*.txt}}"
    for p in (inside, path):
        try:
            df = spark.read.text(p, wholetext=True)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        if p == path and df.where(~F.col("_metadata.file_path").rlike(rf"\.json$|{SHARD_NAME}")).limit(1).count():
            # a plain directory without export files
            break
        return df.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    raise FileNotFoundError(f"no annotation export at {path}")


def task_array(j: Column, wrapper_keys, single_task_fallback: bool) -> Column:
    as_list = F.try_variant_get(j, "$", "array<variant>")
    wrapped = [F.try_variant_get(j, f"$.{k}", "array<variant>") for k in wrapper_keys]
    arr = F.coalesce(as_list, *wrapped)
    if single_task_fallback:
        # convert-side rule: an object with none of the keys is ONE task
        is_obj = F.try_variant_get(j, "$", "map<string,variant>").isNotNull()
        arr = F.coalesce(arr, F.when(is_obj, F.array(j)))
    return arr


def _file_tasks(wrapper_keys, single_task_fallback: bool) -> Column:
    """The file's tasks: of a shard its lines, of any other its JSON document.

    The document is parsed once: it is the only element of an array that
    ``transform`` visits, so the unwrapping rules share one VARIANT."""
    lines = F.transform(F.filter(F.split("text", "\n"), lambda x: x != ""), F.try_parse_json)
    document = F.get(F.transform(F.array(F.try_parse_json(F.col("text"))),
                                 lambda j: task_array(j, wrapper_keys, single_task_fallback)), 0)
    return F.when(F.col("file").rlike(SHARD_NAME), lines).otherwise(document)


def parse_task_files(files: DataFrame, wrapper_keys=MERGE_WRAPPER_KEYS,
                     single_task_fallback: bool = False) -> DataFrame:
    """(file, text) → (file, pos, task VARIANT, filename, image_url, parsed).

    Unparseable files and files without a task list yield no task rows (their
    ``parsed`` flag is kept on a single NULL-task row by ``file_status``)."""
    ex = files.select("file", F.posexplode(_file_tasks(wrapper_keys, single_task_fallback)).alias("pos", "task"))
    url = F.try_variant_get(F.col("task"), "$.data.image", "string")
    return ex.select("file", "pos", "task",
                     url.alias("image_url"),
                     image_filename(url).alias("filename"))


def file_status(files: DataFrame, wrapper_keys=MERGE_WRAPPER_KEYS) -> DataFrame:
    """(file, parsed BOOLEAN, n_tasks) per file — includes unreadable files."""
    shard = F.col("file").rlike(SHARD_NAME)
    return files.select("file", (shard | F.try_parse_json(F.col("text")).isNotNull()).alias("parsed"),
                        F.greatest(F.coalesce(F.size(_file_tasks(wrapper_keys, False)), F.lit(0)),
                                   F.lit(0)).alias("n_tasks"))


def read_warnings(files: DataFrame) -> DataFrame:
    """Side output: one warning per file that is not valid JSON."""
    return files.where(~F.col("file").rlike(SHARD_NAME) & F.try_parse_json(F.col("text")).isNull()).select(
        F.lit("read").alias("stage"), F.col("file").alias("key"),
        F.lit("failed to load").alias("reason"), F.lit(None).cast("string").alias("detail"))


def labeled_filenames(tasks: DataFrame) -> DataFrame:
    """Distinct filenames of tasks that are objects with a non-empty URL."""
    return tasks.where(F.col("filename").isNotNull()).select("filename").distinct()


def read_labeled_filenames(spark: SparkSession, path: str) -> DataFrame:
    """S4b from storage: filenames already in an export; a missing path is an
    empty set (not an error), like the reference's skip list."""
    try:
        files = read_annotation_files(spark, path)
    except FileNotFoundError:
        return spark.createDataFrame([], "filename string")
    return labeled_filenames(parse_task_files(files))
