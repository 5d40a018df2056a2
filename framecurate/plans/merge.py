"""Merge annotation exports (E2c): union of files → first-wins by filename → stats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecurate.operators.dedup import dedup_first
from framecurate.functions.naming import image_filename
from framecurate.session import folders_before
from framecurate.sources.annotations import MERGE_WRAPPER_KEYS, _file_tasks, file_status


def merge_dedup_first(tasks: DataFrame) -> DataFrame:
    """One task per filename, the first in (file, pos) order; whole payload kept."""
    return dedup_first(tasks.select("filename", "file", "pos", "image_url", "task"),
                       key="filename", order=["file", "pos"])


def merge_new_files(tasks: DataFrame, state_path: str, run: int) -> DataFrame:
    """W1 run by run: the winners so far, of ``tasks`` of the new files and what
    earlier runs have kept.

    The state is a table of one row a filename, the winner with its (file, pos),
    in a folder a run; a run reads the last folder before its own, so running one
    again writes the same.  As the order is by (file, pos) and not by run, any
    split of the files into runs ends with ``merge_dedup_first`` of them all."""
    spark = tasks.sparkSession
    own = tasks.select("filename", "file", "pos", "image_url", "task")
    earlier = folders_before(spark, state_path, "run", run)
    last = earlier.agg(F.max("run")).first()[0] if earlier is not None else None
    if last is not None:
        own = own.unionByName(earlier.where(F.col("run") == last).select(*own.columns))
    out = f"{state_path.rstrip('/')}/run={run}"
    merge_dedup_first(own).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def merge_stats(files: DataFrame, wrapper_keys=MERGE_WRAPPER_KEYS) -> DataFrame:
    """A2: files (incl. unreadable), total tasks (incl. no URL), duplicates, unique.

    One parse of each file: ``posexplode_outer`` keeps empty and unreadable
    files as one NULL row.  Rows are first counted by filename, then the
    filenames; a file is counted at its first row."""
    ex = files.select(F.posexplode_outer(_file_tasks(wrapper_keys, False)).alias("pos", "task"))
    name = image_filename(F.try_variant_get(F.col("task"), "$.data.image", "string"))
    per_name = ex.select("pos", name.alias("filename")).groupBy("filename").agg(
        F.count("pos").alias("n"), F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("firsts"))
    named = F.col("filename").isNotNull()
    agg = per_name.agg(F.sum("firsts").alias("files"), F.sum("n").alias("total"),
                       F.sum(F.when(named, F.col("n"))).alias("with_name"), F.count_if(named).alias("unique_tasks"))
    return agg.select(*[F.coalesce(c, F.lit(0)).alias(c) for c in ("files", "total")],
                      (F.coalesce("with_name", F.lit(0)) - F.col("unique_tasks")).alias("duplicates"), "unique_tasks")


def tasks_per_file(files: DataFrame) -> DataFrame:
    """Task count per file, zero rows kept (unreadable files count 0)."""
    return file_status(files).select("file", F.col("n_tasks").cast("long").alias("n_tasks"))
