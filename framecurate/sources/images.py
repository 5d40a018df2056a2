"""Frame and file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framecurate.schemas import IMAGE


def _frame_columns(df: DataFrame, camera_pattern: str) -> DataFrame:
    origin = F.col("image.origin")
    return df.select(
        F.regexp_extract(origin, camera_pattern, 1).alias("camera_id"),
        F.xxhash64(origin).alias("frame_id"),
        F.col("_metadata.file_modification_time").alias("ts"),
        "image")


def read_frames(spark: SparkSession, path: str, camera_pattern: str = r"/([^/]+)/[^/]+$") -> DataFrame:
    """Decoded frames with dimensions.  Undecodable files are kept as rows
    with width −1 (an error row, like the reference's failed read)."""
    df = spark.read.format("image").option("dropInvalid", False).load(path)
    return _frame_columns(df, camera_pattern)


def image_dims(frames: DataFrame) -> DataFrame:
    """S1 projection: (path, width, height, readable) — image bytes pruned after decode."""
    return frames.select(F.col("image.origin").alias("path"), F.col("image.width").alias("width"),
                         F.col("image.height").alias("height"), (F.col("image.width") > 0).alias("readable"))


def _decodable():
    img = F.col("image")
    return F.coalesce(img.isNotNull() & img["data"].isNotNull() & (img["width"] > 0) & (img["height"] > 0), F.lit(False))


def valid_frames(frames: DataFrame) -> DataFrame:
    """frames that can be decoded."""
    return frames.where(_decodable())


def bad_frames(frames: DataFrame) -> DataFrame:
    """F3 side output: one warning per null or undecodable frame."""
    return frames.where(~_decodable()).select(
        F.lit("read").alias("stage"), "camera_id", "frame_id",
        F.when(F.col("image").isNull(), F.lit("no frame")).otherwise(F.lit("cannot be decoded")).alias("reason"),
        F.col("image.origin").alias("detail"))


def stream_frames(spark: SparkSession, path: str, camera_pattern: str = r"/([^/]+)/[^/]+$",
                  max_files_per_trigger: int = 1000) -> DataFrame:
    """Continuous frame source over a landing directory (explicit schema)."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("image", IMAGE)])
    df = spark.readStream.format("image").schema(schema).option("dropInvalid", False) \
        .option("maxFilesPerTrigger", max_files_per_trigger).load(path)
    return _frame_columns(df, camera_pattern)


def read_inventory(spark: SparkSession, directory: str, glob: str = "*.jpg") -> DataFrame:
    """File paths only (binary content is pruned by the scan), non-recursive,
    case-sensitive glob."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob) \
        .option("recursiveFileLookup", False).load(directory)
    return df.select("path")
