"""Capture metadata (K3 writer form and S3 reader).

Metadata is one small JSON document per saved frame.  At scale it is written
as JSON-lines shards (``write_capture_meta``) and read back with an explicit
schema — never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framecurate.functions.boxes import round_confidence
from framecurate.functions.naming import iso_timestamp
from framecurate.schemas import CAPTURE_META


def capture_meta_struct(frames: DataFrame):
    """K3 document: bbox unclamped, confidence rounded to 4 dp; background rows
    (no detections) carry ``cat_count 0, crops [], detections []``."""
    dets = F.coalesce(F.col("detections"), F.array())
    meta_dets = F.transform(dets, lambda d: F.struct(
        d["class_id"].alias("class_id"),
        F.array(d["bbox"]["x1"], d["bbox"]["y1"], d["bbox"]["x2"], d["bbox"]["y2"]).alias("bbox"),
        round_confidence(d["confidence"]).alias("confidence")))
    return F.struct(iso_timestamp("ts").alias("timestamp"), F.size(dets).alias("cat_count"),
                    F.col("full_frame"), F.coalesce(F.col("crops"), F.array().cast("array<string>")).alias("crops"),
                    meta_dets.alias("detections"))


def capture_meta_json(frames: DataFrame) -> DataFrame:
    """(frame_id, meta_json) — the text a capture writes next to its frame."""
    return frames.select("frame_id", F.to_json(capture_meta_struct(frames)).alias("meta_json"))


def parse_capture_meta(df: DataFrame, col: str = "meta_json") -> DataFrame:
    """Typed metadata columns from JSON text; missing ``detections`` → []."""
    m = F.from_json(F.col(col), CAPTURE_META)
    out = df.select(*[c for c in df.columns if c != col], m.alias("m")).select("*", "m.*").drop("m")
    return out.withColumn("detections", F.coalesce("detections", F.array().cast(
        CAPTURE_META["detections"].dataType.simpleString())))


def read_capture_meta(spark: SparkSession, directory: str) -> DataFrame:
    """S3: every ``*_meta.json`` document and every shard of
    :func:`write_capture_meta` in ``directory`` (its ``batch_id`` folders included)."""
    def files(glob: str, whole: bool) -> DataFrame:
        return spark.read.schema(CAPTURE_META).option("multiLine", whole).option("pathGlobFilter", glob) \
            .option("recursiveFileLookup", not whole).json(directory) \
            .select(*CAPTURE_META.fieldNames(), F.col("_metadata.file_path").alias("meta_path"))
    df = files("*_meta.json", True).unionByName(files("part-*.json", False))
    return df.withColumn("detections", F.coalesce("detections", F.array().cast(
        CAPTURE_META["detections"].dataType.simpleString())))


def write_capture_meta(frames: DataFrame, path: str, batch_id: int | str | None = None) -> None:
    """K3 at scale: JSON-lines shards, one document per capture.  With a
    ``batch_id`` the batch has a folder of its own, so a retry replaces it."""
    out = frames.select(capture_meta_struct(frames).alias("m"), "frame_id").select("frame_id", "m.*")
    if batch_id is None:
        out.write.mode("append").json(path)
    else:
        out.write.mode("overwrite").json(f"{path}/batch_id={batch_id}")
