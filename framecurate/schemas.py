"""Canonical StructTypes of the data model (explicit everywhere, no inference)."""

from pyspark.sql import types as T

IMAGE = T.StructType([
    T.StructField("origin", T.StringType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("nChannels", T.IntegerType()),
    T.StructField("mode", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
])

BBOX = T.StructType([
    T.StructField("x1", T.IntegerType()),
    T.StructField("y1", T.IntegerType()),
    T.StructField("x2", T.IntegerType()),
    T.StructField("y2", T.IntegerType()),
])

DETECTION = T.StructType([
    T.StructField("bbox", BBOX),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("class_id", T.IntegerType()),
])

DETECTIONS = T.ArrayType(DETECTION)

FRAMES = T.StructType([
    T.StructField("camera_id", T.StringType()),
    T.StructField("frame_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("image", IMAGE),
])

# Rows fed to the per-camera state machine.
FILTER_INPUT = T.StructType([
    T.StructField("camera_id", T.StringType()),
    T.StructField("frame_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("has_cats", T.BooleanType()),
    T.StructField("control", T.StringType()),
    T.StructField("hist", T.ArrayType(T.DoubleType())),
])

# Capture metadata JSON (one file per saved frame).
CAPTURE_META = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("cat_count", T.IntegerType()),
    T.StructField("full_frame", T.StringType()),
    T.StructField("crops", T.ArrayType(T.StringType())),
    T.StructField("detections", T.ArrayType(T.StructType([
        T.StructField("class_id", T.IntegerType()),
        T.StructField("bbox", T.ArrayType(T.IntegerType())),
        T.StructField("confidence", T.DoubleType()),
    ]))),
])

# Typed projection of one annotation-tool task.
TASK_RESULT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("value", T.StructType([
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("width", T.DoubleType()),
        T.StructField("height", T.DoubleType()),
        T.StructField("rectanglelabels", T.ArrayType(T.StringType())),
    ])),
    T.StructField("original_width", T.IntegerType()),
    T.StructField("original_height", T.IntegerType()),
])

WARNINGS = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("detail", T.StringType()),
])

SAMPLES = T.StructType([
    T.StructField("stem", T.StringType()),
    T.StructField("image_path", T.StringType()),
    T.StructField("label_path", T.StringType()),
    T.StructField("split", T.StringType()),
])
