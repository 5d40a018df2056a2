"""Capture curation (E1 in batch form: T2-T5, A1, X3).

``route_frames`` shuffles only the compact routing columns
``(camera_id, us, frame_id, has_cats, control, hist)`` — never image bytes —
by camera, sorts them within partitions and runs the shared state machine
per camera over a stream of Arrow batches.  Image bytes are joined back
only for accepted frames.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framecurate.operators.images import frame_histogram
from framecurate.operators.state_machine import (ROUTE_SCHEMA, WAVE_OUT_SCHEMA, FilterParams,
                                                 make_partition_router, make_wave_router)
from framecurate.session import checkpoint_dir, stage
from framecurate.sources.images import valid_frames

KEY = ["camera_id", "frame_id"]          # frame ids are a camera's own
BROADCAST_IDS = 1_000_000                # saved frames' ids are broadcast up to so many rows


def _same_frame(a: DataFrame, b: DataFrame):
    return a["camera_id"].eqNullSafe(b["camera_id"]) & (a["frame_id"] == b["frame_id"])


def frame_histograms(frames: DataFrame) -> DataFrame:
    """X2 → A7 → A8: the key columns present and ``hist``, the normalised 16×8
    hue/saturation histogram of each decodable frame's thumbnail: binned in the
    pass that decodes it, one array a frame."""
    key = [c for c in KEY if c in frames.columns]
    return valid_frames(frames).select(*key, frame_histogram("image", normalized=True).alias("hist"))


def routing_input(frames: DataFrame, hist: DataFrame | None = None) -> DataFrame:
    """Compact routing rows; ``hist`` (camera_id, frame_id, hist) is joined on both ids."""
    base = frames.select("camera_id", "frame_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
                         "has_cats", F.col("control").cast("string").alias("control"))
    if hist is None:
        return base.withColumn("hist", F.lit(None).cast("array<double>"))
    return base.join(hist, _same_frame(base, hist), "left").select(*[base[c] for c in base.columns], hist["hist"])


ROUTE_COLUMNS = ["camera_id", "us", "frame_id", "has_cats", "control", "hist"]


def route_frames(rows: DataFrame, params: FilterParams = FilterParams(), chunk_us: int | None = None) -> DataFrame:
    """T5: kind ∈ cats | background | dropped (NULL for pure control rows) + manual_save.

    One shuffle by camera, sorted within partitions, one streaming fold per
    partition; a NULL camera is a camera like others.  ``chunk_us`` routes long
    histories in waves of that time span instead (:func:`route_in_waves`); the
    decisions are the same."""
    if chunk_us is not None:
        return route_in_waves(rows, params, chunk_us)
    ordered = rows.select(*ROUTE_COLUMNS).repartition("camera_id") \
                  .sortWithinPartitions("camera_id", "us", "frame_id")
    return ordered.mapInPandas(make_partition_router(params), ROUTE_SCHEMA)


def route_in_waves(rows: DataFrame, params: FilterParams, chunk_us: int, work_dir: str | None = None) -> DataFrame:
    """Exact routing of camera histories in time-ordered waves.

    The compact routing rows are materialised once in the shared checkpoint
    folder, partitioned by time chunk.  Wave k then reads only chunk k
    (partition pruning) and routes it for every camera in parallel; each task
    sees one (camera, chunk) slice — bounded by the chunk length, never the
    whole history — preceded by the camera's carried state (last accepted cat
    frame and histogram, last background time).  Decisions and end states are
    written back to the checkpoint folder, so lineage stays one wave long and a
    lost executor only repeats its task of the current wave."""
    spark = rows.sparkSession
    base = work_dir or os.path.join(checkpoint_dir(spark), "route-waves", uuid.uuid4().hex)
    staged = os.path.join(base, "input")
    given = rows.select(*ROUTE_COLUMNS, F.floor(F.col("us") / F.lit(chunk_us)).cast("long").alias("chunk"))
    given.write.mode("overwrite").partitionBy("chunk").parquet(staged)
    r = spark.read.schema(given.schema).parquet(staged)
    # one value a chunk of the time span
    chunks = [x.chunk for x in r.select("chunk").distinct().orderBy("chunk").collect()]
    state = None
    router = make_wave_router(params)
    for k in chunks:
        wave = route_wave(r.where(F.col("chunk").eqNullSafe(F.lit(k))), state, router)
        out = os.path.join(base, "out", f"wave={k}")
        wave.write.mode("overwrite").parquet(out)
        state = spark.read.parquet(out).where(F.col("is_state"))
    if not chunks:
        return spark.createDataFrame([], ROUTE_SCHEMA)
    done = spark.read.parquet(os.path.join(base, "out")).where(~F.col("is_state"))
    return done.select("camera_id", "frame_id", "us", "has_cats", "kind", "manual_save")


def route_wave(rows: DataFrame, state: DataFrame | None, router) -> DataFrame:
    """Decisions of rows, routed on from the cameras' carried state, and the end
    state of every camera that has rows or a state (WAVE_OUT_SCHEMA)."""
    data = rows.select(
        "camera_id", F.lit(False).alias("is_state"), "us", "frame_id", "has_cats", "control", "hist",
        F.lit(None).cast("long").alias("s_cat_us"), F.lit(None).cast("array<double>").alias("s_cat_hist"),
        F.lit(None).cast("long").alias("s_cat_fid"), F.lit(None).cast("long").alias("s_bg_us"))
    if state is not None:
        st = state.select("camera_id", F.lit(True).alias("is_state"), F.lit(None).cast("long").alias("us"),
                          F.lit(None).cast("long").alias("frame_id"), F.lit(None).cast("boolean").alias("has_cats"),
                          F.lit(None).cast("string").alias("control"),
                          F.lit(None).cast("array<double>").alias("hist"),
                          "s_cat_us", "s_cat_hist", "s_cat_fid", "s_bg_us")
        data = st.unionByName(data)
    return data.repartition("camera_id") \
               .sortWithinPartitions("camera_id", F.col("is_state").desc(), "us", "frame_id") \
               .mapInPandas(router, WAVE_OUT_SCHEMA)


def session_stats(routed: DataFrame) -> DataFrame:
    """A1 per camera: total, detection (has cats), saved (cats), background.

    Manual background saves count in none of them.  ``routed`` is already
    clustered by camera, so this aggregate adds no shuffle."""
    return routed.groupBy("camera_id").agg(
        F.count_if(F.col("has_cats").isNotNull()).alias("total_frames"),
        F.count_if(F.col("has_cats")).alias("detection_frames"),
        F.count_if(F.col("kind") == "cats").alias("saved_frames"),
        F.count_if(F.col("kind") == "background").alias("background_frames"))


def latest_frame(frames: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """T1 batch analogue: the newest frame per camera and time bucket.

    The winner's (ts, frame_id) is a partial aggregate, so a hot camera sends
    one row per bucket and map task to the shuffle.  Plain columns travel with
    it; a table with images gets the winners joined back, so image bytes of
    other frames go through no aggregate."""
    b = F.window("ts", bucket)["start"]
    row = F.struct("ts", "frame_id")
    cols = [c for c in frames.columns if c != "camera_id"]
    heavy = [f.name for f in frames.schema if isinstance(f.dataType, (T.BinaryType, T.StructType))]
    light = [c for c in cols if c not in heavy]
    agg = frames.select("camera_id", *light).withColumn("bucket", b).groupBy("camera_id", "bucket").agg(
        F.max_by(F.struct(*light), row).alias("r")).select("camera_id", "bucket", "r.*")
    if not heavy:
        return agg
    # the winners' keys, few and narrow, go to the frames: no image of another frame is shuffled by an aggregate
    won = agg.select(F.col("camera_id").alias("__cam"), F.col("frame_id").alias("__fid"), F.col("ts").alias("__ts")).distinct()
    same = F.col("camera_id").eqNullSafe(F.col("__cam")) & (F.col("frame_id") == F.col("__fid")) & (F.col("ts") == F.col("__ts"))
    own = frames.select("camera_id", "frame_id", "ts", *heavy).join(won, same, "left_semi")
    # of rows that repeat a winner the one whose image has the least hash counts
    order = F.xxhash64(*[F.to_json(c) if isinstance(frames.schema[c].dataType, T.StructType) else F.col(c) for c in heavy])
    back = own.withColumn("__h", order).groupBy(F.col("camera_id").alias("__cam"), F.col("frame_id").alias("__fid"), F.col("ts").alias("__ts")) \
        .agg(F.min_by(F.struct(*heavy), "__h").alias("__r")).select("__cam", "__fid", "__ts", "__r.*")
    return agg.join(back, same).select("camera_id", "bucket", *cols)


def curate(frames: DataFrame, make_predict_fn, params: FilterParams = FilterParams(),
           confidence: float = 0.4, num_classes: int = 80, preprocess=None,
           chunk_us: int | None = None) -> DataFrame:
    """The capture loop as one DataFrame chain, keyed by (camera_id, frame_id).

    1. F3: null and undecodable frames go (``sources.images.bad_frames`` lists
       them as warnings).
    2. One pass over the frame bytes: optional ``preprocess`` (e.g. contrast
       equalisation), X1 detection and the thumbnail's histogram, evaluated
       together (the image column is read once).  P4/F1/F2 run as Column
       expressions.
    3. The compact per-frame result (ids, time, detections, histogram — no
       image bytes) is staged once in the checkpoint folder, so inference and
       decoding never run twice; T5 routing reads it.
    4. The saved frames' ids, staged too, are joined to the raw frames, and
       only those frames are preprocessed again, ready for the K1-K3 sinks."""
    good, staged = detected(frames, make_predict_fn, confidence, num_classes, preprocess)
    return with_images(good, staged, route_frames(routing_rows(staged), params, chunk_us), preprocess)


def detected(frames: DataFrame, make_predict_fn, confidence: float = 0.4, num_classes: int = 80,
             preprocess=None) -> tuple[DataFrame, DataFrame]:
    """Steps 1 to 3 of ``curate``: the frames that can be decoded, and their
    detections and histograms, staged."""
    from framecurate.functions.boxes import class_scope, confidence_filter
    from framecurate.operators.images import detect

    good = valid_frames(frames)
    if "control" not in good.columns:
        good = good.withColumn("control", F.lit(None).cast("string"))
    f = preprocess(good) if preprocess is not None else good
    det = detect(f, make_predict_fn).withColumn("hist", frame_histogram("image", normalized=True))
    det = det.withColumn("detections", class_scope(confidence_filter("detections", confidence), num_classes))
    staged = stage(det.select(*KEY, "ts", "control", "detections", (F.size("detections") > 0).alias("has_cats"),
                              "hist"), "curate")
    return good, staged


def routing_rows(staged: DataFrame) -> DataFrame:
    """What routing reads of the staged detections."""
    return staged.select("camera_id", "frame_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
                         "has_cats", F.col("control").cast("string").alias("control"),
                         F.when(F.col("has_cats"), F.col("hist")).alias("hist"))


def with_images(good: DataFrame, staged: DataFrame, routed: DataFrame, preprocess=None) -> DataFrame:
    """Step 4 of ``curate``: the frames to save, with their images."""
    chosen = routed.where(F.col("kind").isin("cats", "background") | F.col("manual_save")) \
        .withColumn("kind", F.when(F.col("kind").isin("cats", "background"), F.col("kind"))
                    .otherwise(F.lit("manual_background")))
    info = staged.select(*KEY, "ts", "detections")
    keep = stage(chosen.join(info, _same_frame(chosen, info)).select(*[chosen[c] for c in chosen.columns],
                                                                     "ts", "detections"), "curate-saved")
    ids = keep.select(*KEY).distinct()
    ids = F.broadcast(ids) if keep.count() <= BROADCAST_IDS else ids
    raw = good.join(ids, _same_frame(good, ids), "left_semi")
    saved = (preprocess(raw) if preprocess is not None else raw).select(*KEY, "image")
    return keep.join(saved, _same_frame(keep, saved)).select(*[keep[c] for c in keep.columns], "image")
