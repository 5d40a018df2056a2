"""The capture loop end to end on a stream (X3), its running counters (T6) and a
queue that does not repeat itself (T7).

Each micro-batch runs the batch operators and writes to folders that carry its
number: decisions, saved frames with their images, and last the cameras' state
with the counters.  A batch reads the state of the batch before it, so one that
is run again after a failure gives the same folders again, whatever it had
written by then.  Images never go through state or a shuffle by camera: the batch
still holds its frames, and only accepted ids are joined to them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framecurate.operators.state_machine import KIND_LATE, FilterParams, make_wave_router
from framecurate.plans import curate as cu
from framecurate.session import discard, folders_before, stage
from framecurate.streaming.capture import checkpoint_for

COUNTERS = ("total_frames", "detection_frames", "saved_frames", "background_frames")
_STATE = ("s_cat_us", "s_cat_hist", "s_cat_fid", "s_bg_us")


def _last_state(spark: SparkSession, base: str, batch_id: int) -> DataFrame | None:
    earlier = folders_before(spark, f"{base}/state", "batch", batch_id)
    last = earlier.agg(F.max("batch")).first()[0] if earlier is not None else None
    return None if last is None else earlier.where(F.col("batch") == last).drop("batch")


def running_stats(spark: SparkSession, base: str) -> DataFrame:
    """(camera_id and COUNTERS) as of the last complete batch."""
    state = _last_state(spark, base, 1 << 62)
    if state is None:
        return spark.createDataFrame([], "camera_id string, " + ", ".join(f"{c} long" for c in COUNTERS))
    return state.select("camera_id", *COUNTERS)


def curate_batch(batch: DataFrame, batch_id: int, base: str, make_predict_fn, params: FilterParams = FilterParams(),
                 after: Callable[[str, int], None] | None = None, **how) -> None:
    """One micro-batch of ``start_curate``; ``after(name, batch_id)`` is called when a folder is written."""
    spark = batch.sparkSession
    good, staged = cu.detected(batch, make_predict_fn, **how)
    rows, before = cu.routing_rows(staged), _last_state(spark, base, batch_id)
    late = None
    if before is not None:
        seen = before.select(F.col("camera_id").alias("__cam"), "seen_us")
        rows = rows.join(seen, rows["camera_id"].eqNullSafe(seen["__cam"]), "left").drop("__cam")
        is_late = F.coalesce(F.col("us") < F.col("seen_us"), F.lit(False))
        late = rows.where(is_late).select("camera_id", "frame_id", "us", "has_cats", F.lit(KIND_LATE).alias("kind"), F.lit(False).alias("manual_save"))
        rows = rows.where(~is_late).drop("seen_us")
    wave = stage(cu.route_wave(rows, before, make_wave_router(params)), "curate-wave")
    routed = wave.where("NOT is_state").select("camera_id", "frame_id", "us", "has_cats", "kind", "manual_save")
    everything = routed if late is None else routed.unionByName(late)

    def put(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{base}/{name}/batch={batch_id}")
        if after is not None:
            after(name, batch_id)
    put(everything, "routed")
    put(cu.with_images(good, staged, routed, how.get("preprocess")), "saved")
    counts = cu.session_stats(everything).join(
        everything.groupBy(F.col("camera_id").alias("__cam")).agg(F.max("us").alias("__seen")),
        F.col("camera_id").eqNullSafe(F.col("__cam")))
    ends = wave.where("is_state").select(F.col("camera_id").alias("__own"), *_STATE)
    state = ends.join(counts, F.col("__own").eqNullSafe(F.col("camera_id")), "left").drop("camera_id", "__cam")
    if before is not None:
        old = before.select(F.col("camera_id").alias("__old"), F.col("seen_us").alias("__before"), *[F.col(c).alias(f"__{c}") for c in COUNTERS])
        state = state.join(old, F.col("__own").eqNullSafe(F.col("__old")), "left")
    else:
        state = state.select("*", F.lit(None).cast("long").alias("__before"), *[F.lit(0).cast("long").alias(f"__{c}") for c in COUNTERS])
    put(state.select(F.col("__own").alias("camera_id"), *_STATE, F.greatest("__seen", "__before").alias("seen_us"),
                     *[(F.coalesce(c, F.lit(0)) + F.coalesce(f"__{c}", F.lit(0))).alias(c) for c in COUNTERS]), "state")
    discard(staged, wave)


def start_curate(frames_stream: DataFrame, make_predict_fn, base: str, name: str, params: FilterParams = FilterParams(),
                 trigger: dict | None = None, after: Callable[[str, int], None] | None = None, **how):
    """X3 on a stream of (camera_id, frame_id, ts, image[, control]).

    Folders under ``base``: ``routed`` (all decisions), ``saved`` (kept frames
    with images, as ``curate`` returns them) and ``state`` (one row a camera: the
    routing state, the last time seen and the counters), each by batch.  Rows
    older than their camera's last one of an earlier batch are ``dropped_late``
    and not routed, their controls included.  ``how`` goes to ``curate``'s
    detection step (confidence, num_classes, preprocess)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        curate_batch(batch, batch_id, base, make_predict_fn, params, after, **how)
    w = frames_stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_for(frames_stream.sparkSession, name))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def queue_once(batch: DataFrame, batch_id: int, names: str) -> DataFrame:
    """Rows of a micro-batch whose filename no earlier batch has queued.

    The names of a batch are kept in a folder of their own under ``names``; a
    batch that is run again looks at earlier ones only, so it queues the same."""
    earlier = folders_before(batch.sparkSession, names, "batch", batch_id)
    fresh = batch if earlier is None else batch.join(earlier.select("filename").distinct(), "filename", "left_anti").select(*batch.columns)
    fresh.select("filename").distinct().write.mode("overwrite").parquet(f"{names}/batch={batch_id}")
    return fresh
