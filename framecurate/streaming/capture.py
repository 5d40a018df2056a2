"""Structured Streaming forms of the capture loop.

The same state machine as the batch form (``operators.state_machine``) runs
per camera inside ``applyInPandasWithState``: the keyed state holds each
camera's last accepted cat frame (time + histogram), last background time and
last-seen time.  Cameras share a key by a hash of their id.  Within a micro-batch a camera's rows are sorted by
(ts, frame_id); rows older than the state's last-seen time are routed to
``dropped_late`` (our one documented late-data policy: the reference is
arrival-ordered and has no watermark).

Checkpoints go to the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from framecurate.operators.state_machine import (ROUTE_SCHEMA, CameraState, FilterParams,
                                                 fold_slice, frame_columns)
from framecurate.session import checkpoint_dir

#: One camera's state.
STATE_SCHEMA = ("last_cat_us long, last_cat_hist array<double>, last_cat_fid long, "
                "last_bg_us long, last_seen_us long")

#: The state of a group of cameras: an entry a camera, histograms as the bytes of their doubles.
GROUP_STATE = ("camera_id array<string>, last_cat_us array<long>, last_cat_hist array<binary>, "
               "last_cat_fid array<long>, last_bg_us array<long>, last_seen_us array<long>")

#: Groups that cameras are dealt out to; a group's cameras share one keyed state.
STATE_BUCKETS = 2048


def _load(state) -> dict[str | None, CameraState]:
    if not state.exists:
        return {}
    return {cam: CameraState(cat, None if hist is None else np.frombuffer(bytes(hist), dtype=np.float64), fid, bg, seen)
            for cam, cat, hist, fid, bg, seen in zip(*state.get, strict=True)}


def _save(state, cameras: dict[str | None, CameraState]) -> None:
    of = cameras.values()
    state.update((list(cameras), [s.last_cat_us for s in of],
                  [None if s.last_cat_hist is None else s.last_cat_hist.tobytes() for s in of],
                  [s.last_cat_fid for s in of], [s.last_bg_us for s in of], [s.last_seen_us for s in of]))


def make_stream_router(p: FilterParams) -> Callable:
    def route(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        cameras = _load(state)
        # the rows of a group's cameras in ONE micro-batch: bounded by the trigger size
        pdf = pd.concat(list(pdfs), ignore_index=True)
        codes, names = pd.factorize(pdf["camera_id"].to_numpy(dtype=object))        # a NULL camera is -1
        order = np.lexsort((pdf["frame_id"].to_numpy(), pdf["us"].to_numpy(), codes))
        pdf, codes = pdf.iloc[order], codes[order]
        columns = frame_columns(pdf)
        kinds, manual = np.empty(len(pdf), dtype=object), np.zeros(len(pdf), dtype=bool)
        starts = np.flatnonzero(np.diff(codes, prepend=-2))
        for a, b in zip(starts, [*starts[1:], len(pdf)], strict=True):
            cam = None if codes[a] < 0 else names[codes[a]]
            fold_slice(columns, int(a), int(b), kinds, manual, cameras.setdefault(cam, CameraState()), p, late_policy=True)
        _save(state, cameras)
        yield pd.DataFrame({"camera_id": pdf["camera_id"].to_numpy(), "frame_id": columns[1], "us": columns[0],
                            "has_cats": pdf["has_cats"].to_numpy(), "kind": kinds, "manual_save": manual})
    return route


def route_stream(rows: DataFrame, params: FilterParams = FilterParams(), buckets: int = STATE_BUCKETS) -> DataFrame:
    """T2-T5 on a streaming DataFrame of routing rows
    ``(camera_id, frame_id, us, has_cats, control, hist)``.

    Cameras are dealt out to ``buckets`` groups by a hash of their id, and a
    group keeps the state of its cameras, each on its own: Spark hands a group
    to Python in milliseconds, so one group a camera costs far more than its
    frames.  Like the number of shuffle partitions, ``buckets`` is fixed for
    the life of a stream's checkpoint."""
    bucket = F.pmod(F.xxhash64("camera_id"), F.lit(buckets)).cast("int")
    return rows.select(bucket.alias("bucket"), "camera_id", "frame_id", "us", "has_cats", "control", "hist") \
        .groupBy("bucket").applyInPandasWithState(
            make_stream_router(params), outputStructType=ROUTE_SCHEMA, stateStructType=GROUP_STATE,
            outputMode="append", timeoutConf=GroupStateTimeout.NoTimeout)


def running_session_stats(routed: DataFrame) -> DataFrame:
    """The A1 counters maintained incrementally (use update/complete mode)."""
    return routed.groupBy("camera_id").agg(
        F.count(F.when(F.col("has_cats").isNotNull(), 1)).alias("total_frames"),
        F.count(F.when(F.col("has_cats"), 1)).alias("detection_frames"),
        F.count(F.when(F.col("kind") == "cats", 1)).alias("saved_frames"),
        F.count(F.when(F.col("kind") == "background", 1)).alias("background_frames"))


def conflate_latest(batch: DataFrame) -> DataFrame:
    """T1 per micro-batch: keep only the newest frame of each camera."""
    cols = [c for c in batch.columns if c != "camera_id"]
    return batch.groupBy("camera_id").agg(
        F.max_by(F.struct(*cols), F.struct("ts", "frame_id")).alias("r")).select("camera_id", "r.*")


def checkpoint_for(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", name)


def start_latest_frame(frames_stream: DataFrame, sink: Callable[[DataFrame, int], None], name: str,
                       trigger: dict | None = None):
    """Conflate each micro-batch to the newest frame per camera, then hand
    it to ``sink(df, batch_id)`` (e.g. detection + routing of the newest frame)."""
    spark = frames_stream.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        sink(conflate_latest(batch), batch_id)

    w = frames_stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_for(spark, name))
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()


def start_incremental_queue(captures_stream: DataFrame, labeled: Callable[[], DataFrame],
                            sink: Callable[[DataFrame, int], None], name: str, trigger: dict | None = None,
                            inventory: Callable[[], DataFrame] | None = None, document_root: str | None = None,
                            on_summary: Callable[[DataFrame, int], None] | None = None,
                            names: str | None = None):
    """Every micro-batch of new captures is queued for labeling minus the
    images already labeled (against the *current* labeled table, re-read per
    batch).  With an ``inventory`` the batch is classified like the batch queue
    (J1, J2, A4): ``sink`` gets the rows with their outcome, ``on_summary`` the
    one-row counts.  With a folder ``names`` for the names queued so far, an image
    that an earlier micro-batch has queued is not queued again (its outcome is
    ``skipped``), restarts included."""
    from framecurate.plans import labeling as lb
    from framecurate.streaming.chain import queue_once
    spark = captures_stream.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        if inventory is None:
            got = lb.unlabeled(batch, labeled().distinct())
            sink(got if names is None else queue_once(got, batch_id, names), batch_id)
            return
        got = lb.classify_captures(batch, inventory(), labeled(), document_root)
        if names is not None:
            fresh = queue_once(got.where(F.col("outcome") == "exported"), batch_id, names).select(
                F.col("filename").alias("__fresh")).distinct()
            got = got.join(fresh, F.col("filename") == F.col("__fresh"), "left").withColumn(
                "outcome", F.when((F.col("outcome") == "exported") & F.col("__fresh").isNull(), F.lit("skipped"))
                .otherwise(F.col("outcome"))).drop("__fresh")
        if on_summary is not None:
            on_summary(lb.export_summary(got), batch_id)
        sink(got, batch_id)

    w = captures_stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_for(spark, name))
    return w.trigger(**(trigger or {"availableNow": True})).start()
