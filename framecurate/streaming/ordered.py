"""Capture routing of streams whose rows arrive out of order, with controls as a
stream of their own (T2-T4 on ``transformWithState``).

Frames and controls of a camera wait in list state until the watermark has passed
their time; then they are routed in (us, frame_id) order by the same fold as in
batch.  So any order of arrival within ``lateness`` gives the sorted batch's
decisions; rows behind the watermark are left out by Spark's watermark filter and
counted in its metric ``numRowsDroppedByWatermark``.  A camera's state goes once
the watermark is ``idle`` past its last row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from framecurate.operators.state_machine import (CONTROL_MANUAL, CONTROL_RESET, ROUTE_SCHEMA, CameraState, FilterParams,
                                                 fold_frames)
from framecurate.streaming.capture import STATE_SCHEMA

WAITING_SCHEMA = "us long, is_frame boolean, frame_id long, has_cats boolean, control string, hist array<double>"
_WAITING = ["us", "is_frame", "frame_id", "has_cats", "control", "hist"]
_ROUTED = [c.split()[0] for c in ROUTE_SCHEMA.split(", ")] if isinstance(ROUTE_SCHEMA, str) else ROUTE_SCHEMA.names


def _plain(v):
    """A pandas cell as a state value."""
    if isinstance(v, np.ndarray | list | tuple):
        return [float(x) for x in v]
    return None if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v) else v


class OrderedRouter(StatefulProcessor):
    def __init__(self, params: FilterParams, idle_us: int | None):
        self.params, self.idle_us = params, idle_us

    def init(self, handle) -> None:
        self.handle = handle
        self.camera = handle.getValueState("camera", STATE_SCHEMA)
        self.waiting = handle.getListState("waiting", WAITING_SCHEMA)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        self.camera.update(tuple(_plain(row[c.split()[0]]) for c in STATE_SCHEMA.split(", ")))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            got = [(int(us), bool(f), None if _plain(i) is None else int(i), None if _plain(c) is None else bool(c), _plain(t), _plain(h))
                   for us, f, i, c, t, h in pdf[_WAITING].itertuples(index=False)]
            self.waiting.appendList(got)
            first = min([r[0] for r in got] + ([] if first is None else [first]), default=None)
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)
        yield pd.DataFrame(columns=_ROUTED)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(self.waiting.get() if self.waiting.exists() else (), key=lambda r: (r[0], r[1], -1 if r[2] is None else r[2]))
        due, later = [r for r in rows if r[0] < until], [r for r in rows if r[0] >= until]
        # manual saves behind the last frame that is due wait for the next one
        done = 1 + max((i for i, r in enumerate(due) if r[1]), default=-1)
        held = [r for r in due[done:] if r[4] == CONTROL_MANUAL]
        due = due[:done] + [r for r in due[done:] if r[4] != CONTROL_MANUAL]
        state = CameraState()
        if self.camera.exists():
            cat, hist, fid, bg, seen = self.camera.get()
            state = CameraState(cat, None if hist is None else np.asarray(hist, np.float64), fid, bg, seen)
        if due:
            out = [fold_frames(pdf, state, self.params, late_policy=False) for pdf in _segments(due, key[0], state)]
            seen = max(r[0] for r in due)
            self.camera.update((state.last_cat_us, None if state.last_cat_hist is None else [float(x) for x in state.last_cat_hist],
                                state.last_cat_fid, state.last_bg_us, seen))
            self.waiting.clear()
            if held or later:
                self.waiting.put(held + later)
            if out:
                yield pd.concat(out, ignore_index=True)[_ROUTED]
        else:
            seen = state.last_seen_us
        if later:
            self.handle.registerTimer(later[0][0] // 1000 + 1)
        elif self.idle_us is not None and seen is not None:
            if seen + self.idle_us < until:
                self.camera.clear()
            else:
                self.handle.registerTimer((seen + self.idle_us) // 1000 + 1)

    def close(self) -> None:
        pass


def _segments(due: list, camera, state: CameraState) -> Iterator[pd.DataFrame]:
    """Frames in order, cut where a reset comes; a manual save is a control of the
    camera's next frame."""
    frames, manual = [], False
    for us, is_frame, fid, cats, control, hist in due:
        if not is_frame:
            if control == CONTROL_RESET:
                if frames:
                    yield _frame_table(frames, camera)
                    frames = []
                state.reset()
            manual = manual or control == CONTROL_MANUAL
            continue
        if control == CONTROL_RESET and manual:
            if frames:
                yield _frame_table(frames, camera)
                frames = []
            state.reset()
        frames.append((fid, us, cats, CONTROL_MANUAL if manual else control, hist))
        manual = False
    if frames:
        yield _frame_table(frames, camera)


def _frame_table(frames: list, camera) -> pd.DataFrame:
    pdf = pd.DataFrame(frames, columns=["frame_id", "us", "has_cats", "control", "hist"])
    pdf.insert(0, "camera_id", [camera] * len(pdf))
    return pdf


def route_ordered(frames: DataFrame, controls: DataFrame | None = None, params: FilterParams = FilterParams(),
                  lateness: str = "10 seconds", idle_us: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """Routed rows of a stream of frames (camera_id, frame_id, us, has_cats,
    control, hist) and a stream of controls (camera_id, us, control).

    A reset clears the camera's state at its time; a manual save takes the next
    frame of the camera.  ``initial`` (camera_id and the columns of STATE_SCHEMA)
    carries end states of a batch run on.  State of a camera that has been silent
    for ``idle_us`` is removed.
    """
    own = frames.select("camera_id", F.lit(True).alias("is_frame"), "frame_id", "us", "has_cats", "control", "hist")
    if controls is not None:
        told = controls.select("camera_id", F.lit(False).alias("is_frame"), F.lit(None).cast("long").alias("frame_id"), "us",
                               F.lit(None).cast("boolean").alias("has_cats"), "control", F.lit(None).cast("array<double>").alias("hist"))
        own = own.unionByName(told)
    timed = own.withColumn("ts", F.timestamp_micros("us")).withWatermark("ts", lateness)
    return timed.groupBy("camera_id").transformWithStateInPandas(
        statefulProcessor=OrderedRouter(params, idle_us), outputStructType=ROUTE_SCHEMA, outputMode="Append",
        timeMode="EventTime", initialState=initial.groupBy("camera_id") if initial is not None else None)
