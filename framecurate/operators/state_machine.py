"""Per-camera capture state machine (T2 variety filter, T3 background throttle,
T4 control events, T5 routing), shared by batch and Structured Streaming.

The decision for a frame depends on the last *accepted* frame, so it is a
sequential fold per camera and cannot be written with ``lag``.  Everything
that can run in parallel is done before the fold by Spark (histograms,
normalisation); the fold itself only compares 128-float vectors.

Semantics (one frame at a time, in (ts, frame_id) order):

* ``control == 'reset'`` clears both states before the frame is routed.
* frame with cats → variety filter:  elapsed < min → reject; no last
  histogram, or none of its own → accept; elapsed ≥ max → accept;
  distance ≥ threshold → accept; else reject.  Only accepts update the state.
* frame without cats → background throttle: accept when there was no
  background save yet or ``ts − last ≥ interval``.
* ``control == 'manual_background'`` saves the frame as background after
  routing and restarts the background timer at its ts (no counter).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd

FLT_EPSILON = 1.1920928955078125e-07

KIND_CATS = "cats"
KIND_BACKGROUND = "background"
KIND_DROPPED = "dropped"
KIND_LATE = "dropped_late"
CONTROL_RESET = "reset"
CONTROL_MANUAL = "manual_background"

# Fixed defaults of the capture loop (seconds → microseconds).
DEFAULT_SIMILARITY = 0.15
DEFAULT_MIN_US = 2_000_000
DEFAULT_MAX_US = 30_000_000
DEFAULT_BACKGROUND_US = 60_000_000


@dataclass(frozen=True)
class FilterParams:
    similarity: float = DEFAULT_SIMILARITY
    min_us: int = DEFAULT_MIN_US
    max_us: int = DEFAULT_MAX_US
    background_us: int = DEFAULT_BACKGROUND_US


def bhattacharyya(a: np.ndarray, b: np.ndarray) -> float:
    """Bhattacharyya histogram distance with left-fold sums (bit-equal to the
    SQL ``aggregate`` form used by the Column function and the oracle)."""
    s = float(np.cumsum(np.sqrt(a * b))[-1]) if len(a) else 0.0
    sa = float(np.cumsum(a)[-1]) if len(a) else 0.0
    sb = float(np.cumsum(b)[-1]) if len(b) else 0.0
    p = sa * sb
    scale = 1.0 / math.sqrt(p) if abs(p) > FLT_EPSILON else 1.0
    return math.sqrt(max(1.0 - s * scale, 0.0))


@dataclass
class CameraState:
    last_cat_us: int | None = None
    last_cat_hist: np.ndarray | None = None
    last_cat_fid: int | None = None
    last_bg_us: int | None = None
    last_seen_us: int | None = None

    def reset(self) -> None:
        self.last_cat_us = None
        self.last_cat_hist = None
        self.last_cat_fid = None
        self.last_bg_us = None


def step(state: CameraState, us: int, fid: int, has_cats, control, hist, p: FilterParams):
    """Route one frame; returns (kind, manual_save, distance)."""
    if control == CONTROL_RESET:
        state.reset()
    kind = None
    dist = None
    if has_cats is True:
        if state.last_cat_us is not None and us - state.last_cat_us < p.min_us:
            kind = KIND_DROPPED
        elif state.last_cat_hist is None or hist is None or len(hist) != len(state.last_cat_hist):
            kind = KIND_CATS                     # nothing to compare with
        elif us - state.last_cat_us >= p.max_us:
            kind = KIND_CATS
        else:
            dist = bhattacharyya(state.last_cat_hist, hist)
            kind = KIND_CATS if dist >= p.similarity else KIND_DROPPED
        if kind == KIND_CATS:
            state.last_cat_us, state.last_cat_hist, state.last_cat_fid = us, hist, fid
    elif has_cats is False:
        if state.last_bg_us is None or us - state.last_bg_us >= p.background_us:
            kind = KIND_BACKGROUND
            state.last_bg_us = us
        else:
            kind = KIND_DROPPED
    manual = control == CONTROL_MANUAL
    if manual:
        state.last_bg_us = us
    state.last_seen_us = us
    return kind, manual, dist


def _array(values) -> list:
    """Histogram cells as float arrays, None where there is none."""
    return [None if v is None or isinstance(v, float) else np.asarray(v, dtype=np.float64) for v in values]


def _distances(last: np.ndarray, hists: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """:func:`bhattacharyya` of one histogram to many, with the same sums."""
    s = np.cumsum(np.sqrt(hists * last), axis=1)[:, -1]
    p = float(np.cumsum(last)[-1]) * sums
    scale = np.where(np.abs(p) > FLT_EPSILON, 1.0 / np.sqrt(np.where(p > 0, p, 1.0)), 1.0)
    return np.sqrt(np.maximum(1.0 - s * scale, 0.0))


BLOCK = 64      # frames compared with the last saved one at a time


def _fold_cats(at: np.ndarray, us: np.ndarray, fid: np.ndarray, hists: list, kinds, state: CameraState,
               p: FilterParams) -> None:
    """Cat frames at positions ``at``, without controls between them: jumps over
    what falls into the minimum interval and compares the rest in blocks."""
    kinds[at] = KIND_DROPPED
    own, k = us[at], 0
    while k < len(at):
        if state.last_cat_us is not None:
            k = max(k, int(np.searchsorted(own, state.last_cat_us + p.min_us)))
            if k >= len(at):
                return
        last = state.last_cat_hist
        if last is None or own[k] - state.last_cat_us >= p.max_us:
            hit = k
        else:
            block = at[k:k + BLOCK]
            fit = np.array([hists[i] is not None and len(hists[i]) == len(last) for i in block])
            keep = ~fit                             # nothing to compare with: saved
            if fit.any():
                some = np.stack([hists[i] for i in block[fit]])
                sums = np.cumsum(some, axis=1)[:, -1] if some.shape[1] else np.zeros(len(some))
                keep[fit] = _distances(last, some, sums) >= p.similarity if some.shape[1] else p.similarity <= 1.0
            keep |= us[block] - state.last_cat_us >= p.max_us
            if not keep.any():
                k += len(block)
                continue
            hit = k + int(np.argmax(keep))
        i = at[hit]
        kinds[i] = KIND_CATS
        state.last_cat_us, state.last_cat_hist, state.last_cat_fid = int(us[i]), hists[i], int(fid[i])
        k = hit + 1


def _fold_background(at: np.ndarray, us: np.ndarray, kinds, state: CameraState, p: FilterParams) -> None:
    kinds[at] = KIND_DROPPED
    own, k = us[at], 0
    while k < len(at):
        if state.last_bg_us is not None:
            k = max(k, int(np.searchsorted(own, state.last_bg_us + p.background_us)))
            if k >= len(at):
                return
        kinds[at[k]], state.last_bg_us = KIND_BACKGROUND, int(own[k])
        k += 1


def frame_columns(pdf: pd.DataFrame) -> tuple:
    """What a fold reads of routing rows, as arrays: us, frame id, is a cat frame,
    has no flag, control, histogram."""
    flags = pdf["has_cats"].to_numpy()
    cats = np.array([x is True or x is np.True_ or (isinstance(x, float) and x == 1.0) for x in flags], dtype=bool)
    none = np.array([x is None or x is pd.NA or (isinstance(x, float) and math.isnan(x)) for x in flags], dtype=bool)
    ctrl = [c if isinstance(c, str) else None for c in pdf["control"].to_numpy()]
    return pdf["us"].to_numpy().astype(np.int64), pdf["frame_id"].to_numpy(), cats, none, ctrl, _array(pdf["hist"].to_numpy())


def fold_slice(columns: tuple, a: int, b: int, kinds: np.ndarray, manual: np.ndarray, state: CameraState,
               p: FilterParams, late_policy: bool = False) -> None:
    """Run the state machine over rows a to b of ``frame_columns``, one camera's in
    order of (us, frame_id), and put the decisions into ``kinds`` and ``manual``.

    Between two control rows the cat and background filters do not touch each
    other, so each walks its own frames; a control row takes one ``step``.
    ``late_policy``: rows before the last one seen are not routed
    (``dropped_late``), but their controls still count."""
    us, fid, cats, none, ctrl, hists = columns
    begin = a
    if late_policy and state.last_seen_us is not None:
        begin = a + int(np.searchsorted(us[a:b], state.last_seen_us))
        kinds[a:begin] = KIND_LATE
        for i in range(a, begin):
            if ctrl[i] == CONTROL_RESET:
                state.reset()
            elif ctrl[i] == CONTROL_MANUAL:
                manual[i] = True
                state.last_bg_us = max(int(us[i]), state.last_bg_us or int(us[i]))
    events = [i for i in range(begin, b) if ctrl[i] is not None]
    for stop in [*events, b]:
        if stop > begin:
            span = np.arange(begin, stop)
            _fold_cats(span[cats[begin:stop]], us, fid, hists, kinds, state, p)
            _fold_background(span[~cats[begin:stop] & ~none[begin:stop]], us, kinds, state, p)
        if stop < b:
            flag = None if none[stop] else bool(cats[stop])
            kinds[stop], manual[stop], _ = step(state, int(us[stop]), int(fid[stop]), flag, ctrl[stop], hists[stop], p)
        begin = stop + 1
    if b > a:
        state.last_seen_us = max(int(us[b - 1]), state.last_seen_us or int(us[b - 1]))


def fold_frames(pdf: pd.DataFrame, state: CameraState, p: FilterParams,
                late_policy: bool = False) -> pd.DataFrame:
    """:func:`fold_slice` over one camera's rows already sorted by (us, frame_id)."""
    n = len(pdf)
    kinds, manual, columns = np.empty(n, dtype=object), np.zeros(n, dtype=bool), frame_columns(pdf)
    fold_slice(columns, 0, n, kinds, manual, state, p, late_policy)
    return pd.DataFrame({"camera_id": pdf["camera_id"].to_numpy(), "frame_id": columns[1],
                         "us": columns[0], "has_cats": pdf["has_cats"].to_numpy(),
                         "kind": kinds, "manual_save": manual})


ROUTE_SCHEMA = "camera_id string, frame_id long, us long, has_cats boolean, kind string, manual_save boolean"


_NO_CAMERA = object()      # before the first row; a NULL camera is a camera


def make_batch_router(p: FilterParams):
    """``applyInPandas`` function: rows of one camera arrive as an iterator of
    Arrow batches already sorted by (us, frame_id); state lives between batches,
    so a long camera history is never materialised at once."""
    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = CameraState()
        for pdf in batches:
            if len(pdf):
                yield fold_frames(pdf, state, p)
    return route


def make_partition_router(p: FilterParams):
    """``mapInPandas`` function over a partition clustered by camera and sorted
    by (camera_id, us, frame_id): one Python call per partition, state reset
    whenever the camera changes, so per-camera overhead is a dictionary-free
    comparison rather than a separate Arrow round trip."""
    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = CameraState()
        cam = _NO_CAMERA
        last = None
        for pdf in batches:
            if not len(pdf):
                continue
            cams = pdf["camera_id"].to_numpy()
            us = pdf["us"].to_numpy()
            fid = pdf["frame_id"].to_numpy()
            # split the batch at camera changes
            change = np.flatnonzero(cams[1:] != cams[:-1]) + 1
            starts = np.concatenate(([0], change))
            ends = np.concatenate((change, [len(pdf)]))
            out = []
            for a, b in zip(starts, ends):
                if cams[a] != cam:
                    cam, state, last = cams[a], CameraState(), None
                key = (int(us[a]), int(fid[a]))
                if last is not None and key < last:
                    raise ValueError("rows must arrive sorted by (camera_id, ts, frame_id)")
                last = (int(us[b - 1]), int(fid[b - 1]))
                out.append(fold_frames(pdf.iloc[a:b], state, p))
            yield pd.concat(out, ignore_index=True) if len(out) > 1 else out[0]
    return route


# ---------------------------------------------------------------- waves
# Long histories can be routed in time-ordered waves of bounded chunks.  Each wave's task gets the camera's carried state as a leading
# "state row" (is_state = True) followed by the chunk's rows in order.
WAVE_OUT_SCHEMA = ("camera_id string, is_state boolean, frame_id long, us long, has_cats boolean, kind string, "
                   "manual_save boolean, s_cat_us long, s_cat_hist array<double>, s_cat_fid long, s_bg_us long")


def _nullable_int(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or v is pd.NA:
        return None
    return int(v)


def make_wave_router(p: FilterParams):
    """``mapInPandas`` function for one wave: per camera an optional state row,
    then its rows sorted by (us, frame_id); emits decisions plus one end-state
    row per camera for the next wave."""
    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cam, state = _NO_CAMERA, None

        def end_row(c, s):
            return {"camera_id": c, "is_state": True, "frame_id": None, "us": None, "has_cats": None,
                    "kind": None, "manual_save": None, "s_cat_us": s.last_cat_us,
                    "s_cat_hist": None if s.last_cat_hist is None else [float(x) for x in s.last_cat_hist],
                    "s_cat_fid": s.last_cat_fid, "s_bg_us": s.last_bg_us}

        columns = ["camera_id", "is_state", "frame_id", "us", "has_cats", "kind",
                   "manual_save", "s_cat_us", "s_cat_hist", "s_cat_fid", "s_bg_us"]
        for pdf in batches:
            if not len(pdf):
                continue
            cams = pdf["camera_id"].to_numpy()
            is_state = pdf["is_state"].to_numpy().astype(bool)
            carried = {c: pdf[c].to_numpy() for c in columns[7:]}
            change = np.flatnonzero(cams[1:] != cams[:-1]) + 1
            starts = np.concatenate(([0], change))
            ends = np.concatenate((change, [len(pdf)]))
            outs, pending_end = [], []
            for a, b in zip(starts, ends):
                if cams[a] != cam:
                    if cam is not _NO_CAMERA:
                        pending_end.append(end_row(cam, state))
                    cam, state = cams[a], CameraState()
                if is_state[a]:
                    h = carried["s_cat_hist"][a]
                    state = CameraState(last_cat_us=_nullable_int(carried["s_cat_us"][a]),
                                        last_cat_hist=None if h is None else np.asarray(h, dtype=np.float64),
                                        last_cat_fid=_nullable_int(carried["s_cat_fid"][a]),
                                        last_bg_us=_nullable_int(carried["s_bg_us"][a]))
                    a += 1
                if b > a:
                    outs.append(fold_frames(pdf.iloc[a:b], state, p))
            # the columns that decisions and states lack are added once a batch, not once a camera
            if outs:
                decided = pd.concat(outs, ignore_index=True)
                decided["is_state"] = False
                for c in columns[7:]:
                    decided[c] = pd.Series([None] * len(decided), dtype=object)
                yield decided[columns]
            if pending_end:
                yield pd.DataFrame(pending_end, columns=columns, dtype=object)     # as object, long values stay exact
        if cam is not _NO_CAMERA:
            yield pd.DataFrame([end_row(cam, state)])
    return route
