"""The fold that jumps between candidates decides as one step per frame does
(the step itself is checked against SQL by the registered routing queries)."""

import numpy as np
import pandas as pd

from framecurate.operators import state_machine as sm
from framecurate.plans import curate as cu

MIN = 60_000_000


def timeline(rng, n, late=0):
    us = np.sort(rng.integers(0, n * MIN // 3, n))
    rows = []
    for i in range(n):
        cats = rng.choice([True, False, None], p=[0.6, 0.35, 0.05])
        hist = None
        if cats and rng.random() < 0.95:
            hist = np.ones(6) if rng.random() < 0.5 else rng.random(6)
        control = rng.choice([None, sm.CONTROL_RESET, sm.CONTROL_MANUAL, "other"], p=[0.9, 0.03, 0.05, 0.02])
        rows.append(("c", int(us[i]), i, cats, control, hist))
    return pd.DataFrame(rows, columns=["camera_id", "us", "frame_id", "has_cats", "control", "hist"]).astype(
        {"has_cats": object, "control": object, "hist": object})


def one_by_one(pdf, state, p):
    out = []
    for r in pdf.itertuples():
        kind, manual, _ = sm.step(state, r.us, r.frame_id, r.has_cats, r.control, r.hist, p)
        out.append((kind, manual))
    return out


def test_jumping_fold_equals_steps(monkeypatch):
    monkeypatch.setattr(sm, "BLOCK", 4)
    for seed in range(60):
        rng = np.random.default_rng(seed)
        p = sm.FilterParams(similarity=float(rng.choice([0.0, 0.2, 0.5])), min_us=int(rng.integers(0, 3)) * MIN,
                            max_us=int(rng.integers(1, 9)) * MIN, background_us=int(rng.integers(0, 6)) * MIN)
        pdf = timeline(rng, 90)
        a, b = sm.CameraState(), sm.CameraState()
        cut = int(rng.integers(0, 90))          # in two batches
        got = pd.concat([sm.fold_frames(pdf.iloc[:cut], a, p), sm.fold_frames(pdf.iloc[cut:], a, p)])
        assert list(zip(got["kind"], got["manual_save"])) == one_by_one(pdf, b, p), seed
        assert (a.last_cat_us, a.last_cat_fid, a.last_bg_us, a.last_seen_us) == \
            (b.last_cat_us, b.last_cat_fid, b.last_bg_us, b.last_seen_us)


def test_controls_of_late_rows_count():
    p = sm.FilterParams(min_us=0, background_us=10)
    def rows(*x):
        return pd.DataFrame(x, columns=["camera_id", "us", "frame_id", "has_cats", "control", "hist"]).astype(
            {"has_cats": object, "control": object, "hist": object})
    state = sm.CameraState()
    sm.fold_frames(rows(("c", 100, 1, False, None, None)), state, p, late_policy=True)
    out = sm.fold_frames(rows(("c", 50, 2, False, sm.CONTROL_RESET, None), ("c", 101, 3, False, None, None)),
                         state, p, late_policy=True)
    assert list(out["kind"]) == [sm.KIND_LATE, sm.KIND_BACKGROUND]      # the reset cleared the timer


def test_null_cameras_are_routed_in_either_way(spark):
    rng = np.random.default_rng(5)
    rows = [(rng.choice(["a", "b", None]), i, int(i * MIN // 4), bool(rng.random() < 0.5), None,
             [float(x) for x in rng.random(4)]) for i in range(200)]
    df = spark.createDataFrame(rows, "camera_id string, frame_id long, us long, has_cats boolean, control string, "
                                     "hist array<double>")
    p = sm.FilterParams(similarity=0.2, min_us=MIN, max_us=20 * MIN, background_us=5 * MIN)
    plain = sorted(map(tuple, cu.route_frames(df, p).collect()), key=str)
    waves = sorted(map(tuple, cu.route_frames(df, p, chunk_us=7 * MIN).collect()), key=str)
    assert len(plain) == 200 and plain == waves
    assert cu.route_frames(df.where("us < 0"), p, chunk_us=MIN).collect() == []
