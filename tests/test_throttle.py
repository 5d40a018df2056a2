"""The throttle by pointer jumping equals the fold."""

import random

import pytest

from framecurate.operators.state_machine import FilterParams
from framecurate.operators.throttle import background_throttle
from framecurate.plans import curate as cu

S = 1_000_000
ROWS = "camera_id string, frame_id long, us long, has_cats boolean, control string, hist array<double>"


@pytest.mark.parametrize("seed, interval", [(1, 20), (2, 3), (3, 500)])
def test_equals_the_fold(spark, seed, interval):
    rng, rows = random.Random(seed), []
    for cam in ("a", "b", None, "quiet"):
        us = rng.randint(-50, 50) * S
        for i in range(200 if cam != "quiet" else 5):
            us += rng.choice((0, 1, 1, 2, 5, 40, 4000) if cam == "b" else (0, 1, 1, 2)) * S
            cats = rng.choice((True, False, False, False, None))
            rows.append((cam, i, us, cats, rng.choice((None,) * 12 + ("reset", "manual_background", "other")), None))
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    want = {(r.camera_id, r.frame_id): (None if r.has_cats is not False else r.kind == "background", r.manual_save)
            for r in cu.route_frames(df, FilterParams(background_us=interval * S)).collect()}
    got = {(r.camera_id, r.frame_id): (r.kept, r.manual_save) for r in background_throttle(df, interval * S).collect()}
    assert got == want


def test_empty_and_bad_interval(spark):
    none = spark.createDataFrame([], ROWS)
    assert background_throttle(none).collect() == []
    with pytest.raises(ValueError):
        background_throttle(none, 0)
