"""Streams that arrive out of order are routed as the sorted batch is."""

import random
import uuid

import pytest

from framecurate.operators.state_machine import FilterParams
from framecurate.plans import curate as cu
from framecurate.streaming.ordered import route_ordered

S = 1_000_000
ROWS = "camera_id string, frame_id long, us long, has_cats boolean, control string, hist array<double>"
P = FilterParams(similarity=0.15, min_us=2 * S, max_us=30 * S, background_us=20 * S)


def frames(seed, n=60, cams=("a", "b")):
    rng = random.Random(seed)
    out = []
    for cam in cams:
        us = 0
        for i in range(n):
            us += rng.randint(1, 4) * S
            cats = rng.random() < 0.6
            out.append((cam, i, us, cats, None, [rng.random() for _ in range(8)] if cats else None))
    return out


def drain(spark, tmp_path, batches, controls=(), **more):
    """Runs one micro-batch a list of rows and returns {(camera, frame): (kind, manual)}."""
    land, told = str(tmp_path / "frames"), str(tmp_path / "controls")
    end = max(r[2] for b in batches for r in b) + 1000 * S
    tail = [[("~", -1, end, None, None, None)], [("~", -2, end + S, None, None, None)], [("~", -3, end + 2 * S, None, None, None)]]
    for k, rows in enumerate([*batches, *tail]):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{land}/b{k:02d}")
    src = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(land)
    ctl = None
    if controls:
        spark.createDataFrame(list(controls), "camera_id string, us long, control string").coalesce(1).write.parquet(told)
        ctl = spark.readStream.schema("camera_id string, us long, control string").parquet(told)
    name = f"ordered_{uuid.uuid4().hex}"
    q = route_ordered(src, ctl, P, **more).writeStream.format("memory").queryName(name).outputMode("append") \
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    assert q.awaitTermination(150)
    return {(r.camera_id, r.frame_id): (r.kind, r.manual_save) for r in spark.table(name).collect() if r.camera_id != "~"}


def batch(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    return {(r.camera_id, r.frame_id): (r.kind, r.manual_save) for r in cu.route_frames(df, P).collect()}


def shuffled(rows, seed, size):
    """Rows in batches, up to 8 seconds out of order."""
    rng = random.Random(seed)
    late = sorted(rows, key=lambda r: r[2] + rng.randint(0, 8) * S)
    return [late[i:i + size] for i in range(0, len(late), size)]


def test_shuffled_arrival_equals_sorted_batch(spark, tmp_path):
    rows = frames(1)
    assert drain(spark, tmp_path, shuffled(rows, 2, 30)) == batch(spark, rows)


def test_controls_as_a_second_stream(spark, tmp_path):
    rows = frames(3, cams=("a",))
    controls, told = [], {}
    for i, control in ((10, "reset"), (20, "manual_background"), (35, "reset"), (41, "manual_background")):
        controls.append(("a", rows[i][2], control))
        told[i] = control
    want = batch(spark, [(*r[:4], told.get(r[1]), r[5]) for r in rows])
    assert drain(spark, tmp_path, shuffled(rows, 4, 30), controls, lateness="1000 seconds") == want


def test_late_rows_and_carried_state(spark, tmp_path):
    rows = frames(5, n=40, cams=("a",))
    late = ("a", 999, 1 * S, False, None, None)
    got = drain(spark, tmp_path, [rows[:20], rows[20:30], [*rows[30:], late]], lateness="0 seconds")
    assert ("a", 999) not in got and got == batch(spark, rows)


def test_state_goes_after_silence(spark, tmp_path):
    """After `idle` the camera starts anew: its next frame is saved at once."""
    h = [0.1] * 8
    rows = [("a", 1, 100 * S, True, None, h), ("a", 2, 101 * S, True, None, h)]
    again = [("a", 3, 120 * S, True, None, h)]
    other = [[("b", k, t * S, None, None, None)] for k, t in enumerate((110, 112, 114))]
    kept = drain(spark, tmp_path / "kept", [rows, *other, again], lateness="0 seconds")
    gone = drain(spark, tmp_path / "gone", [rows, *other, again], lateness="0 seconds", idle_us=5 * S)
    assert kept[("a", 3)][0] == "dropped" and gone[("a", 3)][0] == "cats"


def test_batch_then_stream_equals_one_batch(spark, tmp_path):
    rows = frames(7, n=50, cams=("a",))
    first = {k: v for k, v in batch(spark, rows).items() if k[1] < 25}
    cats = [r for r in rows[:25] if first[("a", r[1])][0] == "cats"][-1]
    bg = [r for r in rows[:25] if first[("a", r[1])][0] == "background"]
    state = spark.createDataFrame([("a", cats[2], cats[5], cats[1], bg[-1][2] if bg else None, rows[24][2])],
                                  "camera_id string, last_cat_us long, last_cat_hist array<double>, last_cat_fid long, "
                                  "last_bg_us long, last_seen_us long")
    got = drain(spark, tmp_path, [rows[25:]], initial=state)
    assert {**first, **got} == batch(spark, rows)
