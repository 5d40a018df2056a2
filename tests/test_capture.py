"""Capture curation: histograms, variety filter, background throttle, routing, stats,
and the streaming form (drained stream = batch)."""

import datetime as dt
import uuid

import numpy as np
from pyspark.sql import functions as F

from frames import image_row, make_frame, make_random_frame
from framecurate.operators.histogram import bhattacharyya as bh_col
from framecurate.operators.state_machine import FilterParams, bhattacharyya
from framecurate.plans import curate as cu
from framecurate.streaming import capture as st

S = 1_000_000


def _hists(spark, frames):
    rows = [(i, image_row(f)) for i, f in enumerate(frames)]
    df = spark.createDataFrame(rows, "frame_id long, image struct<origin:string,height:int,width:int,"
                                     "nChannels:int,mode:int,data:binary>")
    h = {r.frame_id: np.array(r.hist) for r in cu.frame_histograms(df).collect()}
    return [h[i] for i in range(len(frames))]


def _route(spark, timeline, params):
    """timeline: (us, has_cats, control, hist)"""
    rows = [("cam", i, us, hc, ctl, None if h is None else [float(x) for x in h])
            for i, (us, hc, ctl, h) in enumerate(timeline)]
    df = spark.createDataFrame(rows, "camera_id string, frame_id long, us long, has_cats boolean, "
                                     "control string, hist array<double>")
    out = cu.route_frames(df, params).orderBy("frame_id").collect()
    return [r.kind for r in out], [r.manual_save for r in out]


def test_histogram_shape_and_distance(spark):
    a, b, g = _hists(spark, [make_frame(color=(200, 50, 50)), make_frame(color=(50, 50, 200)),
                             make_frame(color=(100, 100, 100))])
    assert a.shape == (128,) and a.max() == 1.0
    assert bhattacharyya(a, a) == 0.0
    assert bhattacharyya(a, b) > 0.05
    assert g[0] == 1.0                      # grey: hue 0, saturation 0 → bin 0


def test_distance_column_equals_python(spark):
    rng = np.random.default_rng(1)
    a, b = rng.random(128), rng.random(128)
    df = spark.createDataFrame([([float(x) for x in a], [float(x) for x in b])], "a array<double>, b array<double>")
    assert df.select(bh_col("a", "b").alias("d")).first().d == bhattacharyya(a, b)


def test_hsv_reciprocals_without_decimals(spark):
    """Table entries of every denominator, half up, and no rounding by decimal numbers, which cost most of a pixel."""
    from framecurate.operators.histogram import _recip, bgr_to_hsv
    df = spark.range(0, 1531).select("id", _recip(255, F.col("id")).alias("s"), _recip(180, F.col("id")).alias("h"))
    for r in df.collect():
        assert (r.s, r.h) == tuple((2 * (n << 12) + r.id) // (2 * r.id) if r.id else 0 for n in (255, 180))
    px = spark.range(1).select(F.col("id").cast("int").alias("b"), F.lit(1).alias("g"), F.lit(2).alias("r"))
    assert "round(" not in px.select(bgr_to_hsv("b", "g", "r").alias("v"))._jdf.queryExecution().analyzed().toString()


def test_variety_filter_timelines(spark):
    A, B, G = _hists(spark, [make_frame(color=(200, 50, 50)), make_frame(color=(50, 50, 200)),
                             make_frame(color=(100, 100, 100))])
    p = FilterParams(similarity=0.1, min_us=0, max_us=9999 * S)
    assert _route(spark, [(0, True, None, G), (1, True, None, G)], p)[0] == ["cats", "dropped"]
    p = FilterParams(similarity=0.05, min_us=0, max_us=9999 * S)
    assert _route(spark, [(0, True, None, A), (1, True, None, B)], p)[0] == ["cats", "cats"]
    p = FilterParams(similarity=0.0, min_us=60 * S, max_us=9999 * S)
    assert _route(spark, [(0, True, None, A), (1, True, None, B)], p)[0] == ["cats", "dropped"]
    p = FilterParams(similarity=0.99, min_us=0, max_us=5 * S)
    assert _route(spark, [(0, True, None, G), (6 * S, True, None, G)], p)[0] == ["cats", "cats"]
    p = FilterParams(similarity=0.01, min_us=0, max_us=9999 * S)
    assert _route(spark, [(0, True, None, A), (1, None, "reset", None), (2, True, None, A)], p)[0] == \
        ["cats", None, "cats"]


def test_random_frames(spark):
    r0, r42, r7 = _hists(spark, [make_random_frame(seed=0), make_random_frame(seed=42), make_random_frame(seed=7)])
    p = FilterParams(similarity=0.05, min_us=0, max_us=9999 * S)
    assert _route(spark, [(0, True, None, r0), (1, True, None, r42)], p)[0] == ["cats", "cats"]
    p = FilterParams(similarity=0.1, min_us=0, max_us=9999 * S)
    assert _route(spark, [(0, True, None, r7), (1, True, None, r7)], p)[0] == ["cats", "dropped"]


def test_background_throttle_and_controls(spark):
    p = FilterParams(background_us=60 * S, min_us=0)
    assert _route(spark, [(0, False, None, None), (1, False, None, None)], p)[0] == ["background", "dropped"]
    assert _route(spark, [(0, False, None, None), (61 * S, False, None, None)], p)[0] == ["background", "background"]
    kinds, manual = _route(spark, [(0, False, None, None), (61 * S, None, "manual_background", None),
                                   (61 * S, False, None, None)], p)
    assert kinds == ["background", None, "dropped"] and manual == [False, True, False]
    # cat filter and background timer are independent
    h = [1.0] + [0.0] * 127
    assert _route(spark, [(0, True, None, h), (0, False, None, None)], p)[0] == ["cats", "background"]
    # reset clears the background timer
    assert _route(spark, [(0, False, None, None), (1, False, "reset", None)], p)[0] == ["background", "background"]


def test_routing_and_session_stats(spark):
    h1 = [1.0] + [0.0] * 127
    h2 = [0.0] * 127 + [1.0]
    rows = [("c1", 1, 0, True, None, h1), ("c1", 2, 1 * S, True, None, h1), ("c1", 3, 2 * S, True, None, h2),
            ("c1", 4, 3 * S, False, None, None), ("c1", 5, 4 * S, False, "manual_background", None),
            ("c2", 6, 0, False, None, None)]
    df = spark.createDataFrame(rows, "camera_id string, frame_id long, us long, has_cats boolean, "
                                     "control string, hist array<double>")
    p = FilterParams(similarity=0.5, min_us=0, max_us=100 * S, background_us=60 * S)
    routed = cu.route_frames(df, p)
    kinds = {r.frame_id: r.kind for r in routed.collect()}
    assert kinds == {1: "cats", 2: "dropped", 3: "cats", 4: "background", 5: "dropped", 6: "background"}
    stats = {r.camera_id: tuple(r)[1:] for r in cu.session_stats(routed).collect()}
    assert stats["c1"] == (5, 3, 2, 1) and stats["c2"] == (1, 0, 0, 1)


def test_latest_frame(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("c", i, t0 + dt.timedelta(seconds=s)) for i, s in enumerate([1, 30, 59, 61, 62])]
    df = spark.createDataFrame(rows, "camera_id string, frame_id long, ts timestamp")
    got = sorted(r.frame_id for r in cu.latest_frame(df, "1 minute").collect())
    assert got == [2, 4]
    got = [r.frame_id for r in st.conflate_latest(df).collect()]
    assert got == [4]


def test_stream_drain_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = []
    for cam in ("a", "b", "c"):
        for i in range(40):
            us = i * 7 * S
            hc = bool(rng.random() < 0.7)
            ctl = "manual_background" if rng.random() < 0.1 else None
            h = [float(x) for x in rng.random(16)] if hc else None
            rows.append((cam, len(rows), us, hc, ctl, h))
    schema = "camera_id string, frame_id long, us long, has_cats boolean, control string, hist array<double>"
    df = spark.createDataFrame(rows, schema)
    p = FilterParams(similarity=0.2, min_us=10 * S, max_us=60 * S, background_us=30 * S)
    batch = {r.frame_id: r.kind for r in cu.route_frames(df, p).collect()}
    land = str(tmp_path / "landing")
    # two files, the second strictly later in time: two micro-batches in order
    df.where("us < 140000000").coalesce(1).write.parquet(land + "/part1")
    df.where("us >= 140000000").coalesce(1).write.parquet(land + "/part2")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", True).parquet(land)
    routed = st.route_stream(src, p)
    q = routed.writeStream.format("memory").queryName("routed_drain").outputMode("append") \
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    stream = {r.frame_id: r.kind for r in spark.table("routed_drain").collect()}
    assert stream == batch


def test_stream_of_many_cameras_shares_keys(spark, tmp_path):
    """Cameras, a NULL one among them, share keyed states by groups; each keeps its
    own state from one micro-batch to the next, resets and late rows included."""
    rng = np.random.default_rng(5)
    cams = [None, *map(str, range(60))]
    rows = [(cams[int(rng.integers(61))], i, int(rng.integers(1, 400)) * S, [True, False, None][int(rng.integers(3))],
             [None, None, None, "reset", "manual_background"][int(rng.integers(5))],
             None if rng.random() < 0.2 else [float(x) for x in rng.random(int(rng.choice([0, 8, 8, 8])))]) for i in range(1500)]
    schema = "camera_id string, frame_id long, us long, has_cats boolean, control string, hist array<double>"
    df = spark.createDataFrame(rows, schema)
    p = FilterParams(similarity=0.2, min_us=10 * S, max_us=60 * S, background_us=30 * S)
    want = {r.frame_id: (r.camera_id, r.kind, r.manual_save) for r in cu.route_frames(df, p).collect()}
    late = spark.createDataFrame([(cams[1], 9001, 0, True, None, None), (None, 9002, 0, False, "manual_background", None)], schema)
    want |= {9001: (cams[1], "dropped_late", False), 9002: (None, "dropped_late", True)}
    land, out = str(tmp_path / "landing"), str(tmp_path / "out")
    for part in (df.where("us < 200000000"), df.where("us >= 200000000"), late):
        part.coalesce(1).write.mode("append").parquet(land)
        q = st.route_stream(spark.readStream.schema(schema).parquet(land), p, buckets=5).writeStream.format("parquet") \
            .option("path", out).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
        q.awaitTermination(180)
        keys = max(s["numRowsTotal"] for x in q.recentProgress for s in x["stateOperators"])
        assert 1 < keys <= 5
    assert {r.frame_id: (r.camera_id, r.kind, r.manual_save) for r in spark.read.parquet(out).collect()} == want


def test_waves_equal_single_pass(spark, tmp_path):
    """Histories routed in time chunks with carried state, a NULL camera among
    them; decisions must equal the single-pass fold exactly."""
    rng = np.random.default_rng(11)
    rows, day = [], 86_400 * S
    for cam, n, gap in (("hot", 300, 6 * 3600), ("hot2", 200, 2 * 3600), (None, 40, 6 * 3600)):
        us = int(rng.integers(0, 30 * 86_400)) * S
        for i in range(n):
            # "hot" has a burst: 100 frames one second apart in the middle
            us += (1 if cam == "hot" and 100 <= i < 200 else int(rng.integers(1, gap))) * S
            hc = bool(rng.random() < 0.6)
            ctl = ("manual_background" if rng.random() < 0.08 else ("reset" if rng.random() < 0.03 else None))
            rows.append((cam, len(rows), us, hc, ctl, [float(x) for x in rng.random(16)] if hc else None))
    schema = "camera_id string, frame_id long, us long, has_cats boolean, control string, hist array<double>"
    df = spark.createDataFrame(rows, schema)
    p = FilterParams(similarity=0.15, min_us=2 * 3600 * S, max_us=30 * 3600 * S, background_us=20 * 3600 * S)
    single = {r.frame_id: (r.kind, r.manual_save) for r in cu.route_frames(df, p).collect()}
    for span in (7 * day, day // 3):
        waves = {r.frame_id: (r.kind, r.manual_save) for r in cu.route_frames(df, p, chunk_us=span).collect()}
        assert waves == single
    assert len(single) == 540


def test_curate_composition(spark, tmp_path):
    """Detection → filters → histograms → routing on real frame bytes;
    the model sees every frame exactly once."""
    t0 = dt.datetime(2024, 1, 1)
    frames = [("cam", 0, t0, make_frame(color=(200, 50, 50))),
              ("cam", 1, t0 + dt.timedelta(seconds=1), make_frame(color=(200, 50, 50))),
              ("cam", 2, t0 + dt.timedelta(seconds=3), make_frame(color=(50, 50, 200))),
              ("cam", 3, t0 + dt.timedelta(seconds=4), make_frame(color=(0, 0, 0)))]
    df = spark.createDataFrame([(c, i, t, image_row(a)) for c, i, t, a in frames],
                               "camera_id string, frame_id long, ts timestamp, image struct<origin:string,"
                               "height:int,width:int,nChannels:int,mode:int,data:binary>")

    log = str(tmp_path / "calls.log")

    def make():
        def predict(imgs):
            with open(log, "a") as fh:
                fh.write("x\n" * len(imgs))
            # a "cat" wherever the frame is not black
            return [np.array([[10, 10, 200, 200, 0.9, 15]]) if img.max() > 0 else np.zeros((0, 6)) for img in imgs]
        return predict

    p = FilterParams(similarity=0.15, min_us=0, max_us=30 * S, background_us=60 * S)
    rows = cu.curate(df, make, p).collect()
    assert {r.frame_id: r.kind for r in rows} == {0: "cats", 2: "cats", 3: "background"}
    assert all(r.image is not None for r in rows)
    assert open(log).read().count("x") == 4


def test_streaming_latest_frame_and_incremental_queue(spark, tmp_path):
    """T1 conflation and T7 skip-already-labeled, each drained with availableNow."""
    t0 = dt.datetime(2024, 1, 1)
    frames = spark.createDataFrame([("c1", 1, t0), ("c1", 2, t0 + dt.timedelta(seconds=1)),
                                    ("c2", 3, t0), ("c1", 4, t0 + dt.timedelta(seconds=2))],
                                   "camera_id string, frame_id long, ts timestamp")
    land = str(tmp_path / "frames")
    frames.coalesce(1).write.parquet(land)
    got = []
    src = spark.readStream.schema(frames.schema).parquet(land)
    q = st.start_latest_frame(src, lambda df, bid: got.extend(r.frame_id for r in df.collect()),
                              f"t1_test_{uuid.uuid4().hex}", trigger={"availableNow": True})
    q.awaitTermination(120)
    assert sorted(got) == [3, 4]

    caps = spark.createDataFrame([("a.jpg",), ("b.jpg",), ("c.jpg",)], "filename string")
    cl = str(tmp_path / "caps")
    caps.coalesce(1).write.parquet(cl)
    labeled = spark.createDataFrame([("b.jpg",)], "filename string")
    queued = []
    q = st.start_incremental_queue(spark.readStream.schema(caps.schema).parquet(cl), lambda: labeled,
                                   lambda df, bid: queued.extend(r.filename for r in df.collect()),
                                   f"t7_test_{uuid.uuid4().hex}")
    q.awaitTermination(120)
    assert sorted(queued) == ["a.jpg", "c.jpg"]


def test_running_session_stats_stream(spark, tmp_path):
    """Incremental counters equal the batch A1 numbers once drained."""
    rows = [("c", i, i * S, i % 3 != 0, None, [1.0, 0.0] if i % 3 else None) for i in range(30)]
    schema = "camera_id string, frame_id long, us long, has_cats boolean, control string, hist array<double>"
    df = spark.createDataFrame(rows, schema)
    p = FilterParams(similarity=0.5, min_us=3 * S, max_us=6 * S, background_us=5 * S)
    batch = cu.session_stats(cu.route_frames(df, p)).first()
    land = str(tmp_path / "rows")
    df.coalesce(1).write.parquet(land)
    stats = st.running_session_stats(st.route_stream(spark.readStream.schema(schema).parquet(land), p))
    q = stats.writeStream.format("memory").queryName("t6_stats").outputMode("complete") \
        .option("checkpointLocation", str(tmp_path / "ck6")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    got = spark.table("t6_stats").first()
    assert tuple(got) == tuple(batch)


def test_stream_late_rows_dropped(spark, tmp_path):
    """Documented policy: a row older than its camera's last-seen time in an
    earlier micro-batch is routed to dropped_late (the reference has no clock skew)."""
    schema = "camera_id string, frame_id long, us long, has_cats boolean, control string, hist array<double>"
    land = str(tmp_path / "late")
    spark.createDataFrame([("c", 1, 10 * S, False, None, None), ("c", 2, 100 * S, False, None, None)], schema) \
        .coalesce(1).write.parquet(land + "/b1")
    spark.createDataFrame([("c", 3, 50 * S, False, None, None), ("c", 4, 200 * S, False, None, None)], schema) \
        .coalesce(1).write.parquet(land + "/b2")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True) \
        .parquet(land)
    name = f"late_{uuid.uuid4().hex}"
    q = st.route_stream(src, FilterParams(background_us=60 * S)).writeStream.format("memory").queryName(name) \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    kinds = {r.frame_id: r.kind for r in spark.table(name).collect()}
    assert kinds == {1: "background", 2: "background", 3: "dropped_late", 4: "background"}


def test_curate_with_shared_frame_numbers_and_bad_frames(spark, tmp_path):
    """Frame numbers are a camera's own; null and undecodable frames become
    warnings; saved frames alone are preprocessed twice; one model a worker."""
    from framecurate.sources.images import bad_frames
    t0 = dt.datetime(2024, 1, 1)
    log, loads = str(tmp_path / "seen.log"), str(tmp_path / "loads.log")
    rows = []
    for cam in ("a", "b", None):
        for i in range(8):
            color = (200, 50, 50) if i % 4 < 3 else (50, 50, 200 if cam == "a" else 120)
            rows.append((cam, i, t0 + dt.timedelta(seconds=i), image_row(make_frame(60, 80, color))))
    rows.append(("a", 90, t0, None))
    rows.append(("b", 91, t0, {"origin": "x", "height": -1, "width": -1, "nChannels": -1, "mode": -1, "data": b""}))
    df = spark.createDataFrame(rows, "camera_id string, frame_id long, ts timestamp, image struct<origin:string,"
                                     "height:int,width:int,nChannels:int,mode:int,data:binary>").repartition(6)

    def make():
        import os
        with open(loads, "a") as fh:
            fh.write(f"{os.getpid()}\n")
        return lambda imgs: [np.array([[1, 1, 50, 50, 0.9, 15]]) for _ in imgs]

    def preprocess(frames):
        def run(batches):
            for pdf in batches:
                with open(log, "a") as fh:
                    fh.write("x\n" * len(pdf))
                yield pdf
        return frames.mapInPandas(run, frames.schema)

    p = FilterParams(similarity=0.15, min_us=0, max_us=900 * S)
    got = cu.curate(df, make, p, preprocess=preprocess).collect()
    saved = sorted((str(r.camera_id), r.frame_id) for r in got)
    assert saved == [(c, i) for c in ("None", "a", "b") for i in (0, 3, 4, 7)]
    assert all(r.image.width == 80 for r in got)
    assert open(log).read().count("x") == 24 + 12
    pids = open(loads).read().split()
    assert len(pids) == len(set(pids))
    assert sorted((r.frame_id, r.reason) for r in bad_frames(df).collect()) == [
        (90, "no frame"), (91, "cannot be decoded")]


def test_latest_frame_with_images(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(c, i, t0 + dt.timedelta(seconds=20 * i), image_row(make_frame(4, 4, (i, i, i))))
            for c in ("a", None) for i in range(5)]
    df = spark.createDataFrame(rows, "camera_id string, frame_id long, ts timestamp, image struct<origin:string,"
                                     "height:int,width:int,nChannels:int,mode:int,data:binary>")
    got = cu.latest_frame(df).collect()
    assert sorted((str(r.camera_id), r.frame_id, r.image.data[0]) for r in got) == [
        ("None", 2, 2), ("None", 4, 4), ("a", 2, 2), ("a", 4, 4)]


def test_incremental_queue_classifies(spark, tmp_path):
    schema = "full_frame string, detections array<struct<class_id:int,bbox:array<int>,confidence:double>>"
    spark.createDataFrame([("/r/a.jpg", []), ("/r/b.jpg", []), ("/r/c.jpg", [])], schema).write.parquet(str(tmp_path / "in"))
    inv = spark.createDataFrame([("/r/a.jpg", 9, 9), ("/r/b.jpg", 9, 9)], "path string, width int, height int")
    lab = spark.createDataFrame([("b.jpg",)], "filename string")
    seen, sums = [], []
    q = st.start_incremental_queue(
        spark.readStream.schema(schema).parquet(str(tmp_path / "in")), lambda: lab,
        lambda d, i: seen.extend((r.full_frame, r.outcome) for r in d.collect()), f"q-{uuid.uuid4().hex}",
        inventory=lambda: inv, document_root="/r", on_summary=lambda d, i: sums.append(tuple(d.first())))
    q.awaitTermination(120)
    assert sorted(seen) == [("/r/a.jpg", "exported"), ("/r/b.jpg", "skipped"), ("/r/c.jpg", "error")]
    assert sums == [(1, 1, 1)]
