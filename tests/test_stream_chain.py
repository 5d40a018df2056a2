"""The capture loop on a stream gives the batch's tables, failures included."""

import datetime as dt
import uuid

import pytest
from frames import image_row, make_frame

from framecurate.operators.state_machine import FilterParams
from framecurate.plans import curate as cu
from framecurate.streaming import capture as st
from framecurate.streaming import chain

S = 1_000_000
SCHEMA = ("camera_id string, frame_id long, ts timestamp, image struct<origin:string,height:int,width:int,nChannels:int,"
          "mode:int,data:binary>, control string")
P = FilterParams(similarity=0.15, min_us=2 * S, max_us=30 * S, background_us=20 * S)


def model():
    """A cat wherever the frame is not black; nested, so that workers get it by value."""
    def make():
        def predict(imgs):
            import numpy
            return [numpy.array([[10, 10, 50, 50, 0.9, 15]]) if img.max() > 0 else numpy.zeros((0, 6)) for img in imgs]
        return predict
    return make


make = model()


def rows():
    t0, out = dt.datetime(2024, 1, 1), []
    for c, cam in enumerate(("a", "b", None)):
        for i in range(24):
            color = (0, 0, 0) if (i + c) % 5 == 4 else ((200, 50, 50), (50, 50, 200), (60, 220, 60))[(i // 3 + c) % 3]
            control = {7: "reset", 13: "manual_background"}.get(i)
            out.append((cam, i, t0 + dt.timedelta(seconds=i), image_row(make_frame(40, 50, color)), control))
    return out


def table(df):
    return sorted((r.camera_id or "", r.frame_id, r.kind, r.manual_save, bytes(r.image.data)) for r in df.collect())


@pytest.mark.parametrize("fail_after", [None, ("saved", 1), ("routed", 2), ("state", 0)])
def test_stream_equals_batch_after_a_failure(spark, tmp_path, fail_after):
    land, base, name = str(tmp_path / "in"), str(tmp_path / "out"), f"chain_{uuid.uuid4().hex}"
    every = rows()
    for k in range(3):
        spark.createDataFrame([r for r in every if r[1] // 8 == k], SCHEMA).coalesce(1).write.parquet(f"{land}/b{k}")
    failed = []

    def after(folder, batch_id):
        if (folder, batch_id) == fail_after and not failed:
            failed.append(1)
            raise RuntimeError("killed")

    def run():
        src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(land)
        q = chain.start_curate(src, make, base, name, P, after=after)
        q.awaitTermination(150)
    if fail_after:
        with pytest.raises(Exception, match="killed"):
            run()
    run()
    whole = spark.createDataFrame(every, SCHEMA)
    assert table(spark.read.parquet(f"{base}/saved")) == table(cu.curate(whole, make, P))
    staged = cu.detected(whole, make)[1]
    routed = cu.route_frames(cu.routing_rows(staged), P)
    plain = lambda df: sorted(map(str, df.select("camera_id", "frame_id", "kind", "manual_save").collect()))
    assert plain(spark.read.parquet(f"{base}/routed")) == plain(routed)
    stats = lambda df: sorted(map(str, df.collect()))
    assert stats(chain.running_stats(spark, base)) == stats(cu.session_stats(routed).select("camera_id", *chain.COUNTERS))


def test_late_rows_and_no_state(spark, tmp_path):
    base, every = str(tmp_path / "out"), [r for r in rows() if r[0] == "a"]
    assert chain.running_stats(spark, base).count() == 0
    chain.curate_batch(spark.createDataFrame(every[10:], SCHEMA), 0, base, make, P)
    chain.curate_batch(spark.createDataFrame(every[:2], SCHEMA), 1, base, make, P)
    kinds = {r.frame_id: r.kind for r in spark.read.parquet(f"{base}/routed/batch=1").collect()}
    assert kinds == {0: "dropped_late", 1: "dropped_late"}
    assert spark.read.parquet(f"{base}/saved/batch=1").count() == 0


def test_a_name_is_queued_once(spark, tmp_path):
    land, names, name = str(tmp_path / "in"), str(tmp_path / "names"), f"queue_{uuid.uuid4().hex}"
    schema = "filename string, n int"
    for k, files in enumerate((["a", "b"], ["b", "c"], ["a", "c", "d", "done"])):
        spark.createDataFrame([(f, k) for f in files], schema).coalesce(1).write.parquet(f"{land}/b{k}")
    got, fail = {}, [True]

    def sink(df, batch_id):
        got[batch_id] = sorted(r.filename for r in df.collect())
        if batch_id == 1 and fail:
            fail.clear()
            raise RuntimeError("killed")

    def run():
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(land)
        labeled = lambda: spark.createDataFrame([("done",)], "filename string")
        st.start_incremental_queue(src, labeled, sink, name, names=names).awaitTermination(100)
    with pytest.raises(Exception, match="killed"):
        run()
    run()
    assert got == {0: ["a", "b"], 1: ["c"], 2: ["d"]}
