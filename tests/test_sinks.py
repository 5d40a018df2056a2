"""Sinks: captures, crops, metadata, annotation import, merged tasks, split table."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from frames import image_row, make_frame
from framecurate.plans import merge as mg
from framecurate.plans import splitting as sp
from framecurate.sinks import writers as wr
from framecurate.sources.annotations import parse_task_files
from framecurate.sources.captures import read_capture_meta, write_capture_meta

IMG = "struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
DETS = "array<struct<bbox:struct<x1:int,y1:int,x2:int,y2:int>,confidence:double,class_id:int>>"


def _captures(spark):
    t = dt.datetime(2026, 3, 15, 21, 2, 4, 123000)
    dets = [((50, 60, 300, 400), 0.91234, 15), ((10, 10, 20, 20), 0.5, 15), ((300, 200, 600, 450), 0.75, 0)]
    rows = [("cam", 1, t, "cats", image_row(make_frame()), dets),
            ("cam", 2, t, "background", image_row(make_frame()), [])]
    return spark.createDataFrame(rows, f"camera_id string, frame_id long, ts timestamp, kind string, image {IMG}, "
                                       f"detections {DETS}")


def test_crops_and_captures(spark, tmp_path):
    caps = _captures(spark)
    crops = {r.crop_name: r for r in wr.crops(caps).collect()}
    assert sorted(crops) == ["cam_20260315_210204_123_3cats_crop_0", "cam_20260315_210204_123_3cats_crop_2"]
    c0 = crops["cam_20260315_210204_123_3cats_crop_0"]
    assert (c0.width, c0.height) == (250, 340) and len(c0.data) == 250 * 340 * 3
    wr.write_captures(caps, str(tmp_path / "captures"))
    back = spark.read.parquet(str(tmp_path / "captures"))
    assert sorted(r.kind for r in back.collect()) == ["background", "cats"]
    assert {r.stem for r in back.collect()} == {"cam_20260315_210204_123_3cats", "cam_20260315_210204_123_background"}


def test_capture_meta_roundtrip(spark, tmp_path):
    caps = _captures(spark).withColumn("full_frame", F.lit("/data/raw/x.jpg")) \
                           .withColumn("crops", F.array().cast("array<string>"))
    out = str(tmp_path / "meta")
    write_capture_meta(caps, out)
    # a document as a single capture writes it stands beside the shards
    with open(os.path.join(out, "one_meta.json"), "w") as f:
        json.dump({"timestamp": "t", "cat_count": 9, "full_frame": "/data/raw/y.jpg"}, f, indent=2)
    back = {r.cat_count: r for r in read_capture_meta(spark, out).collect()}
    assert back[3].timestamp == "2026-03-15T21:02:04.123000"
    assert back[3].detections[0].confidence == 0.9123 and list(back[3].detections[0].bbox) == [50, 60, 300, 400]
    assert back[0].detections == [] and back[0].crops == []
    assert back[9].full_frame == "/data/raw/y.jpg" and back[9].detections == []
    for _ in range(2):                       # a retried batch replaces itself
        write_capture_meta(caps, str(tmp_path / "batches"), batch_id=7)
    assert read_capture_meta(spark, str(tmp_path / "batches")).count() == 2


def test_capture_switches(spark, tmp_path):
    caps = _captures(spark)
    wr.write_crops(caps, str(tmp_path / "off"), save_crops=False)
    assert not os.path.exists(tmp_path / "off")
    for _ in range(2):
        wr.write_crops(caps, str(tmp_path / "crops"), batch_id="a")
        wr.write_captures(caps, str(tmp_path / "captures"), batch_id="a")
    assert spark.read.parquet(str(tmp_path / "crops")).count() == 2
    assert spark.read.parquet(str(tmp_path / "captures")).count() == 2
    bare = caps.where("kind = 'cats'").withColumn("detections", F.array().cast(DETS))
    wr.write_captures(bare, str(tmp_path / "bare"))          # cats without boxes are not saved
    assert spark.read.schema(caps.schema).parquet(str(tmp_path / "bare")).count() == 0


def test_annotation_import_and_merged(spark, tmp_path):
    empty = spark.createDataFrame([], "task_json string")
    assert wr.write_annotation_import(empty, str(tmp_path / "none")) is False
    assert not os.path.exists(tmp_path / "none")
    files = spark.createDataFrame([("a.json", json.dumps([{"data": {"image": "/x/1.jpg"}, "id": 1},
                                                           {"data": {"image": "/x/2.jpg"}, "id": 2}])),
                                   ("b.json", json.dumps([{"data": {"image": "/y/1.jpg"}, "id": 3}]))],
                                  "file string, text string")
    merged = mg.merge_dedup_first(parse_task_files(files))
    assert wr.write_merged_tasks(merged, str(tmp_path / "merged")) is True
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "merged")).collect()]
    assert sorted(t["id"] for t in lines) == [1, 2]


def test_write_split_overwrites(spark, tmp_path):
    df = spark.createDataFrame([(f"s{i}",) for i in range(10)], "stem string")
    out = str(tmp_path / "split")
    sp.write_split(sp.seeded_split(df, (0.8, 0.1, 0.1), 1), out)
    sp.write_split(sp.seeded_split(df, (0.8, 0.1, 0.1), 2), out)
    assert spark.read.parquet(out).count() == 10
