"""Column functions: boxes, naming, classes, label text (reference expectations)."""

import datetime as dt

from pyspark.sql import functions as F

from framecurate.functions import boxes as bx
from framecurate.functions import classes as cl
from framecurate.functions import labels as lb
from framecurate.functions import naming as nm


def _box_df(spark, boxes):
    return spark.createDataFrame([((x1, y1, x2, y2),) for x1, y1, x2, y2 in boxes],
                                 "bbox struct<x1:int,y1:int,x2:int,y2:int>")


def test_box_area_and_degenerate(spark):
    rows = _box_df(spark, [(10, 20, 110, 170), (50, 50, 50, 50), (5, 5, 1, 1)]) \
        .select(bx.box_area("bbox").alias("a")).collect()
    assert [r.a for r in rows] == [15000, 0, 0]


def test_box_center_floors(spark):
    rows = _box_df(spark, [(0, 0, 100, 200), (-3, -3, 0, 0)]).select(bx.box_center("bbox").alias("c")).collect()
    assert (rows[0].c.cx, rows[0].c.cy) == (50, 100)
    assert (rows[1].c.cx, rows[1].c.cy) == (-2, -2)          # Python // floors


def test_int_box_truncates_and_round_conf(spark):
    df = spark.createDataFrame([(10.9, -2.7, 100.2, 50.99, 0.123456)], "a double, b double, c double, d double, e double")
    r = df.select(bx.to_int_box("a", "b", "c", "d").alias("b"), bx.round_confidence("e").alias("e")).first()
    assert (r.b.x1, r.b.y1, r.b.x2, r.b.y2) == (10, -2, 100, 50)
    assert r.e == 0.1235


def test_clamp_and_crop_eligibility(spark):
    df = _box_df(spark, [(50, 60, 300, 400), (-10, -10, 700, 500), (10, 10, 20, 20)])
    r = df.select(bx.clamp_box("bbox", F.lit(640), F.lit(480)).alias("c")) \
          .select("c", bx.crop_eligible("c").alias("ok")).collect()
    assert tuple(r[1].c) == (0, 0, 640, 480)
    assert [x.ok for x in r] == [True, True, False]


def test_box_to_percent(spark):
    df = _box_df(spark, [(192, 108, 384, 216), (0, 0, 1920, 1080)])
    r = df.select(bx.box_to_percent("bbox", F.lit(1920), F.lit(1080)).alias("p")).collect()
    assert abs(r[0].p.x - 10) < 1e-9 and abs(r[0].p.y - 10) < 1e-9
    assert r[1].p.x == 0 and r[1].p.width == 100


def test_percent_to_yolo(spark):
    df = spark.createDataFrame([(25.0, 25.0, 50.0, 50.0), (0.0, 0.0, 20.0, 20.0), (0.0, 0.0, 100.0, 100.0)],
                               "x double, y double, w double, h double")
    r = [tuple(x.p) for x in df.select(bx.percent_to_yolo("x", "y", "w", "h").alias("p")).collect()]
    assert r == [(0.5, 0.5, 0.5, 0.5), (0.1, 0.1, 0.2, 0.2), (0.5, 0.5, 1.0, 1.0)]


def test_confidence_and_class_scope(spark):
    df = spark.createDataFrame(
        [([((10, 20, 100, 150), 0.85, 15), ((200, 300, 400, 450), 0.3, 0)],)],
        "d array<struct<bbox:struct<x1:int,y1:int,x2:int,y2:int>,confidence:double,class_id:int>>")
    r = df.select(F.size(bx.confidence_filter("d", 0.4)).alias("n"),
                  F.size(bx.class_scope("d", 80)).alias("stock"),
                  F.size(bx.class_scope("d", 2)).alias("tuned")).first()
    assert (r.n, r.stock, r.tuned) == (1, 1, 2)


def test_image_filename_rules(spark):
    urls = ["/data/local-files/?d=data/raw/subdir/img1.jpg", "http://localhost:8081/data/raw/img1.jpg", "", None,
            "http://x/a/b/?d=c/d.png"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r.f for r in df.select(nm.image_filename("u").alias("f")).collect()] == \
        ["img1.jpg", "img1.jpg", None, None, "d.png"]


def test_image_path_rules(spark):
    urls = ["/data/local-files/?d=data/raw/subdir/img1.jpg", "http://localhost:8081/data/raw/img1.jpg",
            "/data/local-files/?d=data/raw/my+cat%201.jpg&x=1", "http://h/data//raw/a.jpg?q=1#f"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r.p for r in df.select(nm.image_path("u", "/root").alias("p")).collect()]
    assert got == ["/root/data/raw/subdir/img1.jpg", "/root/data/raw/img1.jpg",
                   "/root/data/raw/my cat 1.jpg", "/root/data/raw/a.jpg"]
    rel = df.select(nm.image_path("u", ".").alias("p")).first().p
    assert rel == "data/raw/subdir/img1.jpg"


def test_file_stem(spark):
    names = ["a/b/img.jpg", "x.tar.gz", ".bashrc", "trailing.", "noext"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.s for r in df.select(nm.file_stem("n").alias("s")).collect()] == \
        ["img", "x.tar", ".bashrc", "trailing.", "noext"]


def test_capture_stem_and_iso(spark):
    ts = [dt.datetime(2026, 3, 15, 21, 2, 4, 123987), dt.datetime(2026, 3, 15, 21, 2, 4)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp")
    r = df.select(nm.capture_stem("ts", F.lit(2), F.lit("cats")).alias("s"),
                  nm.capture_stem("ts", F.lit(0), F.lit("background")).alias("b"),
                  nm.iso_timestamp("ts").alias("i")).collect()
    assert r[0].s == "20260315_210204_123_2cats"          # ms truncated
    assert r[0].b == "20260315_210204_123_background"
    assert r[0].i == "2026-03-15T21:02:04.123987"
    assert r[1].i == "2026-03-15T21:02:04"


def test_image_url(spark):
    df = spark.createDataFrame([("/proj/data/raw/a.jpg",), ("/elsewhere/a.jpg",)], "p string")
    r = df.select(nm.image_url("p", "/proj").alias("l"), nm.image_url("p", "/proj", "http://h:8081/").alias("h")).collect()
    assert r[0].l == "/data/local-files/?d=data/raw/a.jpg" and r[0].h == "http://h:8081/data/raw/a.jpg"
    assert r[1].l is None


def test_class_dictionaries(spark):
    df = spark.createDataFrame([(0,), (1,), (15,), (7,), (None,)], "c int")
    assert [r.l for r in df.select(cl.label_for_class("c").alias("l")).collect()] == \
        ["salo", "taro", "cat", "cat", "cat"]
    lab = spark.createDataFrame([("salo",), ("taro",), ("unknown_cat",)], "l string")
    assert [r.c for r in lab.select(cl.class_for_label("l").alias("c")).collect()] == [0, 1, None]
    ids = spark.createDataFrame([(15,), (99,)], "class_id int")
    named = cl.attach_class_names(ids, cl.class_names_df(spark)).orderBy("class_id").collect()
    assert [r.name for r in named] == ["cat", "class_99"]


def test_yolo_text(spark):
    df = spark.createDataFrame([(0, 0.5, 0.5, 1.0, 0.123457), (1, 0.00001, 0.000015, 0.000005, 0.0)],
                               "c int, a double, b double, w double, h double")
    r = df.select(lb.yolo_line("c", "a", "b", "w", "h").alias("l")).collect()
    assert r[0].l == "0 0.5 0.5 1.0 0.123457"
    assert r[1].l == "1 1e-05 1.5e-05 5e-06 0.0"
    t = spark.createDataFrame([(["a", "b"],), ([],)], "x array<string>").select(lb.label_text("x").alias("t")).collect()
    assert [x.t for x in t] == ["a\nb\n", ""]


def test_debug_summary_and_overlay(spark):
    df = spark.createDataFrame([([("cat", 0.87), ("dog", 0.91)],), ([],)],
                               "f array<struct<name:string,confidence:double>>")
    r = [x.s for x in df.select(cl.debug_summary("f").alias("s")).collect()]
    assert r == ["dog: 0.91, cat: 0.87", "no detections"]


def test_image_filename_path_edge_cases(spark):
    urls = ["http://h/a/b/.", "http://h/a/b//", "x?d=", "/data/local-files/?d=a%20b.jpg", "http://h/p/x.jpg#frag"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r.f for r in df.select(nm.image_filename("u").alias("f")).collect()]
    # Path(...).name: '.' components and trailing slashes collapse; no percent-decoding; fragments stay
    assert got == ["b", "b", "", "a%20b.jpg", "x.jpg#frag"]


def test_label_numbers_are_rounded_once(spark):
    """Float texts equal Python's over all sizes, and a value is worked out once however it is written."""
    values = [0.5, 1.0, 0.123457, 0.1, 12.000001, 99.999999, 1e-4, 9.9e-05, 1e-06, 0.0, -0.25, -3e-05, 123456789.654321, 7.1, 0.100001]
    values += [i / 1e6 for i in range(1, 2000, 7)] + [round(1 + i / 1e6, 6) for i in range(0, 10 ** 6, 9973)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.t for r in df.select(lb.py_float_text("v").alias("t")).collect()] == [str(v) for v in values]
    odd = spark.createDataFrame([(None,), (2e9,), (float("nan"),)], "v double").select(lb.py_float_text("v").alias("t")).collect()
    assert [r.t for r in odd] == ["null", "2000000000.0", "NaN"]
    text = df.select(lb.py_float_text(F.round(F.col("v") / 3, 6)).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("round(") == 1
