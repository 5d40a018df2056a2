"""Annotation exports: parse, merge, convert, queue (reference expectations)."""

import json

import pytest

from framecurate.plans import convert as cv
from framecurate.plans import labeling as lb
from framecurate.plans import merge as mg
from framecurate.sources.annotations import (labeled_filenames, parse_task_files, read_annotation_files,
                                             read_warnings)


def _task(url, labels=None, box=(12.5, 40.0, 30.0, 10.0), rtype="rectanglelabels"):
    t = {"data": {"image": url}}
    if labels is not None:
        r = {"value": {**dict(zip(("x", "y", "width", "height"), box)), "rectanglelabels": labels},
             "original_width": 1280, "original_height": 720}
        if rtype:
            r["type"] = rtype
        t["annotations"] = [{"result": [r]}]
    return t


def _files(spark, files):
    return spark.createDataFrame([(k, v) for k, v in files.items()], "file string, text string")


def test_merge_keeps_the_first_of_equal_names(spark):
    north = [_task(f"/data/local-files/?d=porch/cam{n}.jpg") for n in (4, 9, 9)]
    south = [_task("https://host.example/yard/cam9.jpg"), _task("/data/local-files/?d=yard/cam2.jpg"), {"data": {}}]
    files = _files(spark, {"a/south.json": json.dumps(south), "a/north.json": json.dumps(north)})
    merged = mg.merge_dedup_first(parse_task_files(files)).orderBy("file", "pos").collect()
    assert [(r.file, r.pos, r.filename) for r in merged] == [
        ("a/north.json", 0, "cam4.jpg"), ("a/north.json", 1, "cam9.jpg"), ("a/south.json", 1, "cam2.jpg")]
    s = mg.merge_stats(files).first()
    assert (s.files, s.total, s.duplicates, s.unique_tasks) == (2, 6, 2, 3)


def test_wrapped_cut_off_and_other_json(spark):
    files = _files(spark, {"w.json": json.dumps({"tasks": [_task("/q/k.jpg")]}, indent=3),
                           "cut.json": '[{"data": ', "num.json": "17", "empty.json": "[]",
                           "res.json": json.dumps({"results": [_task("/q/l.jpg"), _task("/q/m.jpg")]}, indent=1)})
    per = {r.file: r.n_tasks for r in mg.tasks_per_file(files).collect()}
    assert per == {"w.json": 1, "cut.json": 0, "num.json": 0, "empty.json": 0, "res.json": 2}
    assert [r.key for r in read_warnings(files).collect()] == ["cut.json"]
    s = mg.merge_stats(files).first()
    assert (s.files, s.total, s.duplicates, s.unique_tasks) == (5, 3, 0, 3)
    none = mg.merge_stats(files.where("file = ''")).first()
    assert (none.files, none.total, none.duplicates, none.unique_tasks) == (0, 0, 0, 0)


def test_convert_side_unwrap_single_task(spark):
    files = _files(spark, {"one.json": json.dumps(_task("/x/img1.jpg")),
                           "res.json": json.dumps({"results": [_task("/x/a.jpg")]})})
    t = parse_task_files(files, wrapper_keys=("tasks", "annotations"), single_task_fallback=True)
    assert sorted(r.file for r in t.collect()) == ["one.json", "res.json"]   # dict without key → one task


def test_read_annotation_files(spark, tmp_path):
    d = tmp_path / "exports"
    d.mkdir()
    (d / "project-1.json").write_text(json.dumps([_task("/q/a.jpg"), _task("/q/b.jpg")], indent=2))
    (d / "project-2.json").write_text(json.dumps({"tasks": [_task("/q/c.jpg")]}, indent=2))
    (d / "notes.txt").write_text("ignore")
    (d / "below").mkdir()
    (d / "below" / "more.json").write_text(json.dumps([_task("/q/d.jpg")]))
    for path in (str(d), f"file://{d}", f"{d}/"):
        files = read_annotation_files(spark, path)
        assert files.count() == 2
        assert sorted(r.filename for r in parse_task_files(files).collect()) == ["a.jpg", "b.jpg", "c.jpg"]
    assert read_annotation_files(spark, f"{d}/project-1.json").count() == 1
    assert read_annotation_files(spark, f"{d}/project-*.json").count() == 2
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "notes.txt").write_text("ignore")
    for path in (str(empty), str(tmp_path / "none")):
        with pytest.raises(FileNotFoundError):
            read_annotation_files(spark, path)


def test_merged_export_is_read_back(spark, tmp_path):
    """K5 and K4 write what S4, S4b and S4c read."""
    from framecurate.sinks.writers import write_annotation_import, write_merged_tasks
    from framecurate.sources.annotations import CONVERT_WRAPPER_KEYS, read_labeled_filenames
    files = _files(spark, {"1.json": json.dumps([_task("/q/a.jpg", ["salo"]), _task("/q/b.jpg")], indent=2),
                           "2.json": json.dumps([_task("/q/a.jpg"), _task("/q/c.jpg", ["taro"])], indent=2)})
    out = str(tmp_path / "merged")
    assert write_merged_tasks(mg.merge_dedup_first(parse_task_files(files)), out)
    assert sorted(r.filename for r in read_labeled_filenames(spark, out).collect()) == ["a.jpg", "b.jpg", "c.jpg"]
    inv = spark.createDataFrame([("/q/a.jpg",), ("/q/c.jpg",)], "path string")
    for args in ({}, {"wrapper_keys": CONVERT_WRAPPER_KEYS, "single_task_fallback": True}):
        tasks = parse_task_files(read_annotation_files(spark, out), **args)
        conv = cv.convert_tasks(tasks, inv, document_root="/").orderBy("file", "pos").collect()
        assert [(r.stem, r.status, r.label_text) for r in conv] == [
            ("a", "ok", "0 0.275 0.45 0.3 0.1\n"), ("b", "missing", ""), ("c", "ok", "1 0.275 0.45 0.3 0.1\n")]
    queue = str(tmp_path / "queue")
    assert write_annotation_import(spark.createDataFrame([(json.dumps(_task("/q/z.jpg")),)], "task_json string"), queue)
    assert [r.filename for r in read_labeled_filenames(spark, queue).collect()] == ["z.jpg"]


def test_convert_labels_and_warnings(spark):
    root = "/proj"
    tasks = [
        _task("/data/local-files/?d=data/raw/a.jpg", ["salo"], box=(25.0, 25.0, 50.0, 50.0)),
        _task("/data/local-files/?d=data/raw/b.jpg", ["taro"], box=(0.0, 0.0, 20.0, 20.0)),
        _task("/data/local-files/?d=data/raw/c.jpg", ["unknown_cat"]),
        _task("/data/local-files/?d=data/raw/d.jpg"),                       # negative sample
        _task("/data/local-files/?d=data/raw/missing.jpg", ["salo"]),
        {"data": {}},
        _task("/data/local-files/?d=data/raw/e.jpg", ["salo"], rtype=None),  # no type → dropped
        _task("/data/local-files/?d=data/raw/f.jpg", []),
        _task("/data/local-files/?d=data/raw/g%.jpg", ["taro"], box=(None, 1.0, 2.0, 3.0)),
    ]
    files = _files(spark, {"m.json": json.dumps(tasks)})
    inv = spark.createDataFrame([(f"/proj/data/raw/{n}.jpg",) for n in ["a", "b", "c", "d", "e", "f", "g%"]], "path string")
    conv = cv.convert_tasks(parse_task_files(files), inv, document_root=root)
    by = {r.stem: r for r in conv.where("status = 'ok'").collect()}
    assert by["a"].label_text == "0 0.5 0.5 0.5 0.5\n"
    assert by["b"].label_text == "1 0.1 0.1 0.2 0.2\n"
    assert by["c"].label_text == "" and by["d"].label_text == "" and by["e"].label_text == ""
    w = sorted(r.reason for r in cv.convert_warnings(conv).collect())
    assert "Image not found: /proj/data/raw/missing.jpg" in w
    assert "Task has no image URL, skipping" in w
    assert "c: unknown label 'unknown_cat', skipping" in w
    assert "f: box with no label, skipping" in w
    assert "g%: box without coordinates, skipping" in w and by["g%"].label_text == ""
    s = cv.convert_summary(conv).first()
    assert (s.tasks, s.boxes, s.background_count) == (9, 2, 7)
    counts = {r.class_name: r.boxes for r in cv.class_box_counts(conv).collect()}
    assert counts == {"salo": 1, "taro": 1}


def test_queue_outcomes_and_task_json(spark):
    meta = spark.createDataFrame([
        ("/srv/cams/k.jpg", [(15, [64, 36, 192, 252], 0.9)]), ("/srv/cams/plain.jpg", []),
        ("/srv/cams/done.jpg", [(0, [0, 0, 8, 8], 0.5)]), ("/srv/cams/lost.jpg", []),
        ("/srv/cams/broken.jpg", []), ("/srv/cams/donebroken.jpg", []), ("/else/far.jpg", [])],
        "full_frame string, detections array<struct<class_id:int,bbox:array<int>,confidence:double>>")
    inv = [("/srv/cams/k.jpg", 640, 360), ("/srv/cams/k.jpg", 640, 360), ("/srv/cams/plain.jpg", 640, 360),
           ("/srv/cams/done.jpg", 640, 360), ("/srv/cams/broken.jpg", -1, -1), ("/srv/cams/donebroken.jpg", -1, -1),
           ("/else/far.jpg", 640, 360)]
    inv = spark.createDataFrame(inv, "path string, width int, height int")
    labeled = spark.createDataFrame([("done.jpg",), ("done.jpg",), ("lost.jpg",), ("donebroken.jpg",)], "filename string")
    cls = lb.classify_captures(meta, inv, labeled, "/srv")
    got = {r.full_frame.rsplit("/", 1)[1]: r.outcome for r in cls.collect()}
    # missing beats labeled; labeled beats unreadable; each capture once
    assert cls.count() == 7 and got == {
        "k.jpg": "exported", "plain.jpg": "exported", "done.jpg": "skipped", "lost.jpg": "error",
        "broken.jpg": "error", "donebroken.jpg": "skipped", "far.jpg": "error"}
    s = lb.export_summary(cls).first()
    assert (s.exported, s.skipped, s.errors) == (2, 2, 3)
    tasks = {r.full_frame: json.loads(r.task_json) for r in lb.build_tasks(cls, "/srv").collect()}
    k = tasks["/srv/cams/k.jpg"]
    assert k["data"]["image"] == "/data/local-files/?d=cams/k.jpg"
    assert k["annotations"][0]["result"][0] == {
        "type": "rectanglelabels", "from_name": "label", "to_name": "image", "original_width": 640,
        "original_height": 360, "value": {"x": 10.0, "y": 10.0, "width": 20.0, "height": 60.0,
                                          "rectanglelabels": ["cat"]}}
    assert "annotations" not in tasks["/srv/cams/plain.jpg"]


def test_labeled_filenames_distinct(spark):
    files = _files(spark, {"e.json": json.dumps([_task("/x/a.jpg"), _task("/y/a.jpg"), 5, {"data": {}}])})
    assert [r.filename for r in labeled_filenames(parse_task_files(files)).collect()] == ["a.jpg"]


def test_read_labeled_filenames_missing_and_present(spark, tmp_path):
    from framecurate.sources.annotations import read_labeled_filenames
    assert read_labeled_filenames(spark, str(tmp_path / "nope.json")).count() == 0
    f = tmp_path / "export.json"
    f.write_text(json.dumps({"annotations": [_task("/data/local-files/?d=data/raw/x1.jpg")]}))
    assert [r.filename for r in read_labeled_filenames(spark, str(f)).collect()] == ["x1.jpg"]


def test_no_matching_export_files_is_an_error(spark, tmp_path):
    import pytest
    with pytest.raises(Exception):
        read_annotation_files(spark, str(tmp_path / "exports" / "project-*.json")).count()


def test_materialize_labeled(spark, tmp_path):
    from framecurate.sinks.writers import materialize_labeled
    first = [_task("/data/local-files/?d=raw/u.jpg", ["salo"]), _task("/data/local-files/?d=raw/v.jpg"),
             _task("/data/local-files/?d=raw/gone.jpg", ["taro"])]
    second = [_task("/data/local-files/?d=new/u.jpg", ["taro"])]
    files = _files(spark, {"1.json": json.dumps(first), "2.json": json.dumps(second)})
    inv = spark.createDataFrame([("/p/raw/u.jpg",), ("/p/raw/v.jpg",), ("/p/new/u.jpg",)], "path string")
    conv = cv.convert_tasks(parse_task_files(files), inv, document_root="/p")
    images = spark.createDataFrame([("/p/new/u.jpg", b"1"), ("/p/new/u.jpg", b"1"), ("/p/raw/u.jpg", b"0")],
                                   "path string, image binary")
    for n, labels in enumerate((conv, cv.label_files(conv))):
        for k, img in enumerate((None, images)):
            out = str(tmp_path / f"labeled{n}{k}")
            materialize_labeled(labels, img, out)
            rows = spark.read.parquet(out).collect()
            # one row a name, the last task's image; no image, no row; negatives too
            assert sorted((r.stem, r.image_path) for r in rows) == [("u", "/p/new/u.jpg"), ("v", "/p/raw/v.jpg")]
            if img is not None:
                assert {r.stem: r.image for r in rows} == {"u": bytearray(b"1"), "v": None}


def test_result_lists_are_read_once(spark):
    """One row a result, tasks without results none; a task's list is taken out of its JSON once."""
    tasks = parse_task_files(_files(spark, {"a.json": json.dumps([_task("/x/1.jpg", ["salo", "taro"]), {"data": {"image": "/x/2.jpg"}}])}))
    rows = cv.result_rows(cv.typed_results(tasks))
    assert [(r.pos, r.box_idx, r.r.value.rectanglelabels) for r in rows.orderBy("box_idx").collect()] == [(0, 0, ["salo", "taro"])]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$.annotations[0].result") == 1
