"""Image sources (S1, S2, S5) on real files written by the test."""

import struct
import uuid
import zlib

import numpy as np

from framecurate.operators.images import _as_bgr
from framecurate.sources.images import image_dims, read_frames, read_inventory, stream_frames


def _png(path, rgb: np.ndarray):
    h, w, _ = rgb.shape
    raw = b"".join(b"\x00" + rgb[y].tobytes() for y in range(h))

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + \
        chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    path.write_bytes(png)


def _camera_dir(tmp_path):
    cam = tmp_path / "frames" / "cam7"
    cam.mkdir(parents=True)
    rgb = np.zeros((6, 8, 3), dtype=np.uint8)
    rgb[..., 0], rgb[..., 1], rgb[..., 2] = 200, 150, 100          # R, G, B
    _png(cam / "f1.png", rgb)
    _png(cam / "f2.png", rgb[:4, :5])
    (cam / "broken.png").write_bytes(b"not an image")
    return cam


def test_read_frames_dims_bgr_and_error_rows(spark, tmp_path):
    cam = _camera_dir(tmp_path)
    frames = read_frames(spark, str(cam))
    rows = {r.image.origin.split("/")[-1]: r for r in frames.collect()}
    assert rows["f1.png"].camera_id == "cam7"
    f1 = rows["f1.png"].image
    a = _as_bgr(bytes(f1.data), f1.height, f1.width, f1.nChannels)
    assert (f1.width, f1.height) == (8, 6) and tuple(a[0, 0]) == (100, 150, 200)   # BGR order
    dims = {r.path.split("/")[-1]: (r.width, r.height, r.readable) for r in image_dims(frames).collect()}
    assert dims["f2.png"] == (5, 4, True)
    assert dims["broken.png"][2] is False                                         # error row, not dropped


def test_stream_frames_drains(spark, tmp_path):
    cam = _camera_dir(tmp_path)
    q = stream_frames(spark, str(cam)).writeStream.format("memory").queryName(f"s2_{uuid.uuid4().hex}") \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table(q.name).count() == 3


def test_read_inventory_only_jpg_paths(spark, tmp_path):
    d = tmp_path / "images"
    d.mkdir()
    for n in ("a.jpg", "b.jpg", "c.JPG", "d.png"):
        (d / n).write_bytes(b"x" * 10)
    (d / "sub").mkdir()
    (d / "sub" / "e.jpg").write_bytes(b"x")
    inv = read_inventory(spark, str(d))
    assert inv.columns == ["path"]
    assert sorted(r.path.split("/")[-1] for r in inv.collect()) == ["a.jpg", "b.jpg"]
