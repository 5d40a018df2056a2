"""Image arrays and rows that several tests use."""

import numpy as np


def make_frame(height=480, width=640, color=(100, 150, 200)):
    f = np.zeros((height, width, 3), dtype=np.uint8)
    f[:] = color
    return f


def make_random_frame(height=480, width=640, seed=0):
    return np.random.default_rng(seed).integers(0, 256, (height, width, 3), dtype=np.uint8)


def image_row(arr, origin="mem://frame"):
    h, w, c = arr.shape
    return {"origin": origin, "height": h, "width": w, "nChannels": c, "mode": 16, "data": bytearray(arr.tobytes())}
