"""The wave router's frames: some a batch, whatever the number of cameras."""
import pandas as pd

from framecurate.operators.state_machine import FilterParams, make_wave_router

BIG = (1 << 53) + 1          # no double holds it


def test_many_cameras_of_a_batch_come_as_two_frames_with_exact_times():
    n = 50
    pdf = pd.DataFrame({
        "camera_id": [str(i) for i in range(n)], "is_state": False, "us": BIG, "frame_id": range(n),
        "has_cats": [i % 2 == 0 for i in range(n)], "control": None, "hist": None,
        "s_cat_us": None, "s_cat_hist": None, "s_cat_fid": None, "s_bg_us": None})
    got = list(make_wave_router(FilterParams())(iter([pdf])))
    assert len(got) == 3                                   # decisions, states, the last camera's state
    assert got[0]["kind"].tolist() == ["cats" if i % 2 == 0 else "background" for i in range(n)]
    states = pd.concat(got[1:], ignore_index=True)
    assert states["camera_id"].tolist() == [str(i) for i in range(n)]
    assert [x for x in states["s_cat_us"] if x is not None and x == x] == [BIG] * (n // 2)
    assert [x for x in states["s_bg_us"] if x is not None and x == x] == [BIG] * (n // 2)
