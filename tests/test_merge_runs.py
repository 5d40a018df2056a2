"""Merging exports run by run equals merging them at once."""

import json
import random

import pytest

from framecurate.plans import merge as mg
from framecurate.sources.annotations import parse_task_files


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_of_files_into_runs(spark, tmp_path, seed):
    rng = random.Random(seed)
    files = [(f"{c}.json", json.dumps([{"id": f"{c}{i}", "data": {"image": f"x/{rng.randint(0, 12)}.jpg"}} for i in range(8)] + [{"id": 9}]))
             for c in "abcdef"]
    df = spark.createDataFrame(files, "file string, text string")
    told = lambda d: sorted(map(tuple, d.selectExpr("filename", "file", "pos", "image_url", "to_json(task)").collect()))
    want = told(mg.merge_dedup_first(parse_task_files(df)))
    rng.shuffle(files)
    state = str(tmp_path / "state")
    for run, some in enumerate((files[:2], [], files[2:3], files[3:], files[3:])):       # the last files come twice
        tasks = parse_task_files(spark.createDataFrame(some, "file string, text string"))
        out = mg.merge_new_files(tasks, state, run)
        if run == 2:                                                                     # a run that is repeated
            again = told(out)
            assert told(mg.merge_new_files(tasks, state, run)) == again
    assert told(out) == want
