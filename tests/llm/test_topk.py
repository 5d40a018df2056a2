import math
import random

import pytest
from pyspark.sql import functions as F

from framecurate.llm import topk as T


def brute(rows, k, is_query, scale=256):
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, [math.floor(scale * x) for x in v]))
    out = []
    for i, v in whole:
        if is_query(i):
            scored = sorted((-max(-T.LIMIT, min(T.LIMIT, sum(a * b for a, b in zip(v, w, strict=True)))), j)
                            for j, w in whole if j != i and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=5, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.select(F.lit("x").alias("score"), F.lit("y").alias("rank"), F.lit(1).alias("g"), "*")
    return sorted(tuple(r) for r in T.top_k(df.repartition(3), F.col("vec_id") % 5 == 0, k, **more).collect())


def test_equals_brute_force(llm_spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[7][1]) for i in range(60)]                 # a vector that a third shares
    want = brute(rows, 5, lambda i: i % 5 == 0)
    assert run(llm_spark, rows) == want
    assert run(llm_spark, rows, block_rows=7, block_queries=4) == want


def test_queries_go_in_waves_that_candidates_do_not_multiply(llm_spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(150)] + [(5, [1.0, 2.0]), (151, [0.5, 0.5])]
    want, seen = brute(rows, 5, lambda i: i % 5 == 0), []
    asked = T._asked

    def told(queries, state):
        got = asked(queries, state)
        seen.append((got.count(), got.select("qb").distinct().count(), got.select("qb", "dim").distinct().count()))
        return got

    monkeypatch.setattr(T, "_asked", told)
    assert run(llm_spark, rows, block_rows=3, block_queries=4) == want      # some 50 candidate blocks, one wave
    assert max(n for n, _, _ in seen) > 4 and all(n == blocks for n, _, blocks in seen)
    seen.clear()
    assert run(llm_spark, rows, block_rows=3, block_queries=4, wave_bytes=1) == want
    assert {blocks for _, blocks, _ in seen} == {1}                         # a block of queries a wave


def test_odd_rows(llm_spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice((-1.0, 0.0, 1.0)) for _ in range(3)]) for i in range(-10, 20)]       # many ties
    rows += [(None, [1.0] * 3), (30, None), (31, [1.0, None, 1.0]), (35, [float("nan"), 1.0, 1.0]),
             (36, [float("inf"), 1.0, 1.0]), (40, []), (41, []), (45, [1.0, 2.0]), (50, [0.5] * 300), (51, [0.25] * 300),
             (5, [1.0, 1.0, 1.0]), (5, [1.0, 1.0, 1.0]), (60, [1e30, 1.0]), (61, [1e12, 3.0]), (65, [-1e12, 1e12])]
    assert run(llm_spark, [r for r in rows if r[0] != 60]) == brute([r for r in rows if r[0] != 60], 5, lambda i: i % 5 == 0)
    far = run(llm_spark, rows, k=2)                                     # components beyond a long count as its ends
    assert {r[3] for r in far if r[0] == 65} <= {T.LIMIT, -T.LIMIT} | {r[3] for r in far}


def test_few_and_no_rows(llm_spark):
    assert run(llm_spark, []) == []
    assert run(llm_spark, [(0, [1.0, 2.0])]) == []
    assert run(llm_spark, [(0, [1.0]), (1, [2.0]), (2, [-3.0])]) == brute([(0, [1.0]), (1, [2.0]), (2, [-3.0])], 5, lambda i: i % 5 == 0)
    assert run(llm_spark, [(1, [1.0]), (2, [2.0])]) == []


@pytest.mark.parametrize("scale", [1, 1 << 20])
def test_scales(llm_spark, scale):
    rng = random.Random(scale)
    rows = [(i, [rng.uniform(-9, 9) for _ in range(4)]) for i in range(50)]
    assert run(llm_spark, rows, k=3, scale=scale) == brute(rows, 3, lambda i: i % 5 == 0, scale)
