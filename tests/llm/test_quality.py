import zlib

import numpy as np
import pytest

from framecurate.llm import quality as Q
from framecurate.llm.catalog import op5_quality_ranking


def test_held_out_accuracy(llm_spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in op5_quality_ranking(llm_spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in llm_spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(got[d]["held_out"] for d in held) and len(held) > 500
    assert np.mean([got[d]["predicted"] == labels[d] for d in held]) > 0.98
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in got.values())


def test_ranking_orders_pairs():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)).astype(np.float32)
    y = (x @ [2, -1, 0, 0, 0.5] + 0.3 * rng.normal(size=400) > 0.4).astype(int)
    m = Q.fit(x, y)
    s = m.scores(x)
    good, bad = s[y == 1], s[y == 0]
    assert (good[:, None] > bad[None, :]).mean() > 0.97 and ((s >= 0.5) == y).mean() > 0.9


@pytest.mark.parametrize("labels", [[], [(3, 1)], [(3, 1), (9, 1), (None, 0), (7, None), (11, 5)]])
def test_without_both_labels_every_score_is_a_half(llm_spark, odd_docs, labels):
    table = llm_spark.createDataFrame(labels, "doc_id long, quality int")
    rows = Q.score(odd_docs, Q.train(odd_docs, table)).collect()
    assert len(rows) == odd_docs.count() and {r["score"] for r in rows} == {0.5}


def test_odd_rows(llm_spark, odd_docs, no_docs):
    table = llm_spark.createDataFrame([(3, 1), (3, 1), (16, 1), (20, 0), (12, 0)], "doc_id long, quality int")
    model = Q.train(odd_docs, table)
    got = Q.score(odd_docs, model)
    assert sorted(got.columns) == sorted(odd_docs.columns)           # score and predicted are replaced
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    kept = Q.keep_good(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(r["doc_id"]) for r in got.where("predicted = 1").collect())
    assert Q.score(no_docs, model).collect() == [] and Q.keep_good(no_docs, model).collect() == []
    assert np.isfinite(Q.features(None)).all() and len(Q.features(b"a")) == len(Q.features(b""))
