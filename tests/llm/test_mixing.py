import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from framecurate.llm import mixing as M
from framecurate.llm.catalog import MIX_POWERS, mixed, mixed_sample


def plain(rows, powers, keep, sweeps=M.SWEEPS):
    """Raked weights and probabilities by cell, in plain arrays."""
    df = pd.DataFrame(rows, columns=[*powers, "tokens"]).fillna("null")
    c = df.groupby(list(powers)).tokens.sum().astype(float).reset_index()
    whole, raked, goal = c.tokens.sum(), c.tokens.copy(), {}
    for d, p in powers.items():
        s = c.groupby(d).tokens.sum()
        s = s[s > 0] ** p
        goal[d] = s / s.sum()
    for _ in range(sweeps):
        for d in powers:
            now = raked.groupby(c[d]).transform("sum")
            raked = pd.Series(np.where((raked > 0) & (now > 0), raked * c[d].map(goal[d]).fillna(0) * whole
                                       / now.replace(0, 1), 0.0))
    ratio = np.where(c.tokens > 0, raked / c.tokens.replace(0, 1), 0)
    lo, hi = 0.0, 1e6
    for _ in range(200):
        f = (lo + hi) / 2
        lo, hi = (f, hi) if (np.minimum(1, f * ratio) * c.tokens).sum() < keep * whole else (lo, f)
    return {tuple(k): (w, min(1, lo * w)) for k, w in zip(c[list(powers)].values.tolist(), ratio, strict=True)}


def test_weights_equal_plain_raking(odd_docs, small_docs):
    docs = small_docs.select("doc_id", "text", "lang", "source").unionByName(
        odd_docs.select("doc_id", "text", "lang", "source"))
    got = mixed(docs, keep=0.5).collect()
    assert len(got) == docs.count()
    want = plain([(r["source"], r["lang"], r["_topic"], r["_tokens"]) for r in got], MIX_POWERS, 0.5)
    for r in got:
        w, p = want[r["source"] or "null", r["lang"] or "null", r["_topic"]] if r["_tokens"] else (0, 0)
        assert abs(r["_weight"] - w) < 1e-6 and abs(r["_probability"] - p) < 1e-6
        assert r["_tokens"] == len([x for x in (r["text"] or "").split() if x])
        assert not (r["_selected"] and r["_probability"] == 0)


def test_given_targets_are_met(llm_spark):
    rows = [(i, "w " * 10, ("en", "en", "en", "de", "fr")[i * 7919 % 5], "s" + str(i * 31 % 4)) for i in range(4000)]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = llm_spark.createDataFrame([("lang", "en", 0.2), ("lang", "de", 0.4), ("lang", "fr", 0.4)],
                                        "dim string, value string, share double")
    got = M.mix(docs, {"lang": F.col("lang"), "source": F.col("source")}, targets=targets, keep=0.3).toPandas()
    raked = (got._weight * got._tokens).groupby(got.lang).sum() / got._tokens.sum()
    assert abs(raked["en"] - 0.2) < 1e-3 and abs(raked["de"] - 0.4) < 1e-3
    drawn = got[got._selected]
    assert abs(drawn._tokens.sum() / got._tokens.sum() - 0.3) < 0.03
    assert abs((drawn.lang == "en").mean() - 0.2) < 0.04


def test_sample_keeps_columns_and_empty_tables(odd_docs, no_docs):
    got = mixed_sample(odd_docs, keep=1.0)
    assert got.columns == odd_docs.columns
    with_words = [r for r in odd_docs.collect() if (r["text"] or "").split()]
    assert sorted(map(str, got.collect())) == sorted(map(str, with_words))
    assert mixed_sample(no_docs, keep=0.5).collect() == []
    assert mixed(odd_docs.where("text is null"), keep=0.5).where("_selected").collect() == []
