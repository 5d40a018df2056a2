import math
from collections import Counter

import pytest

from framecurate.llm.ngram_lm import score_documents


def plain(texts, order, min_count, backoff):
    docs = [(t or "").lower().split() for t in texts]
    counts = [Counter(tuple(d[i:i + n]) for d in docs for i in range(len(d) - n + 1)) for n in range(1, order + 1)]
    whole = sum(counts[0].values())

    def s(history, w):
        if not history:
            return counts[0][w,] / whole
        c = counts[len(history)][(*history, w)]
        return c / counts[len(history) - 1][history] if c >= min_count else backoff * s(history[1:], w)
    return [(len(d), sum(math.log(s(tuple(d[max(0, i - order + 1):i]), w)) for i, w in enumerate(d))) for d in docs]


@pytest.mark.parametrize("order,min_count,chunk", [(1, 2, 10**6), (2, 2, 10**6), (2, 1, 700), (3, 2, 2000)])
def test_scores_equal_brute_force(odd_docs, small_docs, order, min_count, chunk):
    docs = odd_docs.select("doc_id", "text").unionByName(small_docs.select("doc_id", "text").where("doc_id < 60"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = score_documents(docs.repartition(3), order=order, min_count=min_count, backoff=0.3, chunk_words=chunk).collect()
    want = plain([t for _, t in rows], order, min_count, 0.3)

    def key(x):
        return (x[0] is None, x[0] or 0, x[1], round(x[2], 5))
    for a, b in zip(sorted(map(tuple, got), key=key),
                    sorted(((d, n, s) for (d, _), (n, s) in zip(rows, want, strict=True)), key=key), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 * max(1, abs(b[2]))


def test_empty_tables(odd_docs, no_docs):
    assert score_documents(no_docs).collect() == []
    got = score_documents(odd_docs.where("text is null or text = ''")).collect()
    assert {(r["n_tokens"], r["log_score"]) for r in got} == {(0, 0.0)} and len(got) == 4
