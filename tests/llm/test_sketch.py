import hashlib

import numpy as np
import pyarrow as pa

from framecurate.llm import sketch as K

from texts import prose  # noqa: E402


def shingles(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_estimates():
    a, b = prose(1, 4000), prose(1, 3000) + " " + prose(2, 1000)
    fa, fb, fab = K.bottom_k(pa.array([a, b, a + "\n" + b]))
    sa, sb = shingles(a), shingles(b)
    assert abs(K.resemblance(fa, fb) - jaccard(sa, sb)) < 0.1
    assert abs(K.containment(fa, fb) - len(sa & sb) / len(sa)) < 0.12
    assert abs(K.distinct(fa) / len(sa) - 1) < 0.2
    assert K.resemblance(K.merge(fa, fb), fab) > 0.95
    few = K.bottom_k(pa.array(["a b c d e f g", "a b c d e f h", "a b", "", None]))
    assert K.distinct(few[0]) == 3 and K.resemblance(few[0], few[1]) == 2 / 4
    assert K.distinct(few[2]) == 1 and len(few[3]) == len(few[4]) == 0
    assert K.resemblance(few[3], few[4]) == 1 and K.resemblance(few[0], few[3]) == 0
    assert K.containment(few[3], few[0]) == 1
    assert (K.from_string(K.to_string(fa)) == fa).all() and K.to_string(few[3]) == ""
    assert K.to_string(K.bottom_k(pa.array(["  A  b\nc d e F g "]))[0]) == K.to_string(few[0])


def test_merging_groups_gives_the_whole(llm_spark):
    rows = [(i % 3, prose(i, 300)) for i in range(30)] + [(None, "x y"), (None, "y z"), (4, None)]
    df = llm_spark.createDataFrame(rows, "g int, text string").repartition(5)
    got = {r["g"]: r["fingerprint"] for r in K.merge_fingerprints(K.fingerprint_documents(df), "g").collect()}
    for g in (0, 1, 2, None, 4):
        whole = np.unique(np.concatenate(K.bottom_k(pa.array([t for h, t in rows if h == g]), k=10**6)))[:K.K]
        assert got[g] == K.to_string(whole)
    assert K.merge_fingerprints(K.fingerprint_documents(df.where("g > 9")), "g").collect() == []


def test_edits_equal_brute_force(llm_spark, odd_docs, small_docs, no_docs):
    import xxhash
    docs = odd_docs.select("doc_id", "text").unionByName(small_docs.select("doc_id", "text"))

    def spark_hash(t):
        h = xxhash.xxh64_intdigest(t.encode(), 42)
        return h - (1 << 64) if h >> 63 else h
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()),
                  key=lambda r: (r[0] is None, -(r[0] or 0), spark_hash(r[1])))
    want = []
    for n, (d, t) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        edited = t[:len(t) - len(t) // 3] + after[:len(t) // 3]
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), t, edited, after))
    got = K.compare_with_edits(docs).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == sorted((w[:3] for w in want), key=str)
    by = {w[:3]: w for w in want}
    for r in got:
        _, _, _, t, edited, after = by[r[0], r[1], r[2]]
        assert abs(r["near_edited"] - jaccard(shingles(t), shingles(edited))) < 0.16
        if rows.count((r[0], t)) == 1:
            assert abs(r["near_next"] - jaccard(shingles(t), shingles(after))) < 0.16
        assert r["fingerprint"] == K.to_string(K.bottom_k(pa.array([t]))[0])
        assert r["edited_fingerprint"] == K.to_string(K.bottom_k(pa.array([edited]))[0])
    assert K.compare_with_edits(no_docs).collect() == []
    one = K.compare_with_edits(odd_docs.where("doc_id = 14")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1
