import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from framecurate.llm import simhash as S


def plain_simhash(text, shingle=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ")
             .replace("\t", " ").replace("\n", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius, roots=False):
    """{(doc_id, fp): component_id} by comparing all fingerprints."""
    fps = sorted({fp for _, fp in rows})
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    if roots:
        return {(d, fp): find(fps.index(fp)) for d, fp in rows}
    least = {}
    for d, fp in rows:
        r = find(fps.index(fp))
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return {(d, fp): least.get(find(fps.index(fp))) for d, fp in rows}


@pytest.mark.parametrize("radius", [1, 2, 3, 4, 6, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    fps = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    fps[::2] = fps[0] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64)) \
        ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64)) ^ (rng.integers(0, 16, 100).astype(np.uint64))
    want = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    rows, sets = S.near_lanes(fps, S.bit_planes(fps), len(fps), radius)
    got = np.zeros_like(want)
    for r, s in zip(rows, sets, strict=True):
        got[r] = np.unpackbits(s.view(np.uint8), bitorder="little")[:len(fps)]
    assert (got == want).all()


def test_large_buckets_are_cut_into_units(monkeypatch):
    monkeypatch.setattr(S, "UNIT", 16)
    monkeypatch.setattr(S, "LANES", 8)
    rng = random.Random(4)
    fps = sorted({(5 << 40) ^ (1 << rng.randrange(30)) ^ (1 << rng.randrange(30)) for _ in range(70)})
    alone = [rng.getrandbits(63) for _ in range(20)]
    keys = [1] * len(fps) + list(range(2, 22))
    batches = [pa.RecordBatch.from_arrays([pa.array([0] * len(k), pa.int32()), pa.array(k, pa.int64()),
                                           pa.array(f, pa.int64())], names=["t", "key", "fp"])
               for k, f in ((keys[:33], (fps + alone)[:33]), (keys[33:], (fps + alone)[33:]))]
    links, units = [], []
    for b in S._compare(3)(batches):
        for r in b.to_pylist():
            (links if r["left"] is None else units).append(r)
    assert units and all(len(u["left"]) <= 16 * 8 for u in units)
    out = [pa.RecordBatch.from_arrays([pa.array([u[c] for u in units], pa.binary()) for c in ("left", "right")],
                                      names=["left", "right"])]
    found = [(r["a"], r["b"]) for b in S._units(3)(out) for r in b.to_pylist()]
    got = plain_components([(f, f) for f in fps], 3)
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for a, b in found + [(x["a"], x["b"]) for x in links]:
        assert (a ^ b).bit_count() <= 3
        hi, lo = sorted((find(a), find(b)), reverse=True)
        root[hi] = lo
    assert {f: find(f) for f in fps} == {f: got[f, f] for f in fps}


def test_components_equal_brute_force(small_docs, odd_docs):
    docs = small_docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    rows = [(r["doc_id"], plain_simhash(r["text"])) for r in docs.collect()]
    want = plain_components(rows, 3)
    got = S.simhash_components(docs, radius=3).collect()
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64)) for r in got), key=str) == sorted(rows, key=str)
    assert all(r["component_id"] == want[r["doc_id"], r["fp"] % (1 << 64)] for r in got)


def test_one_row_of_each_component_stays(odd_docs, no_docs):
    got = S.keep_one_per_component(odd_docs)
    rows = got.collect()
    assert got.columns == odd_docs.columns
    want = plain_components([(r["doc_id"], plain_simhash(r["text"])) for r in odd_docs.collect()], 3)
    kept = [(r["doc_id"], plain_simhash(r["text"])) for r in rows]
    assert len(kept) == len(set(kept)) and all(r["fp"] == "clash" for r in rows)
    roots = plain_components(list(want), 3, roots=True)
    assert sorted(roots[k] for k in kept) == sorted(set(roots.values()))
    assert all(k[0] == want[k] for k in kept)
    assert S.keep_one_per_component(no_docs).collect() == []
    assert S.simhash_components(no_docs).collect() == []
