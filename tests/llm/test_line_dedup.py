import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from framecurate.llm import line_dedup as L

from texts import prose  # noqa: E402


def norm(line):
    return re.sub(r"[\x00-/:-@\[-`{-\x7f]+", " ", line.lower()).strip(" ")


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def simhash(text):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in set(text.split(" "))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def distance(a, b):
    start = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[start:][::-1], b[start:][::-1]
    end = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[end:], b[end:]
    prev, codes = np.arange(len(b) + 1), np.array([ord(c) for c in b])
    for i, c in enumerate(a, 1):
        now = np.concatenate([[i], np.minimum(prev[:-1] + (codes != ord(c)), prev[1:] + 1)])
        prev = np.minimum.accumulate(now - np.arange(len(now))) + np.arange(len(now))
    return prev[-1]


def plain(rows, radius=3, similarity=0.8):
    """{(doc_id, text): dropped line numbers}."""
    where = {}
    for d, t in set(rows):
        for p, line in enumerate(t.split("\n") if t else []):
            if n := norm(line):
                where.setdefault(n, set()).add((d is None, d or 0, signed(xxhash.xxh64_intdigest(t.encode(), 42)), p, t))
    lines, root = list(where), {}
    sims = [simhash(n) for n in lines]
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(lines):
        for j in range(i):
            if (sims[i] ^ sims[j]).bit_count() <= radius and find(i) != find(j):
                most = int((1 - similarity) * max(len(a), len(lines[j])) + 1e-9)
                if abs(len(a) - len(lines[j])) <= most and distance(a, lines[j]) <= most:
                    root[find(i)] = find(j)
    groups, out = {}, {}
    for i, n in enumerate(lines):
        groups.setdefault(find(i), set()).update(where[n])
    for g in groups.values():
        for none, d, _, p, t in sorted(g)[1:]:
            out.setdefault((None if none else d, t), []).append(p)
    return {k: sorted(v) for k, v in out.items()}


def documents(odd_docs, small_docs):
    spark = odd_docs.sparkSession
    base = prose(40, 60)
    near = [base.replace("alpha", "alpha x", 1), base + " end", base.replace("tau", "tao"), base.upper() + "!!"]
    rows = [(100 + i, "\n".join([t, "", "Common line.", prose(i, 12), "..."])) for i, t in enumerate([base, *near, base])]
    rows += [(None, base), (300, "a\na\nb\n\n\na"), (301, "common LINE")]
    return (spark.createDataFrame(rows, "doc_id long, text string")
            .unionByName(odd_docs.select("doc_id", "text"))
            .unionByName(small_docs.select("doc_id", "text").where("doc_id < 90")))


def test_dropped_lines_equal_brute_force(odd_docs, small_docs, no_docs):
    docs = documents(odd_docs, small_docs)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain(rows)
    told = sorted(((d, 0 if t is None else t.count("\n") + 1, ",".join(map(str, want.get((d, t), []))))
                   for d, t in rows), key=str)
    got = L.line_report(docs).collect()
    assert sorted(((r["doc_id"], r["n_lines"], r["dropped"]) for r in got), key=str) == told
    assert all(r["n_kept"] == r["n_lines"] - len([x for x in r["dropped"].split(",") if x]) for r in got)
    assert L.line_report(no_docs).collect() == []


def test_texts_without_the_repeated_lines(odd_docs, small_docs, no_docs):
    docs = odd_docs.select(*[c for c in odd_docs.columns if c not in ("lang", "source")])
    more = documents(odd_docs, small_docs).where("doc_id >= 100")
    docs = docs.unionByName(more, allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain(rows)
    left = sorted(((d, None if t is None else "\n".join(
        x for n, x in enumerate(t.split("\n")) if n not in want.get((d, t), ()))) for d, t in rows), key=str)
    got = L.dedup_lines(docs)
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == left
    assert L.dedup_lines(no_docs).collect() == []


def test_counters_of_long_lines(llm_spark):
    texts = ["one", " ".join(f"w{i % 7}" for i in range(127)), " ".join(f"v{i}" for i in range(128)), prose(9, 5000), "same " * 40_000]
    df = llm_spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["sim"] & (1 << 64) - 1 for r in L._occurrences(df).collect()}
    assert got == {i: simhash(norm(t)) for i, t in enumerate(texts)}


def test_one_block_of_many_near_copies(llm_spark):
    """Groups in one block that the chain has joined do not meet again, others do."""
    words = prose(11, 300).split(" ")
    rows = [(i, " ".join(words[:i % 40] + ["extra"] + words[i % 40:])) for i in range(60)]
    rows += [(100 + i, " ".join(words) + " z" * i) for i in range(20)]
    df = llm_spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(rows)
    got = {r["doc_id"]: r["dropped"] for r in L.line_report(df, pieces=6).collect()}
    assert got == {d: ",".join(map(str, want.get((d, t), []))) for d, t in rows}


def measured_recall(spark, docs, low, high):
    """(pairs, share found): of all pairs of distinct lines of low to high
    characters at edit similarity 0.8, by brute force without fingerprints,
    those that the operator puts in one group."""
    lines = L._lines(docs).select("norm", L._lid().alias("lid"), "size").distinct().where(f"size between {low} and {high}")
    a, b = lines.select(F.col("norm").alias("a"), F.col("lid").alias("i")), lines.select(F.col("norm").alias("b"), F.col("lid").alias("j"))
    near = "abs(length(a) - length(b)) <= floor(0.2 * greatest(length(a), length(b)) + 1e-9)"
    want = a.join(b, a["i"] < b["j"]).where(near).where(L._alike("a", "b", 0.8)).select("i", "j").collect()
    own = L.staged(L._occurrences(docs), "lines")
    root = {bytes(r["node"]): r["root"] for r in L.line_components(docs, own).collect()}
    return len(want), np.mean([root.get(bytes(r["i"]), 0) == root.get(bytes(r["j"]), 1) for r in want])


def test_recall_by_length(llm_spark):
    """One word changed in n: found surely in long lines, seldom in short ones, as
    README says; no link is made between lines that are not alike."""
    rng = random.Random(7)
    words = [f"{rng.choice('bcdfg')}{rng.randrange(10 ** 5)}" for _ in range(12_000)]
    for n, least, most in ((12, 0.0, 0.6), (400, 0.8, 1.0)):
        lines = [" ".join(words[i * n:i * n + n]) for i in range(30)]
        rows = [(i, t) for i, t in enumerate(lines)]
        rows += [(100 + i, t.replace(" ", " q", 1)) for i, t in enumerate(lines)]
        docs = llm_spark.createDataFrame(rows, "doc_id long, text string")
        pairs, share = measured_recall(llm_spark, docs, 1, 10_000)
        assert pairs >= 30 and least <= share <= most


def test_fingerprints_stay_code_that_the_jvm_compiles(llm_spark, capsys):
    """HotSpot compiles no method of over 8000 bytes; the one of the fingerprints had 12,267."""
    df = llm_spark.createDataFrame([(1, "one line")], "doc_id long, text string")
    L._occurrences(df).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_counts_at_and_beside_half(llm_spark):
    """Each bit by itself: in half of the hashes, one more, none and all."""
    rows = [(n, [c for c in (0, n // 2, n // 2 + 1, n)]) for n in (1, 2, 3, 126, 127, 128, 1 << 29)]
    got = llm_spark.createDataFrame(rows, "n int, some array<long>").select(
        "n", F.posexplode("some").alias("i", "c")).select("n", "c", *[
            L._simhash(F.expr(f"transform(sequence(0, 31), i -> if(i = {i}, c * {by}L, 0L))"), F.col("n")).alias(f"b{i}_{by}")
            for i in (0, 13, 30, 31) for by in (1, 1 << 32)]).collect()
    for r in got:
        for i in (0, 13, 30, 31):
            bit = i % 4 * 8 + i // 4
            over = 2 * r["c"] > r["n"]
            assert r[f"b{i}_1"] & (1 << 64) - 1 == over << bit
            assert r[f"b{i}_{1 << 32}"] & (1 << 64) - 1 == over << 32 + bit


def test_short_lines_are_counted_without_lambdas(llm_spark):
    """Lambdas are interpreted, word for word; up to SHORT words bits are added instead."""
    sizes = [*range(1, 18), 31, 32, 63, 64, 65, 124, L.SHORT - 1, L.SHORT, L.SHORT + 1, 200, 300]
    texts = [" ".join(f"w{n}x{i}" for i in range(n)) for n in sizes]
    df = llm_spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["sim"] & (1 << 64) - 1 for r in L._occurrences(df).collect()}
    assert got == {i: simhash(t) for i, t in enumerate(texts)}
    many = llm_spark.createDataFrame([(n, [h] * n) for n in (1, 2, 63, L.SHORT) for h in (-1, 0, 1 << 62)], "k int, hashes array<long>")
    assert [r["sim"] for r in L._fingerprints(many, ["k"]).orderBy("k", "sim").collect()] == [-1, 0, 1 << 62] * 4
