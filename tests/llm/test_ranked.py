import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from framecurate.llm import ranked as R
from texts import LONG, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    length = sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c in counts:
            n, s = sum(c.values()), 0
            for w in terms(text):
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    m = 75 + 25 * n * n_docs // length
                    s += weight * (10 ** 9 * c[w] // (1000 * c[w] + 12 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def run(docs, items, **more):
    return sorted((tuple(r) for r in R.rank_documents(docs, items, **more).collect()), key=str)


ITEMS = [(1, prose(2, 12)), (2, "Alpha beta, ALPHA gamma!"), (2, "Alpha beta, ALPHA gamma!"), (3, None), (4, ""), (5, "~~~ ..."),
         (6, "unheard-of"), (7, "日本語 ümlaut 3² alpha"), (None, "kappas lambda"), (8, LONG), (9, "the " * 50 + "alpha " * 3)]


@pytest.mark.parametrize("sizes", [{}, {"chunk_docs": 3, "bundle_items": 2, "k": 3}, {"stages": 1, "k": 1}, {"stages": 7, "chunk_docs": 5, "k": 2}])
def test_odd_documents(llm_spark, odd_docs, sizes):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    items = llm_spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("term", F.lit("clash"))
    assert run(odd_docs, items, **sizes) == brute(rows, ITEMS, sizes.get("k", 20))


def test_many_ties_and_pruning(llm_spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(vocab[min(59, int(rng.expovariate(0.12)))] for _ in range(n))
    docs = [(i, text(rng.randint(0, 40))) for i in range(400)] + [(1000 + i, "w50 w51 w52 w0") for i in range(200)]
    items = [(i, text(10)) for i in range(30)] + [(99, "w50 w0 w0")]
    got = run(llm_spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
              llm_spark.createDataFrame(items, "item_id long, text string"), chunk_docs=64, bundle_items=8)
    assert got == brute(docs, items)


def test_whole_table_equals_brute_force(llm_spark, small_docs):
    rows = [(r["doc_id"], r["text"]) for r in small_docs.select("doc_id", "text").collect()]
    items = llm_spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    asked = [(r["item_id"], r["text"]) for r in items.collect()]
    assert run(small_docs, items) == brute(rows, asked)


def test_empty_tables(llm_spark, no_docs, small_docs):
    items = llm_spark.createDataFrame(ITEMS, "item_id long, text string")
    assert run(no_docs, items) == []
    assert run(small_docs, items.where("1 = 0")) == []
    assert run(small_docs, items.where("item_id = 3")) == []
