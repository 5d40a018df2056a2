import random
import re
import zlib
from collections import Counter

import pytest

from framecurate.llm import spelling as S


def plain_counts(rows, slip, least, often):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= often}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(words, ratio=2):
    form, out = {}, []
    for w, n in words.items():
        near = sorted((-m, v) for v, m in words.items() if one_edit(v, w))
        best = near[0][1] if near and -near[0][0] >= ratio * n else None
        form[w] = best
        out.append((w, best, n, len(near), words.get(best)))

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, f, root(w), n, k, m) for w, f, n, k, m in out)


def grouped(df, ratio=2):
    return sorted((tuple(r) for r in S.group_variants(df, ratio).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])


@pytest.mark.parametrize("letters", ["ab", "abcé", "aàÿxyz"])
def test_groups_equal_brute_force(llm_spark, letters):
    rng = random.Random(len(letters))
    words = {}
    for _ in range(250):
        words["".join(rng.choice(letters) for _ in range(rng.randint(1, 7)))] = rng.choice((3, 3, 4, 6, 12, 24, 50, 100))
    words |= {"a" * 40: 9, "a" * 41: 20, "a" * 42: 41, "日本語": 3, "日本": 7, "日本誤": 6}
    df = llm_spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert grouped(df) == plain_groups(words)


def test_counts_and_long_chains(llm_spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    for slip in (0, 3, 97):
        got = {r["word"]: r["n"] for r in S.count_words(odd_docs, slip=slip, min_chars=2, min_count=1).collect()}
        assert got == plain_counts(rows, slip, 2, 1)
    chain = {"x" * (5 + i): 3 * 2 ** i for i in range(20)}
    df = llm_spark.createDataFrame(list(chain.items()), "word string, n long")
    assert grouped(df) == plain_groups(chain)
    assert {r[2] for r in grouped(df)} == {"x" * 24}


def test_whole_table_equals_brute_force(llm_spark, small_docs):
    rows = [(r["doc_id"], r["text"]) for r in small_docs.select("doc_id", "text").collect()]
    got = S.count_words(small_docs, slip=97)
    words = plain_counts(rows, 97, 5, 3)
    assert {r["word"]: r["n"] for r in got.collect()} == words
    some = dict(sorted(words.items())[::3])
    df = llm_spark.createDataFrame(list(some.items()), "word string, n long")
    assert grouped(df) == plain_groups(some)


def test_empty_and_null(llm_spark, no_docs):
    assert S.count_words(no_docs, slip=97).collect() == []
    none = llm_spark.createDataFrame([], "word string, n long, form string")
    assert grouped(none) == []
    odd = llm_spark.createDataFrame([(None, 5, "f"), ("alpha", None, "f"), ("alphas", 4, "f"), ("", 3, "f"), ("a", 7, "f")],
                                    "word string, n long, form string")
    assert grouped(odd) == plain_groups({"alphas": 4, "": 3, "a": 7})
    with pytest.raises(ValueError):
        S.group_variants(none, ratio=1)
