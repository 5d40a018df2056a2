import random

from framecurate.llm import decontam as D

from texts import LONG, prose  # noqa: E402


def row_by_row(pattern, text):
    """(least distance of the pattern to any stretch of text, first end)."""
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        now = [i]
        for j, x in enumerate(text, 1):
            now.append(min(prev[j] + 1, now[-1] + 1, prev[j - 1] + (c != x)))
        prev = now
    return min(prev), prev.index(min(prev))


def edited(text, n, rng):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(len(out))
        out[at:at + rng.choice((0, 1))] = rng.choice(("", "q", "zz"[:1]))
    return "".join(out)


def test_bit_parallel_distance():
    rng = random.Random(3)
    for _ in range(400):
        p = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        assert D.best_match(p, t) == row_by_row(p, t)


def test_all_matches_are_found(llm_spark, odd_docs, no_docs):
    rng = random.Random(9)
    items = [(i, prose(100 + i, 14 + i)) for i in range(12)] + [(None, prose(300, 20)), (50, prose(100, 14)),
                                                               (60, None), (61, ""), (62, "  "), (63, "Zq")]
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").where("length(text) < 5000 or text is null").collect()]
    for n in range(60):
        i, t = items[rng.randrange(13)]
        t = edited(t.upper() if n % 3 else t, int(len(t) * rng.choice((0, .03, .08, .1, .13))), rng)
        docs.append((1000 + n, prose(n, 30) + rng.choice((" ", "\n\n ")) + t + " " + prose(n + 1, 20)))
    docs.append((2000, LONG + " " + items[3][1] + " " + LONG))
    table = llm_spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = llm_spark.createDataFrame(items, "item_id long, text string")
    want = []
    for d, t in docs:
        t = D.normalise(t)
        for i, p in items:
            p = D.normalise(p)
            if d == 2000:
                if p == D.normalise(items[3][1]):
                    want.append((d, i, 0))
            elif p and (best := row_by_row(p, t)[0]) <= int(0.1 * len(p)):
                want.append((d, i, best))
    for block in (D.BLOCK_CHARS, 200):                # one block and many
        got = D.find_items(table, bench, rate=0.1, block_chars=block).collect()
        rows = [(r["doc_id"], r["item_id"], r["distance"]) for r in got]
        assert sorted([r for r in rows if r[0] != 2000], key=str) == sorted([w for w in want if w[0] != 2000], key=str)
        assert (2000, 3, 0) in rows
        text = dict(docs)
        names = {i: D.normalise(p) for i, p in items if p}
        for r in got:
            if r["item_id"] not in (None, 0, 50):
                part = D.normalise(text[r["doc_id"]])[r["start"]:r["end"]]
                assert row_by_row(names[r["item_id"]], part)[0] == r["distance"]
        kept = D.drop_contaminated(table, bench, rate=0.1, block_chars=block)
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
            str(d) for d, _ in docs if d not in {w[0] for w in rows})
    assert D.drop_contaminated(odd_docs, bench.where("item_id = 3")).columns == odd_docs.columns
    assert D.drop_contaminated(odd_docs, bench.where("1 = 0")).count() == odd_docs.count()
    assert D.find_items(no_docs, bench).collect() == []
