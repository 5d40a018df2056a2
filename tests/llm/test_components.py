import random

from framecurate.llm.components import connected_components


def test_components_of_random_graphs_chains_and_stars(llm_spark):
    rng = random.Random(8)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(3000, 3000 + i) for i in range(1, 80)]
    links += [(5, 5), (None, 7), (8, None), (1000, 1001)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        if a is not None and b is not None and a != b:
            hi, lo = sorted((find(a), find(b)), reverse=True)
            root[hi] = lo
    df = llm_spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(df, "t").collect()}
    assert got == {x: find(x) for x in list(root)}
    assert connected_components(df.where("a < 0"), "t").collect() == []
