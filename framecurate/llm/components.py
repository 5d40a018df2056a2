"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecurate.llm.common import staged
from framecurate.session import discard


def _large_star(e: DataFrame) -> DataFrame:
    """Every neighbour above u is linked to the least of u and its neighbours."""
    sym = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = sym.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (sym.where("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """u and its neighbours below are linked to the least of them."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (hung.unionByName(low.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct())


def connected_components(links: DataFrame, tag: str) -> DataFrame:
    """Links (a, b) between orderable node ids -> (node, root), root being the
    least node reachable, for every node that has a link to another node.

    Null ends and loops are ignored; an empty link table gives an empty result.
    Each round is written to the shared folder and the one before it removed, so
    lineage stays short and a lost executor costs one round at most.  The minimum per node is combined
    before the shuffle, and joins on a hub's id are ones AQE can split.  The
    driver sees only a count and a checksum a round.
    """
    e = staged(links.select("a", "b").where("a <> b").distinct(), f"{tag}-links")
    mark = None
    while True:
        before, e = e, staged(_small_star(_large_star(e)), f"{tag}-round")
        discard(before)
        now = e.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if not now["n"] or tuple(now) == mark:
            break
        mark = tuple(now)
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
