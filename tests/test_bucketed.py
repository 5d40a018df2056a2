"""J1/J2 on stored lookups: the large side is read in place."""
import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from framecurate.plans import bucketed as bk
from framecurate.plans import labeling as lb


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def _exchanged(plan):
    """Columns that the plan's exchanges hash by (before a run: afterwards two plans are shown)."""
    return re.findall(r"Exchange hashpartitioning\((\w+)#", plan)


def _tables(spark):
    inv = spark.range(300).select(F.concat(F.lit("/d/i"), F.col("id") % 250, F.lit(".jpg")).alias("path"),
                                  F.when(F.col("id") % 7 == 0, -1).otherwise(F.col("id").cast("int")).alias("width"),
                                  F.lit(10).alias("height"))
    lab = spark.range(200).select(F.when(F.col("id") != 3, F.concat(F.lit("i"), F.col("id") % 60 * 3, F.lit(".jpg")))
                                  .alias("filename"))
    cap = spark.range(500).select(F.col("id").alias("frame_id"),
                                  F.concat(F.lit("/d/i"), F.col("id") % 330, F.lit(".jpg")).alias("full_frame"))
    return inv, lab, cap


def test_outcomes_as_without_buckets(spark, no_broadcast):
    inv, lab, cap = _tables(spark)
    want = lb.classify_captures(cap, inv, lab)
    got = lb.classify_captures(cap, bk.store_inventory(inv, 4), bk.store_labeled(lab, 4))
    # only captures move: once to the inventory's buckets, once to the names'
    assert sorted(_exchanged(_plan(got))) == ["filename", "full_frame"]
    assert len(_exchanged(_plan(want))) == 4
    key = lambda df: sorted(tuple(r) for r in df.select("frame_id", "full_frame", "width", "outcome").na.fill(-9).collect())
    assert key(got) == key(want)
    assert {r.outcome for r in got.collect()} == {"error", "skipped", "exported"}


def test_queue_reads_names_in_place(spark, no_broadcast):
    _, lab, cap = _tables(spark)
    images = cap.select("frame_id", F.substring("full_frame", 4, 99).alias("filename"))
    got = lb.unlabeled(images, bk.store_labeled(lab, 4))
    assert len(_exchanged(_plan(got))) == 1
    assert sorted(r.frame_id for r in got.collect()) == sorted(r.frame_id for r in lb.unlabeled(images, lab).collect())


def test_empty_lookup(spark):
    _, lab, cap = _tables(spark)
    images = cap.select("frame_id", F.substring("full_frame", 4, 99).alias("filename"))
    assert lb.unlabeled(images, bk.store_labeled(lab.limit(0), 4)).count() == 500
