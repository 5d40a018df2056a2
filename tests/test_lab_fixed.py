"""P24 in integers against the float form."""
from pyspark.sql import functions as F

from framecurate.operators import images as im
from framecurate.operators import lab_fixed as lf


def _worst(df, one, other, fields):
    d = df.select(one.alias("p"), other.alias("q"))
    return d.agg(*[F.max(F.abs(F.col(f"p.{c}") - F.col(f"q.{c}"))).alias(c) for c in fields]).first()


def _cube(spark, step):
    n = (255 // step) + 1
    i = F.col("id")
    pick = lambda v: (F.floor(v) % n * step).cast("int")
    return spark.range(n ** 3).select(pick(i).alias("c1"), pick(i / n).alias("c2"), pick(i / (n * n)).alias("c3"))


def test_to_lab_within_one(spark):
    dark = spark.range(32 ** 3).select(*[(F.floor(F.col("id") / 32 ** k) % 32).cast("int").alias(f"c{k + 1}") for k in range(3)])
    for df in (_cube(spark, 3), dark):
        worst = _worst(df, lf.bgr_to_lab_fixed("c1", "c2", "c3"), im.bgr_to_lab("c1", "c2", "c3"), "lab")
        assert max(worst) <= 1


def test_to_bgr_within_one(spark):
    worst = _worst(_cube(spark, 3), lf.lab_to_bgr_fixed("c1", "c2", "c3"), im.lab_to_bgr("c1", "c2", "c3"), "bgr")
    assert max(worst) <= 1


def test_greys_and_nulls(spark):
    df = spark.createDataFrame([(0, 0, 0), (255, 255, 255), (None, 1, 1)], "c1 int, c2 int, c3 int")
    rows = [r.lab for r in df.select(lf.bgr_to_lab_fixed("c1", "c2", "c3").alias("lab")).collect()]
    assert tuple(rows[0]) == (0, 128, 128) and tuple(rows[1]) == (255, 128, 128)
    back = df.select(lf.lab_to_bgr_fixed(F.lit(255), F.lit(128), F.lit(128)).alias("c")).first().c
    assert tuple(back) == (255, 255, 255)


def test_tables_are_literals(spark):
    # the tables are folded before the job runs, not split again for every row
    plan = _cube(spark, 51).select(lf.bgr_to_lab_fixed("c1", "c2", "c3").alias("lab")) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan
