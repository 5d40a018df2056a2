"""J1/J2 against stored lookups: the inventory and the labeled names as tables
bucketed by their join key.

Both are asked again with every labeling run, and both grow with all images ever
taken, where a run's captures do not.  Stored once in buckets, they are read in
place: a run shuffles its captures to the buckets, never the stored side.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecurate.session import folder


def store_bucketed(df: DataFrame, key: str, buckets: int, name: str | None = None,
                   path: str | None = None) -> DataFrame:
    """``df`` as a table in ``buckets`` buckets of ``key``, sorted within them; read back.

    ``path`` is a folder on shared storage (default: a new one in the shared
    checkpoint folder), ``name`` the catalog's name for it (default: a new one).
    Choose as many buckets as the session has shuffle partitions, or more: with
    fewer, Spark may prefer to shuffle the table after all.  Rows are hashed to
    one file a bucket; rows of null key are stored like others."""
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    path = path or folder(spark, "bucketed")
    df.repartition(buckets, F.col(key)).write.bucketBy(buckets, key).sortBy(key) \
        .option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def store_inventory(inventory: DataFrame, buckets: int, **where) -> DataFrame:
    """J1's lookup: one row an image path, of several listed sizes the greatest."""
    one = inventory.groupBy("path").agg(F.max(F.struct("width", "height")).alias("s"))
    return store_bucketed(one.select("path", "s.width", "s.height"), "path", buckets, **where)


def store_labeled(labeled: DataFrame, buckets: int, **where) -> DataFrame:
    """J2's lookup: every labeled filename once."""
    return store_bucketed(labeled.select("filename").where(F.col("filename").isNotNull()).distinct(),
                          "filename", buckets, **where)
