"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framecurate.session import checkpoint_dir, ship_package


def prepare(spark: SparkSession) -> None:
    """Session settings every operator here relies on: the package on the
    Python workers, and Arrow batches bounded by bytes as well as rows."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder named by spark.checkpoint.dir."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and
    survives the loss of executors."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_buckets(docs: DataFrame, key: str, n: int) -> list[int]:
    """Up to n-1 ascending cut values that split the rows by `key` into about
    equal parts.  Reads the key column only; the driver gets n-1 numbers."""
    if n < 2:
        return []
    cuts = docs.stat.approxQuantile(key, [i / n for i in range(1, n)], 0.25 / n)
    return sorted({int(c) for c in cuts or []})


def bucket_of(key, cuts: list[int]):
    """Number of cuts <= key (0 for a null key): ascending ranges of the key."""
    @F.arrow_udf("int")
    def bucket(ids: pa.Array) -> pa.Array:
        at = np.searchsorted(np.array(cuts, np.int64), ids.fill_null(0).to_numpy(zero_copy_only=False), side="right")
        return pa.array(at.astype(np.int32), mask=ids.is_null().to_numpy(zero_copy_only=False)).fill_null(0)

    return bucket(key) if cuts else F.lit(0)
