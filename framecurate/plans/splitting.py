"""Train/val/test split (E3: S5, J3, W3, A5, K8, K9, S6).

The seeded shuffle is a hash order: ``k = md5('{seed}:{stem}')``.  A global
row number over k would be one task, so it is built from 16^d hash-prefix
buckets: count per bucket (a tiny aggregate), prefix-sum those counts,
broadcast them back (size bounded by 16^d, not by the data) and add the
row number within the bucket.  Buckets are uniform by construction, so a
skewed source cannot make one of them hot.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framecurate.functions.classes import CLASS_NAMES
from framecurate.functions.naming import file_name, file_stem

# Fixed values of the split layout.
SPLIT_DIRS = {"train": "train/images", "val": "val/images", "test": "test/images"}
DEFAULT_RATIOS = (0.8, 0.1, 0.1)
DEFAULT_SEED = 42


def image_samples(images: DataFrame) -> DataFrame:
    """Only ``*.jpg`` (case-sensitive) names; stem and path."""
    return images.where(F.col("path").endswith(".jpg")) \
                 .select(file_stem("path").alias("stem"), F.col("path").alias("image_path"))


def pair_samples(images: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stem, image_path, label_path) for images whose ``{stem}.txt`` exists,
    plus a warnings frame for images without a label."""
    img = image_samples(images)
    lab = labels.select(F.col("path").alias("label_path"), file_name("path").alias("__n")) \
                .where(F.col("__n").endswith(".txt")) \
                .select(F.regexp_replace("__n", r"\.txt$", "").alias("stem"), "label_path")
    pairs = img.join(lab, "stem", "inner")
    missing = img.join(lab, "stem", "left_anti").select(
        F.lit("split").alias("stage"), F.col("stem").alias("key"),
        F.lit("no label").alias("reason"), F.col("image_path").alias("detail"))
    return pairs, missing


def seeded_split(samples: DataFrame, ratios=DEFAULT_RATIOS, seed: int = DEFAULT_SEED,
                 key: str = "stem", hex_digits: int = 3) -> DataFrame:
    """Reproducible split; counts are ``int(n*r_train)``, ``int(n*r_val)``, rest test."""
    if not 1 <= hex_digits <= 5:
        raise ValueError("hex_digits must be 1..5 (the broadcast bucket table has 16^hex_digits rows)")
    r_train, r_val, r_test = (float(r) for r in ratios)
    if abs(r_train + r_val + r_test - 1.0) >= 1e-6:
        raise ValueError("Split ratios must sum to 1.0")
    k = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    # non-nullable bucket key: no inferred isnotnull filter makes the two
    # branches below differ, so their shuffle is shared (ReusedExchange)
    s = samples.withColumn("__k", F.coalesce(k, F.lit(""))) \
               .withColumn("__b", F.coalesce(F.substring("__k", 1, hex_digits), F.lit("")))
    # rank inside each hash bucket first; the bucket counts are then read from
    # the same (reused) exchange, so the samples are computed only once
    within = s.withColumn("__r", F.row_number().over(Window.partitionBy("__b").orderBy("__k", key)) - 1)
    counts = within.groupBy("__b").agg((F.max("__r") + 1).alias("__nb"))
    # ≤ 16^hex_digits rows: the prefix sum runs on a bounded table
    w = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("__b", F.coalesce(F.sum("__nb").over(w), F.lit(0)).alias("__base"),
                          F.sum("__nb").over(Window.partitionBy()).alias("__n"))
    ranked = within.join(F.broadcast(bases), "__b").withColumn("__rn", F.col("__base") + F.col("__r"))
    n = F.col("__n").cast("double")
    n_train = F.floor(n * F.lit(r_train)).cast("long")
    n_val = F.floor(n * F.lit(r_val)).cast("long")
    split = F.when(F.col("__rn") < n_train, F.lit("train")) \
             .when(F.col("__rn") < n_train + n_val, F.lit("val")).otherwise(F.lit("test"))
    return ranked.withColumn("split", split).drop("__k", "__b", "__base", "__n", "__rn", "__r")


def split_counts(split_df: DataFrame) -> DataFrame:
    """A5."""
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def manifest(spark: SparkSession, output_dir: str, classes=None) -> DataFrame:
    """K9: one-row manifest; ``path`` absolute, ``nc = len(names)``."""
    names = list(classes or CLASS_NAMES)
    row = (os.path.abspath(output_dir), SPLIT_DIRS["train"], SPLIT_DIRS["val"], SPLIT_DIRS["test"],
           len(names), names)
    return spark.createDataFrame([row], "path string, train string, val string, test string, "
                                        "nc int, names array<string>")


def with_root(manifest_df: DataFrame, path: str) -> DataFrame:
    """Relocate a manifest; every other key unchanged."""
    return manifest_df.withColumn("path", F.lit(path))


def write_split(split_df: DataFrame, path: str) -> None:
    """K8: overwrite the split table partitioned by split (no stale samples)."""
    split_df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_manifest(manifest_df: DataFrame, path: str) -> None:
    manifest_df.coalesce(1).write.mode("overwrite").json(path)
