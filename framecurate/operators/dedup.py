"""Deterministic deduplication (W1 first-wins, W2 last-wins).

Both are single aggregations keyed on the dedup key with ``min_by``/``max_by``
over an explicit ordering struct: the partial aggregate runs before the
shuffle (map-side combine), so a hot key sends one row per map task, never all
of its duplicates.  ``dropDuplicates`` is not used: its winner is arbitrary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, key: str, order: list[str], keep_null_keys: bool = False) -> DataFrame:
    """Keep, per ``key``, the row with the smallest ``order`` tuple.

    Rows whose key is NULL are dropped (the reference skips them)."""
    cols = [c for c in df.columns if c != key]
    src = df if keep_null_keys else df.where(F.col(key).isNotNull())
    ordering = F.struct(*[F.col(c) for c in order])
    row = F.struct(*[F.col(c) for c in cols])
    agg = src.groupBy(key).agg(F.min_by(row, ordering).alias("__r"))
    return agg.select(key, *[F.col("__r")[c].alias(c) for c in cols])


def union_with_merged(tasks: DataFrame, merged: DataFrame, cols: list[str]) -> DataFrame:
    """Exported and merged tasks in one table, told apart by ``source``."""
    return tasks.select(F.lit("export").alias("source"), *cols).unionByName(
        merged.select(F.lit("merged").alias("source"), *cols))


def dedup_last(df: DataFrame, key: str, order: list[str], keys_not_null: bool = False) -> DataFrame:
    """Keep, per ``key``, the row with the largest ``order`` tuple (overwrite semantics).

    ``keys_not_null`` skips the NULL-key filter when the caller guarantees it
    (keeps a computed key expression from being inlined a second time)."""
    cols = [c for c in df.columns if c != key]
    ordering = F.struct(*[F.col(c) for c in order])
    row = F.struct(*[F.col(c) for c in cols])
    src = df if keys_not_null else df.where(F.col(key).isNotNull())
    agg = src.groupBy(key).agg(F.max_by(row, ordering).alias("__r"))
    return agg.select(key, *[F.col("__r")[c].alias(c) for c in cols])
