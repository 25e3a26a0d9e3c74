"""Set operations on id lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_ids(lists: Sequence[DataFrame]) -> DataFrame:
    """U-01."""
    return reduce(DataFrame.union, lists).distinct()


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """U-02: distinct rows of ``a`` that are not in ``b``."""
    return a.subtract(b)


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """U-03: rows in both."""
    return a.intersect(b)


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    """U-04: all rows of all parts, matched by column name."""
    return reduce(DataFrame.unionByName, parts)


def keep_existing(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """U-07: existing rows stay; of the new ones only those with another key are added."""
    return existing.unionByName(new.join(existing.select(key), key, "left_anti").select(existing.columns))


def overlap_report(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Sizes of both lists, their overlap and what only one of them has."""
    x = a.select(key).distinct().withColumn("_a", F.lit(True))
    y = b.select(key).distinct().withColumn("_b", F.lit(True))
    return x.join(y, key, "full_outer").agg(
        F.count("_a").alias("n_first"),
        F.count("_b").alias("n_second"),
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("n_both"),
        F.count_if(F.col("_b").isNull()).alias("n_only_first"),
        F.count_if(F.col("_a").isNull()).alias("n_only_second"),
    )
