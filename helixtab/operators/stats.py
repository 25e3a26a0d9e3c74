"""Correlation and rank statistics (A-40)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.operators.scan import average_rank, running
from helixtab.workspace import stage


def correlations(df: DataFrame, x: str, y: str) -> DataFrame:
    """A-40: linear and rank correlation of two numeric columns over rows that have both."""
    both = df.select(x, y).dropna()
    ranked = average_rank(average_rank(both, x, "_rx"), y, "_ry")
    return ranked.agg(
        F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("pearson"), F.corr("_rx", "_ry").alias("spearman")
    )


def rank_sum(df: DataFrame, value: str, in_first: Column) -> DataFrame:
    """A-40: rank-sum U of a group against the rest, its z and two-sided p by the normal approximation.

    Ranks are averages over ties and the variance is corrected for them.
    """
    rows = df.where(F.col(value).isNotNull()).select(value, in_first.alias("_first"))
    counts = stage(
        rows.groupBy(value).agg(F.count(F.lit(1)).alias("_n"), F.count_if("_first").alias("_n1")),
        "values",
    )
    cum = running(counts, (), value, _cum=("sum", F.col("_n")))
    rank = F.col("_cum") - F.col("_n") + (F.col("_n") + 1) / 2
    n, n1 = F.col("_n").cast("double"), F.col("_n1").cast("double")
    sums = cum.agg(
        F.sum(n).alias("_n"),
        F.sum(n1).alias("n_first"),
        F.sum(rank * n1).alias("_r1"),
        F.sum(n * n * n - n).alias("_ties"),
    ).withColumn("n_rest", F.col("_n") - F.col("n_first"))
    u = F.col("_r1") - F.col("n_first") * (F.col("n_first") + 1) / 2
    mean = F.col("n_first") * F.col("n_rest") / 2
    var = (
        F.col("n_first") * F.col("n_rest") / 12
        * ((F.col("_n") + 1) - F.col("_ties") / (F.col("_n") * (F.col("_n") - 1)))
    )
    shifted = F.greatest(F.abs(u - mean) - 0.5, F.lit(0.0))
    return (
        sums.withColumn("u", u)
        .withColumn("z", F.when(var > 0, shifted / F.sqrt(var)))
        .withColumn("p_value", _two_sided(F.col("z")))
        .select(
            F.col("n_first").cast("bigint").alias("n_first"),
            F.col("n_rest").cast("bigint").alias("n_rest"),
            "u", "z", "p_value",
        )
    )


def _two_sided(z: Column) -> Column:
    """Two-sided normal tail, by a rational Chebyshev fit of erfc (relative error below 1.2e-7)."""
    x = z / F.lit(2.0**0.5)
    t = 1 / (1 + x / 2)
    # Coefficients of the published fit, constant term first.
    coefficients = [
        -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
        0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
    ]
    poly = F.lit(0.0)
    for c in reversed(coefficients):
        poly = poly * t + c
    return t * F.exp(-x * x + poly)
