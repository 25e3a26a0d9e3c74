"""Sums of doubles against exact fractions."""

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from helixtab.functions.sums import exact_sum, exact_total, exact_weighted_sum
from helixtab.operators import profile, rollup, scan

GROUPS = {
    "small": [0.001] * 1000,
    "smaller": [1e-7] * 999 + [0.5],
    "deep": [1e-7, 3e-30, 2.5e-12],
    "large": [1e13, 0.001, -1e13, 0.002],
    "larger": [1e18, 0.1, 0.2, -1e18],
    "digits": [0.1, 0.2, 0.30000000000000004, 123456.789012345],
    "zeros": [0.0, -0.0],
    "nulls": [None, None],
    "mixed": [None, 2.5, -7.25],
    "beyond": [1e300, 2.0, -1e299],
}


def decimal_sum(values, times=None):
    """As decimals of the shortest digits, added exactly."""
    kept = [(Fraction(repr(v)), n) for v, n in zip(values, times or [1] * len(values)) if v is not None]
    return float(sum(v * n for v, n in kept)) if kept else None


@pytest.fixture(scope="module")
def rows(spark):
    data = [(g, v, 1 + (k * 7919) % 5) for g, values in GROUPS.items() for k, v in enumerate(values)]
    return spark.createDataFrame(data, "g string, v double, n long").repartition(7)


def test_sums(rows):
    got = {r.g: r for r in rows.groupBy("g").agg(exact_sum(F.col("v")).alias("s"), exact_weighted_sum(F.col("v"), F.col("n")).alias("w")).collect()}
    for g, values in GROUPS.items():
        times = [1 + (k * 7919) % 5 for k in range(len(values))]
        for found, want in ((got[g].s, decimal_sum(values)), (got[g].w, decimal_sum(values, times))):
            if g in ("deep", "beyond"):  # added as doubles
                assert math.isclose(found, want, rel_tol=1e-15)
            else:
                assert found == want, g


def test_sums_of_what_is_no_number(spark):
    data = [("nan", math.nan), ("nan", 1.0), ("inf", math.inf), ("inf", 1.0), ("both", math.inf), ("both", -math.inf)]
    found = spark.createDataFrame(data, "g string, v double").groupBy("g").agg(exact_sum(F.col("v")).alias("s")).collect()
    got = {r.g: r.s for r in found}
    assert got["inf"] == math.inf and math.isnan(got["nan"]) and math.isnan(got["both"])
    assert spark.createDataFrame([], "v double").agg(exact_sum(F.col("v")).alias("s")).first().s is None


def test_total_beyond_the_decimals(spark):
    many = spark.range(2000).select(F.lit(9e18).alias("v"), F.lit(10**6).alias("n"))
    found = many.agg(exact_sum(F.col("v")).alias("s"), exact_weighted_sum(F.col("v"), F.col("n")).alias("w")).first()
    assert math.isclose(found.s, 1.8e22, rel_tol=1e-12) and math.isclose(found.w, 1.8e28, rel_tol=1e-12)


def test_means_keep_their_digits(spark, rows):
    """Means of values far from two digits after the point: of a profile, of text cells, of a distribution and of groups."""
    few = rows.where("g in ('small', 'smaller', 'large')")
    want = {g: decimal_sum(GROUPS[g]) / len(GROUPS[g]) for g in ("small", "smaller", "large")}
    means = {r.g: r.mean for r in scan.distribution(few, "g", "v", {"median": 0.5}).collect()}
    assert means == pytest.approx(want, rel=1e-14)
    wide = spark.createDataFrame([("1e-7", "1e12"), ("3e-7", "2e12"), ("x", "")], "a string, b string")
    cells = {r["column"]: r["mean"] for r in profile.mean_and_invalid(wide, ["a", "b"]).collect()}
    assert cells == pytest.approx({"a": 2e-7, "b": 1.5e12}, rel=1e-14)
    measures = profile.numbers(few, "t", ["v"])
    got = profile.measured_profile([(few, measures)]).collect()[0]
    whole = [v for g in want for v in GROUPS[g]]
    assert float(got["mean"]) == pytest.approx(decimal_sum(whole) / len(whole), rel=1e-12)
    assert rollup.exact_sum is exact_sum


def test_total_of_a_row(spark):
    """The columns of a row are added as the rows of a group are."""
    cells = [0.1, 0.2, 0.3, 1e-7, -1e-7, 1e19, 1e300, 1 / 3, None, float("inf"), 0.0, 65536.5]
    df = spark.createDataFrame([(i * 12 + j, a, b, 0.7 if i % 2 else None) for i, a in enumerate(cells) for j, b in enumerate(cells)], "k int, a double, b double, c double")
    across = df.select("k", exact_total(F.col("a"), F.col("b"), F.col("c")).alias("t"))
    long = df.select("k", F.explode(F.array("a", "b", "c")).alias("x")).groupBy("k").agg(exact_sum(F.col("x")).alias("t"))
    assert {r.k: r.t for r in across.collect()} == {r.k: r.t for r in long.collect()}
