"""Ordered operators against plain Python, with and without splitting."""

import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from helixtab.operators import scan, stats


def table(n=400, seed=1):
    """A third of the rows share one key; one key is null; values repeat."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        out.append((key, i, rng.choice([None, *range(12)])))
    rng.shuffle(out)
    return out


def model(data):
    groups = {}
    for k, i, v in sorted(data, key=lambda r: r[1]):
        g = groups.setdefault(k, [])
        earlier = [x for _, x, *_ in g if x is not None]
        g.append(
            (
                i,
                v,
                sum(x for x in [*earlier, v] if x is not None) if any(x is not None for x in [*earlier, v]) else None,
                max(earlier) if earlier else None,
                g[-1][1] if g else None,
                len(g),
            )
        )
    return sorted(((k, *r) for k, g in groups.items() for r in g), key=repr)


@pytest.mark.parametrize("limit", ["1000000", "5", "120"])
def test_running(spark, limit):
    data = table()
    df = spark.createDataFrame(data, "k string, i int, v int").repartition(7)
    spark.conf.set("helixtab.maxGroupRows", limit)
    try:
        out = scan.running(
            df, "k", "i", s=("sum", F.col("v")), m=("max", F.col("v")), g=("lag", F.col("v")),
            o=("sum", F.lit(1)),
        )
        got = rows(out.select("k", "i", "v", "s", "m", "g", F.col("o") - 1))
    finally:
        spark.conf.unset("helixtab.maxGroupRows")
    assert got == model(data)


@pytest.mark.parametrize("limit", ["1000000", "5"])
def test_global_order(spark, limit):
    df = spark.range(137).repartition(5)
    spark.conf.set("helixtab.maxGroupRows", limit)
    try:
        placed = scan.ordinal(df, "id")
        assert all(r.id == r.ordinal for r in placed.collect())
        chunks = scan.chunk_numbers(df, "id", 5).collect()
        assert all(r.chunk == r.id // 28 + 1 for r in chunks)
        assert {r.chunk for r in scan.fixed_chunks(df, "id", 50).collect()} == {1, 2, 3}
        assert sorted(r.id for r in scan.every_nth(df, "id", 60).collect()) == [0, 60, 120]
    finally:
        spark.conf.unset("helixtab.maxGroupRows")


def test_percentile_rank(spark, small_groups):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,), (None,)], "v double")
    got = rows(scan.percentile_rank(df, "v", "p"))
    assert got == sorted([(1.0, 0.25), (2.0, 0.625), (2.0, 0.625), (3.0, 1.0), (None, None)], key=repr)


@pytest.mark.parametrize("limit", ["1000000", "5"])
def test_quantiles(spark, limit):
    data = table(300, 3)
    df = spark.createDataFrame(data, "k string, i int, v int").where("k is not null")
    spark.conf.set("helixtab.maxGroupRows", limit)
    try:
        got = {r.k: (r.q, r.m) for r in scan.quantiles(df, "k", "v", {"q": 0.25, "m": 0.5}).collect()}
        whole = scan.quantiles(df, (), "v", {"m": 0.5}).first().m
        upper = {r.k: r.u for r in scan.upper_median(df, "k", "v", "u").collect()}
        dist = {r.k: (r.n, r.mean, r.m, r.hi) for r in scan.distribution(df, "k", "v", {"m": 0.5}, {"hi": 6}).collect()}
    finally:
        spark.conf.unset("helixtab.maxGroupRows")
    groups = {}
    for k, _, v in data:
        if k is not None and v is not None:
            groups.setdefault(k, []).append(v)
    for k, vs in groups.items():
        q = statistics.quantiles(vs, n=4, method="inclusive")[0]
        assert got[k] == (q, statistics.median(vs))
        assert upper[k] == sorted(vs)[len(vs) // 2]
        assert dist[k] == (
            len(vs), sum(vs) / len(vs), statistics.median(vs), sum(v >= 6 for v in vs) / len(vs)
        )
    assert whole == statistics.median([v for vs in groups.values() for v in vs])


def test_weighted_quantile(spark):
    df = spark.createDataFrame([(1, 2), (10, 3), (3, 1)], "v int, w int")
    assert scan.quantiles(df, (), "v", {"m": 0.5}, weight="w").first().m == 6.5
    four = spark.createDataFrame([(1,), (2,), (3,), (10,)], "v int")
    assert scan.quantiles(four, (), "v", {"m": 0.5}).first().m == 2.5
    assert scan.upper_median(four, (), "v", "u").first().u == 3


@pytest.mark.parametrize("limit, block", [("1000000", 4096), ("5", 16), ("5", 8)])
def test_rolling_mean(spark, limit, block):
    rng = random.Random(5)
    data = [(k, i, rng.choice([None, 1.0, 2.0, 5.0])) for k, n in (("hot", 90), ("x", 10), ("y", 4)) for i in range(n)]
    df = spark.createDataFrame(data, "k string, i int, v double").repartition(6)
    spark.conf.set("helixtab.maxGroupRows", limit)
    try:
        got = {(r.k, r.i): r.smooth for r in scan.rolling_mean(df, "k", "i", "v", 7, 8, block=block).collect()}
    finally:
        spark.conf.unset("helixtab.maxGroupRows")
    assert len(got) == len(data)
    series = {}
    for k, i, v in data:
        series.setdefault(k, []).append(v)
    for (k, i), smooth in got.items():
        window = [v for v in series[k][max(0, i - 7) : i + 8] if v is not None]
        if len(window) < 8:
            assert smooth is None
        else:
            assert abs(smooth - sum(window) / len(window)) < 1e-9


def test_rank_statistics(spark, small_groups):
    data = [(float(i % 7), float((i * 3) % 11)) for i in range(60)]
    df = spark.createDataFrame(data, "x double, y double")

    def ranks(vs):
        return [sum(w < v for w in vs) + (sum(w == v for w in vs) + 1) / 2 for v in vs]

    def corr(a, b):
        ma, mb = statistics.mean(a), statistics.mean(b)
        cov = sum((p - ma) * (q - mb) for p, q in zip(a, b))
        return cov / (sum((p - ma) ** 2 for p in a) * sum((q - mb) ** 2 for q in b)) ** 0.5

    xs, ys = zip(*data)
    got = stats.correlations(df, "x", "y").first()
    assert abs(got.pearson - corr(xs, ys)) < 1e-9
    assert abs(got.spearman - corr(ranks(xs), ranks(ys))) < 1e-9
    u = stats.rank_sum(df, "x", F.col("y") >= 5).first()
    first = [x for x, y in data if y >= 5]
    rest = [x for x, y in data if y < 5]
    want = sum((a > b) + (a == b) / 2 for a in first for b in rest)
    assert (u.n_first, u.n_rest, u.u) == (len(first), len(rest), want)
    assert abs(u.p_value - 2 * (1 - statistics.NormalDist().cdf(u.z))) < 1e-6
