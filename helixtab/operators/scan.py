"""Ordered operators that stay balanced when one group holds most of the rows.

A window partitioned by a key puts each key into one task.  That is right as long as no key is large,
and a count per key tells.  The rows of keys above the limit go another way: they are sorted over the
whole cluster, each row notes the sorted slice it fell into, values are scanned inside every
(slice, key) piece, and one value per slice is carried into the next.  A key of any size is cut into
as many pieces as it needs, and the carried table has at most one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixtab.functions.sums import exact_weighted_sum
from helixtab.workspace import stage

LIMIT_CONF = "helixtab.maxGroupRows"
DEFAULT_LIMIT = 5_000_000

_SLICE = "_slice"
_FIRST = "_first"
Scans = dict[str, tuple[str, Column]]


def _names(cols: Sequence[str] | str) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def max_group_rows(spark: SparkSession) -> int:
    """Rows of one key that a single task may hold."""
    return int(spark.conf.get(LIMIT_CONF, str(DEFAULT_LIMIT)))


def _small_table(df: DataFrame) -> bool:
    """May a window without a key, which is one task, hold the table?

    The share is far below that of a key, as nothing else runs beside such a task.
    """
    return df.count() <= max_group_rows(df.sparkSession) // 50


def _same_keys(a: str, b: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return cond


def running(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str] | str,
    *,
    row_weight: int = 1,
    **scans: tuple[str, Column],
) -> DataFrame:
    """Running values within ``keys`` in ``order``, one output column per keyword.

    Each scan is ``(kind, column)`` with kind ``sum`` (inclusive running total), ``max`` (running
    maximum of the earlier rows, null for the first) or ``lag`` (value of the row before).
    ``order`` must be unique within a key for a repeatable result.  ``row_weight`` tells how many rows
    a later step makes of one, which lowers the number of rows a task may hold.
    """
    keys, order = _names(keys), _names(order)
    unknown = {kind for kind, _ in scans.values()} - {"sum", "max", "lag"}
    if unknown:
        raise ValueError(f"unknown scan kinds {unknown}")
    if not keys:
        return (_one_window if _small_table(df) else _sliced)(df, [], order, scans)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # no more rows than the table has limits in it
    heavy = counts.where(F.col("_n") * row_weight > max_group_rows(df.sparkSession)).select(*keys)
    if heavy.isEmpty():
        return _one_window(df, keys, order, scans)
    heavy = stage(heavy, "heavy-keys")
    same = _same_keys("d", "h", keys)
    light = df.alias("d").join(heavy.alias("h"), same, "left_anti")
    large = df.alias("d").join(heavy.alias("h"), same, "left_semi")
    return _one_window(light, keys, order, scans).unionByName(_sliced(large, keys, order, scans))


def _local(kind: str, c: Column, window) -> Column:
    if kind == "sum":
        return F.sum(c).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if kind == "max":
        return F.max(c).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.lag(c).over(window)


def _one_window(df: DataFrame, keys: list[str], order: list[str], scans: Scans) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({n: _local(kind, c, window) for n, (kind, c) in scans.items()})


def _sliced(df: DataFrame, keys: list[str], order: list[str], scans: Scans) -> DataFrame:
    inputs = {f"_in_{n}": c for n, (_, c) in scans.items()}
    ranged = df.withColumns(inputs).orderBy(*keys, *order)
    # written once, so that both uses below see the same slices
    rows = stage(ranged.withColumn(_SLICE, F.spark_partition_id()), "slices")

    piece = Window.partitionBy(_SLICE, *keys).orderBy(*order)
    scanned = rows.withColumns(
        {
            _FIRST: F.row_number().over(piece) == 1,
            **{n: _local(kind, F.col(f"_in_{n}"), piece) for n, (kind, _) in scans.items()},
        }
    )

    # One row per (slice, key).  Only a key that continues from an earlier slice carries anything
    # in, and a slice has at most one such key, so the table kept has at most one row per slice.
    total = {
        "sum": F.sum,
        "max": F.max,
        "lag": lambda c: F.max_by(c, F.struct(*order)),
    }
    pieces = rows.groupBy(_SLICE, *keys).agg(
        *[total[kind](F.col(f"_in_{n}")).alias(f"_c_{n}") for n, (kind, _) in scans.items()]
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    carry_over = {"sum": F.sum, "max": F.max, "lag": F.last}
    carry = (
        pieces.withColumns(
            {
                "_has": F.count(F.lit(1)).over(earlier) > 0,
                **{
                    f"_k_{n}": carry_over[kind](F.col(f"_c_{n}")).over(earlier)
                    for n, (kind, _) in scans.items()
                },
            }
        )
        .where("_has")
        .select(_SLICE, *keys, *[f"_k_{n}" for n in scans])
    )
    same = _same_keys("s", "c", [_SLICE, *keys])
    joined = scanned.alias("s").join(F.broadcast(carry).alias("c"), same, "left")
    out: list[Column] = [F.col(f"s.{c}") for c in df.columns]
    for name, (kind, _) in scans.items():
        here, before = F.col(f"s.{name}"), F.col(f"c._k_{name}")
        if kind == "sum":
            # a sum that has met no value yet stays null
            both = F.coalesce(here + before, here, before)
        elif kind == "max":
            both = F.greatest(here, before)
        else:
            both = F.when(F.col(f"s.{_FIRST}"), before).otherwise(here)
        out.append(both.alias(name))
    return joined.select(*out)


def ordinal(
    df: DataFrame,
    order: Sequence[str] | str,
    keys: Sequence[str] | str = (),
    name: str = "ordinal",
) -> DataFrame:
    """0-based position of every row in ``order``, within ``keys`` if any are given."""
    keys = _names(keys)
    if not keys and not _small_table(df):
        return _global_ordinal(df, _names(order), name)
    ranked = running(df, keys, order, **{name: ("sum", F.lit(1).cast("bigint"))})
    return ranked.withColumn(name, F.col(name) - 1)


def _global_ordinal(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Position over the whole table: place in the sorted slice plus the rows of earlier slices.

    The generated id holds the slice in its upper and the place in its lower 33 bits, so no second
    sort is needed; the offsets have one row per slice.
    """
    rows = stage(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), "sorted")
    slice_no = F.shiftright("_mid", 33)
    sizes = rows.groupBy(slice_no.alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_s", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    place = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        rows.withColumn("_s", slice_no)
        .join(F.broadcast(offsets), "_s")
        .withColumn(name, F.col("_off") + place)
        .drop("_s", "_off", "_mid")
    )


def chunk_numbers(df: DataFrame, order: Sequence[str] | str, n_chunks: int) -> DataFrame:
    """W-12: contiguous chunks of ceil(n / n_chunks) rows, numbered from 1."""
    size = F.ceil(F.lit(df.count()) / F.lit(n_chunks)).cast("bigint")
    return (
        ordinal(df, order)
        .withColumn("chunk", (F.floor(F.col("ordinal") / size) + 1).cast("int"))
        .drop("ordinal")
    )


def fixed_chunks(df: DataFrame, order: Sequence[str] | str, rows_per_chunk: int) -> DataFrame:
    """K-04: contiguous chunks of a fixed number of rows, numbered from 1."""
    return (
        ordinal(df, order)
        .withColumn("chunk", (F.floor(F.col("ordinal") / rows_per_chunk) + 1).cast("int"))
        .drop("ordinal")
    )


def every_nth(df: DataFrame, order: Sequence[str] | str, stride: int = 60) -> DataFrame:
    """W-15: systematic sample, the first row and every ``stride``-th after it."""
    return ordinal(df, order).where(F.col("ordinal") % stride == 0).drop("ordinal")


def hashed_nth(df: DataFrame, key: Column, stride: int = 60) -> DataFrame:
    """W-15, the form without a sort: a repeatable sample by hash of the row key."""
    return df.where(F.pmod(F.xxhash64(key), F.lit(stride)) == 0)


def _value_counts(df: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Occurrences of each value per key; all ordered statistics start from these."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("_n"))


def percentile_rank(df: DataFrame, value: str, name: str = "pct_rank") -> DataFrame:
    """W-07: average-tie rank divided by the number of non-null values; null stays null.

    Values are counted first, so the sort runs over distinct values only.
    """
    counts = stage(_value_counts(df, [], value), "values")
    ranked = running(counts, (), value, _cum=("sum", F.col("_n")))
    total = counts.agg(F.sum("_n")).scalar()
    ranks = ranked.select(
        F.col(value).alias("_v"),
        ((F.col("_cum") - F.col("_n") + (F.col("_n") + 1) / 2) / total).alias(name),
    )
    return df.join(ranks, F.col(value) == F.col("_v"), "left").drop("_v")


def average_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Average-tie rank (1-based) of a non-null column, by way of distinct values."""
    counts = stage(_value_counts(df, [], value), "values")
    ranked = running(counts, (), value, _cum=("sum", F.col("_n")))
    ranks = ranked.select(
        F.col(value).alias("_v"),
        (F.col("_cum") - F.col("_n") + (F.col("_n") + 1) / 2).alias(name),
    )
    return df.join(ranks, F.col(value) == F.col("_v")).drop("_v")


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str] | str,
    value: str,
    half: int = 7,
    min_count: int = 8,
    name: str = "smooth",
    block: int = 4096,
) -> DataFrame:
    """W-09: centred mean over 2*half+1 rows, null below ``min_count`` values.

    Rows are cut into blocks by position; each block also receives the ``half`` rows beyond its
    two edges, so the frame never needs more than one block and a key of any length is split.
    """
    keys = _names(keys)
    ranked = ordinal(df, order, keys, "_i")
    home = F.floor(F.col("_i") / block)
    spread = ranked.withColumn(
        "_b",
        F.explode(
            F.array_distinct(
                F.array(
                    F.floor((F.col("_i") - half) / block),
                    home,
                    F.floor((F.col("_i") + half) / block),
                )
            )
        ),
    )
    frame = Window.partitionBy(*keys, "_b").orderBy("_i").rowsBetween(-half, half)
    mean = F.when(F.count(value).over(frame) >= min_count, F.avg(value).over(frame))
    return spread.withColumn(name, mean).where(F.col("_b") == home).drop("_b", "_i")


def _with_totals(cum: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    if not keys:
        return cum.withColumn("_total", counts.agg(F.sum("_n")).scalar())
    return cum.join(counts.groupBy(*keys).agg(F.sum("_n").alias("_total")), keys)


def _quantiles_of(counts: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Quantiles from the occurrences of each value."""
    cum = running(counts, keys, value, _cum=("sum", F.col("_n")))
    both = _with_totals(cum, counts, keys)
    picks: list[Column] = []
    near = F.lit(False)
    for label, p in probs.items():
        pos = (F.col("_total") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            holds = (F.col("_cum") - F.col("_n") <= at) & (F.col("_cum") > at)
            near = near | holds
            picks.append(F.max(F.when(holds, F.col(value))).alias(f"_{label}_{side}"))
    few = both.where(near)
    if keys:
        # few rows are left; their own shuffle frees the join before them to split a heavy key
        few = few.repartition(*keys)
    per_key = few.groupBy(*keys, "_total").agg(*picks)
    out = []
    for label, p in probs.items():
        pos = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_{label}_lo"), F.col(f"_{label}_hi")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(label))
    return per_key.select(*keys, *out)


def quantiles(
    df: DataFrame,
    keys: Sequence[str] | str,
    value: str,
    probs: dict[str, float],
    weight: str | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per key, one column per entry of ``probs``.

    Equal values are counted before anything else; cumulative counts come from ``running``, so a
    group with very many distinct values is never held by one task.
    ``weight`` names a column of whole-number multiplicities.
    """
    keys = _names(keys)
    counts = stage(_value_counts(df, keys, value, weight), "values")
    return _quantiles_of(counts, keys, value, probs)


def distribution(
    df: DataFrame,
    keys: Sequence[str] | str,
    value: str,
    probs: dict[str, float],
    above: dict[str, float] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Count, mean, exact quantiles and shares at or above cut-offs per key, from one pass.

    The rows are read once to count equal values; all measures come from the counts.  The mean adds
    decimals, so it does not depend on the order of addition.
    """
    keys = _names(keys)
    counts = stage(_value_counts(df, keys, value, weight), "values")
    n = F.sum("_n")
    stats = counts.groupBy(*keys).agg(
        n.alias("n"),
        (exact_weighted_sum(F.col(value), F.col("_n")) / n).alias("mean"),
        *[
            (F.sum(F.when(F.col(value) >= cut, F.col("_n")).otherwise(0)) / n).alias(name)
            for name, cut in (above or {}).items()
        ],
    )
    if not keys:
        picks = _quantiles_of(counts, keys, value, probs)
        return stats.withColumns({p: picks.select(p).scalar() for p in probs})
    return stats.join(_quantiles_of(counts, keys, value, probs), keys)


def upper_median(df: DataFrame, keys: Sequence[str] | str, value: str, name: str) -> DataFrame:
    """A-42: the element at index n // 2 of the sorted values."""
    keys = _names(keys)
    counts = stage(_value_counts(df, keys, value), "values")
    cum = running(counts, keys, value, _cum=("sum", F.col("_n")))
    both = _with_totals(cum, counts, keys)
    at = F.floor(F.col("_total") / 2)
    return both.where((F.col("_cum") - F.col("_n") <= at) & (F.col("_cum") > at)).select(
        *keys, F.col(value).alias(name)
    )
