"""Sums of decimal-like doubles that don't depend on the order of addition.

A double is taken as the shortest decimal that reads back as it.  Values below 1e19 with at most 17
digits after the point are added exactly.  A group that has a larger value, an infinity or NaN, a
total beyond 1e21, or nothing but values below 1e-6, whose digits lie too deep, is added as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_VALUE = "decimal(36,17)"
_WHOLE, _REST = "decimal(19,0)", "decimal(18,17)"
#: Groups without a value of this size are added as doubles.
LEAST = 1e-6


def _or_plain(value: Column, exact: Column, plain: Column) -> Column:
    largest = F.max(F.abs(value))
    fits = F.count(value.try_cast(_VALUE)) == F.count(value)
    return F.when(fits & ((largest >= LEAST) | (largest == 0)), F.coalesce(exact, plain)).otherwise(plain)


def exact_sum(c: Column) -> Column:
    """Aggregate: the sum of the values that aren't null; null if there are none."""
    value = c.cast("double")
    return _or_plain(value, F.try_sum(value.try_cast(_VALUE)).cast("double"), F.sum(value))


def exact_total(*cols: Column) -> Column:
    """``exact_sum`` of up to three columns of one row."""
    if len(cols) > 3:
        raise ValueError("the decimals hold the sum of three values")
    values = [c.cast("double") for c in cols]
    missing = F.coalesce(*values).isNull()
    plain = sum((F.coalesce(v, F.lit(0.0)) for v in values[1:]), F.coalesce(values[0], F.lit(0.0)))
    exact = [F.when(v.isNull(), F.lit(0).cast(_VALUE)).otherwise(v.try_cast(_VALUE)) for v in values]
    total = sum(exact[1:], exact[0])
    sizes = [F.abs(F.coalesce(v, F.lit(0.0))) for v in values]
    largest = F.greatest(*sizes) if len(sizes) > 1 else sizes[0]
    fits = total.isNotNull() & ((largest >= LEAST) | (largest == 0))
    return F.when(~missing, F.when(fits, total.cast("double")).otherwise(plain))


def exact_weighted_sum(c: Column, times: Column) -> Column:
    """Aggregate: the sum of each value as often as the whole number ``times`` says."""
    value, n = c.cast("double"), times.cast("decimal(18,0)")
    exact = value.try_cast(_VALUE)
    whole = F.round(exact, 0).cast(_WHOLE)
    rest = (exact - whole).cast(_REST)
    total = F.try_sum(whole * n).try_cast("decimal(38,17)") + F.try_sum(rest * n)
    return _or_plain(value, total.cast("double"), F.sum(value * times))
