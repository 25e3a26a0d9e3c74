"""Joins whose keys may be very unevenly used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _names(cols: Sequence[str] | str) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _heavy(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Heavy keys with ``_salts``: how many times the share each has, rounded up, plus one."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    salts = (F.ceil(F.col("_n") / (F.lit(total) * F.lit(share))) + 1).cast("int")
    return counts.where(F.col("_n") >= total * F.lit(share)).select(*keys, salts.alias("_salts"))


def heavy_keys(df: DataFrame, keys: Sequence[str] | str, share: float = 0.01) -> DataFrame:
    """Keys that hold at least ``share`` of the rows: by counting, no more than 1/share of them."""
    return _heavy(df, _names(keys), share).drop("_salts")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] | str,
    how: str = "inner",
    salts: int | None = None,
    share: float = 0.01,
) -> DataFrame:
    """An inner or left equi-join in which the rows of heavy left keys are spread over salts.

    A key gets salts in proportion to its share of the rows, or as many as given, and its rows are dealt by their number, so
    equal rows are spread as well.  Only right rows of heavy keys are repeated, and there are at most
    1/share such keys; the list of heavy keys is broadcast because of that bound.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    keys = _names(keys)
    heavy = _heavy(left, keys, share)
    heavy = F.broadcast(heavy if salts is None else heavy.withColumn("_salts", F.lit(salts)))
    number = F.coalesce("_salts", F.lit(1))
    numbered = left.withColumn("_row", F.monotonically_increasing_id())
    salted_left = numbered.join(heavy, keys, "left").withColumn("_salt", F.pmod("_row", number).cast("int"))
    salted_right = right.join(heavy, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), number - 1)))
    return (
        salted_left.drop("_salts", "_row")
        .join(salted_right.drop("_salts"), [*keys, "_salt"], how)
        .drop("_salt")
    )
