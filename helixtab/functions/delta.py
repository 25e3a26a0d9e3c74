"""Wild-type versus mutant score vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def delta_vector(wt: Column, mut: Column) -> Column:
    """F-28: mutant minus wild type, member by member."""
    return F.zip_with(wt, mut, lambda w, m: m - w)


def delta_columns(columns: Sequence[str], wt: str = "WT_", mut: str = "MUT_") -> dict[str, Column]:
    """F-28 over named columns: ``DELTA_x = MUT_x - WT_x``."""
    return {f"DELTA_{c}": F.col(f"{mut}{c}") - F.col(f"{wt}{c}") for c in columns}


def total_abs_delta(wt: Column, mut: Column) -> Column:
    """F-29: sum of absolute differences; one missing member makes the row null."""
    gaps = F.zip_with(wt, mut, lambda w, m: F.abs(m - w))
    total = F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(wt) == F.size(mut), total)


def max_abs(values: Column) -> Column:
    """F-30: largest magnitude in an array."""
    return F.array_max(F.transform(values, F.abs))


def argmax_name(values: Column, names: Sequence[str]) -> Column:
    """F-31: name of the largest member, the first one on ties."""
    best = F.array_position(values, F.array_max(values))
    return F.element_at(F.array(*[F.lit(n) for n in names]), best.cast("int"))


def argmax_position(values: Column) -> Column:
    """F-31: 1-based place of the largest member, the first one on ties."""
    return F.array_position(values, F.array_max(values)).cast("int")


def label_changed(wt_label: Column, mut_label: Column) -> Column:
    """F-32: 1 when the label differs."""
    return (wt_label != mut_label).cast("int")


def direction(delta: Column) -> Column:
    """A-45: increase, decrease or equal."""
    return F.when(delta > 0, "increase").when(delta < 0, "decrease").when(delta == 0, "equal")


def score_status(raw: Column) -> Column:
    """State of a raw score cell: scored, blank, too long (``NA``) or out of memory (``OOM``)."""
    t = F.trim(raw)
    return (
        F.when(t.isNull() | (t == ""), "blank")
        .when(t == "NA", "too_long")
        .when(t == "OOM", "out_of_memory")
        .otherwise("scored")
    )


def fixed4(value: Column) -> Column:
    """The four-decimal text form used in written tables."""
    return F.format_string("%.4f", value)
