"""Filters with reasons, column rules and projections."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions.cells import coordinate, is_filled
from helixtab.functions.rules import first_rule
from helixtab.functions.terms import CONTIGS


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P-01, S-17: the named columns; a missing one is an error."""
    return df.select(*columns)


def with_reason(df: DataFrame, rules: Sequence[tuple[Column, str]], ok: str = "usable", name: str = "reason") -> DataFrame:
    """P-06, P-11: the first rule that rejects a row, or ``ok``; nothing is dropped."""
    return df.withColumn(name, first_rule(rules, ok))


def of_assembly(df: DataFrame, column: str, assembly: str = "GRCh38") -> DataFrame:
    """P-05."""
    return df.where(F.col(column) == assembly)


def contig_name(c: Column) -> Column:
    """P-06: ``MT`` is written ``chrM``."""
    return F.concat(F.lit("chr"), F.when(c == "MT", "M").otherwise(c))


def variant_reason(contig: Column, position: Column) -> Column:
    """P-06: contig on the list and position a positive whole number."""
    pos = F.when(F.trim(position).rlike(r"^[+-]?\d+$"), position.try_cast("bigint"))
    return first_rule(
        [
            (~F.coalesce(contig.isin(*CONTIGS), F.lit(False)), "unplaced"),
            (F.coalesce(pos, F.lit(0)) < 1, "bad_position"),
        ],
        "usable",
    )


def usable_allele(c: Column) -> Column:
    """P-08: not empty and not ``-``."""
    return is_filled(c) & (c != "-")


def coordinate_reason(text: Column, ref: Column, alt: Column) -> Column:
    """P-07, P-08: why a variant given by coordinate text cannot be used."""
    place = coordinate(text)
    on_list = F.coalesce(place["contig"].isin(*CONTIGS), F.lit(False))
    return first_rule(
        [(~on_list, "no_position"), (~(usable_allele(ref) & usable_allele(alt)), "bad_allele")],
        "usable",
    )


def bulk_only(df: DataFrame, cell_type: str, label: str, fallback: str, name: str) -> DataFrame:
    """P-10: rows without a cell type, labelled by the first name given."""
    kept = df.where(~is_filled(F.col(cell_type)))
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    return kept.withColumn(name, F.coalesce(given(label), given(fallback), F.lit("")))


def split_quarantine(df: DataFrame, corrupt: Column) -> tuple[DataFrame, DataFrame]:
    """P-14: clean rows and rows set aside."""
    bad = F.coalesce(corrupt, F.lit(False))
    return df.where(~bad), df.where(bad)


def without_reference_rows(df: DataFrame, is_reference: str) -> DataFrame:
    """P-15: drop the wild-type rows of a scan."""
    return df.where(F.col(is_reference).cast("string") != "True")


def replace_columns(df: DataFrame, stale: Sequence[str], new: Mapping[str, Column]) -> DataFrame:
    """P-16: stale columns dropped, fresh ones appended; running it twice changes nothing."""
    kept = [c for c in df.columns if c not in set(stale) | set(new)]
    return df.select(*kept, *[c.alias(n) for n, c in new.items()])


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """P-17: mark the origin of columns."""
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keep})


def canonical_headers(df: DataFrame, rules: Sequence[tuple[Callable[[str], bool], str]], keep: Sequence[str] = ()) -> DataFrame:
    """P-18: rename columns by the first rule that accepts the lower-cased name, else raise."""
    renames = {}
    for c in df.columns:
        if c in keep:
            continue
        name = next((new for test, new in rules if test(c.lower())), None)
        if name is None:
            raise ValueError(f"unrecognised column {c!r}")
        renames[c] = name
    return df.withColumnsRenamed(renames)


# Words in the headers of an orthology export and the names they get.
ORTHOLOGY_HEADERS = [
    (lambda h: "stable id" in h, "gene"),
    (lambda h: "homology type" in h, "orthology_type"),
    (lambda h: "target" in h and "identical to query" in h, "pid_target"),
    (lambda h: "query" in h and "identical to target" in h, "pid_query"),
    (lambda h: "gene-order" in h, "goc"),
    (lambda h: "whole-genome" in h, "wga"),
    (lambda h: "confidence" in h, "confidence"),
]


def missing_but_expected(has: Column, lacks: Column) -> Column:
    """P-19: a source id is there and the value is not."""
    return is_filled(has) & ~is_filled(lacks)


def override(df: DataFrame, cond: Column, **values: Column) -> DataFrame:
    """P-22: set columns where a condition holds."""
    return df.withColumns({c: F.when(cond, v).otherwise(F.col(c)) for c, v in values.items()})


def trial_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """P-12: the first rows for a trial run."""
    return df.orderBy(*order).limit(n)
