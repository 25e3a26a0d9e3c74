"""Mutant sequences from a wild type and a parsed change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions.notation import BUILDABLE, ONE_LETTER, residue_code


def build_mutant(
    seq: Column, category: Column, details: Column, three_letter: bool = True
) -> Column:
    """F-11 and F-12: the mutant sequence, null when the change does not fit the wild type.

    Only a missense change has its wild-type residue checked; the others check their range.
    """
    n = F.length(seq)
    start, end, after = (details.getField(f) for f in ("start", "end", "after"))
    pos, keep_to = details.getField("pos"), details.getField("keep_to")
    text, count = details.getField("inserted"), details.getField("n_inserted")
    cut = F.coalesce(details.getField("truncate"), F.lit(False))
    code = residue_code if three_letter else (lambda c: c)
    wt, mut = code(details.getField("wt")), code(details.getField("mut"))

    def head(length: Column) -> Column:
        return F.substr(seq, F.lit(1), length)

    def tail(skipped: Column) -> Column:
        return F.substr(seq, skipped + 1)

    in_range = (start >= 1) & (end <= n) & (start <= end)
    insert_ok = F.length(text) == count
    missense_ok = wt.isNotNull() & mut.isNotNull() & (pos >= 1) & (pos <= n) & (F.substr(seq, pos, F.lit(1)) == wt)
    return (
        F.when(
            (category == "missense") & missense_ok, F.concat(head(pos - 1), mut, tail(pos))
        )
        .when((category == "nonsense") & (keep_to >= 0) & (keep_to <= n), head(keep_to))
        .when((category == "del") & in_range, F.concat(head(start - 1), tail(end)))
        .when(
            (category == "ins") & insert_ok & (after <= n),
            F.concat(head(after), text, F.when(cut, F.lit("")).otherwise(tail(after))),
        )
        .when(
            (category == "delins") & insert_ok & in_range,
            F.concat(head(start - 1), text, F.when(cut, F.lit("")).otherwise(tail(end))),
        )
        .when(
            (category == "dup") & in_range,
            F.concat(head(end), F.substr(seq, start, end - start + 1), tail(end)),
        )
    )


def build_outcome(category: Column, has_wild_type: Column, mutant: Column) -> Column:
    """Q-11: the single counted outcome of every change."""
    return (
        F.when(~category.isin(*BUILDABLE), F.concat(F.lit("skip_"), category))
        .when(~has_wild_type, F.lit("skip_no_wt_seq"))
        .when(mutant.isNull(), F.lit("mismatch_or_invalid"))
        .when(mutant == "", F.lit("empty_mutant"))
        .otherwise(F.concat(F.lit("built_"), category))
    )


def mutants_of(
    changes: DataFrame, wild_types: DataFrame, accession: str = "accession", seq: str = "sequence",
    three_letter: bool = True,
) -> DataFrame:
    """P-11, F-11, Q-11: every change with its mutant sequence and outcome; no row is dropped.

    ``wild_types`` must be unique on ``accession``.
    """
    joined = changes.join(wild_types, accession, "left")
    mutant = build_mutant(F.col(seq), F.col("category"), F.col("details"), three_letter)
    return joined.withColumn("mutant", mutant).withColumn(
        "outcome", build_outcome(F.col("category"), F.col(seq).isNotNull(), F.col("mutant"))
    )


def point_mutations(df: DataFrame, seq: str) -> DataFrame:
    """F-15: one row per position and other residue, with ``position``, ``wt_aa`` and ``mut_aa``."""
    letters = F.array(*[F.lit(a) for a in ONE_LETTER])
    residues = df.select(
        "*", F.posexplode(F.regexp_extract_all(F.col(seq), F.lit("(?s)."), 0)).alias("_p", "wt_aa")
    ).withColumn("position", F.col("_p") + 1)
    return (
        residues.drop("_p").withColumn("mut_aa", F.explode(letters)).where("wt_aa <> mut_aa")
    )


def substituted(seq: Column, position: Column, residue: Column) -> Column:
    """The sequence with one residue replaced."""
    return F.overlay(seq, residue, position, F.lit(1))
