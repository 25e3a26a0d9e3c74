"""Motif instances and what a point mutation does to them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions.mutate import point_mutations, substituted



def usable_classes(classes: dict[str, str]) -> dict[str, str]:
    """Motif classes whose regex compiles; the others are left out, as a class dictionary is small."""
    kept = {}
    for name, pattern in classes.items():
        try:
            re.compile(pattern)
        except re.error:
            continue
        kept[name] = pattern
    return kept


def class_regex(motif: Column, classes: dict[str, str]) -> Column:
    """Regex of a motif class, null for an unknown one."""
    cells = [F.lit(x) for pair in usable_classes(classes).items() for x in pair]
    return F.try_element_at(F.create_map(*cells), motif)


def full_match(text: Column, motif: Column, classes: dict[str, str]) -> Column:
    """Does the whole text match its class?  Null for an unknown class.

    A short dictionary is written as one constant pattern per branch, so that no regex is compiled
    per row; a long one would make the expression too large and is looked up.
    """
    good = usable_classes(classes)
    if len(good) > 40:
        return text.rlike(F.concat(F.lit("^(?:"), class_regex(motif, good), F.lit(")\\z")))
    out = F.when(F.lit(False), F.lit(None).cast("boolean"))
    for name, pattern in good.items():
        out = out.when(motif == name, text.rlike(f"^(?:{pattern})\\z"))
    return out


def match_ranges(text: Column, pattern: str, found: Column) -> Column:
    """First and last place of every match in ``found``, counted from 1.

    The text between the matches, cut at the pattern, and the matches themselves add up to the text.
    """
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m")))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<array<int>>").alias("out"))

    def step(done: Column, x: Column) -> Column:
        at = done["at"] + x["g"]
        return F.struct(
            (at + F.coalesce(x["m"], F.lit(0))).alias("at"),
            F.when(x["m"].isNull(), done["out"])
            .otherwise(F.concat(done["out"], F.array(F.array(at, at + x["m"] - 1))))
            .alias("out"),
        )

    return F.aggregate(lengths, start, step)["out"]


def unpack_instances(ranges: Column, classes: Column, seqs: Column) -> Column:
    """F-38: parallel JSON cells to an array of instances; null when a cell or the lengths are bad."""
    r = F.from_json(ranges, "array<array<int>>")
    c = F.from_json(classes, "array<string>")
    s = F.from_json(seqs, "array<string>")
    agree = (F.size(r) == F.size(c)) & (F.size(c) == F.size(s))
    instance = lambda x: F.struct(
        F.get(x["r"], F.lit(0)).alias("start"),
        F.get(x["r"], F.lit(1)).alias("end"),
        x["c"].alias("motif"),
        x["s"].alias("matched"),
    )
    zipped = F.arrays_zip(r.alias("r"), c.alias("c"), s.alias("s"))
    return F.when(r.isNotNull() & c.isNotNull() & s.isNotNull() & agree, F.transform(zipped, instance))


def instance_status(instance_cols: dict[str, Column], classes: dict[str, str]) -> Column:
    """F-16: why an instance is used or skipped."""
    matched, motif = instance_cols["matched"], instance_cols["motif"]
    span = instance_cols["end"] - instance_cols["start"] + 1
    fits = full_match(matched, motif, classes)
    return (
        F.when(fits.isNull(), "unknown_class")
        .when((F.length(matched) != span) | ~fits, "seq_mismatch")
        .otherwise("used")
    )


def motif_disruptions(instances: DataFrame, classes: dict[str, str]) -> DataFrame:
    """F-16, J-19: every point mutation inside a usable instance and whether it breaks the class.

    Written from the instance side: only residues inside an annotated span are enumerated.
    Expects ``start``, ``end``, ``motif`` and ``matched``; adds ``position`` (in the protein),
    ``wt_aa``, ``mut_aa``, ``mutated`` and ``disrupts``.
    """
    cols = {c: F.col(c) for c in ("start", "end", "motif", "matched")}
    used = instances.where(instance_status(cols, classes) == "used")
    scan = point_mutations(used, "matched")
    mutated = substituted(F.col("matched"), F.col("position"), F.col("mut_aa"))
    return (
        scan.withColumn("mutated", mutated)
        .withColumn("disrupts", ~full_match(F.col("mutated"), F.col("motif"), classes))
        .withColumn("position", F.col("start") + F.col("position") - 1)
    )
