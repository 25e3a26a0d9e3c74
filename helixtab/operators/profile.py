"""Column profiles in one long table (A-22 to A-27, A-30, A-43)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions.cells import blank_to_null, is_filled, parse_float
from helixtab.functions.sums import exact_sum, exact_weighted_sum
from helixtab.operators.scan import quantiles
from helixtab.operators.select import first_rows
from helixtab.workspace import stage

OUTPUT = ("table", "column", "kind", "n_populated", "pct_populated", "n_distinct", "min", "max", "mean", "median", "notes")


def _shape(df: DataFrame, table: str | None, kind: str | None, **cols: Column) -> DataFrame:
    blank = {
        "n_distinct": F.lit(-1).cast("bigint"),
        "min": F.lit(None).cast("double"),
        "max": F.lit(None).cast("double"),
        "mean": F.lit(None).cast("double"),
        "median": F.lit(None).cast("double"),
        "notes": F.lit(""),
    }
    named = {n: F.lit(v) for n, v in (("table", table), ("kind", kind)) if v is not None}
    given = {**blank, **named, **cols}
    return df.select(*[given.get(c, F.col(c)).alias(c) for c in OUTPUT])


def _pct() -> Column:
    return F.when(F.col("_rows") > 0, F.col("n_populated") * 100.0 / F.col("_rows")).otherwise(0.0)


def generic_profile(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """A-22: populated and distinct, all columns through one shuffle."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counts = long.groupBy("column", blank_to_null(F.col("value")).alias("value")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    per = counts.groupBy("column").agg(
        F.sum("_n").alias("_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("_n"))), F.lit(0)).alias("n_populated"),
        F.count("value").alias("n_distinct"),
    )
    return _shape(per, table, "generic", pct_populated=_pct(), n_distinct=F.col("n_distinct"))


@dataclass(frozen=True)
class Measure:
    """A number per row, null meaning "leave out", and whether the row counts as populated."""

    table: str
    column: str
    kind: str
    value: Column
    populated: Column


def lengths(table: str, columns: Sequence[str]) -> list[Measure]:
    """A-23: lengths of filled texts."""
    text = {c: blank_to_null(F.col(c).cast("string")) for c in columns}
    return [Measure(table, c, "length", F.length(t), t.isNotNull()) for c, t in text.items()]


def numbers(
    df: DataFrame,
    table: str,
    columns: Sequence[str],
    exclude_zero: bool = True,
    count_zero_as_populated: bool = True,
) -> list[Measure]:
    """A-24: numbers, with or without zeros; a zero may or may not count as populated.

    Text is read as numbers; columns that are numbers already are taken as they are.
    """
    texts = {n for n, kind in df.dtypes if kind == "string"}
    out = []
    for c in columns:
        n = parse_float(F.col(c)) if c in texts else F.col(c).cast("double")
        kept = F.when(n != 0, n) if exclude_zero else n
        out.append(Measure(table, c, "numeric", kept, (n if count_zero_as_populated else kept).isNotNull()))
    return out


def list_lengths(table: str, columns: Sequence[str], sep: str = ";") -> list[Measure]:
    """A-25: number of entries of filled packed lists, empty entries included."""
    text = {c: blank_to_null(F.col(c)) for c in columns}
    quoted = "\\Q" + sep + "\\E"
    return [
        Measure(table, c, "list", F.when(t.isNotNull(), F.size(F.split(t, quoted))), t.isNotNull())
        for c, t in text.items()
    ]


def measured_profile(sources: Sequence[tuple[DataFrame, Sequence[Measure]]]) -> DataFrame:
    """A-23 to A-25: min, max, mean and exact median of all measures of several tables at once.

    Equal numbers of a measure are counted first; everything else is computed from those counts.
    """
    key = ["table", "column", "kind"]
    parts = []
    for df, measures in sources:
        wide = df.select(
            *[m.value.cast("double").alias(f"v{i}") for i, m in enumerate(measures)],
            *[m.populated.alias(f"p{i}") for i, m in enumerate(measures)],
        )
        items = [
            F.struct(
                F.lit(m.table).alias("table"),
                F.lit(m.column).alias("column"),
                F.lit(m.kind).alias("kind"),
                F.col(f"v{i}").alias("v"),
                F.col(f"p{i}").alias("p"),
            )
            for i, m in enumerate(measures)
        ]
        parts.append(wide.select(F.explode(F.array(*items)).alias("_i")).select("_i.*"))
    counts = stage(
        reduce(DataFrame.unionByName, parts).groupBy(*key, "v", "p").agg(F.count(F.lit(1)).alias("n")),
        "measures",
    )
    valued = F.sum(F.when(F.col("v").isNotNull(), F.col("n")))
    per = counts.groupBy(*key).agg(
        F.sum("n").alias("_rows"),
        F.coalesce(F.sum(F.when(F.col("p"), F.col("n"))), F.lit(0)).alias("n_populated"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        (exact_weighted_sum(F.col("v"), F.col("n")) / valued).alias("mean"),
    )
    medians = quantiles(counts, key, "v", {"median": 0.5}, weight="n")
    both = per.join(medians, key, "left")
    return _shape(
        both, None, None, pct_populated=_pct(), **{c: F.col(c) for c in ("min", "max", "mean", "median")}
    )


def length_profile(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """A-23 alone."""
    return measured_profile([(df, lengths(table, columns))])


def numeric_profile(df: DataFrame, table: str, columns: Sequence[str], **options: bool) -> DataFrame:
    """A-24 alone."""
    return measured_profile([(df, numbers(df, table, columns, **options))])


def list_profile(df: DataFrame, table: str, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """A-25 alone."""
    return measured_profile([(df, list_lengths(table, columns, sep))])


def category_profile(df: DataFrame, table: str, columns: Sequence[str], top: int = 8) -> DataFrame:
    """A-26: distinct values and the most common ones as ``value=count (pct%)``; blanks are ``(none)``."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counts = long.groupBy(
        "column", F.coalesce(blank_to_null(F.col("value")), F.lit("(none)")).alias("value")
    ).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy("column").agg(
        F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("n_distinct")
    )
    leaders = first_rows(counts, "column", [F.col("_n").desc(), F.col("value").asc()], top)
    joined = leaders.join(totals, "column")
    text = F.format_string("%s=%d (%.1f%%)", "value", "_n", F.col("_n") * 100.0 / F.col("_rows"))
    per = (
        joined.groupBy("column", "_rows", "n_distinct")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("o"), "value", text.alias("t")))).alias("_t"))
        .withColumn("n_populated", F.col("_rows"))
    )
    return _shape(
        per, table, "category", pct_populated=F.lit(100.0), n_distinct=F.col("n_distinct"),
        notes=F.array_join(F.transform("_t", lambda x: x["t"]), "; "),
    )


def inventory(profiles: Sequence[DataFrame]) -> DataFrame:
    """A-27: profiles of several tables, one below the other."""
    return reduce(DataFrame.unionByName, profiles)


def first_examples(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """A-30: filled cells and the first filled cell of each column."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        cell = F.col(c).cast("string")
        aggs += [
            F.count_if(is_filled(cell)).alias(f"n_{c}"),
            F.min_by(cell, F.when(is_filled(cell), F.col(order))).alias(f"e_{c}"),
        ]
    row = df.agg(*aggs)
    items = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n_{c}").alias("n_filled"),
            (F.col(f"n_{c}") * 100.0 / F.col("_rows")).alias("coverage_pct"),
            F.coalesce(F.col(f"e_{c}"), F.lit("")).alias("example"),
        )
        for c in columns
    ]
    return row.select(F.explode(F.array(*items)).alias("_i")).select("_i.*")


def mean_and_invalid(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A-29: mean of the readable cells and number of the others, per text column."""
    aggs = []
    for c in columns:
        n = parse_float(F.col(c))
        aggs += [
            exact_sum(n).alias(f"s_{c}"),
            F.count(n).alias(f"v_{c}"),
            F.count_if(n.isNull()).alias(f"i_{c}"),
        ]
    row = df.agg(*aggs)
    items = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"v_{c}").alias("n_valid"),
            F.col(f"i_{c}").alias("n_invalid"),
            F.when(F.col(f"v_{c}") > 0, F.col(f"s_{c}") / F.col(f"v_{c}")).alias("mean"),
        )
        for c in columns
    ]
    return row.select(F.explode(F.array(*items)).alias("_i")).select("_i.*")


def ratio_profile(df: DataFrame, numerator: Column, denominator: Column) -> DataFrame:
    """A-43: min, max, mean and median of a ratio; zero denominators are left out."""
    ratios = df.select(F.when(denominator != 0, numerator / denominator).alias("r")).where("r is not null")
    stats = ratios.agg(
        F.count("r").alias("n"), F.min("r").alias("min"), F.max("r").alias("max"), F.avg("r").alias("mean")
    )
    median = quantiles(ratios, (), "r", {"median": 0.5})
    return stats.withColumn("median", median.select("median").scalar())


