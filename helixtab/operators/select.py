"""Record selection: first, last, best and top-k rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _names(cols: Sequence[str] | str) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def first_rows(
    df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column | str], k: int = 1
) -> DataFrame:
    """W-13, P-12 per group: the first ``k`` rows of each key.

    Spark cuts every map partition to ``k`` rows per key before the shuffle, so a key that holds
    most of the table still sends at most ``k`` rows per partition.
    """
    rank = F.row_number().over(Window.partitionBy(*_names(keys)).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def first_wins(df: DataFrame, keys: Sequence[str] | str, ord_cols: Sequence[str] | str) -> DataFrame:
    """W-01: the earliest row per key."""
    return first_rows(df, keys, [F.col(c).asc() for c in _names(ord_cols)])


def last_wins(df: DataFrame, keys: Sequence[str] | str, ord_cols: Sequence[str] | str) -> DataFrame:
    """W-02: the latest row per key."""
    return first_rows(df, keys, [F.col(c).desc() for c in _names(ord_cols)])


def longest(df: DataFrame, key: str, text: str, ord_cols: Sequence[str] | str) -> DataFrame:
    """W-03: the longest text per key, the first of equals; rows without a key are dropped."""
    keyed = df.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    order = [F.length(text).desc(), *[F.col(c).asc() for c in _names(ord_cols)]]
    return first_rows(keyed, key, order)


def best_row(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[Column],
    n_candidates: str | None = None,
    distinct: str | None = None,
) -> DataFrame:
    """W-04, W-06: the best row per key, with the number of rows (or distinct ``distinct``) it beat."""
    keys = _names(keys)
    best = first_rows(df, keys, order)
    if n_candidates is None:
        return best
    n = F.count_distinct(distinct) if distinct else F.count(F.lit(1))
    return best.join(df.groupBy(*keys).agg(n.alias(n_candidates)), keys)


def first_values(
    df: DataFrame, keys: Sequence[str] | str, columns: Sequence[str], order: Column
) -> DataFrame:
    """W-06, A-06: first non-null cell of each column per key, which may mix rows."""
    return df.groupBy(*_names(keys)).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    )


def transcript_choice(
    df: DataFrame,
    keys: Sequence[str] | str,
    tx: str,
    length_matches: str,
    preferred: str,
    canonical: str,
    cds_length: str,
) -> DataFrame:
    """W-04: exact length, then preferred, canonical, longest, lowest id; records the rule used."""
    order = [
        F.col(length_matches).desc(),
        F.col(preferred).desc(),
        F.col(canonical).desc(),
        F.col(cds_length).desc(),
        F.col(tx).asc(),
    ]
    rule = (
        F.when(F.col(preferred), "MANE_Select")
        .when(F.col(canonical), "Ensembl_canonical")
        .otherwise("longest_CDS")
    )
    return best_row(df, keys, order, "n_candidate_transcripts", tx).withColumn(
        "selection_rule", rule
    )


def tagged_choice(
    owners: DataFrame, refs: DataFrame, key: str, item: str, tag: str, ord_col: str
) -> DataFrame:
    """W-05: the reference tagged canonical (no tag, or ``<key>-1``), else the first, else none."""
    canonical = F.col(tag).isNull() | (F.col(tag) == F.concat(F.col(key).cast("string"), F.lit("-1")))
    picked = first_rows(
        refs.withColumn("_canonical", canonical),
        key,
        [F.col("_canonical").desc(), F.col(ord_col).asc()],
    ).select(key, item, "_canonical")
    method = (
        F.when(F.col("_canonical").isNull(), "no_ensembl_xref")
        .when(F.col("_canonical"), "canonical_isoform_match")
        .otherwise("fallback_no_canonical_tag")
    )
    return (
        owners.join(picked, key, "left")
        .withColumn("transcript_selection_method", method)
        .drop("_canonical")
    )


def by_priority(
    sources: Sequence[DataFrame], keys: Sequence[str] | str, ord_cols: Sequence[str] = ()
) -> DataFrame:
    """W-16, J-14, U-07: union of same-shaped sources, the earlier source wins per key."""
    stacked = None
    for rank, src in enumerate(sources):
        part = src.withColumn("_priority", F.lit(rank))
        stacked = part if stacked is None else stacked.unionByName(part)
    return first_wins(stacked, keys, ["_priority", *ord_cols]).drop("_priority")


def top_rows(df: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    """T-02, T-04, T-05: the first ``n`` rows in an order; each task keeps only ``n`` rows."""
    return df.orderBy(*by).limit(n)


def top_per_metric(
    df: DataFrame, ids: Sequence[str], metrics: Sequence[str], n: int = 20
) -> DataFrame:
    """T-03: the ``n`` largest rows per metric, nulls left out, with their rank."""
    long = df.unpivot(list(ids), list(metrics), "metric", "value").where("value is not null")
    order = [F.col("value").desc(), *[F.col(i).asc() for i in ids]]
    kept = first_rows(long, "metric", order, n)
    # at most n rows per metric are left
    return kept.withColumn(
        "rank", F.row_number().over(Window.partitionBy("metric").orderBy(*order))
    )


def byte_sorted(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """T-01: rows in byte order of their keys, the order of the C locale."""
    return df.orderBy(*[F.col(k).asc() for k in _names(keys)])


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """T-06: sorted distinct values, blanks dropped."""
    return byte_sorted(df.select(column).where(F.trim(F.col(column)) != "").distinct(), column)
