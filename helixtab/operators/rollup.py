"""Audits, rollups, rates and distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions.cells import blank_to_null, is_filled, packed_items
from helixtab.functions.sums import exact_sum
from helixtab.operators.select import first_rows


def _names(cols: Sequence[str] | str) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def key_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A-01, A-03: rows, empty cells, distinct values and repeated values per column.

    All columns go through one shuffle: cells are counted per (column, value) first.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counts = (
        long.withColumn("value", blank_to_null(F.col("value")))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    filled = F.col("value").isNotNull()
    return counts.groupBy("column").agg(
        F.sum("_n").alias("rows"),
        F.coalesce(F.sum(F.when(~filled, F.col("_n"))), F.lit(0)).alias("empty_rows"),
        F.count("value").alias("distinct_values"),
        F.count_if(filled & (F.col("_n") > 1)).alias("repeated_values"),
        F.coalesce(F.max(F.when(filled, F.col("_n"))), F.lit(0)).alias("max_repeat"),
    )


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """A-02: most common first, equal counts by value."""
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.col(name).desc(), column)
    )


def flagged_groups(df: DataFrame, keys: Sequence[str] | str, flag: Column) -> DataFrame:
    """A-04, A-05: rows and flagged rows per group."""
    return df.groupBy(*_names(keys)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(flag).alias("n_flagged")
    )


def group_size_histogram(groups: DataFrame, size: str = "n_rows") -> DataFrame:
    """A-05: how many groups have how many rows."""
    return groups.groupBy(size).agg(F.count(F.lit(1)).alias("n_groups"))


def distinct_composites(df: DataFrame, columns: Sequence[str], name: str, approximate: bool = False) -> DataFrame:
    """A-08: number of distinct combinations; rows with a missing part are not counted."""
    whole = df.dropna(subset=list(columns))
    key = F.struct(*columns)
    n = F.approx_count_distinct(F.xxhash64(*columns)) if approximate else F.count_distinct(key)
    return whole.agg(n.alias(name))


def entity_rollup(
    df: DataFrame,
    key: str,
    distinct: Mapping[str, str],
    conditions: Mapping[str, Column],
    rows: str = "total_rows",
) -> DataFrame:
    """A-07: row count, distinct non-empty ids and conditional counts per entity, in one pass.

    Rows without an entity are dropped.
    """
    texts = {n for n, kind in df.dtypes if kind == "string"}
    cell = lambda c: blank_to_null(F.col(c)) if c in texts else F.col(c)
    named = F.col(key).isNotNull()
    return (
        df.where(named & (F.trim(F.col(key)) != "") if key in texts else named)
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias(rows),
            *[F.count_distinct(cell(c)).alias(n) for n, c in distinct.items()],
            *[F.count_if(c).alias(n) for n, c in conditions.items()],
        )
    )


def completeness(
    df: DataFrame, checklist: Mapping[str, Sequence[str]], informative: Column | None = None
) -> DataFrame:
    """A-09: per checklist item the filled share of its columns, its worst column and a verdict."""
    from helixtab.functions.cells import is_informative

    present = sorted({c for cols in checklist.values() for c in cols if c in df.columns})
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(is_informative(F.col(c).cast("string"))).alias(f"_f_{c}") for c in present],
    )
    items = []
    for item, cols in checklist.items():
        have = [c for c in cols if c in present]
        gone = [c for c in cols if c not in present]
        pct = [F.col(f"_f_{c}") * 100.0 / F.col("_rows") for c in have]
        worst = F.array_min(F.array(*pct)) if pct else F.lit(None).cast("double")
        if not cols:
            verdict = F.lit("NO MATCHING COLUMN IN TABLE")
        elif not have:
            verdict = F.lit("COLUMN(S) NOT FOUND")
        else:
            verdict = (
                F.when(worst < 5, "ESSENTIALLY EMPTY").when(worst < 50, "SPARSE / SUSPECT").otherwise("")
            )
        items.append(
            F.struct(
                F.lit(item).alias("item"),
                F.lit(",".join(have)).alias("columns"),
                F.lit(",".join(gone)).alias("missing_columns"),
                F.coalesce(worst, F.lit(-1.0)).alias("worst_pct"),
                verdict.alias("verdict"),
            )
        )
    return counts.select(F.explode(F.array(*items)).alias("_i")).select("_i.*")


def duplicates_agree(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """A-10: rows and distinct value tuples per key."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.struct(*columns)).alias("n_versions"),
    )


def members_agree(df: DataFrame, key: str, value: str) -> DataFrame:
    """A-50: is the value of all members of a group the same, different or incomplete?"""
    groups = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_members"),
        F.count(value).alias("_filled"),
        F.count_distinct(value).alias("_distinct"),
    )
    verdict = (
        F.when(F.col("_filled") < F.col("n_members"), "incomplete")
        .when(F.col("_distinct") == 1, "identical")
        .otherwise("different")
    )
    return groups.withColumn("verdict", verdict).drop("_filled", "_distinct")


def inflation(df: DataFrame, key: str, ord_cols: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A-11: column sums over all rows and over the first row per key."""
    sums = lambda d, label: d.agg(
        F.lit(label).alias("scope"),
        F.count(F.lit(1)).alias("n_rows"),
        *[exact_sum(F.coalesce(F.col(c), F.lit(0.0))).alias(f"sum_{c}") for c in columns],
    )
    once = first_rows(df, key, [F.col(c).asc() for c in ord_cols])
    return sums(df, "naive").unionAll(sums(once, "deduplicated"))


def class_presence(df: DataFrame, classes: Sequence[str]) -> DataFrame:
    """A-11: entities with any class, with each class, and with only that class."""
    has = {c: F.coalesce(F.col(c), F.lit(0)) > 0 for c in classes}
    any_ = F.lit(False)
    for h in has.values():
        any_ = any_ | h
    measures = {"entities": F.lit(True), "any": any_}
    for c, h in has.items():
        only = h
        for other, ho in has.items():
            if other != c:
                only = only & ~ho
        measures[f"has_{c}"] = h
        measures[f"only_{c}"] = only
    row = df.agg(*[F.count_if(m).alias(n) for n, m in measures.items()])
    return row.unpivot([], list(measures), "measure", "n")


def mapping_cardinality(df: DataFrame, a: str, b: str) -> DataFrame:
    """A-12: in both directions, how many keys map to more than one partner.

    Pairs are made distinct once and serve both directions.
    """
    pairs = (
        df.select(
            blank_to_null(F.col(a).cast("string")).alias("a"),
            blank_to_null(F.col(b).cast("string")).alias("b"),
        )
        .where("a is not null and b is not null")
        .distinct()
    )

    def one_way(key: str, label: str) -> DataFrame:
        sizes = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        return sizes.agg(
            F.lit(label).alias("direction"),
            F.count(F.lit(1)).alias("n_keys"),
            F.count_if(F.col("_n") > 1).alias("n_ambiguous"),
            F.coalesce(F.max("_n"), F.lit(0)).alias("max_partners"),
        )

    return one_way("a", f"{a}->{b}").unionAll(one_way("b", f"{b}->{a}"))


def filled_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A-12: filled cells per column and rows with all of them filled."""
    flags = {c: is_filled(F.col(c).cast("string")) for c in columns}
    every = F.lit(True)
    for f in flags.values():
        every = every & f
    measures = {"rows": F.lit(True), **flags, "all_filled": every}
    row = df.agg(*[F.count_if(m).alias(n) for n, m in measures.items()])
    return row.unpivot([], list(measures), "measure", "n")


def grouped_means(
    df: DataFrame,
    groupings: Sequence[Sequence[str]],
    measures: Mapping[str, Column],
    count: str = "n",
) -> DataFrame:
    """A-13: the same means over several groupings in one pass, with the grouping's name.

    ``measures`` maps output names to aggregates.
    """
    columns = list(dict.fromkeys(c for g in groupings for c in g))
    sets = [[F.col(c) for c in g] for g in groupings]
    marks = [F.grouping(c).alias(f"_g_{c}") for c in columns]
    out = df.groupingSets(sets, *columns).agg(
        F.count(F.lit(1)).alias(count), *[m.alias(n) for n, m in measures.items()], *marks
    )
    name = F.concat_ws("+", *[F.when(F.col(f"_g_{c}") == 0, F.lit(c)) for c in columns])
    keys = [F.when(F.col(f"_g_{c}") == 0, F.col(c).cast("string")).alias(c) for c in columns]
    return out.select(name.alias("grouping"), *keys, count, *measures)


def matrix(df: DataFrame, row: str, column: str, values: Sequence[str], cell: Column) -> DataFrame:
    """A-14, A-38: one row per ``row`` value, one column per listed ``column`` value."""
    return df.groupBy(row).pivot(column, list(values)).agg(cell)


def rates(df: DataFrame, keys: Sequence[str] | str, thresholds: Mapping[str, Column]) -> DataFrame:
    """A-15, A-18: rows, hits and hit rate of each condition per group."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for name, cond in thresholds.items():
        hits = F.count_if(cond)
        aggs += [hits.alias(f"n_{name}"), (hits / F.count(F.lit(1))).alias(f"frac_{name}")]
    keys = _names(keys)
    return df.groupBy(*keys).agg(*aggs)


def fixed_order(df: DataFrame, column: str, values: Sequence[str], name: str = "place") -> DataFrame:
    """A-16: only the listed groups, with their place in the list."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column)).cast("int")
    return df.where(F.col(column).isin(*values)).withColumn(name, place)


def crosstab(df: DataFrame, first: Column, second: Column) -> DataFrame:
    """A-17: 2 x 2 counts of two conditions."""
    yes_no = lambda c: F.when(c, "yes").otherwise("no")
    return (
        df.select(yes_no(first).alias("first"), yes_no(second).alias("second"))
        .groupBy("first")
        .agg(
            F.count_if(F.col("second") == "no").alias("second_no"),
            F.count_if(F.col("second") == "yes").alias("second_yes"),
        )
    )


def transitions(df: DataFrame, before: Column, after: Column, n: int = 20) -> DataFrame:
    """A-19: most common changes of a label."""
    label = F.concat(before, F.lit(" -> "), after)
    counts = df.where(before != after).groupBy(label.alias("transition")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.orderBy(F.col("n").desc(), "transition").limit(n)


def enrichment(df: DataFrame, subset: Column, trait: Column) -> DataFrame:
    """A-20: rate of a trait in a subset against its rate in all rows."""
    return df.agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(trait).alias("n_trait"),
        F.count_if(subset).alias("n_subset"),
        F.count_if(subset & trait).alias("n_subset_trait"),
    ).withColumns(
        {
            "rate_all": F.col("n_trait") / F.col("n_all"),
            "rate_subset": F.when(F.col("n_subset") > 0, F.col("n_subset_trait") / F.col("n_subset")),
        }
    )


def exploded_counts(df: DataFrame, packed: str, sep: str = "|", name: str = "item") -> DataFrame:
    """A-28: frequency of the entries of a packed column."""
    return (
        df.select(F.explode(packed_items(F.col(packed), sep)).alias(name))
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def packed_summary(
    df: DataFrame, key: str, item: str, flag: Column, order: str | None = None
) -> DataFrame:
    """A-31: rows of a key collapsed to a count, all items, an any-flag and the flagged items.

    Items are counted per key first and listed with their repeats, in their own order or, with
    ``order``, by first appearance.  What reaches a key's task is one row per distinct item (a class
    name), however many rows the key has.
    """
    place = F.col(item) if order is None else F.min(order)
    counted = df.groupBy(key, item).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(flag).alias("f"), place.alias("o")
    )
    rows = F.array_sort(F.collect_list(F.struct("o", F.col(item).alias("i"), "n", "f")))
    out = counted.groupBy(key).agg(
        rows.alias("_rows"), F.sum("n").alias("n_items"), F.sum("f").alias("_flagged")
    )
    repeat = lambda times: F.array_join(
        F.flatten(F.transform("_rows", lambda r: F.array_repeat(r["i"], r[times].cast("int")))), ";"
    )
    return out.select(
        key,
        "n_items",
        repeat("n").alias("items"),
        F.when(F.col("_flagged") > 0, "Y").otherwise("N").alias("any_flagged"),
        repeat("f").alias("flagged_items"),
    )


def label_agreement(df: DataFrame, ours: Column, authority: Column) -> DataFrame:
    """A-32: agreement of two labellings and what the disagreeing ones resolve to."""
    return (
        df.select(
            F.when(ours == authority, "agree").otherwise("disagree").alias("verdict"),
            ours.alias("ours"),
            authority.alias("resolves_to"),
        )
        .groupBy("verdict", "ours", "resolves_to")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def method_breakdown(
    df: DataFrame, method: str, category: str, categories: Sequence[str], unchecked: str
) -> DataFrame:
    """A-33: category counts per method and the share of checked rows."""
    wide = df.groupBy(method).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(category) != unchecked).alias("checked"),
        *[F.count_if(F.col(category) == c).alias(c) for c in categories],
    )
    pct = {
        f"pct_{c}": F.when(F.col("checked") > 0, F.col(c) * 100.0 / F.col("checked")).otherwise(0.0)
        for c in categories
    }
    return wide.withColumns(pct)


def examples(df: DataFrame, category: str, order: Sequence[Column], k: int = 5) -> DataFrame:
    """A-34: the first ``k`` rows per category."""
    return first_rows(df, category, order, k)


def bucket_rows(df: DataFrame, buckets: Mapping[str, Column], name: str = "bucket") -> DataFrame:
    """A-44: a row once for each bucket it belongs to."""
    hits = F.filter(
        F.array(*[F.when(c, F.lit(b)) for b, c in buckets.items()]), lambda b: b.isNotNull()
    )
    return df.withColumn(name, F.explode(hits))


def large_groups(
    df: DataFrame, keys: Sequence[str] | str, min_rows: int, name: str = "n", **aggregates: Column
) -> DataFrame:
    """P-13: aggregates of the groups that have enough rows."""
    sizes = df.groupBy(*_names(keys)).agg(
        F.count(F.lit(1)).alias(name), *[a.alias(n) for n, a in aggregates.items()]
    )
    return sizes.where(F.col(name) >= min_rows)


def group_medians(
    df: DataFrame, keys: Sequence[str] | str, value: str, min_rows: int, name: str = "median"
) -> DataFrame:
    """A-41: medians of the groups that have enough rows."""
    from helixtab.operators.scan import quantiles

    keys = _names(keys)
    return large_groups(df, keys, min_rows).join(quantiles(df, keys, value, {name: 0.5}), keys)


def class_flips(df: DataFrame, keys: Sequence[str] | str, before: Column, after: Column) -> DataFrame:
    """A-46: scored rows and rows whose dominant class changed."""
    return df.groupBy(*_names(keys)).agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(before != after).alias("n_dominant_changed")
    )


def dominant_with_place(scores: Sequence[Column], places: Sequence[Column], names: Sequence[str]) -> dict[str, Column]:
    """A-52: name of the largest score (the first on ties), its value and the place that belongs to it."""
    values = F.array(*scores)
    best = F.array_position(values, F.array_max(values)).cast("int")
    return {
        "mechanism": F.element_at(F.array(*[F.lit(n) for n in names]), best),
        "score": F.array_max(values),
        "distance": F.element_at(F.array(*places), best),
    }


def direction_counts(df: DataFrame, delta: Column) -> DataFrame:
    """A-45: increases, decreases, unchanged and not scored."""
    return df.agg(
        F.count_if(delta > 0).alias("n_increase"),
        F.count_if(delta < 0).alias("n_decrease"),
        F.count_if(delta == 0).alias("n_equal"),
        F.count_if(delta.isNull()).alias("n_unscored"),
    )


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """A-47: rows per bin of a fixed range, with the log10 of the count for a log axis."""
    return (
        df.where(F.col(value).between(low, high))
        .select(
            F.least(
                F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins)
            ).alias("bin")
        )
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("log10_n", F.log10("n"))
    )


def strong_ranks(df: DataFrame, key: str, strong: Column, n: int = 20) -> DataFrame:
    """A-51: keys by number of strong rows."""
    counts = df.where(strong).groupBy(key).agg(F.count(F.lit(1)).alias("n_strong"))
    return counts.orderBy(F.col("n_strong").desc(), key).limit(n)


def ladder(flags: Sequence[Column], names: Sequence[str]) -> dict[str, Column]:
    """A-39: how many steps of a ladder are reached, and the deepest one."""
    reached = F.array(*[F.coalesce(f, F.lit(False)) for f in flags])
    depth = F.array_max(F.transform(reached, lambda f, i: F.when(f, i + 1).otherwise(0)))
    steps = F.array(F.lit("none"), *[F.lit(n) for n in names])
    return {
        "n_reached": F.size(F.filter(reached, lambda f: f)),
        "deepest": F.element_at(steps, depth + 1),
    }
