"""Enrichment, lookup, filtering and resolution joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions.cells import blank_to_null, is_filled, packed_items
from helixtab.functions.delta import score_status
from helixtab.operators.quality import check_no_collision, check_unique
from helixtab.operators.select import first_rows, first_wins


def _names(cols: Sequence[str] | str) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def enrich(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] | str,
    on_clash: str = "fail",
    blanks: bool = True,
    matched: str | None = None,
    verify_unique: bool = False,
) -> DataFrame:
    """J-01, J-03: left join of a table that is unique on ``keys``.

    Text columns that found no partner become empty when ``blanks``.  ``on_clash`` says what happens
    to columns both sides have: ``fail``, ``overwrite`` (the right one) or ``skip`` (the left one).
    ``matched`` names a flag column that tells whether a partner was found.
    """
    keys = _names(keys)
    if verify_unique:
        check_unique(right, keys)
    shared = [c for c in right.columns if c in left.columns and c not in keys]
    if shared and on_clash == "fail":
        check_no_collision(left, right, keys)
    if on_clash == "overwrite":
        left = left.drop(*shared)
    elif on_clash == "skip":
        right = right.drop(*shared)
    new = [f for f in right.schema.fields if f.name not in keys]
    marked = right.withColumn("_matched", F.lit(True))
    out = left.join(marked, keys, "left")
    if blanks:
        texts = [f.name for f in new if f.dataType.simpleString() == "string"]
        out = out.fillna("", subset=texts) if texts else out
    if matched:
        out = out.withColumn(matched, F.coalesce(F.col("_matched"), F.lit(False)))
    return out.drop("_matched")


def enrich_all(
    left: DataFrame, sources: Sequence[tuple[DataFrame, Sequence[str] | str]], **kw
) -> DataFrame:
    """J-02: several enrichments in one chain."""
    return reduce(lambda df, s: enrich(df, s[0], s[1], **kw), sources, left)


def match_counts(df: DataFrame, flag: str) -> DataFrame:
    """J-01: how many rows found a partner."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(flag)).alias("matched"),
        F.count_if(~F.col(flag)).alias("unmatched"),
    )


def expand(left: DataFrame, right: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """J-04, J-05: left join that multiplies rows on purpose, unmatched left rows kept.

    Written as an inner join plus the rows without a partner: Spark splits a key that is heavy on
    either side of an inner join, but in a left join only one that is heavy on the left.
    """
    keys = _names(keys)
    lonely = left.join(right.select(*keys).distinct(), keys, "left_anti")
    return left.join(right, keys).unionByName(lonely, allowMissingColumns=True)


def product_profile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] | str,
    left_by: Sequence[str],
    right_by: Sequence[str],
    name: str = "n_rows",
) -> DataFrame:
    """J-05: row counts of the keyed N x M product, without writing the product.

    Both sides are counted per key and attribute first, and the counts are multiplied; an unmatched
    left row counts once.
    """
    keys = _names(keys)
    lc = left.groupBy(*keys, *left_by).agg(F.count(F.lit(1)).alias("_l"))
    rc = right.groupBy(*keys, *right_by).agg(F.count(F.lit(1)).alias("_r"))
    return (
        lc.join(rc, keys, "left")
        .groupBy(*left_by, *right_by)
        .agg(F.sum(F.col("_l") * F.coalesce(F.col("_r"), F.lit(1))).cast("bigint").alias(name))
    )


def pair_with_wild_type(
    variants: DataFrame,
    scores: DataFrame,
    wt_key: str,
    mut_key: str,
    score_key: str,
    columns: Sequence[str],
) -> DataFrame:
    """J-06, J-07: each variant with the scores of its wild type and of itself.

    ``WT_`` and ``MUT_`` columns are null where a side is missing, and ``pair_status`` tells which,
    so the counts of missing sides need no second pass.
    """
    # of the scores on the wild-type side only the few that are asked for travel
    asked = variants.select(F.col(wt_key).alias(score_key)).distinct()
    wt = scores.join(asked, score_key, "left_semi").select(
        F.col(score_key).alias(wt_key), F.lit(True).alias("_wt"), *[F.col(c).alias(f"WT_{c}") for c in columns]
    )
    mut = scores.select(
        F.col(score_key).alias(mut_key), F.lit(True).alias("_mut"), *[F.col(c).alias(f"MUT_{c}") for c in columns]
    )
    status = (
        F.when(F.col("_wt").isNull(), "missing_wt")
        .when(F.col("_mut").isNull(), "missing_mut")
        .otherwise("paired")
    )
    # mutants first: the wild types are few, and joining them last leaves their scores out of the
    # shuffle by mutant
    return (
        variants.join(mut, mut_key, "left")
        .join(wt, wt_key, "left")
        .withColumn("pair_status", status)
        .drop("_wt", "_mut")
    )


def numeric_scores(df: DataFrame, columns: Sequence[str], status: str = "score_status") -> DataFrame:
    """J-07: raw score texts to numbers plus the worst state among them.

    ``NA`` and ``OOM`` both lead to null scores, and the state keeps them apart.
    """
    states = F.array(*[score_status(F.col(c)) for c in columns])
    worst = (
        F.when(F.array_contains(states, "out_of_memory"), "out_of_memory")
        .when(F.array_contains(states, "too_long"), "too_long")
        .when(F.array_contains(states, "blank"), "blank")
        .otherwise("scored")
    )
    return df.withColumn(status, worst).withColumns(
        {c: F.when(score_status(F.col(c)) == "scored", F.col(c).try_cast("double")) for c in columns}
    )


def merge_tables(
    tables: Sequence[DataFrame], key: str, optional: Sequence[DataFrame] = ()
) -> DataFrame:
    """J-08: wide merge on one key.  The first tables must hold the same keys (see Q-06)."""
    base = reduce(lambda a, b: a.join(b, key), tables)
    return reduce(lambda a, b: a.join(b, key, "left"), optional, base)


def keep_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """J-09: rows whose key is on a list."""
    return df.join(listed, _names(keys), "left_semi")


def keep_bridged(
    df: DataFrame, bridge: DataFrame, listed: DataFrame, key: str, via: str, ord_col: str | None = None
) -> DataFrame:
    """J-10: rows whose key leads, through the first entry of a bridge table, to a listed one."""
    links = first_wins(bridge, key, ord_col) if ord_col else bridge
    allowed = links.join(listed, via, "left_semi").select(key)
    return df.join(allowed, key, "left_semi")


def unmatched(df: DataFrame, other: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """J-11, J-12, U-02: rows whose key is absent from the other table."""
    return df.join(other, _names(keys), "left_anti")


def explode_key(df: DataFrame, packed: str, name: str, sep: str = ";") -> DataFrame:
    """J-13: one row per entry of a packed key column."""
    return df.withColumn(name, F.explode(packed_items(F.col(packed), sep)))


def synonym_table(
    df: DataFrame, symbol: str, primary: str, packed: Sequence[str], ord_col: str
) -> DataFrame:
    """J-14: accession to symbol over a primary and several packed columns; the first row wins.

    Within one row the primary accession comes first, then the packed columns in their order.
    """
    groups = [F.array(blank_to_null(F.col(primary))), *[packed_items(F.col(c)) for c in packed]]
    tagged = [
        F.transform(g, lambda a, r=rank: F.struct(F.lit(r).alias("rank"), a.alias("accession")))
        for rank, g in enumerate(groups)
    ]
    rows = (
        df.where(is_filled(F.col(symbol)))
        .select(ord_col, F.col(symbol).alias("symbol"), F.explode(F.concat(*tagged)).alias("_a"))
        .select(ord_col, "symbol", "_a.rank", "_a.accession")
        .where(F.col("accession").isNotNull())
    )
    return first_wins(rows, "accession", [ord_col, "rank", "symbol"]).select("accession", "symbol")


def exact_product(
    rows: DataFrame, products: DataFrame, group: str, text: str, product_id: str, ord_col: str
) -> DataFrame:
    """J-16: the first product of the row's group whose text equals the row's text.

    Products are cut to one per (group, text) first, so a group with many products is never
    compared all against all.
    """
    firsts = (
        products.where(F.col(text).isNotNull() & (F.col(text) != ""))
        .groupBy(group, text)
        .agg(F.min_by(product_id, ord_col).alias(product_id))
    )
    method = F.when(F.col(product_id).isNotNull(), "exact_translation_match").otherwise("no_match")
    return rows.join(firsts, [group, text], "left").withColumn("method", method)


def fallback_join(
    left: DataFrame,
    right: DataFrame,
    first: tuple[str, str],
    second: tuple[str, str],
    labels: tuple[str, str] = ("uniprot", "symbol"),
    how_col: str = "match_type",
) -> DataFrame:
    """J-17: join by one key pair; rows without any partner are tried again by a second pair.

    Key pairs are (left column, right column).  Rows with no partner in either keep null columns
    and the type ``none``.
    """
    (l1, r1), (l2, r2) = first, second
    cols = [F.col(f"r.{c}") for c in right.columns]
    r = right.alias("r")
    one = left.alias("l").join(r, F.col(f"l.{l1}") == F.col(f"r.{r1}")).select(
        "l.*", *cols, F.lit(labels[0]).alias(how_col)
    )
    rest = left.join(
        right.select(F.col(r1).alias("_k")).distinct(), F.col(l1) == F.col("_k"), "left_anti"
    )
    two = rest.alias("l").join(r, F.col(f"l.{l2}") == F.col(f"r.{r2}"), "left").select(
        "l.*",
        *cols,
        F.when(F.col(f"r.{r2}").isNull(), "none").otherwise(labels[1]).alias(how_col),
    )
    return one.unionAll(two)


def widened_candidates(
    rows: DataFrame,
    candidates: DataFrame,
    xrefs: DataFrame,
    row_id: str,
    gene: str,
    tx: str,
    size: str,
) -> DataFrame:
    """J-30: candidates of the same gene or named by a cross reference, of equal size.

    Two equi-joins and a distinct union stand for the OR condition.  The size is part of the join
    key, so rows and candidates of one gene are not paired all with all.
    """
    by_gene = rows.join(candidates, [gene, size]).select(row_id, tx)
    by_ref = rows.join(xrefs, row_id).join(candidates.drop(gene), [tx, size]).select(row_id, tx)
    return by_gene.union(by_ref).distinct()


def resolve_endpoint(
    edges: DataFrame, endpoint: str, own: DataFrame, external: DataFrame, id_col: str, name: str
) -> DataFrame:
    """J-20: own map first, external map for the rest; both maps unique on ``id_col``."""
    o = own.select(F.col(id_col).alias(endpoint), F.col(name).alias("_own"))
    x = external.select(F.col(id_col).alias(endpoint), F.col(name).alias("_ext"))
    return (
        edges.join(o, endpoint, "left")
        .join(x, endpoint, "left")
        .withColumn(name, F.coalesce("_own", "_ext"))
        .drop("_own", "_ext")
    )


def canonical_id(df: DataFrame, column: str, resolution: DataFrame, old: str, new: str) -> DataFrame:
    """J-21: an id replaced by its resolved form, kept when there is none."""
    table = resolution.select(F.col(old).alias(column), F.col(new).alias("_resolved"))
    return (
        df.join(table, column, "left")
        .withColumn(f"{column}_resolved", F.coalesce("_resolved", column))
        .drop("_resolved")
    )


def rewrite_alias(
    df: DataFrame, names: DataFrame, key: str, alias: str, official: str
) -> DataFrame:
    """J-23: the official name for each key, and whether the row was fixed, right or unmapped."""
    status = (
        F.when(F.col(official).isNull(), "unmapped")
        .when(F.col(official) != F.col(alias), "fixed")
        .otherwise("ok")
    )
    return (
        df.join(names, key, "left")
        .withColumn("alias_status", status)
        .withColumn(alias, F.coalesce(official, alias))
        .drop(official)
    )


def flag_membership(df: DataFrame, listed: DataFrame, keys: Sequence[str] | str, flag: str) -> DataFrame:
    """J-24: is the key on a list?  The list need not be distinct."""
    keys = _names(keys)
    marks = listed.select(*keys).distinct().withColumn("_in", F.lit(True))
    return (
        df.join(marks, keys, "left")
        .withColumn(flag, F.coalesce(F.col("_in"), F.lit(False)))
        .drop("_in")
    )


def coverage_counts(df: DataFrame, columns: Sequence[str], flag: str) -> DataFrame:
    """J-24: per column, how many cells are filled in all rows and in flagged rows."""
    measures = {}
    for c in columns:
        filled = is_filled(F.col(c).cast("string"))
        measures[f"all|{c}"] = F.count_if(filled)
        measures[f"flagged|{c}"] = F.count_if(filled & F.col(flag))
    row = df.agg(*[m.alias(n) for n, m in measures.items()])
    return (
        row.unpivot([], list(measures), "measure", "n")
        .withColumn("scope", F.substring_index("measure", "|", 1))
        .withColumn("column", F.substring_index("measure", "|", -1))
        .select("scope", "column", "n")
    )


def reconcile_lists(
    theirs: DataFrame, ours: DataFrame, resolved: DataFrame, symbol: str, current: str
) -> DataFrame:
    """J-29: each foreign symbol is new, covered under its current name, or unresolved."""
    mine = ours.select(F.col(symbol).alias(current)).distinct().withColumn("_mine", F.lit(True))
    status = (
        F.when(F.col(current).isNull(), "unresolved")
        .when(F.col("_mine"), "already_covered")
        .otherwise("new")
    )
    return (
        unmatched(theirs, ours, symbol)
        .join(resolved, symbol, "left")
        .join(mine, current, "left")
        .withColumn("list_status", status)
        .drop("_mine")
    )


def backfill(
    df: DataFrame, lookup: DataFrame, key: str, column: str, source: str, wanted: Column | None = None
) -> DataFrame:
    """P-20: fill a column from a lookup only where it is empty (and ``wanted`` holds)."""
    new = lookup.select(key, F.col(source).alias("_new"))
    empty = ~is_filled(F.col(column))
    cond = empty if wanted is None else empty & wanted
    return (
        df.join(new, key, "left")
        .withColumn(column, F.when(cond, F.coalesce(F.col("_new"), F.col(column))).otherwise(F.col(column)))
        .drop("_new")
    )


def first_alternate(
    df: DataFrame, key: str, alternates: str, lookup: DataFrame, alt_key: str, value: str
) -> DataFrame:
    """P-21: the first alternate of an ordered array that the lookup knows, null if none does."""
    tried = df.select(key, F.posexplode(alternates).alias("_rank", alt_key))
    hit = first_rows(tried.join(lookup.select(alt_key, value), alt_key), key, [F.col("_rank").asc()])
    status = F.when(F.col(value).isNotNull(), "alternate_after_retired_id").otherwise("unrecoverable")
    return df.join(hit.drop("_rank"), key, "left").withColumn("alternate_status", status)


def composite_match(scan: DataFrame, observed: DataFrame, keys: Sequence[str], bucket: str) -> DataFrame:
    """J-15: the scan rows whose composite key was observed, once for each bucket it was observed in."""
    return scan.join(observed.select(*keys, bucket).distinct(), list(keys))


def attach_by_position(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """J-25: pair two tables row by row; raises when their lengths differ."""
    from helixtab.operators.scan import ordinal

    n_left, n_right = left.count(), right.count()
    if n_left != n_right:
        raise ValueError(f"tables to pair have {n_left} and {n_right} rows")
    a = ordinal(left, left_order, name="_pos")
    b = ordinal(right, right_order, name="_pos")
    return a.join(b, "_pos").drop("_pos")


def cooccurrence(
    a: DataFrame, b: DataFrame, key: str, a_strong: Column, b_strong: Column, by: Sequence[str] = ()
) -> DataFrame:
    """J-27: two result tables joined on the variant; strong hits of each and of both."""
    return a.join(b, key).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(a_strong).alias("n_first"),
        F.count_if(b_strong).alias("n_second"),
        F.count_if(a_strong & b_strong).alias("n_both"),
    )


def through_bridges(df: DataFrame, bridges: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """J-28: an id converted step by step; each bridge is joined on the id the one before gave."""
    return reduce(lambda d, step: d.join(step[0], step[1]), bridges, df)


def dedup_then_join(
    left: DataFrame, right: DataFrame, key: str, ord_cols: Sequence[str], columns: Mapping[str, str]
) -> DataFrame:
    """J-26: the right side cut to its first row per key before the join."""
    once = first_wins(right, key, ord_cols).select(
        key, *[F.col(c).alias(n) for c, n in columns.items()]
    )
    return left.join(once, key, "left")


