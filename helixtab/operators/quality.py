"""Guards and verification of merges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.workspace import stage


def _names(cols: Sequence[str] | str) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


class QualityError(AssertionError):
    """A guard found the data other than promised."""


def duplicate_keys(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """A-03, Q-03: keys that occur more than once, with their count."""
    return df.groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_unique(df: DataFrame, keys: Sequence[str] | str) -> None:
    """Q-03: raise when a key repeats."""
    if not duplicate_keys(df, keys).isEmpty():
        raise QualityError(f"{_names(keys)} is not unique")


def check_no_collision(left: DataFrame, right: DataFrame, keys: Sequence[str] | str) -> None:
    """Q-04: raise when a new column exists already."""
    keys = _names(keys)
    shared = sorted(set(left.columns) & set(right.columns) - set(keys))
    if shared:
        raise QualityError(f"columns exist on both sides: {shared}")


def check_columns(df: DataFrame, documented: Sequence[str] | Mapping[str, str] | int) -> None:
    """Q-05: raise unless there are as many columns as said, or each is documented exactly once."""
    if isinstance(documented, int):
        if len(df.columns) != documented:
            raise QualityError(f"{len(df.columns)} columns instead of {documented}")
        return
    names = list(documented)
    twice = sorted({n for n in names if names.count(n) > 1})
    missing = sorted(set(df.columns) - set(names))
    gone = sorted(set(names) - set(df.columns))
    if twice or missing or gone:
        raise QualityError(f"documented twice {twice}, undocumented {missing}, not in table {gone}")


def key_set_report(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Q-06: for each combination of tables, how many keys occur in exactly those."""
    flags = [F.lit(name) for name in tables]
    stacked = None
    for name, df in tables.items():
        part = df.select(key, F.lit(name).alias("_table"))
        stacked = part if stacked is None else stacked.unionAll(part)
    per_key = stacked.groupBy(key).agg(
        *[F.max(F.col("_table") == f).alias(f"_in_{i}") for i, f in enumerate(flags)]
    )
    where = F.concat_ws("+", *[F.when(F.col(f"_in_{i}"), f) for i, f in enumerate(flags)])
    return per_key.groupBy(where.alias("present_in")).agg(F.count(F.lit(1)).alias("n_keys"))


def check_same_keys(tables: Mapping[str, DataFrame], key: str) -> None:
    """Q-06: raise unless all tables hold the same keys."""
    everywhere = "+".join(tables)
    odd = key_set_report(tables, key).where(F.col("present_in") != everywhere)
    if not odd.isEmpty():
        raise QualityError(f"key sets differ between {list(tables)}")


RANGE_BITS = 12
_DIGESTS = ("d1", "d2", "d3", "d4")


def _range(key: str, bits: int) -> Column:
    """The range of a key: the upper bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(1), F.col(key)), 64 - bits)


def digest_tree(df: DataFrame, key: str, cols: Sequence[str] | None = None, bits: int = RANGE_BITS, fan_bits: int = 6) -> DataFrame:
    """Q-01: a hash tree over the ranges of a key, as (level, range, rows, keys, repeated, d1 .. d4).

    A leaf is a range of key hashes, the node above it the range of all hashes that agree in ``fan_bits`` bits
    less, and so on up to level 0, the whole table.  ``d1`` to ``d4`` add up two 64-bit digests of each row, in halves
    that don't overflow, so they depend neither on the order of the rows nor on their partitions, and the digests of a
    node are the sums of its children's.  Equal digests mean equal rows (of the columns ``cols``; all by default).  Only keys
    and digests are shuffled.  The tree has at most ``2 ** bits`` leaves and can be written next to the table.
    """
    cols = [c for c in (df.columns if cols is None else cols) if c != key]
    cells = [x for c in [key, *cols] for x in (F.col(c), F.col(c).isNull())]
    own = df.select(
        F.col(key).alias("_key"), F.xxhash64(F.lit(7), *cells).alias("a"), F.xxhash64(F.lit(8), *cells).alias("b")
    )
    halves = {"d1": F.col("a").bitwiseAND(F.lit(0xFFFFFFFF)), "d2": F.shiftrightunsigned("a", 32),
              "d3": F.col("b").bitwiseAND(F.lit(0xFFFFFFFF)), "d4": F.shiftrightunsigned("b", 32)}
    per_key = own.groupBy("_key").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(x).alias(d) for d, x in halves.items()])
    sums = [F.sum(c).alias(c) for c in ("rows", "keys", "repeated", *_DIGESTS)]
    leaves = per_key.groupBy(_range("_key", bits).alias("range")).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("keys"), F.count_if(F.col("rows") > 1).alias("repeated"),
        *[F.sum(d).alias(d) for d in _DIGESTS],
    )
    depths = sorted({0, *range(bits, 0, -fan_bits)})
    # every node from the leaves below it: a leaf has one row per level
    ranges = F.array(
        *[F.struct(F.lit(k).alias("level"), F.shiftrightunsigned("range", bits - d).alias("range")) for k, d in enumerate(depths)]
    )
    return leaves.withColumn("_node", F.explode(ranges)).groupBy("_node.level", "_node.range").agg(*sums)


def differing_ranges(old: DataFrame, new: DataFrame, bits: int = RANGE_BITS, fan_bits: int = 6) -> DataFrame:
    """Q-01: the leaves at which two trees of ``digest_tree`` differ, by descent from the root.

    A level is looked at only below nodes that differ; ranges that agree are skipped with all that is below.
    """
    depths = sorted({0, *range(bits, 0, -fan_bits)})
    sides = ["rows", *_DIGESTS]
    found = None
    for k, depth in enumerate(depths):
        one, other = (t.where(F.col("level") == k).select("range", F.struct(*sides).alias(n)) for t, n in ((old, "o"), (new, "n")))
        if found is not None:
            below = F.shiftrightunsigned("range", depth - depths[k - 1])
            parents = found.withColumnRenamed("range", "_up")
            one, other = (t.join(parents, below == F.col("_up"), "left_semi") for t in (one, other))
        found = one.join(other, "range", "full_outer").where(~F.col("o").eqNullSafe(F.col("n"))).select("range")
    return found


def rows_in_ranges(df: DataFrame, ranges: DataFrame, key: str, bits: int = RANGE_BITS) -> DataFrame:
    """The rows whose keys lie in the given leaves."""
    return df.withColumn("_range", _range(key, bits)).join(ranges.withColumnRenamed("range", "_range"), "_range", "left_semi").drop("_range")


def table_diff(old: DataFrame, new: DataFrame, key: str, bits: int = RANGE_BITS) -> DataFrame:
    """Q-01, Q-14: differences of two versions of a table, in long form.

    Both versions get a hash tree over key ranges, and those are compared before the result is put together.  Counts of rows and of repeated keys come from the roots; only rows in
    ranges that differ are joined by key, which gives the rows of keys on one side only and, for each shared
    column, the number of differing cells with the sample of the lowest such key.  Cells are compared for
    keys that stand once on both sides.
    """
    shared = [c for c in old.columns if c in new.columns and c != key]
    added = [c for c in new.columns if c not in old.columns]
    lost = [c for c in old.columns if c not in new.columns]

    marked = [digest_tree(t, key, shared, bits).withColumn("_side", F.lit(m)) for m, t in (("o", old), ("n", new))]
    trees = stage(marked[0].unionByName(marked[1]), "digests")
    ranges = stage(differing_ranges(trees.where("_side = 'o'"), trees.where("_side = 'n'"), bits), "ranges")
    roots = {r["_side"]: r for r in trees.where("level = 0").collect()}  # two rows at most
    root = lambda m, c: roots[m][c] if m in roots else 0

    def by_key(table: DataFrame, mark: str) -> DataFrame:
        near = rows_in_ranges(table.select(key, *shared), ranges, key, bits)
        if not root(mark, "repeated"):
            return near.select(F.col(key).alias("_k"), F.lit(1).alias(f"_{mark}"), *[F.col(c).alias(f"{mark}_{c}") for c in shared])
        firsts = [F.first(c).alias(f"{mark}_{c}") for c in shared]
        return near.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias(f"_{mark}"), *firsts)

    both = by_key(old, "o").join(by_key(new, "n"), "_k", "full_outer")
    paired = (F.col("_o") == 1) & (F.col("_n") == 1)
    rows = lambda x: F.coalesce(F.sum(x), F.lit(0))
    aggs = [
        rows(F.when(F.col("_n").isNull(), F.col("_o"))).alias("only_old"),
        rows(F.when(F.col("_o").isNull(), F.col("_n"))).alias("only_new"),
    ]
    for c in shared:
        differs = paired & ~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
        text = lambda x: F.coalesce(x.cast("string"), F.lit("null"))
        sample = F.concat(
            F.col("_k").cast("string"),
            F.lit(": "),
            text(F.col(f"o_{c}")),
            F.lit(" -> "),
            text(F.col(f"n_{c}")),
        )
        aggs += [
            F.count_if(differs).alias(f"d_{c}"),
            F.min_by(sample, F.when(differs, F.col("_k"))).alias(f"s_{c}"),
        ]
    row = both.agg(*aggs)
    for m, side in (("o", "old"), ("n", "new")):
        row = row.withColumns({f"{c}_{side}": F.lit(root(m, c)) for c in ("rows", "repeated")})

    def item(check: str, n_: Column, sample: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            n_.cast("bigint").alias("n"),
            F.coalesce(sample, F.lit("")).alias("sample"),
        )

    none = F.lit("")
    items = [item(c, F.col(c), none) for c in ("rows_old", "rows_new", "only_old", "only_new", "repeated_old", "repeated_new")]
    items += [item(f"mismatch:{c}", F.col(f"d_{c}"), F.col(f"s_{c}")) for c in shared]
    items += [item("columns_added", F.lit(len(added)), F.lit(",".join(added)))]
    items += [item("columns_lost", F.lit(len(lost)), F.lit(",".join(lost)))]
    return row.select(F.explode(F.array(*items)).alias("_i")).select("_i.*")


def check_diff_clean(diff: DataFrame) -> None:
    """Q-01: raise when a merge lost rows or columns or changed a cell that was there before."""
    bad = diff.where(
        (F.col("n") > 0)
        & (F.col("check").startswith("mismatch:") | F.col("check").isin("only_old", "columns_lost"))
    )
    if not bad.isEmpty():
        raise QualityError("the merged table lost or changed earlier data")


def chunk_report(inputs: DataFrame, outputs: DataFrame, chunk: str, key: str) -> DataFrame:
    """Q-07: per chunk, input ids, distinct ids, result rows and ids without a result."""
    done = outputs.groupBy(chunk, key).agg(F.count(F.lit(1)).alias("_rows"))
    ids = inputs.groupBy(chunk, key).agg(F.count(F.lit(1)).alias("_ids"))
    return (
        ids.join(done, [chunk, key], "full_outer")
        .groupBy(chunk)
        .agg(
            F.coalesce(F.sum("_ids"), F.lit(0)).alias("n_input"),
            F.count("_ids").alias("n_distinct"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_output"),
            F.count_if(F.col("_rows").isNull()).alias("n_missing"),
            F.count_if(F.col("_ids").isNull()).alias("n_unexpected"),
        )
        .withColumn(
            "status",
            F.when(F.col("n_missing") > 0, "incomplete")
            .when(F.col("n_input") > F.col("n_distinct"), "duplicate_ids")
            .otherwise("complete"),
        )
    )


def check_chunks_complete(report: DataFrame) -> None:
    """Q-07: raise when an id has no result."""
    if not report.where("n_missing > 0").isEmpty():
        raise QualityError("some chunks lack results")


def reconcile(
    left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str, tolerance: float = 1e-3
) -> DataFrame:
    """Q-08: do two ways to one number agree within a tolerance?"""
    both = left.select(key, F.col(left_value).alias("_a")).join(
        right.select(key, F.col(right_value).alias("_b")), key
    )
    gap = F.abs(F.col("_a") - F.col("_b"))
    return both.agg(
        F.count(F.lit(1)).alias("n_compared"),
        F.count_if(gap < tolerance).alias("n_agree"),
        F.count_if(~(gap < tolerance) | gap.isNull()).alias("n_differ"),
    )


def outcome_counts(df: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Q-11: rows per outcome; they add up to the input because every row has one."""
    return df.groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))


def fill_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q-12: filled cells per column."""
    from helixtab.functions.cells import is_filled

    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(is_filled(F.col(c).cast("string"))).alias(c) for c in columns],
    )
    return row.unpivot(["_rows"], list(columns), "column", "n_filled").select(
        "column", "n_filled", (F.col("n_filled") * 100.0 / F.col("_rows")).alias("pct_filled")
    )


def spot_check(
    expected: DataFrame, observed: DataFrame, key: str, want: str, top: str, labels: str
) -> DataFrame:
    """Q-10: known entities against their top prediction or label."""
    verdict = (
        F.when(F.col(top).isNull(), "absent")
        .when((F.col(top) == F.col(want)) | F.contains(F.col(labels), F.col(want)), "ok")
        .otherwise("mismatch")
    )
    return expected.join(observed, key, "left").withColumn("verdict", verdict)


def rate_sample_vs_full(df: DataFrame, sample: DataFrame, cond: Column) -> DataFrame:
    """Q-13: one rate over a sample and over the whole table."""
    rate = lambda d, n: d.agg(
        F.lit(n).alias("scope"), F.count(F.lit(1)).alias("rows"), F.count_if(cond).alias("hits")
    )
    return rate(df, "full").unionAll(rate(sample, "sample"))


def ragged_rows(lines: DataFrame, n_fields: int, sep: str = "\t", line: str = "value") -> DataFrame:
    """Q-02: rows per number of fields that differs from the header."""
    n = F.size(F.split(line, "\\Q" + sep + "\\E"))
    return (
        lines.select(n.alias("n_fields")).where(F.col("n_fields") != n_fields)
        .groupBy("n_fields").agg(F.count(F.lit(1)).alias("n"))
    )


def frame_check(pivot: DataFrame, third: str, others: Sequence[str]) -> DataFrame:
    """Q-09: on every strand the third codon position must have the lowest mean."""
    ok = F.lit(True)
    for o in others:
        ok = ok & (F.col(third) < F.col(o))
    return pivot.withColumn("frame_ok", ok)
