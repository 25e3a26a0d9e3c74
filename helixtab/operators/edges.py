"""Interaction edges, partner lists and their comparison.

Edges stay rows.  Packed lists are only made at the end, in parts of bounded size, and set
comparisons are counted from edge rows, so a node with very many partners is never one cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtab.functions.cells import valid_accession
from helixtab.operators.scan import ordinal


def directed(edges: DataFrame, a: str, b: str, score: str, threshold: float = 700) -> DataFrame:
    """P-09, U-08: both directions of the edges at or above a score, as distinct (src, dst).

    Each row is turned in place, so the input is read once.
    """
    both = F.explode(
        F.array(
            F.struct(F.col(a).alias("src"), F.col(b).alias("dst")),
            F.struct(F.col(b).alias("src"), F.col(a).alias("dst")),
        )
    )
    return (
        edges.where(F.col(score) >= threshold).select(both.alias("_e")).select("_e.*").distinct()
    )


def of_sources(edges: DataFrame, nodes: DataFrame, node: str) -> DataFrame:
    """P-09: edges that start at a queried node."""
    return edges.join(nodes.select(F.col(node).alias("src")).distinct(), "src", "left_semi")


def within(edges: DataFrame, nodes: DataFrame, node: str) -> DataFrame:
    """Edges whose partner is in the table."""
    return edges.join(nodes.select(F.col(node).alias("dst")).distinct(), "dst", "left_semi")


def partner_lists(edges: DataFrame, max_items: int = 1000) -> DataFrame:
    """K-08 for edges: sorted ``;``-joined partners per node, in numbered parts of ``max_items``.

    A node with up to ``max_items`` partners has the single part 0; joining the parts in order gives
    the whole list.
    """
    placed = ordinal(edges, "dst", "src", "_i").withColumn("part", F.floor(F.col("_i") / max_items))
    items = F.transform(
        F.array_sort(F.collect_list(F.struct("_i", F.col("dst").cast("string").alias("d")))),
        lambda r: r["d"],
    )
    return placed.groupBy("src", "part").agg(
        F.count(F.lit(1)).alias("n_partners"), F.array_join(items, ";").alias("partners")
    )


def reciprocity(edges: DataFrame) -> DataFrame:
    """J-22: for each edge, is the opposite edge there?"""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(True).alias("_b"))
    return (
        edges.join(back, ["src", "dst"], "left")
        .withColumn("reciprocated", F.coalesce(F.col("_b"), F.lit(False)))
        .drop("_b")
    )


def list_checks(nodes: DataFrame, node: str, full: DataFrame, inside: DataFrame) -> DataFrame:
    """U-05, F-35, F-36: structural checks of partner rows per node, from edge rows.

    ``full`` and ``inside`` hold (src, dst) rows that may repeat.  A node is counted under a check
    when any of its rows fails it.
    """
    f = full.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("_f"))
    i = inside.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("_i"))
    per_node = (
        f.join(i, ["src", "dst"], "full_outer")
        .groupBy("src")
        .agg(
            F.max(F.col("src") == F.col("dst")).alias("self_reference"),
            F.max(F.coalesce(F.col("_f") > 1, F.lit(False))).alias("has_duplicate"),
            F.max(F.col("_f").isNull()).alias("not_subset"),
            F.max(~valid_accession(F.col("dst").cast("string"))).alias("bad_format"),
            F.count("_f").alias("n_partners"),
            F.count("_i").alias("n_inside"),
        )
    )
    return nodes.select(F.col(node).alias("src")).distinct().join(per_node, "src", "left")


def compare_methods(nodes: DataFrame, node: str, first: DataFrame, second: DataFrame) -> DataFrame:
    """U-06: Jaccard of the partner sets of two methods per node, and how the pair is counted."""
    a = first.select("src", "dst").distinct().withColumn("_a", F.lit(1))
    b = second.select("src", "dst").distinct().withColumn("_b", F.lit(1))
    sizes = (
        a.join(b, ["src", "dst"], "full_outer")
        .groupBy("src")
        .agg(
            F.count("_a").alias("n_first"),
            F.count("_b").alias("n_second"),
            F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("n_both"),
            F.count(F.lit(1)).alias("n_any"),
        )
    )
    all_nodes = nodes.select(F.col(node).alias("src")).distinct()
    kind = (
        F.when((F.col("n_first") == 0) & (F.col("n_second") == 0), "both_empty")
        .when((F.col("n_first") == 0) | (F.col("n_second") == 0), "one_empty")
        .when(F.col("n_both") == F.col("n_any"), "identical")
        .otherwise("overlapping")
    )
    return (
        all_nodes.join(sizes, "src", "left")
        .fillna(0, subset=["n_first", "n_second", "n_both", "n_any"])
        .withColumn("comparison", kind)
        .withColumn(
            "jaccard",
            F.when((F.col("n_first") > 0) & (F.col("n_second") > 0), F.col("n_both") / F.col("n_any")),
        )
    )


def jaccard_of_lists(a, b):
    """U-06 on two array columns of one row: null when both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union)


def is_subset(a, b):
    """U-05 on two array columns of one row."""
    return F.size(F.array_except(a, b)) == 0
