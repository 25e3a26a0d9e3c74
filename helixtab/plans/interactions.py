"""Interaction edge queries.

Stand-in: a line is an undirected edge between its part and its supplier in one id space with a
prefix; the score is the quantity, and the nodes of the table are the suppliers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions.cells import add_prefix, strip_prefix
from helixtab.operators import edges as E
from helixtab.operators import joins, scan
from helixtab.plans.registry import Tables, query

PREFIX = "9606."


def _node(c: str) -> Column:
    return add_prefix(F.concat(F.lit("N"), F.col(c).cast("string")), PREFIX)


def raw_edges(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _node("l_partkey").alias("protein1"),
        _node("l_suppkey").alias("protein2"),
        F.col("l_quantity").alias("score"),
        "l_shipdate",
    )


def nodes(t: Tables) -> DataFrame:
    return t.supplier.select(_node("s_suppkey").alias("node"))


_RAW_SQL = """
WITH r AS (SELECT '9606.N' || l_partkey AS protein1, '9606.N' || l_suppkey AS protein2, l_quantity AS score, l_shipdate FROM lineitem),
n AS (SELECT '9606.N' || s_suppkey AS node FROM supplier),
d AS (SELECT protein1 AS src, protein2 AS dst FROM r WHERE score >= 35 UNION SELECT protein2, protein1 FROM r WHERE score >= 35)
"""


@query(_RAW_SQL + "SELECT src, count(*) AS n_partners, sum(length(dst))::BIGINT AS n_chars FROM d GROUP BY 1")
def edge_build(t: Tables) -> DataFrame:
    """P-09, U-08: both directions of edges at or above a score."""
    both = E.directed(raw_edges(t), "protein1", "protein2", "score", 35)
    return both.groupBy("src").agg(F.count(F.lit(1)).alias("n_partners"), F.sum(F.length("dst")).alias("n_chars"))


@query(
    _RAW_SQL
    + """, k AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS i FROM d WHERE src IN (SELECT node FROM n))
SELECT src, i // 1000 AS part, count(*) AS n_partners, string_agg(dst, ';' ORDER BY dst) AS partners FROM k GROUP BY 1, 2"""
)
def partner_lists(t: Tables) -> DataFrame:
    """P-09, K-08: packed partners of the queried nodes, in parts of bounded size."""
    both = E.directed(raw_edges(t), "protein1", "protein2", "score", 35)
    return E.partner_lists(E.of_sources(both, nodes(t), "node"), 1000)


@query(
    _RAW_SQL
    + """, e AS (SELECT DISTINCT protein1 AS src, protein2 AS dst FROM r WHERE protein1 IN (SELECT node FROM n) AND protein2 IN (SELECT node FROM n))
SELECT e.src, count(*) AS n_edges, count(CASE WHEN b.src IS NOT NULL THEN 1 END) AS n_reciprocated
FROM e LEFT JOIN e b ON b.src = e.dst AND b.dst = e.src GROUP BY 1"""
)
def reciprocity(t: Tables) -> DataFrame:
    """J-22: is a listed partner listing the node as well?"""
    listed = raw_edges(t).select(F.col("protein1").alias("src"), F.col("protein2").alias("dst")).distinct()
    inside = E.within(E.of_sources(listed, nodes(t), "node"), nodes(t), "node")
    return E.reciprocity(inside).groupBy("src").agg(
        F.count(F.lit(1)).alias("n_edges"), F.count_if("reciprocated").alias("n_reciprocated")
    )


_TWO_SQL = (
    _RAW_SQL
    + """, a AS (SELECT DISTINCT protein2 AS src, protein1 AS dst FROM r WHERE score >= 25 AND l_shipdate < TIMESTAMP '1999-01-01'),
b AS (SELECT DISTINCT protein2 AS src, protein1 AS dst FROM r WHERE score >= 15),
s AS (SELECT coalesce(a.src, b.src) AS src, count(a.src) AS n_first, count(b.src) AS n_second,
   count(CASE WHEN a.src IS NOT NULL AND b.src IS NOT NULL THEN 1 END) AS n_both, count(*) AS n_any
  FROM a FULL JOIN b ON a.src = b.src AND a.dst = b.dst GROUP BY 1),
c AS (SELECT n.node AS src, coalesce(n_first, 0) AS n_first, coalesce(n_second, 0) AS n_second, coalesce(n_both, 0) AS n_both, coalesce(n_any, 0) AS n_any
  FROM n LEFT JOIN s ON s.src = n.node),
j AS (SELECT *, CASE WHEN n_first = 0 AND n_second = 0 THEN 'both_empty' WHEN n_first = 0 OR n_second = 0 THEN 'one_empty'
   WHEN n_both = n_any THEN 'identical' ELSE 'overlapping' END AS comparison,
   CASE WHEN n_first > 0 AND n_second > 0 THEN n_both / n_any END AS jaccard FROM c)
"""
)


def compared(t: Tables) -> DataFrame:
    turned = raw_edges(t).select(
        F.col("protein2").alias("src"), F.col("protein1").alias("dst"), "score", "l_shipdate"
    )
    early = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    return E.compare_methods(
        nodes(t), "node", turned.where((F.col("score") >= 25) & early), turned.where("score >= 15")
    )


@query(_TWO_SQL + "SELECT src, n_first, n_second, n_both, comparison, coalesce(jaccard, -1.0) AS jaccard FROM j")
def jaccard_methods(t: Tables) -> DataFrame:
    """U-06: partner sets by two methods."""
    return compared(t).select(
        "src", "n_first", "n_second", "n_both", "comparison", F.coalesce("jaccard", F.lit(-1.0)).alias("jaccard")
    )


@query(
    _TWO_SQL
    + """SELECT count(*) AS n_rows, count(jaccard) AS n_comparable, round(coalesce(min(jaccard), -1.0), 9) AS min_jaccard,
  round(coalesce(max(jaccard), -1.0), 9) AS max_jaccard, count(CASE WHEN jaccard >= 0.9 THEN 1 END) AS n_high,
  count(CASE WHEN jaccard < 0.5 THEN 1 END) AS n_low,
  (SELECT jaccard FROM (SELECT jaccard, row_number() OVER (ORDER BY jaccard) - 1 AS i, count(*) OVER () AS n FROM j WHERE jaccard IS NOT NULL) WHERE i = n // 2) AS median_jaccard
FROM j"""
)
def jaccard_distribution(t: Tables) -> DataFrame:
    """U-06, A-42: distribution and cut-offs of the similarity."""
    rows = compared(t)
    median = scan.upper_median(rows, (), "jaccard", "median_jaccard")
    j = F.col("jaccard")
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(j).alias("n_comparable"),
        F.round(F.coalesce(F.min(j), F.lit(-1.0)), 9).alias("min_jaccard"),
        F.round(F.coalesce(F.max(j), F.lit(-1.0)), 9).alias("max_jaccard"),
        F.count_if(j >= 0.9).alias("n_high"),
        F.count_if(j < 0.5).alias("n_low"),
    ).withColumn("median_jaccard", median.scalar())


@query(
    _RAW_SQL
    + """, p AS (SELECT src, count(*) AS c FROM d WHERE src IN (SELECT node FROM n) GROUP BY 1)
SELECT count(*) AS n_nodes, min(c) AS min_partners, max(c) AS max_partners, sum(c)::DOUBLE / count(*) AS mean_partners,
  (SELECT c FROM (SELECT c, row_number() OVER (ORDER BY c) - 1 AS i, count(*) OVER () AS n FROM p) WHERE i = n // 2) AS median_partners
FROM p"""
)
def partner_distribution(t: Tables) -> DataFrame:
    """A-42: sizes of partner lists, with the upper median."""
    both = E.directed(raw_edges(t), "protein1", "protein2", "score", 35)
    sizes = E.of_sources(both, nodes(t), "node").groupBy("src").agg(F.count(F.lit(1)).alias("c"))
    median = scan.upper_median(sizes, (), "c", "median_partners")
    return sizes.agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.min("c").alias("min_partners"),
        F.max("c").alias("max_partners"),
        (F.sum("c").cast("double") / F.count(F.lit(1))).alias("mean_partners"),
    ).withColumn("median_partners", median.scalar())


_ACC_SQL = "CASE WHEN l_partkey % 40 = 7 THEN 'p-' || l_partkey ELSE 'P' || lpad((l_partkey % 100000)::VARCHAR, 5, '0') END"


@query(
    f"""WITH f AS (SELECT 'P' || lpad((l_suppkey % 100000)::VARCHAR, 5, '0') AS src, {_ACC_SQL} AS dst, l_quantity FROM lineitem),
a AS (SELECT src, dst, count(*) AS n FROM f WHERE l_quantity >= 25 GROUP BY 1, 2), i AS (SELECT src, dst, count(*) AS n FROM f WHERE l_quantity >= 24 AND l_quantity < 26 GROUP BY 1, 2),
u AS (SELECT coalesce(a.src, i.src) AS src, coalesce(a.dst, i.dst) AS dst, a.n AS fn, i.n AS inn FROM a FULL JOIN i ON a.src = i.src AND a.dst = i.dst)
SELECT src, coalesce(bool_or(src = dst), false) AS self_reference, coalesce(bool_or(fn > 1), false) AS has_duplicate, bool_or(fn IS NULL) AS not_subset,
  bool_or(NOT regexp_matches(dst, '^[OPQ][0-9][A-Z0-9]{{3}}[0-9]$|^[A-NR-Z][0-9]([A-Z][A-Z0-9]{{2}}[0-9]){{1,2}}$')) AS bad_format,
  count(fn) AS n_partners, count(inn) AS n_inside FROM u GROUP BY 1"""
)
def list_structure(t: Tables) -> DataFrame:
    """U-05, F-35, F-36: self references, duplicates, subset and format of partner lists."""
    acc = lambda c: F.concat(F.lit("P"), F.lpad((F.col(c) % 100000).cast("string"), 5, "0"))
    odd = F.col("l_partkey") % 40 == 7
    dst = F.when(odd, F.concat(F.lit("p-"), F.col("l_partkey").cast("string"))).otherwise(acc("l_partkey"))
    rows = t.lineitem.select(acc("l_suppkey").alias("src"), dst.alias("dst"), "l_quantity")
    owners = rows.select("src").distinct()
    return E.list_checks(
        owners, "src", rows.where("l_quantity >= 25"), rows.where("l_quantity >= 24 and l_quantity < 26")
    )


@query(
    _RAW_SQL
    + """, x AS (SELECT DISTINCT substr(dst, 6) AS bare FROM d),
own AS (SELECT 'N' || s_suppkey AS bare, s_name AS name FROM supplier WHERE s_acctbal > 4000),
ext AS (SELECT 'N' || c_custkey AS bare, c_name AS name FROM customer)
SELECT CASE WHEN o.name IS NOT NULL THEN 'own' WHEN e.name IS NOT NULL THEN 'external' ELSE 'none' END AS resolved_by, count(*) AS n,
  coalesce(max(coalesce(o.name, e.name)), '') AS last_name
FROM x LEFT JOIN own o ON o.bare = x.bare LEFT JOIN ext e ON e.bare = x.bare GROUP BY 1"""
)
def endpoint_resolution(t: Tables) -> DataFrame:
    """P-04, J-20: partner ids resolved by the own map first, then by the external map."""
    both = E.directed(raw_edges(t), "protein1", "protein2", "score", 35)
    partners = both.select(strip_prefix(F.col("dst"), PREFIX).alias("bare")).distinct()
    bare = lambda c: F.concat(F.lit("N"), F.col(c).cast("string")).alias("bare")
    own = t.supplier.where("s_acctbal > 4000").select(bare("s_suppkey"), F.col("s_name").alias("name"))
    external = t.customer.select(bare("c_custkey"), F.col("c_name").alias("name"))
    named = joins.resolve_endpoint(partners, "bare", own, external, "bare", "name")
    kind = (
        F.when(F.col("name").startswith("Supplier"), "own")
        .when(F.col("name").isNotNull(), "external")
        .otherwise("none")
    )
    return named.groupBy(kind.alias("resolved_by")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max("name"), F.lit("")).alias("last_name")
    )


@query(
    """WITH q AS (SELECT l_suppkey AS old_id, count(*) AS n_rows FROM lineitem GROUP BY 1),
m AS (SELECT s_suppkey AS old_id, s_suppkey // 2 AS new_id FROM supplier WHERE s_nationkey < 12)
SELECT coalesce(m.new_id, q.old_id) AS resolved_id, count(*) AS n_ids, sum(n_rows)::BIGINT AS n_rows
FROM q LEFT JOIN m ON m.old_id = q.old_id GROUP BY 1"""
)
def id_canonicalisation(t: Tables) -> DataFrame:
    """J-21: old ids replaced before anything is matched on them."""
    queried = t.lineitem.groupBy(F.col("l_suppkey").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    resolution = t.supplier.where("s_nationkey < 12").select(
        F.col("s_suppkey").alias("old_id"), F.floor(F.col("s_suppkey") / 2).cast("bigint").alias("new_id")
    )
    out = joins.canonical_id(queried, "id", resolution, "old_id", "new_id")
    return out.groupBy(F.col("id_resolved").alias("resolved_id")).agg(
        F.count(F.lit(1)).alias("n_ids"), F.sum("n").alias("n_rows")
    )
