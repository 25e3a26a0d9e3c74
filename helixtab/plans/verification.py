"""Verification of merges, chunks and invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtab.operators import quality, rollup
from helixtab.operators.scan import every_nth
from helixtab.plans.registry import Tables, query


def altered_orders(t: Tables) -> DataFrame:
    """Orders without the urgent ones that are open, some prices changed, two columns swapped out."""
    price = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    kept = t.orders.where("not (o_orderstatus = 'O' and o_orderpriority = '1-URGENT')")
    return kept.withColumn("o_totalprice", price).drop("o_orderdate").withColumn("origin", F.lit("new"))


@query(
    """WITH n AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority
  FROM orders WHERE NOT (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')),
d AS (SELECT o.o_orderkey, o.o_totalprice AS a, n.o_totalprice AS b FROM orders o JOIN n ON n.o_orderkey = o.o_orderkey WHERE o.o_totalprice <> n.o_totalprice),
m AS (SELECT min(o_orderkey) AS k FROM d)
SELECT 'rows_old' AS "check", (SELECT count(*) FROM orders) AS n, '' AS has_sample
UNION ALL SELECT 'rows_new', count(*), '' FROM n
UNION ALL SELECT 'only_old', (SELECT count(*) FROM orders) - count(*), '' FROM n
UNION ALL SELECT 'only_new', 0, ''
UNION ALL SELECT 'repeated_old', (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders), ''
UNION ALL SELECT 'repeated_new', count(*) - count(DISTINCT o_orderkey), '' FROM n
UNION ALL SELECT 'mismatch:o_custkey', 0, '' UNION ALL SELECT 'mismatch:o_orderstatus', 0, '' UNION ALL SELECT 'mismatch:o_orderpriority', 0, ''
UNION ALL SELECT 'mismatch:o_totalprice', count(*), (SELECT k::VARCHAR FROM m) FROM d
UNION ALL SELECT 'columns_added', 1, 'origin' UNION ALL SELECT 'columns_lost', 1, 'o_orderdate'"""
)
def table_diff(t: Tables) -> DataFrame:
    """Q-01."""
    diff = quality.table_diff(t.orders, altered_orders(t), "o_orderkey")
    return diff.select("check", "n", F.substring_index("sample", ":", 1).alias("has_sample"))


@query(
    """WITH i AS (SELECT o_orderkey AS id, (o_orderkey // 1000)::INTEGER AS chunk FROM orders),
u AS (SELECT i.chunk, i.id, count(l_orderkey) AS n FROM i LEFT JOIN lineitem ON l_orderkey = i.id GROUP BY 1, 2)
SELECT chunk, count(*) AS n_input, count(*) AS n_distinct, sum(n)::BIGINT AS n_output, count(CASE WHEN n = 0 THEN 1 END) AS n_missing,
  CASE WHEN count(CASE WHEN n = 0 THEN 1 END) > 0 THEN 'incomplete' ELSE 'complete' END AS status FROM u GROUP BY 1"""
)
def chunk_check(t: Tables) -> DataFrame:
    """Q-07, J-12: ids of each chunk against the rows of its results."""
    chunk = F.floor(F.col("id") / 1000).cast("int").alias("chunk")
    inputs = t.orders.select(F.col("o_orderkey").alias("id")).select("id", chunk)
    outputs = t.lineitem.select(F.col("l_orderkey").alias("id")).select("id", chunk)
    return quality.chunk_report(inputs, outputs, "chunk", "id").drop("n_unexpected")


@query(
    """WITH a AS (SELECT c_custkey AS id FROM customer), b AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_totalprice > 200000), c AS (SELECT DISTINCT user_id AS id FROM events),
u AS (SELECT id FROM a UNION SELECT id FROM b UNION SELECT id FROM c),
f AS (SELECT concat_ws('+', CASE WHEN id IN (SELECT id FROM a) THEN 'customer' END, CASE WHEN id IN (SELECT id FROM b) THEN 'orders' END, CASE WHEN id IN (SELECT id FROM c) THEN 'events' END) AS present_in FROM u)
SELECT present_in, count(*) AS n_keys FROM f GROUP BY 1"""
)
def key_sets(t: Tables) -> DataFrame:
    """Q-06: keys by the tables that hold them."""
    return quality.key_set_report(
        {
            "customer": t.customer.select(F.col("c_custkey").alias("id")),
            "orders": t.orders.where("o_totalprice > 200000").select(F.col("o_custkey").alias("id")),
            "events": t.events.select(F.col("user_id").alias("id")),
        },
        "id",
    )


@query(
    """SELECT 'lang' AS "column", count(CASE WHEN lang <> '' THEN 1 END) AS n_filled, round(count(CASE WHEN lang <> '' THEN 1 END) * 100.0 / count(*), 6)::DOUBLE AS pct_filled FROM documents
UNION ALL SELECT 'quality', count(l.quality), round(count(l.quality) * 100.0 / count(*), 6)::DOUBLE FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
)
def coverage_after_merge(t: Tables) -> DataFrame:
    """Q-12."""
    merged = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return quality.fill_rates(merged, ["lang", "quality"]).withColumn("pct_filled", F.round("pct_filled", 6).cast("double"))


@query(
    """WITH e AS (SELECT * FROM (VALUES ('BUILDING', '1-URGENT'), ('MACHINERY', '5-LOW'), ('FURNITURE', '3-MEDIUM'), ('ABSENT', '2-HIGH')) AS v(segment, expected)),
c AS (SELECT c_mktsegment AS segment, o_orderpriority AS p, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2),
t AS (SELECT segment, p FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY n DESC, p) AS r FROM c) WHERE r = 1)
SELECT e.segment, e.expected, CASE WHEN t.p IS NULL THEN 'absent' WHEN t.p = e.expected THEN 'ok' ELSE 'mismatch' END AS verdict
FROM e LEFT JOIN t ON t.segment = e.segment"""
)
def spot_check(t: Tables) -> DataFrame:
    """Q-10: a few known entities against the commonest value found for them."""
    from helixtab.operators.select import best_row

    expected = t.spark.createDataFrame(
        [("BUILDING", "1-URGENT"), ("MACHINERY", "5-LOW"), ("FURNITURE", "3-MEDIUM"), ("ABSENT", "2-HIGH")],
        "segment string, expected string",
    )
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    counts = t.orders.join(customers, "o_custkey").groupBy("segment", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n")
    )
    top = best_row(counts, "segment", [F.col("n").desc(), F.col("o_orderpriority").asc()]).select(
        "segment", F.col("o_orderpriority").alias("top"), F.col("o_orderpriority").alias("labels")
    )
    return quality.spot_check(expected, top, "segment", "expected", "top", "labels").select(
        "segment", "expected", "verdict"
    )


@query(
    """SELECT 'full' AS scope, count(*) AS rows, count(CASE WHEN l_discount >= 0.05 THEN 1 END) AS hits FROM lineitem
UNION ALL SELECT 'sample', count(*), count(CASE WHEN l_discount >= 0.05 THEN 1 END) FROM (
  SELECT l_discount, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS i FROM lineitem) WHERE i % 60 = 0"""
)
def sample_vs_full(t: Tables) -> DataFrame:
    """Q-13: a rate in a systematic sample and in the whole table."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    sample = every_nth(t.lineitem.select(*order, "l_discount"), order, 60)
    return quality.rate_sample_vs_full(t.lineitem, sample, F.col("l_discount") >= 0.05)


@query(
    """WITH c AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2),
i AS (SELECT * FROM (VALUES (1)) AS v(x))
SELECT 'order key unique' AS invariant, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS n_violations
UNION ALL SELECT 'line key unique', (SELECT count(*) FROM c WHERE n > 1)
UNION ALL SELECT 'every line has an order', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
UNION ALL SELECT 'copy equals original', (SELECT count(*) FROM (SELECT o_orderkey, o_custkey, o_totalprice FROM orders
  EXCEPT ALL SELECT o_orderkey, o_custkey + CASE WHEN o_orderkey % 10 = 3 THEN 1 ELSE 0 END, o_totalprice FROM orders))
UNION ALL SELECT 'outcomes add up', (SELECT count(*) FROM lineitem WHERE l_discount = 0) - (SELECT count(*) FROM lineitem)"""
)
def invariant_checks(t: Tables) -> DataFrame:
    """Q-03, Q-06, Q-11, Q-14: violations per invariant; a copied column is altered and outcomes are left out on purpose."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    altered = F.col("o_custkey") + F.when(F.col("o_orderkey") % 10 == 3, 1).otherwise(0)
    copied = quality.table_diff(
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice"),
        t.orders.select("o_orderkey", altered.alias("o_custkey"), "o_totalprice", "o_orderstatus"),
        "o_orderkey",
    ).where("check like 'mismatch:%' or check like 'only_%'")
    outcome = F.when(F.col("l_discount") == 0, "free").when(F.col("l_tax") == 0, "untaxed").otherwise("plain")
    outcomes = quality.outcome_counts(t.lineitem.withColumn("outcome", outcome)).where("outcome = 'free'")
    named = lambda label, df, n: df.agg(F.lit(label).alias("invariant"), n.cast("bigint").alias("n_violations"))
    rows = F.count(F.lit(1))
    total = t.lineitem.agg(F.count(F.lit(1))).scalar()
    return (
        named("order key unique", quality.duplicate_keys(t.orders, "o_orderkey"), rows)
        .unionAll(named("line key unique", quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]), rows))
        .unionAll(named("every line has an order", lines.join(t.orders, "o_orderkey", "left_anti"), rows))
        .unionAll(named("copy equals original", copied, F.sum("n")))
        .unionAll(named("outcomes add up", outcomes, F.sum("n")).withColumn("n_violations", F.col("n_violations") - total))
    )


@query(
    """WITH p AS (SELECT l_orderkey AS k, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS a FROM lineitem GROUP BY 1),
f AS (SELECT l_orderkey AS k, l_returnflag, sum(l_quantity::DECIMAL(18,2)) AS q FROM lineitem GROUP BY 1, 2),
g AS (SELECT k, sum(q)::DOUBLE AS b FROM f GROUP BY 1)
SELECT count(*) AS n_compared, count(CASE WHEN abs(a - b) < 0.001 THEN 1 END) AS n_agree,
  count(CASE WHEN abs(a - b) >= 0.001 THEN 1 END) AS n_differ FROM p JOIN g ON g.k = p.k"""
)
def reconcile_paths(t: Tables) -> DataFrame:
    """Q-08: totals summed from lines and from groups of lines."""
    direct = t.lineitem.groupBy("l_orderkey").agg(rollup.exact_sum(F.col("l_quantity")).alias("a"))
    staged = (
        t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("q"))
        .groupBy("l_orderkey").agg(F.sum("q").cast("double").alias("b"))
    )
    return quality.reconcile(direct, staged, "l_orderkey", "a", "b")
