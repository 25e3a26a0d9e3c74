"""Enrichment, lookup, filtering and resolution queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtab.functions.cells import coordinate
from helixtab.functions.rules import significance_bucket
from helixtab.operators import filters, joins, rollup, scan, sets
from helixtab.plans.registry import Tables, query


@query(
    """SELECT d.lang, l.doc_id IS NOT NULL AS matched, count(*) AS n,
  count(CASE WHEN coalesce(l.quality::VARCHAR, '') = '' THEN 1 END) AS n_blank
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1, 2"""
)
def enrich_left(t: Tables) -> DataFrame:
    """J-01."""
    labels = t.labels.select("doc_id", F.col("quality").cast("string").alias("quality"))
    out = joins.enrich(t.documents.select("doc_id", "lang"), labels, "doc_id", matched="matched")
    return out.groupBy("lang", "matched").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality") == "").alias("n_blank")
    )


@query(
    """SELECT c_custkey, c_name, n_name, r_name, coalesce(n_orders, 0) AS n_orders
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON o_custkey = c_custkey"""
)
def enrich_multi(t: Tables) -> DataFrame:
    """J-02: three sources in one chain."""
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    regions = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    out = joins.enrich_all(
        t.customer, [(nations, "c_nationkey"), (regions, "n_regionkey"), (counts, "c_custkey")]
    )
    return out.select("c_custkey", "c_name", "n_name", "r_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, s_name FROM lineitem
JOIN supplier ON s_suppkey = l_suppkey"""
)
def enrich_duplicated_rows(t: Tables) -> DataFrame:
    """J-03: an entity-level column spread onto a table with many rows per entity."""
    names = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return joins.enrich(rows, names, "l_suppkey", verify_unique=True)


@query(
    """WITH d AS (SELECT doc_id, CASE WHEN lang = 'en' THEN '' ELSE lang END AS lang FROM documents),
m AS (SELECT doc_id, CASE quality WHEN 1 THEN 'good' ELSE '' END AS q FROM labels)
SELECT CASE WHEN d.lang = '' THEN coalesce(m.q, d.lang) ELSE d.lang END AS lang, count(*) AS n
FROM d LEFT JOIN m ON m.doc_id = d.doc_id GROUP BY 1"""
)
def backfill(t: Tables) -> DataFrame:
    """P-19, P-20: only empty cells are filled from the lookup."""
    docs = t.documents.select("doc_id", F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("lang"))
    lookup = t.labels.select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("").alias("q"))
    return joins.backfill(docs, lookup, "doc_id", "lang", "q").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH a AS (SELECT c_custkey, unnest([c_custkey, c_custkey // 2 + c_nationkey, c_nationkey::BIGINT * 1000, c_nationkey::BIGINT]) AS alt,
    unnest([0, 1, 2, 3]) AS rk FROM customer),
h AS (SELECT c_custkey, s_suppkey, s_name, row_number() OVER (PARTITION BY c_custkey ORDER BY rk) AS r
  FROM a JOIN supplier ON s_suppkey = alt WHERE s_acctbal > 6000)
SELECT c.c_custkey, coalesce(h.s_suppkey, -1) AS s_suppkey, coalesce(h.s_name, '') AS s_name,
  CASE WHEN h.s_name IS NULL THEN 'unrecoverable' ELSE 'alternate_after_retired_id' END AS alternate_status
FROM customer c LEFT JOIN h ON h.c_custkey = c.c_custkey AND r = 1"""
)
def alternates_backfill(t: Tables) -> DataFrame:
    """P-21: the first alternate id that resolves."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("bigint")
    alternates = F.array(key, F.floor(key / 2).cast("bigint") + nation, nation * 1000, nation)
    rows = t.customer.select("c_custkey", alternates.alias("alternates"))
    known = t.supplier.where("s_acctbal > 6000").select("s_suppkey", "s_name")
    out = joins.first_alternate(rows, "c_custkey", "alternates", known, "s_suppkey", "s_name")
    return out.select(
        "c_custkey",
        F.coalesce("s_suppkey", F.lit(-1)).alias("s_suppkey"),
        F.coalesce("s_name", F.lit("")).alias("s_name"),
        "alternate_status",
    )


@query(
    """SELECT p_brand, count(*) AS n_rows, count(l_orderkey) AS n_matched, count(DISTINCT p_partkey) AS n_parts
FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1"""
)
def expand_join(t: Tables) -> DataFrame:
    """J-04: a left join that multiplies rows on purpose."""
    lines = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_orderkey")
    return joins.expand(t.part.select("p_partkey", "p_brand"), lines, "p_partkey").groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("l_orderkey").alias("n_matched"),
        F.count_distinct("p_partkey").alias("n_parts"),
    )


@query(
    """SELECT o_orderpriority, coalesce(event_type, '') AS event_type, count(*) AS n_rows
FROM orders LEFT JOIN events ON user_id = o_custkey GROUP BY 1, 2"""
)
def product_join(t: Tables) -> DataFrame:
    """J-05: sizes of a keyed N x M product."""
    orders = t.orders.select(F.col("o_custkey").alias("user_id"), "o_orderpriority")
    return joins.product_profile(
        orders, t.events.select("user_id", "event_type"), "user_id", ["o_orderpriority"], ["event_type"]
    ).fillna("", subset=["event_type"])


@query(
    """WITH l AS (
  SELECT l_orderkey, count(*) AS n_items, string_agg(l_returnflag || l_linestatus, ';' ORDER BY l_returnflag || l_linestatus) AS items,
    CASE WHEN count(CASE WHEN l_tax >= 0.06 THEN 1 END) > 0 THEN 'Y' ELSE 'N' END AS any_flagged,
    coalesce(string_agg(l_returnflag || l_linestatus, ';' ORDER BY l_returnflag || l_linestatus) FILTER (WHERE l_tax >= 0.06), '') AS flagged_items
  FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority, coalesce(n_items, 0) AS n_items, coalesce(items, '') AS items,
  coalesce(any_flagged, '') AS any_flagged, coalesce(flagged_items, '') AS flagged_items
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey"""
)
def fourway_merge(t: Tables) -> DataFrame:
    """J-08, A-31: three tables with the same keys and a fourth collapsed to one row per key."""
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.concat("l_returnflag", "l_linestatus").alias("item"), "l_tax"
    )
    collapsed = rollup.packed_summary(lines, "o_orderkey", "item", F.col("l_tax") >= 0.06)
    prices, states, priorities = (
        t.orders.select("o_orderkey", c) for c in ("o_totalprice", "o_orderstatus", "o_orderpriority")
    )
    wide = joins.merge_tables([prices, states, priorities], "o_orderkey", [collapsed])
    return wide.fillna("", subset=["items", "any_flagged", "flagged_items"]).fillna(0, subset=["n_items"])


@query("SELECT p_partkey, p_name FROM part WHERE p_brand IN (SELECT DISTINCT p_brand FROM part WHERE p_size = 50)")
def list_filter(t: Tables) -> DataFrame:
    """J-09."""
    brands = t.part.where("p_size = 50").select("p_brand").distinct()
    return joins.keep_listed(t.part, brands, "p_brand").select("p_partkey", "p_name")


@query(
    """SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_suppkey IN (
  SELECT s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = 2) GROUP BY 1"""
)
def bridge_filter(t: Tables) -> DataFrame:
    """J-10: kept through a bridge table (line, supplier, nation)."""
    bridge = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    listed = t.nation.where("n_regionkey = 2").select("n_nationkey")
    kept = joins.keep_bridged(t.lineitem, bridge, listed, "l_suppkey", "n_nationkey", "n_nationkey")
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def unmatched_keys(t: Tables) -> DataFrame:
    """J-11."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.unmatched(t.orders, lines, "o_orderkey").select("o_orderkey", "o_custkey")


@query(
    """SELECT lang, count(*) AS n_todo, sum(n_chars)::BIGINT AS chars_todo FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1"""
)
def resume_todo(t: Tables) -> DataFrame:
    """J-12: work left after the finished keys are taken out."""
    return joins.unmatched(t.documents, t.labels, "doc_id").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_todo"), F.sum("n_chars").alias("chars_todo")
    )


@query(
    """WITH x AS (SELECT l_returnflag, unnest([l_partkey, l_suppkey, l_linenumber::BIGINT]) AS k FROM lineitem)
SELECT l_returnflag, n_nation AS nation, count(*) AS n FROM x
JOIN (SELECT s_suppkey, s_nationkey AS n_nation FROM supplier) ON s_suppkey = k GROUP BY 1, 2"""
)
def exploded_key_join(t: Tables) -> DataFrame:
    """J-13: join on the entries of a packed key column."""
    packed = t.lineitem.select("l_returnflag", F.concat_ws(";", "l_partkey", "l_suppkey", "l_linenumber").alias("ids"))
    keys = joins.explode_key(packed, "ids", "id")
    names = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_nationkey").alias("nation"))
    return keys.join(names, "id").groupBy("l_returnflag", "nation").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH p AS (SELECT p_partkey, CASE WHEN p_size = 1 THEN '' ELSE p_brand END AS symbol, 'P' || p_partkey AS a0,
    ['P' || (p_partkey * 2), 'P' || (p_partkey + 3)] AS a1, ['P' || (p_partkey + 1)] AS a2 FROM part),
u AS (SELECT p_partkey, symbol, 0 AS rk, a0 AS acc FROM p WHERE symbol <> '' UNION ALL
  SELECT p_partkey, symbol, 1, unnest(a1) FROM p WHERE symbol <> '' UNION ALL
  SELECT p_partkey, symbol, 2, unnest(a2) FROM p WHERE symbol <> ''),
m AS (SELECT acc, symbol, row_number() OVER (PARTITION BY acc ORDER BY p_partkey, rk, symbol) AS r FROM u)
SELECT l_partkey, coalesce(symbol, 'unresolved') AS symbol, count(*) AS n
FROM lineitem LEFT JOIN m ON acc = 'P' || (l_partkey * 2 + 1) AND r = 1 GROUP BY 1, 2"""
)
def synonym_resolve(t: Tables) -> DataFrame:
    """J-14: primary, secondary and canonical accessions to one symbol."""
    acc = lambda c: F.concat(F.lit("P"), c.cast("string"))
    key = F.col("p_partkey")
    table = t.part.select(
        "p_partkey",
        F.when(F.col("p_size") == 1, "").otherwise(F.col("p_brand")).alias("symbol"),
        acc(key).alias("primary_id"),
        F.concat_ws(";", acc(key * 2), acc(key + 3)).alias("secondary_ids"),
        acc(key + 1).alias("canonical_ids"),
    )
    names = joins.synonym_table(table, "symbol", "primary_id", ["secondary_ids", "canonical_ids"], "p_partkey")
    wanted = t.lineitem.select("l_partkey", acc(F.col("l_partkey") * 2 + 1).alias("accession"))
    return (
        wanted.join(names, "accession", "left")
        .groupBy("l_partkey", F.coalesce("symbol", F.lit("unresolved")).alias("symbol"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    """WITH s AS (SELECT s_suppkey AS k, 'Name' || (s_suppkey * 3) AS nm, s_nationkey FROM supplier WHERE s_acctbal > 0),
c AS (SELECT c_custkey, 'Name' || c_custkey AS nm FROM customer),
one AS (SELECT c_custkey, s_nationkey, 'uniprot' AS match_type FROM c JOIN s ON k = c_custkey),
two AS (SELECT c_custkey, s_nationkey, CASE WHEN s.nm IS NULL THEN 'none' ELSE 'symbol' END AS match_type
  FROM c LEFT JOIN s ON s.nm = c.nm WHERE c_custkey NOT IN (SELECT k FROM s))
SELECT c_custkey, coalesce(s_nationkey, -1) AS s_nationkey, match_type FROM one
UNION ALL SELECT c_custkey, coalesce(s_nationkey, -1), match_type FROM two"""
)
def fallback_join(t: Tables) -> DataFrame:
    """J-17: by key, else by name."""
    name = lambda c: F.concat(F.lit("Name"), c.cast("string"))
    right = t.supplier.where("s_acctbal > 0").select(
        F.col("s_suppkey").alias("k"), name(F.col("s_suppkey") * 3).alias("s_label"), "s_nationkey"
    )
    left = t.customer.select("c_custkey", name(F.col("c_custkey")).alias("c_label"))
    out = joins.fallback_join(left, right, ("c_custkey", "k"), ("c_label", "s_label"))
    return out.select("c_custkey", F.coalesce("s_nationkey", F.lit(-1)).alias("s_nationkey"), "match_type")


@query(
    """WITH o AS (SELECT DISTINCT p_brand AS sym FROM part WHERE p_size = 50 AND p_type = 'ECONOMY'),
th AS (SELECT DISTINCT p_brand AS sym FROM part),
rs AS (SELECT DISTINCT p_brand AS sym, 'Brand#' || (substr(p_brand, 7)::INTEGER + 1) AS cur FROM part WHERE p_brand <> 'Brand#7'),
x AS (SELECT th.sym, rs.cur, o2.sym AS mine FROM th LEFT JOIN rs ON rs.sym = th.sym LEFT JOIN o o2 ON o2.sym = rs.cur
  WHERE th.sym NOT IN (SELECT sym FROM o))
SELECT sym, CASE WHEN cur IS NULL THEN 'unresolved' WHEN mine IS NOT NULL THEN 'already_covered' ELSE 'new' END AS list_status FROM x"""
)
def list_reconcile(t: Tables) -> DataFrame:
    """J-29."""
    brand = F.col("p_brand").alias("sym")
    ours = t.part.where("p_size = 50 and p_type = 'ECONOMY'").select(brand).distinct()
    theirs = t.part.select(brand).distinct()
    following = F.concat(F.lit("Brand#"), (F.substr("sym", F.lit(7)).cast("int") + 1).cast("string"))
    resolved = theirs.where("sym <> 'Brand#7'").select("sym", following.alias("cur"))
    return joins.reconcile_lists(theirs, ours, resolved, "sym", "cur").select("sym", "list_status")


_OBSERVED = ["l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"]

_OBS_SQL = """
WITH b AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_extendedprice::DECIMAL(18,2) AS v, l_quantity,
    row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS i FROM lineitem),
o AS (
  SELECT DISTINCT l_partkey, l_suppkey, l_linenumber, l_returnflag,
    CASE WHEN l_discount >= 0.09 THEN 'pathogenic' ELSE 'benign' END AS bucket FROM lineitem WHERE l_discount >= 0.09 OR l_tax = 0),
x AS (
  SELECT v, o.bucket FROM b JOIN o USING (l_partkey, l_suppkey, l_linenumber, l_returnflag)
  UNION ALL SELECT v, 'background' FROM b WHERE i % 60 = 0)
SELECT bucket, count(*) AS n, sum(v)::DOUBLE / count(*) AS mean, round(quantile_cont(v::DOUBLE, 0.25), 6) AS q1,
  round(quantile_cont(v::DOUBLE, 0.5), 6) AS median, round(quantile_cont(v::DOUBLE, 0.75), 6) AS q3 FROM x GROUP BY 1"""


@query(_OBS_SQL)
def composite_key_match(t: Tables) -> DataFrame:
    """J-15, W-15, A-44, F-26: observed keys onto the scan, and a one-in-sixty background."""
    lines = t.lineitem
    label = F.when(F.col("l_discount") >= 0.09, "Pathogenic").otherwise("Benign")
    observed = lines.where("l_discount >= 0.09 or l_tax = 0").select(
        *_OBSERVED, significance_bucket(label).alias("bucket")
    )
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    value = F.col("l_extendedprice").alias("v")
    matched = joins.composite_match(lines, observed, _OBSERVED, "bucket").select("bucket", value)
    background = scan.every_nth(lines.select(*order), order, 60).select(F.lit("background").alias("bucket"), value)
    rows = matched.unionAll(background)
    boxes = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    return scan.distribution(rows, "bucket", "v", boxes).withColumns({c: F.round(c, 6) for c in boxes})


@query(
    """WITH m AS (SELECT s_suppkey, CASE WHEN s_nationkey = 4 THEN NULL WHEN s_nationkey < 10 THEN 'S' || s_suppkey ELSE s_name END AS official FROM supplier)
SELECT CASE WHEN official IS NULL THEN 'unmapped' WHEN official <> s_name THEN 'fixed' ELSE 'ok' END AS alias_status,
  count(*) AS n, min(l_partkey || '|' || coalesce(official, s_name) || '|' || l_linenumber) AS first_key
FROM lineitem JOIN supplier USING (l_suppkey) LEFT JOIN m ON m.s_suppkey = l_suppkey GROUP BY 1""".replace(
        "JOIN supplier USING (l_suppkey)", "JOIN supplier s ON s.s_suppkey = l_suppkey"
    )
)
def alias_rewrite(t: Tables) -> DataFrame:
    """J-23, F-14: the name part of a compound key replaced by the manifest's name."""
    names = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("alias"), "s_nationkey")
    official = (
        F.when(F.col("s_nationkey") < 10, F.concat(F.lit("S"), F.col("l_suppkey").cast("string")))
        .otherwise(F.col("alias"))
    )
    manifest = names.where("s_nationkey <> 4").select("l_suppkey", official.alias("official"))
    rows = t.lineitem.select("l_partkey", "l_suppkey", "l_linenumber").join(names.drop("s_nationkey"), "l_suppkey")
    fixed = joins.rewrite_alias(rows, manifest, "l_suppkey", "alias", "official")
    key = F.concat_ws("|", F.col("l_partkey").cast("string"), "alias", F.col("l_linenumber").cast("string"))
    return fixed.groupBy("alias_status").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"))


@query(
    """WITH f AS (SELECT CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS tax, CASE WHEN l_discount < 0.05 THEN '' ELSE 'd' END AS discount,
    l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 3000) AS fl FROM lineitem)
SELECT 'all' AS scope, 'tax' AS "column", count(tax) AS n FROM f
UNION ALL SELECT 'flagged', 'tax', count(CASE WHEN fl THEN tax END) FROM f
UNION ALL SELECT 'all', 'discount', count(CASE WHEN discount <> '' THEN 1 END) FROM f
UNION ALL SELECT 'flagged', 'discount', count(CASE WHEN fl AND discount <> '' THEN 1 END) FROM f"""
)
def coverage_flag(t: Tables) -> DataFrame:
    """J-24: coverage in all rows and in the rows on a list."""
    rows = t.lineitem.select(
        "l_suppkey",
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("tax"),
        F.when(F.col("l_discount") < 0.05, "").otherwise("d").alias("discount"),
    )
    listed = t.supplier.where("s_acctbal > 3000").select(F.col("s_suppkey").alias("l_suppkey"))
    flagged = joins.flag_membership(rows, listed, "l_suppkey", "on_list")
    return joins.coverage_counts(flagged, ["tax", "discount"], "on_list")


@query(
    """SELECT n_name, r_name, count(*) AS n_lines, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS revenue
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
GROUP BY 1, 2"""
)
def id_bridge(t: Tables) -> DataFrame:
    """J-28: ids converted through a bridge table."""
    per = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue")
    )
    bridge = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    nations = t.nation.select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    return (
        joins.through_bridges(per, [(bridge, "s_suppkey"), (nations, "n_nationkey"), (t.region, "r_regionkey")])
        .groupBy("n_name", "r_name")
        .agg(F.sum("n_lines").alias("n_lines"), F.sum("revenue").cast("double").alias("revenue"))
    )


@query(
    """SELECT DISTINCT c_custkey, s_suppkey FROM customer, supplier
WHERE (c_custkey // 150 = s_suppkey // 10 OR s_suppkey = c_custkey) AND floor(s_acctbal / 500) = floor(c_acctbal / 500)"""
)
def widened_candidates(t: Tables) -> DataFrame:
    """J-30: same group or cross-referenced, and of equal size."""
    rows = t.customer.select(
        "c_custkey", F.floor(F.col("c_custkey") / 150).alias("gene"), F.floor(F.col("c_acctbal") / 500).alias("size")
    )
    candidates = t.supplier.select(
        "s_suppkey", F.floor(F.col("s_suppkey") / 10).alias("gene"), F.floor(F.col("s_acctbal") / 500).alias("size")
    )
    xrefs = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), "s_suppkey")
    return joins.widened_candidates(rows, candidates, xrefs, "c_custkey", "gene", "s_suppkey", "size")


@query(
    """WITH o AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'),
n AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
SELECT 'union' AS op, count(*) AS n, coalesce(sum(id), 0)::BIGINT AS checksum FROM (SELECT id FROM o UNION SELECT id FROM n)
UNION ALL SELECT 'difference', count(*), coalesce(sum(id), 0)::BIGINT FROM (SELECT id FROM o EXCEPT SELECT id FROM n)
UNION ALL SELECT 'intersection', count(*), coalesce(sum(id), 0)::BIGINT FROM (SELECT id FROM o INTERSECT SELECT id FROM n)
UNION ALL SELECT 'stack', count(*), coalesce(sum(id), 0)::BIGINT FROM (SELECT id FROM o UNION ALL SELECT id FROM n)"""
)
def list_set_ops(t: Tables) -> DataFrame:
    """U-01 to U-04."""
    early = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    ids = lambda cond: t.orders.where(cond).select(F.col("o_custkey").alias("id")).distinct()
    old, new = ids(early), ids(~early)
    results = {
        "union": sets.union_ids([old, new]),
        "difference": sets.difference(old, new),
        "intersection": sets.intersection(old, new),
        "stack": sets.stack([old, new]),
    }
    return sets.stack(
        [
            df.agg(
                F.lit(op).alias("op"),
                F.count(F.lit(1)).alias("n"),
                F.coalesce(F.sum("id"), F.lit(0)).alias("checksum"),
            )
            for op, df in results.items()
        ]
    )


@query(
    """SELECT s_suppkey AS id, s_name AS name FROM supplier
UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)"""
)
def merge_with_priority(t: Tables) -> DataFrame:
    """U-07: existing entries stay, new ones are added."""
    existing = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    new = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return sets.keep_existing(existing, new, "id")


@query(
    """WITH a AS (SELECT DISTINCT o_custkey AS id FROM orders), b AS (SELECT DISTINCT user_id AS id FROM events)
SELECT (SELECT count(*) FROM a) AS n_first, (SELECT count(*) FROM b) AS n_second,
  (SELECT count(*) FROM a WHERE id IN (SELECT id FROM b)) AS n_both,
  (SELECT count(*) FROM a WHERE id NOT IN (SELECT id FROM b)) AS n_only_first,
  (SELECT count(*) FROM b WHERE id NOT IN (SELECT id FROM a)) AS n_only_second"""
)
def list_overlap(t: Tables) -> DataFrame:
    """U-02, U-03: what two lists share."""
    return sets.overlap_report(
        t.orders.select(F.col("o_custkey").alias("id")), t.events.select(F.col("user_id").alias("id")), "id"
    )


@query(
    """WITH r AS (
  SELECT l_orderkey, l_returnflag AS contig_raw,
    CASE l_returnflag WHEN 'A' THEN (l_linenumber + 15)::VARCHAR WHEN 'N' THEN 'MT' ELSE (l_linenumber + 19)::VARCHAR END AS contig,
    CASE WHEN l_quantity < 5 THEN 'na' WHEN l_quantity < 9 THEN (-l_linenumber)::VARCHAR ELSE l_partkey::VARCHAR END AS pos,
    CASE WHEN l_discount = 0 THEN '-' ELSE 'A' END AS ref, CASE WHEN l_tax = 0 THEN '' ELSE 'G' END AS alt, l_linestatus AS assembly
  FROM lineitem)
SELECT CASE WHEN assembly <> 'O' THEN 'other_assembly' WHEN contig::INTEGER > 22 THEN 'unplaced'
    WHEN coalesce(try_cast(pos AS BIGINT), 0) < 1 THEN 'bad_position' WHEN ref = '-' OR alt = '' THEN 'bad_allele' ELSE 'usable' END AS reason,
  count(*) AS n, count(DISTINCT CASE WHEN contig = 'MT' THEN 'chrM' ELSE 'chr' || contig END) AS n_contigs
FROM r GROUP BY 1""".replace("contig::INTEGER > 22", "coalesce(try_cast(contig AS INTEGER), 0) > 22")
)
def reject_reasons(t: Tables) -> DataFrame:
    """P-01, P-05, P-06, P-08, P-11, Q-11: every row ends in one counted outcome."""
    number = F.col("l_linenumber")
    contig = (
        F.when(F.col("l_returnflag") == "A", (number + 15).cast("string"))
        .when(F.col("l_returnflag") == "N", "MT")
        .otherwise((number + 19).cast("string"))
    )
    pos = (
        F.when(F.col("l_quantity") < 5, "na")
        .when(F.col("l_quantity") < 9, (-number).cast("string"))
        .otherwise(F.col("l_partkey").cast("string"))
    )
    rows = filters.keep_columns(
        t.lineitem.withColumns(
            {
                "contig": contig,
                "pos": pos,
                "ref": F.when(F.col("l_discount") == 0, "-").otherwise("A"),
                "alt": F.when(F.col("l_tax") == 0, "").otherwise("G"),
                "assembly": F.col("l_linestatus"),
            }
        ),
        ["contig", "pos", "ref", "alt", "assembly"],
    )
    place = filters.variant_reason(F.col("contig"), F.col("pos"))
    alleles = filters.usable_allele(F.col("ref")) & filters.usable_allele(F.col("alt"))
    judged = filters.with_reason(
        rows,
        [
            (F.col("assembly") != "O", "other_assembly"),
            (place == "unplaced", "unplaced"),
            (place == "bad_position", "bad_position"),
            (~alleles, "bad_allele"),
        ],
    )
    return judged.groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(filters.contig_name(F.col("contig"))).alias("n_contigs")
    )


@query(
    """WITH e AS (SELECT event_type, CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'u' || user_id END AS label, CASE event_type WHEN 'error' THEN 'cell' ELSE '' END AS cell,
   'raw' || user_id AS raw, value < 1 AS is_wt, value FROM events)
SELECT coalesce(label, raw) AS tissue, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM e WHERE cell = '' AND NOT is_wt GROUP BY 1"""
)
def bulk_rows(t: Tables) -> DataFrame:
    """P-10, P-15: rows of cell types and reference rows left out, label from the first name given."""
    user = F.col("user_id").cast("string")
    rows = t.events.select(
        F.when(F.col("user_id") % 3 != 0, F.concat(F.lit("u"), user)).alias("label"),
        F.concat(F.lit("raw"), user).alias("raw"),
        F.when(F.col("event_type") == "error", "cell").otherwise("").alias("cell"),
        F.when(F.col("value") < 1, "True").otherwise("False").alias("is_wt"),
        "value",
    )
    kept = filters.bulk_only(filters.without_reference_rows(rows, "is_wt"), "cell", "label", "raw", "tissue")
    return kept.groupBy("tissue").agg(F.count(F.lit(1)).alias("n"), rollup.exact_sum(F.col("value")).alias("total"))


@query(
    """SELECT o_orderkey, o_custkey AS src_o_custkey, CASE o_orderstatus WHEN 'F' THEN 1.0 ELSE o_totalprice END AS src_o_totalprice,
  CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS finished, o_orderpriority AS src_priority FROM orders"""
)
def column_rules(t: Tables) -> DataFrame:
    """P-16 to P-18, P-22, Q-04, Q-05, S-17: stale columns, prefixes, canonical names and overrides."""
    base = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    stale = base.withColumn("finished", F.lit("?"))
    fresh = filters.replace_columns(
        stale, ["finished"], {"finished": F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N")}
    )
    fixed = filters.override(fresh, F.col("o_orderstatus") == "F", o_totalprice=F.lit(1.0))
    rules = [
        (lambda h: "custkey" in h, "o_custkey"),
        (lambda h: "price" in h, "o_totalprice"),
        (lambda h: "priority" in h, "priority"),
    ]
    named = filters.canonical_headers(fixed.drop("o_orderstatus"), rules, keep=["o_orderkey", "finished"])
    return filters.prefix_columns(named, "src_", keep=["o_orderkey", "finished"])


_PLACE_TEXT = """CASE WHEN l_tax = 0 THEN '' WHEN l_discount = 0 THEN 'chr1:5' WHEN l_linenumber = 7 THEN 'MT' ELSE CAST(l_linenumber + 19 AS STRING) END
 || CASE WHEN l_tax = 0 OR l_discount = 0 THEN '' ELSE ':' || CAST(l_partkey AS STRING) || '-' || CAST(l_partkey + l_linenumber AS STRING) END"""


@query(
    f"""WITH r AS (SELECT {_PLACE_TEXT} AS place, CASE WHEN l_quantity < 5 THEN '-' ELSE 'A' END AS ref, l_returnflag AS alt FROM lineitem),
g AS (SELECT *, regexp_extract(place, '^([0-9XYMT]+):([0-9]+)-([0-9]+)$', ['c', 's', 'e']) AS m FROM r),
x AS (SELECT CASE WHEN m.c = '' OR NOT (m.c IN ('X', 'Y', 'MT') OR try_cast(m.c AS INTEGER) BETWEEN 1 AND 22) THEN 'no_position'
   WHEN ref = '-' OR alt = '-' THEN 'bad_allele' ELSE 'usable' END AS reason, m.c AS c, try_cast(m.s AS BIGINT) AS s, try_cast(m.e AS BIGINT) AS e FROM g)
SELECT reason, coalesce(nullif(c, ''), 'none') AS contig, count(*) AS n, coalesce(sum(s), 0)::BIGINT AS sum_start, coalesce(sum(e), 0)::BIGINT AS sum_stop FROM x GROUP BY 1, 2"""
)
def coordinate_parse(t: Tables) -> DataFrame:
    """P-07, P-08: variants given by a coordinate text."""
    rows = t.lineitem.select(
        F.expr(_PLACE_TEXT).alias("place"),
        F.when(F.col("l_quantity") < 5, "-").otherwise("A").alias("ref"),
        F.col("l_returnflag").alias("alt"),
    )
    place = coordinate(F.col("place"))
    read = rows.select(
        filters.coordinate_reason(F.col("place"), F.col("ref"), F.col("alt")).alias("reason"),
        *[c.alias(n) for n, c in place.items()],
    )
    return read.groupBy("reason", F.coalesce("contig", F.lit("none")).alias("contig")).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("start"), F.lit(0)).alias("sum_start"),
        F.coalesce(F.sum("stop"), F.lit(0)).alias("sum_stop"),
    )
