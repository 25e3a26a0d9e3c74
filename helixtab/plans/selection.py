"""Record selection, ranking and ordered-sample queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtab.functions.rules import reliability, tier
from helixtab.operators import scan, select, stats
from helixtab.plans.registry import Tables, query

_PICK = """SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS r FROM events) WHERE r = 1"""


@query(_PICK.format(order="ts, event_id"))
def first_wins(t: Tables) -> DataFrame:
    """W-01."""
    return select.first_wins(t.events, "user_id", ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "value"
    )


@query(_PICK.format(order="ts DESC, event_id DESC"))
def last_wins(t: Tables) -> DataFrame:
    """W-02."""
    return select.last_wins(t.events, "user_id", ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "value"
    )


@query(
    """SELECT source, doc_id, n_chars, md5(text) AS digest FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY length(text) DESC, doc_id) AS r
  FROM documents WHERE coalesce(source, '') <> '') WHERE r = 1"""
)
def longest_per_group(t: Tables) -> DataFrame:
    """W-03."""
    return select.longest(t.documents, "source", "text", "doc_id").select(
        "source", "doc_id", "n_chars", F.md5(F.col("text").cast("binary")).alias("digest")
    )


_TX_SQL = """
WITH c AS (
  SELECT l_partkey, l_orderkey || '.' || l_linenumber || '.' || l_suppkey || '.' || CAST(l_extendedprice * 100 AS BIGINT) AS tx,
         l_quantity = p_size AS len_match, l_returnflag = 'A' AS preferred, l_linestatus = 'O' AS canonical,
         l_quantity
  FROM lineitem JOIN part ON p_partkey = l_partkey),
r AS (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY len_match DESC, preferred DESC, canonical DESC, l_quantity DESC, tx) AS rn FROM c),
n AS (SELECT l_partkey, count(DISTINCT tx) AS n_candidate_transcripts FROM c GROUP BY 1)
SELECT r.l_partkey, tx, len_match,
       CASE WHEN preferred THEN 'MANE_Select' WHEN canonical THEN 'Ensembl_canonical' ELSE 'longest_CDS' END AS selection_rule,
       n_candidate_transcripts
FROM r JOIN n ON n.l_partkey = r.l_partkey WHERE rn = 1"""


@query(_TX_SQL)
def transcript_select(t: Tables) -> DataFrame:
    """W-04: five order keys, the rule that applied and the number of candidates."""
    tx = F.concat_ws(
        ".",
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_suppkey").cast("string"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
    )
    sizes = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size")
    candidates = t.lineitem.join(sizes, "l_partkey").select(
        "l_partkey",
        tx.alias("tx"),
        (F.col("l_quantity") == F.col("p_size")).alias("len_match"),
        (F.col("l_returnflag") == "A").alias("preferred"),
        (F.col("l_linestatus") == "O").alias("canonical"),
        "l_quantity",
    )
    return select.transcript_choice(
        candidates, "l_partkey", "tx", "len_match", "preferred", "canonical", "l_quantity"
    ).select("l_partkey", "tx", "len_match", "selection_rule", "n_candidate_transcripts")


@query(
    """WITH r AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_totalprice DESC, o_orderkey) AS rn,
         count(*) OVER (PARTITION BY o_custkey) AS n_orthologs FROM orders)
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, n_orthologs FROM r WHERE rn = 1"""
)
def best_per_group(t: Tables) -> DataFrame:
    """W-06: best row per group with the group's size."""
    order = [
        (F.col("o_orderstatus") == "F").desc(),
        F.col("o_totalprice").desc(),
        F.col("o_orderkey").asc(),
    ]
    return select.best_row(t.orders, "o_custkey", order, "n_orthologs").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "n_orthologs"
    )


@query(
    """WITH x AS (
  SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'O' THEN o_custkey || '-1' ELSE o_custkey || '-2' END AS tag FROM orders),
p AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (tag = o_custkey || '-1') DESC, o_orderkey) AS r FROM x)
SELECT c_custkey AS o_custkey, coalesce(o_orderkey, -1) AS o_orderkey,
       CASE WHEN p.tag IS NULL THEN 'no_ensembl_xref' WHEN p.tag = c_custkey || '-1' THEN 'canonical_isoform_match'
            ELSE 'fallback_no_canonical_tag' END AS transcript_selection_method
FROM customer LEFT JOIN p ON p.o_custkey = c_custkey AND r = 1"""
)
def tagged_pick(t: Tables) -> DataFrame:
    """W-05."""
    end = F.when(F.col("o_orderstatus") == "O", "-1").otherwise("-2")
    refs = t.orders.select(
        "o_custkey",
        "o_orderkey",
        F.col("o_orderkey").alias("ord"),
        F.concat(F.col("o_custkey").cast("string"), end).alias("tag"),
    )
    owners = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    return select.tagged_choice(owners, refs, "o_custkey", "o_orderkey", "tag", "ord").fillna(
        -1, subset=["o_orderkey"]
    )


_TIER_SQL = """
WITH m AS (
  SELECT c_custkey, c_acctbal, c_mktsegment <> 'MACHINERY' AS mapped, c_nationkey FROM customer),
r AS (
  SELECT c_custkey, (rank() OVER (ORDER BY c_acctbal) + (count(*) OVER (PARTITION BY c_acctbal) - 1) / 2) / count(*) OVER () * 100 AS p
  FROM m WHERE mapped)
SELECT m.c_custkey, coalesce(round(r.p, 6), -1.0) AS percentile,
  CASE WHEN NOT mapped THEN '' WHEN r.p >= 75 THEN 'high' WHEN r.p <= 25 THEN 'low' ELSE 'medium' END AS tier,
  mapped AND c_acctbal >= 1000 AND c_nationkey >= 3 AS reliable,
  CASE WHEN NOT mapped THEN 'not mapped' ELSE concat_ws('; ', CASE WHEN c_acctbal < 1000 THEN 'balance below 1000' END,
       CASE WHEN c_nationkey < 3 THEN 'nation not covered' END) END AS note
FROM m LEFT JOIN r ON r.c_custkey = m.c_custkey"""


@query(_TIER_SQL)
def percentile_tier(t: Tables) -> DataFrame:
    """W-07, W-08, F-40."""
    mapped = F.col("c_mktsegment") != "MACHINERY"
    rows = t.customer.withColumn("scored", F.when(mapped, F.col("c_acctbal")))
    ranked = scan.percentile_rank(rows, "scored", "pct").withColumn("pct", F.col("pct") * 100)
    reliable, note = reliability(
        mapped,
        {
            "balance below 1000": F.col("c_acctbal") >= 1000,
            "nation not covered": F.col("c_nationkey") >= 3,
        },
        "not mapped",
    )
    return ranked.select(
        "c_custkey",
        F.coalesce(F.round("pct", 6), F.lit(-1.0)).alias("percentile"),
        tier(F.col("pct"), mapped).alias("tier"),
        reliable.alias("reliable"),
        note.alias("note"),
    )


@query(
    """WITH d AS (
  SELECT event_type, date_trunc('hour', ts)::VARCHAR AS hour, sum(value::DECIMAL(18,2))::DOUBLE AS v FROM events GROUP BY 1, 2),
w AS (
  SELECT event_type, hour, v, count(v) OVER f AS n, avg(v) OVER f AS m FROM d
  WINDOW f AS (PARTITION BY event_type ORDER BY hour ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING))
SELECT event_type, hour, v, coalesce(round(CASE WHEN n >= 8 THEN m END, 6), -1.0) AS smooth FROM w"""
)
def rolling_mean(t: Tables) -> DataFrame:
    """W-09."""
    hourly = t.events.groupBy(
        "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").cast("string").alias("hour")
    ).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("v"))
    smooth = scan.rolling_mean(hourly, "event_type", "hour", "v", half=7, min_count=8)
    return smooth.withColumn("smooth", F.coalesce(F.round("smooth", 6), F.lit(-1.0)))


@query(
    """SELECT count(*) AS n, round(corr(l_quantity, l_extendedprice), 9) AS pearson, round(corr(rx, ry), 9) AS spearman FROM (
  SELECT l_quantity, l_extendedprice,
    rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS rx,
    rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2 AS ry FROM lineitem)"""
)
def rank_stats(t: Tables) -> DataFrame:
    """A-40: linear and rank correlation."""
    out = stats.correlations(t.lineitem, "l_quantity", "l_extendedprice")
    return out.withColumns({"pearson": F.round("pearson", 9), "spearman": F.round("spearman", 9)})


@query(
    """WITH r AS (
  SELECT p_size >= 25 AS f, rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2 AS rk FROM part),
s AS (SELECT count(CASE WHEN f THEN 1 END) AS n_first, count(CASE WHEN NOT f THEN 1 END) AS n_rest, sum(CASE WHEN f THEN rk ELSE 0 END) AS r1 FROM r)
SELECT n_first, n_rest, r1 - n_first * (n_first + 1) / 2 AS u FROM s"""
)
def rank_sum_test(t: Tables) -> DataFrame:
    """A-40: rank sum of one group against the rest."""
    return stats.rank_sum(t.part, "p_retailprice", F.col("p_size") >= 25).select(
        "n_first", "n_rest", "u"
    )


@query(
    """WITH r AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS i, count(*) OVER () AS n FROM events)
SELECT (i // ceil(n / 7)::BIGINT + 1)::INTEGER AS chunk, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
FROM r GROUP BY 1"""
)
def chunk_numbering(t: Tables) -> DataFrame:
    """W-12: contiguous chunks of equal size."""
    return scan.chunk_numbers(t.events.select("event_id"), "event_id", 7).groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query(
    """SELECT event_id, user_id, value FROM (SELECT *, row_number() OVER (ORDER BY event_type, event_id) - 1 AS i FROM events)
WHERE i % 60 = 0"""
)
def systematic_sample(t: Tables) -> DataFrame:
    """W-15: one row in sixty, in key order."""
    rows = t.events.select("event_type", "event_id", "user_id", "value")
    return scan.every_nth(rows, ["event_type", "event_id"], 60).drop("event_type")


@query(
    """WITH m AS (
  SELECT p_brand, count(*) AS n_lines, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS quantity, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS revenue,
    sum(CASE WHEN l_returnflag = 'R' AND p_size > 45 THEN l_quantity::DECIMAL(18,2) END)::DOUBLE AS returned
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
u AS (
  SELECT p_brand, 'quantity' AS metric, quantity AS value FROM m UNION ALL SELECT p_brand, 'revenue', revenue FROM m
  UNION ALL SELECT p_brand, 'returned', returned FROM m)
SELECT p_brand, metric, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, p_brand) AS rank FROM u WHERE value IS NOT NULL) WHERE rank <= 20"""
)
def topk_per_metric(t: Tables) -> DataFrame:
    """T-03."""
    money = lambda c: F.sum(c.cast("decimal(18,2)")).cast("double")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size")
    returned = (F.col("l_returnflag") == "R") & (F.col("p_size") > 45)
    per = t.lineitem.join(parts, "l_partkey").groupBy("p_brand").agg(
        money(F.col("l_quantity")).alias("quantity"),
        money(F.col("l_extendedprice")).alias("revenue"),
        money(F.when(returned, F.col("l_quantity"))).alias("returned"),
    )
    return select.top_per_metric(per, ["p_brand"], ["quantity", "revenue", "returned"], 20)


@query(
    """(SELECT 'largest' AS side, p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10)
UNION ALL (SELECT 'smallest', p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 10)"""
)
def extremes(t: Tables) -> DataFrame:
    """T-04."""
    rows = t.part.select("p_partkey", "p_retailprice")
    tie = F.col("p_partkey").asc()
    top = select.top_rows(rows, [F.col("p_retailprice").desc(), tie], 10)
    low = select.top_rows(rows, [F.col("p_retailprice").asc(), tie], 10)
    return top.select(F.lit("largest").alias("side"), "*").unionAll(
        low.select(F.lit("smallest").alias("side"), "*")
    )


@query("SELECT p_name, count(*) OVER (ORDER BY p_name) AS place FROM (SELECT DISTINCT p_name FROM part WHERE trim(p_name) <> '')")
def sorted_list(t: Tables) -> DataFrame:
    """T-01, T-06: sorted distinct names in byte order, with their place."""
    names = select.distinct_sorted(t.part, "p_name")
    return scan.ordinal(names, "p_name", name="place").withColumn("place", F.col("place") + 1)


@query(
    """WITH a AS (
  SELECT s_suppkey AS id, s_name AS name, 0 AS pr FROM supplier WHERE s_acctbal > 5000
  UNION ALL SELECT c_custkey, c_name, 1 FROM customer)
SELECT id, name FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pr) AS r FROM a) WHERE r = 1"""
)
def source_preference(t: Tables) -> DataFrame:
    """W-16: own map before the external map."""
    own = t.supplier.where("s_acctbal > 5000").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    external = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return select.by_priority([own, external], "id")
