"""Key, duplicate, completeness and mapping audits, and entity rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtab.functions.cells import parse_float
from helixtab.operators import filters, joins, profile, quality, rollup
from helixtab.operators.select import first_values, top_rows
from helixtab.plans.registry import Tables, query
from helixtab.workspace import spread

AUDITED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"]


def _key_audit_sql() -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", {c}::VARCHAR AS v FROM lineitem" for c in AUDITED
    ]
    return (
        'WITH c AS (SELECT "column", v, count(*) AS n FROM ('
        + " UNION ALL ".join(parts)
        + """) GROUP BY 1, 2)
SELECT "column", sum(n)::BIGINT AS rows, coalesce(sum(CASE WHEN v IS NULL THEN n END), 0)::BIGINT AS empty_rows,
       count(v) AS distinct_values, count(CASE WHEN v IS NOT NULL AND n > 1 THEN 1 END) AS repeated_values,
       coalesce(max(CASE WHEN v IS NOT NULL THEN n END), 0)::BIGINT AS max_repeat
FROM c GROUP BY 1"""
    )


@query(_key_audit_sql())
def key_audit(t: Tables) -> DataFrame:
    """A-01, A-03, A-22."""
    return rollup.key_audit(t.lineitem, AUDITED)


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1"""
)
def dup_keys(t: Tables) -> DataFrame:
    """A-03, Q-03."""
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    """SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_orderkey LIMIT 10"""
)
def most_duplicated(t: Tables) -> DataFrame:
    """T-05."""
    counts = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return top_rows(counts, [F.col("n").desc(), F.col("l_orderkey").asc()], 10)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type")
def value_distribution(t: Tables) -> DataFrame:
    """A-02."""
    return rollup.value_counts(t.events, "event_type")


@query(
    """SELECT o_custkey, count(*) AS n_rows, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_flagged
FROM orders GROUP BY 1 HAVING count(CASE WHEN o_orderstatus = 'F' THEN 1 END) > 1"""
)
def multi_flag_groups(t: Tables) -> DataFrame:
    """A-04."""
    return rollup.flagged_groups(t.orders, "o_custkey", F.col("o_orderstatus") == "F").where("n_flagged > 1")


@query(
    """WITH g AS (
  SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1
  HAVING count(CASE WHEN o_orderstatus = 'F' THEN 1 END) = 0)
SELECT n_rows, count(*) AS n_groups FROM g GROUP BY 1"""
)
def zero_flag_groups(t: Tables) -> DataFrame:
    """A-05."""
    groups = rollup.flagged_groups(t.orders, "o_custkey", F.col("o_orderstatus") == "F")
    return rollup.group_size_histogram(groups.where("n_flagged = 0"))


@query(
    """SELECT o_custkey,
  arg_min(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END, o_orderkey)
    FILTER (WHERE o_orderpriority <> '5-LOW') AS first_priority,
  arg_min(o_orderkey, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS first_finished
FROM orders GROUP BY 1
HAVING count(CASE WHEN o_orderpriority <> '5-LOW' THEN 1 END) > 0
   AND count(CASE WHEN o_orderstatus = 'F' THEN 1 END) > 0"""
)
def first_attributes(t: Tables) -> DataFrame:
    """A-06, W-06: first filled cell of each column per group, which may come from different rows."""
    rows = t.orders.select(
        "o_custkey",
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("first_priority"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("first_finished"),
    )
    return first_values(
        rows, "o_custkey", ["first_priority", "first_finished"], F.col("o_orderkey")
    ).dropna()


def annotated_documents(t: Tables) -> DataFrame:
    """Documents with label columns as text, blank where a document has no label."""
    labels = t.labels.select(
        "doc_id",
        F.col("quality").cast("string").alias("quality"),
        F.when(F.col("toxic") == 1, "1").otherwise("nan").alias("toxic"),
    )
    return joins.enrich(t.documents.select("doc_id", "lang", "source", "n_chars"), labels, "doc_id")


CHECKLIST = {
    "identity": ["doc_id", "source"],
    "language": ["lang"],
    "labels": ["quality", "toxic"],
    "quality only": ["quality"],
    "licence": ["licence"],
    "size and licence": ["n_chars", "licence"],
    "granular score": [],
}

_ANNOTATED_SQL = """
WITH a AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, coalesce(l.quality::VARCHAR, '') AS quality,
         CASE WHEN l.doc_id IS NULL THEN '' WHEN l.toxic = 1 THEN '1' ELSE 'nan' END AS toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
"""


@query(
    _ANNOTATED_SQL
    + """, c AS (
  SELECT count(*) AS n, count(CASE WHEN trim(quality) NOT IN ('', 'nan') THEN 1 END) AS q,
         count(CASE WHEN trim(toxic) NOT IN ('', 'nan') THEN 1 END) AS x,
         count(CASE WHEN trim(lang) <> '' THEN 1 END) AS l, count(CASE WHEN trim(source) <> '' THEN 1 END) AS s
  FROM a),
w AS (
  SELECT 'identity' AS item, 'doc_id,source' AS "columns", '' AS missing_columns, least(n * 100.0 / n, s * 100.0 / n) AS p FROM c
  UNION ALL SELECT 'language', 'lang', '', l * 100.0 / n FROM c
  UNION ALL SELECT 'labels', 'quality,toxic', '', least(q * 100.0 / n, x * 100.0 / n) FROM c
  UNION ALL SELECT 'quality only', 'quality', '', q * 100.0 / n FROM c
  UNION ALL SELECT 'size and licence', 'n_chars', 'licence', n * 100.0 / n FROM c
  UNION ALL SELECT 'licence', '', 'licence', NULL FROM c
  UNION ALL SELECT 'granular score', '', '', NULL FROM c)
SELECT item, "columns", missing_columns, coalesce(round(p::DOUBLE, 9), -1.0) AS worst_pct,
       CASE WHEN item = 'granular score' THEN 'NO MATCHING COLUMN IN TABLE'
            WHEN item = 'licence' THEN 'COLUMN(S) NOT FOUND'
            WHEN p < 5 THEN 'ESSENTIALLY EMPTY' WHEN p < 50 THEN 'SPARSE / SUSPECT' ELSE '' END AS verdict
FROM w"""
)
def completeness_checklist(t: Tables) -> DataFrame:
    """A-09."""
    out = rollup.completeness(annotated_documents(t), CHECKLIST)
    return out.withColumn("worst_pct", F.round("worst_pct", 9))


@query(
    _ANNOTATED_SQL
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(CASE WHEN trim({c}::VARCHAR) <> '' THEN 1 END) AS n_filled,
  round(count(CASE WHEN trim({c}::VARCHAR) <> '' THEN 1 END) * 100.0 / count(*), 6)::DOUBLE AS coverage_pct,
  coalesce(arg_min({c}::VARCHAR, doc_id) FILTER (WHERE trim({c}::VARCHAR) <> ''), '') AS example FROM a"""
        for c in ("lang", "source", "n_chars", "quality", "toxic")
    )
)
def column_examples(t: Tables) -> DataFrame:
    """A-30: filled cells and first example per column."""
    out = profile.first_examples(
        annotated_documents(t), ["lang", "source", "n_chars", "quality", "toxic"], "doc_id"
    )
    return out.withColumn("coverage_pct", F.round("coverage_pct", 6))


@query(
    """SELECT l_partkey, count(*) AS n_rows, count(DISTINCT (l_suppkey, l_tax)) AS n_versions
FROM lineitem GROUP BY 1"""
)
def dup_rows_agree(t: Tables) -> DataFrame:
    """A-10."""
    return rollup.duplicates_agree(t.lineitem, "l_partkey", ["l_suppkey", "l_tax"])


@query(
    """WITH l AS (
  SELECT l_orderkey, CASE WHEN l_returnflag <> 'R' THEN l_linestatus END AS v FROM lineitem),
g AS (
  SELECT l_orderkey, count(*) AS n, count(v) AS f, count(DISTINCT v) AS d FROM l GROUP BY 1)
SELECT CASE WHEN f < n THEN 'incomplete' WHEN d = 1 THEN 'identical' ELSE 'different' END AS verdict,
       count(*) AS n_groups, sum(n)::BIGINT AS n_members
FROM g GROUP BY 1"""
)
def group_members_agree(t: Tables) -> DataFrame:
    """A-50."""
    rows = t.lineitem.select(
        "l_orderkey", F.when(F.col("l_returnflag") != "R", F.col("l_linestatus")).alias("v")
    )
    return rollup.members_agree(rows, "l_orderkey", "v").groupBy("verdict").agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum("n_members").alias("n_members")
    )


@query(
    """WITH j AS (SELECT o_orderkey, o_totalprice FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
f AS (SELECT o_orderkey, min(o_totalprice) AS o_totalprice FROM j GROUP BY 1)
SELECT 'naive' AS scope, count(*) AS n_rows, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS sum_o_totalprice FROM j
UNION ALL
SELECT 'deduplicated', count(*), sum(o_totalprice::DECIMAL(18,2))::DOUBLE FROM f"""
)
def inflation_audit(t: Tables) -> DataFrame:
    """A-11: an order's price repeated on each of its lines."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    joined = t.orders.select("o_orderkey", "o_totalprice").join(lines, "o_orderkey")
    return rollup.inflation(joined, "o_orderkey", ["o_totalprice"], ["o_totalprice"])


@query(
    """WITH c AS (
  SELECT o_custkey, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS f,
         count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS o, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS p
  FROM orders GROUP BY 1),
m AS (
  SELECT count(*) AS entities, count(CASE WHEN f + o + p > 0 THEN 1 END) AS "any",
    count(CASE WHEN f > 0 THEN 1 END) AS has_n_f, count(CASE WHEN f > 0 AND o = 0 AND p = 0 THEN 1 END) AS only_n_f,
    count(CASE WHEN o > 0 THEN 1 END) AS has_n_o, count(CASE WHEN o > 0 AND f = 0 AND p = 0 THEN 1 END) AS only_n_o,
    count(CASE WHEN p > 0 THEN 1 END) AS has_n_p, count(CASE WHEN p > 0 AND f = 0 AND o = 0 THEN 1 END) AS only_n_p
  FROM c)
SELECT measure, n FROM (UNPIVOT m ON entities, "any", has_n_f, only_n_f, has_n_o, only_n_o, has_n_p, only_n_p
  INTO NAME measure VALUE n)"""
)
def class_presence(t: Tables) -> DataFrame:
    """A-11: entities with each class and with only that class."""
    per = t.orders.groupBy("o_custkey").agg(
        *[
            F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s.lower()}")
            for s in ("F", "O", "P")
        ]
    )
    return rollup.class_presence(per, ["n_f", "n_o", "n_p"])


@query(
    """WITH p AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
a AS (SELECT l_partkey, count(*) AS n FROM p GROUP BY 1), b AS (SELECT l_suppkey, count(*) AS n FROM p GROUP BY 1)
SELECT 'l_partkey->l_suppkey' AS direction, count(*) AS n_keys, count(CASE WHEN n > 1 THEN 1 END) AS n_ambiguous,
       max(n) AS max_partners FROM a
UNION ALL
SELECT 'l_suppkey->l_partkey', count(*), count(CASE WHEN n > 1 THEN 1 END), max(n) FROM b"""
)
def mapping_cardinality(t: Tables) -> DataFrame:
    """A-12."""
    return rollup.mapping_cardinality(t.lineitem, "l_partkey", "l_suppkey")


@query(
    _ANNOTATED_SQL
    + """SELECT 'rows' AS measure, count(*) AS n FROM a
UNION ALL SELECT 'lang', count(CASE WHEN lang <> '' THEN 1 END) FROM a
UNION ALL SELECT 'quality', count(CASE WHEN quality <> '' THEN 1 END) FROM a
UNION ALL SELECT 'toxic', count(CASE WHEN toxic <> '' THEN 1 END) FROM a
UNION ALL SELECT 'all_filled', count(CASE WHEN lang <> '' AND quality <> '' AND toxic <> '' THEN 1 END) FROM a"""
)
def population_rates(t: Tables) -> DataFrame:
    """A-12: filled ids per column and rows with all of them."""
    return rollup.filled_rates(annotated_documents(t), ["lang", "quality", "toxic"])


@query(
    """SELECT c.c_custkey AS entity, c.c_name AS name, count(*) AS total_rows,
  count(DISTINCT e.props) AS distinct_props, count(DISTINCT e.event_type) AS distinct_types,
  count(CASE WHEN e.event_type = 'purchase' THEN 1 END) AS confirmed_rows,
  count(CASE WHEN e.props LIKE '%9%' THEN 1 END) AS missense_rows,
  count(CASE WHEN e.event_type LIKE '%ic%' OR e.event_type LIKE '%ie%' THEN 1 END) AS truncating_rows,
  count(CASE WHEN e.event_type LIKE '%sign%' THEN 1 END) AS synonymous_rows
FROM events e JOIN customer c ON c.c_custkey = e.user_id GROUP BY 1, 2"""
)
def entity_rollup(t: Tables) -> DataFrame:
    """A-07: one pass per entity, joined to the reference table; entities without rows drop out."""
    kind = F.col("event_type")
    per = rollup.entity_rollup(
        t.events.withColumnRenamed("user_id", "entity"),
        "entity",
        {"distinct_props": "props", "distinct_types": "event_type"},
        {
            "confirmed_rows": kind == "purchase",
            "missense_rows": F.col("props").contains("9"),
            "truncating_rows": kind.contains("ic") | kind.contains("ie"),
            "synonymous_rows": kind.contains("sign"),
        },
    )
    reference = t.customer.select(F.col("c_custkey").alias("entity"), F.col("c_name").alias("name"))
    return reference.join(per, "entity")


@query(
    "SELECT count(DISTINCT (l_partkey, l_suppkey, l_linenumber, l_returnflag)) AS n_variants FROM lineitem"
)
def distinct_variants(t: Tables) -> DataFrame:
    """A-08."""
    return rollup.distinct_composites(
        t.lineitem, ["l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"], "n_variants"
    )


@query(
    """WITH s AS (SELECT p_brand, p_retailprice::DECIMAL(18,2) AS v, row_number() OVER w AS r, count(*) OVER (PARTITION BY p_brand) AS n
  FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey)),
m AS (SELECT p_brand, any_value(n) AS n, round((sum(CASE WHEN r IN ((n + 1) // 2, n // 2 + 1) THEN v END)
   / count(CASE WHEN r IN ((n + 1) // 2, n // 2 + 1) THEN 1 END))::DOUBLE, 6) AS median_price FROM s GROUP BY 1)
SELECT p_brand, n, median_price FROM m WHERE n >= 8"""
)
def having_filters(t: Tables) -> DataFrame:
    """P-13, A-41: group medians of groups with enough rows."""
    out = rollup.group_medians(t.part, "p_brand", "p_retailprice", 8, "median_price")
    return out.withColumn("median_price", F.round("median_price", 6))


@query(
    "SELECT event_id, user_id, event_type FROM events ORDER BY ts, event_id LIMIT 100"
)
def trial_limit(t: Tables) -> DataFrame:
    """P-12: the first rows in input order, for a trial run."""
    return filters.trial_rows(t.events, [F.col("ts").asc(), F.col("event_id").asc()], 100).select(
        "event_id", "user_id", "event_type"
    )


@query(
    """WITH r AS (SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem)
SELECT (SELECT count(*) FROM lineitem) AS n_all,
  count(CASE WHEN l_quantity >= 45 THEN 1 END) AS n_trait,
  count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_subset,
  count(CASE WHEN l_returnflag = 'R' AND l_quantity >= 45 THEN 1 END) AS n_subset_trait,
  count(CASE WHEN l_quantity >= 45 THEN 1 END) / count(*) AS rate_all,
  count(CASE WHEN l_returnflag = 'R' AND l_quantity >= 45 THEN 1 END) / count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS rate_subset
FROM lineitem"""
)
def enrichment_rate(t: Tables) -> DataFrame:
    """A-20."""
    return rollup.enrichment(t.lineitem, F.col("l_returnflag") == "R", F.col("l_quantity") >= 45)


@query(
    """WITH w AS (SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS item FROM documents)
SELECT trim(item) AS item, count(*) AS n FROM w WHERE trim(item) <> '' GROUP BY 1"""
)
def exploded_frequency(t: Tables) -> DataFrame:
    """A-28: entries of a packed column, here the words of whole texts."""
    words = spread(t.documents).select(F.regexp_replace("text", "\n", " ").alias("packed"))
    return rollup.exploded_counts(words, "packed", " ")


@query(
    """WITH c AS (
  SELECT CASE WHEN event_type = 'error' THEN 'NA' WHEN event_id % 17 = 0 THEN '' ELSE value::DECIMAL(18,2)::VARCHAR END AS v,
         CASE WHEN event_id % 5 = 0 THEN '1d' ELSE props->>'$.k' END AS k FROM events)
SELECT 'v' AS "column", count(try_cast(v AS DOUBLE)) AS n_valid, count(*) - count(try_cast(v AS DOUBLE)) AS n_invalid,
       sum(try_cast(nullif(v, '') AS DECIMAL(38,6)))::DOUBLE / count(try_cast(v AS DOUBLE)) AS mean FROM c
UNION ALL
SELECT 'k', count(try_cast(k AS DOUBLE)), count(*) - count(try_cast(k AS DOUBLE)),
       sum(try_cast(k AS DECIMAL(38,6)))::DOUBLE / count(try_cast(k AS DOUBLE)) FROM c"""
)
def invalid_counts(t: Tables) -> DataFrame:
    """A-29: means of readable cells and counts of the others."""
    cells = t.events.select(
        F.when(F.col("event_type") == "error", "NA")
        .when(F.col("event_id") % 17 == 0, "")
        .otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
        .alias("v"),
        F.when(F.col("event_id") % 5 == 0, "1d").otherwise(F.get_json_object("props", "$.k")).alias("k"),
    )
    return profile.mean_and_invalid(cells, ["v", "k"])


@query(
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r
  FROM lineitem) WHERE r <= 5"""
)
def first_k_examples(t: Tables) -> DataFrame:
    """A-34, W-13."""
    order = [F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    return rollup.examples(t.lineitem, "l_returnflag", order, 5).select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey"
    )


@query(
    """WITH r AS (SELECT l_extendedprice / p_retailprice AS r FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_retailprice <> 0)
SELECT count(*) AS n, min(r) AS min, max(r) AS max, round(avg(r), 6) AS mean, round(median(r), 6) AS median FROM r"""
)
def ratio_stats(t: Tables) -> DataFrame:
    """A-43."""
    both = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    out = profile.ratio_profile(both, F.col("l_extendedprice"), F.col("p_retailprice"))
    return out.withColumns({"mean": F.round("mean", 6), "median": F.round("median", 6)})


@query(
    """SELECT count(*) AS n_rows, count(CASE WHEN try_cast(value AS DOUBLE) >= 50 THEN 1 END) AS n_large,
  sum(CASE WHEN value >= 50 THEN value::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS sum_large FROM events"""
)
def safe_sums(t: Tables) -> DataFrame:
    """F-46: numbers read from text, with a default."""
    n = parse_float(F.col("value").cast("string"), 0.0)
    return t.events.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(n >= 50).alias("n_large"),
        rollup.exact_sum(F.when(n >= 50, n).otherwise(0.0)).alias("sum_large"),
    )
