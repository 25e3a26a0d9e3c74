"""Column profiles, rates, tables of counts and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtab.functions.rules import first_rule
from helixtab.operators import profile, rollup, scan
from helixtab.plans.registry import Tables, query
from helixtab.workspace import spread

_SHAPE = """CAST({d} AS BIGINT) AS n_distinct, CAST({lo} AS DOUBLE) AS "min", CAST({hi} AS DOUBLE) AS "max",
 round(CAST({mean} AS DOUBLE), 6) AS mean, round(CAST({med} AS DOUBLE), 6) AS median, {notes} AS notes"""


def _generic_sql(table: str, c: str) -> str:
    s = _SHAPE.format(d=f"count(DISTINCT nullif(trim({c}::VARCHAR), ''))", lo=-1, hi=-1, mean=-1, med=-1, notes="''")
    return f"""SELECT '{table}' AS "table", '{c}' AS "column", 'generic' AS kind, count(nullif(trim({c}::VARCHAR), '')) AS n_populated,
 round(count(nullif(trim({c}::VARCHAR), '')) * 100.0 / count(*), 6)::DOUBLE AS pct_populated, {s} FROM {table}"""


def _measured_sql(table: str, c: str, kind: str, value: str, populated: str) -> str:
    s = _SHAPE.format(
        d=-1,
        lo="min(v)",
        hi="max(v)",
        mean="sum(v::DECIMAL(30,6))::DOUBLE / count(v)",
        med="quantile_cont(v, 0.5)",
        notes="''",
    )
    return f"""SELECT '{table}' AS "table", '{c}' AS "column", '{kind}' AS kind, count(CASE WHEN p THEN 1 END) AS n_populated,
 round(count(CASE WHEN p THEN 1 END) * 100.0 / count(*), 6)::DOUBLE AS pct_populated, {s}
 FROM (SELECT ({value})::DOUBLE AS v, {populated} AS p FROM {table})"""


def _category_sql(table: str, c: str) -> str:
    s = _SHAPE.format(d="count(*)", lo=-1, hi=-1, mean=-1, med=-1, notes="""(SELECT string_agg(t, '; ' ORDER BY r) FROM top)""")
    return f"""(WITH g AS (SELECT coalesce(nullif(trim({c}::VARCHAR), ''), '(none)') AS v, count(*) AS n FROM {table} GROUP BY 1),
 top AS (SELECT v || '=' || n || ' (' || printf('%.1f', n * 100.0 / (SELECT sum(n) FROM g)) || '%)' AS t, r FROM (SELECT *, row_number() OVER (ORDER BY n DESC, v) AS r FROM g) WHERE r <= 8)
 SELECT '{table}' AS "table", '{c}' AS "column", 'category' AS kind, sum(n)::BIGINT AS n_populated, 100.0::DOUBLE AS pct_populated, {s} FROM g)"""


def _profile_sql() -> str:
    parts = [
        *[_generic_sql("orders", c) for c in ("o_orderkey", "o_custkey", "o_orderpriority")],
        _generic_sql("customer", "c_name"),
        _measured_sql("customer", "c_name", "length", "length(c_name)", "c_name <> ''"),
        _measured_sql("orders", "o_totalprice", "numeric", "nullif(o_totalprice, 0)", "o_totalprice IS NOT NULL"),
        _measured_sql("lineitem", "l_tax", "numeric", "nullif(l_tax, 0)", "nullif(l_tax, 0) IS NOT NULL"),
        _measured_sql("lineitem", "l_discount", "numeric", "l_discount", "l_discount IS NOT NULL"),
        _measured_sql("documents", "text", "list", "len(string_split(text, ' '))", "trim(text) <> ''"),
        _category_sql("orders", "o_orderpriority"),
        _category_sql("customer", "c_mktsegment"),
    ]
    return " UNION ALL ".join(parts)


@query(_profile_sql())
def column_profile(t: Tables) -> DataFrame:
    """A-22 to A-27: several tables, one long profile."""
    parts = [
        profile.generic_profile(t.orders, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"]),
        profile.generic_profile(t.customer, "customer", ["c_name"]),
        profile.measured_profile(
            [
                (t.customer, profile.lengths("customer", ["c_name"])),
                (t.orders, profile.numbers(t.orders, "orders", ["o_totalprice"])),
                (
                    t.lineitem,
                    [
                        *profile.numbers(t.lineitem, "lineitem", ["l_tax"], count_zero_as_populated=False),
                        *profile.numbers(t.lineitem, "lineitem", ["l_discount"], exclude_zero=False),
                    ],
                ),
                (spread(t.documents), profile.list_lengths("documents", ["text"], " ")),
            ]
        ),
        profile.category_profile(t.orders, "orders", ["o_orderpriority"]),
        profile.category_profile(t.customer, "customer", ["c_mktsegment"]),
    ]
    out = profile.inventory(parts)
    return out.select(
        "table", "column", "kind", "n_populated",
        F.round("pct_populated", 6).cast("double").alias("pct_populated"), "n_distinct",
        *[F.coalesce(c, F.lit(-1.0)).alias(c) for c in ("min", "max")],
        *[F.coalesce(F.round(c, 6), F.lit(-1.0)).alias(c) for c in ("mean", "median")],
        "notes",
    )


_ORDER = ["purchase", "signup", "click", "view", "error"]


@query(
    """SELECT list_position(['purchase', 'signup', 'click', 'view', 'error'], event_type) AS place, event_type, count(*) AS n,
  sum(value::DECIMAL(18,2))::DOUBLE / count(*) AS mean, round(quantile_cont(value, 0.5), 6) AS median,
  count(CASE WHEN value >= 50 THEN 1 END) / count(*) AS frac_large
FROM events GROUP BY event_type"""
)
def rate_by_group(t: Tables) -> DataFrame:
    """A-16: size, mean, median and threshold rate by group, in a fixed order."""
    rows = rollup.fixed_order(t.events, "event_type", _ORDER)
    out = scan.distribution(rows, ["place", "event_type"], "value", {"median": 0.5}, {"frac_large": 50.0})
    return out.withColumn("median", F.round("median", 6))


@query(
    """SELECT l_returnflag, count(*) AS n, count(CASE WHEN l_discount >= 0.02 THEN 1 END) AS n_ge_002,
  count(CASE WHEN l_discount >= 0.02 THEN 1 END) / count(*) AS frac_ge_002, count(CASE WHEN l_discount >= 0.05 THEN 1 END) AS n_ge_005,
  count(CASE WHEN l_discount >= 0.05 THEN 1 END) / count(*) AS frac_ge_005 FROM lineitem GROUP BY 1"""
)
def threshold_rates(t: Tables) -> DataFrame:
    """A-15, A-18."""
    d = F.col("l_discount")
    return rollup.rates(t.lineitem, "l_returnflag", {"ge_002": d >= 0.02, "ge_005": d >= 0.05})


@query(
    """SELECT CASE WHEN l_discount >= 0.05 THEN 'yes' ELSE 'no' END AS first, count(CASE WHEN l_tax < 0.04 THEN 1 END) AS second_no,
  count(CASE WHEN l_tax >= 0.04 THEN 1 END) AS second_yes FROM lineitem GROUP BY 1"""
)
def crosstab(t: Tables) -> DataFrame:
    """A-17."""
    return rollup.crosstab(t.lineitem, F.col("l_discount") >= 0.05, F.col("l_tax") >= 0.04)


@query(
    """WITH b AS (SELECT least(floor(l_extendedprice / 2000)::BIGINT + 1, 50) AS bin FROM lineitem WHERE l_extendedprice BETWEEN 0 AND 100000)
SELECT bin, count(*) AS n, round(log10(count(*)), 9) AS log10_n FROM b GROUP BY 1"""
)
def histogram(t: Tables) -> DataFrame:
    """A-47."""
    out = rollup.histogram(t.lineitem, "l_extendedprice", 0.0, 100000.0, 50)
    return out.withColumn("log10_n", F.round("log10_n", 9))


@query(
    """WITH s AS (SELECT l_orderkey, [l_discount, l_tax, l_quantity / 500, (l_partkey % 10) / 100] AS a, [l_linenumber::BIGINT, l_suppkey, l_partkey, l_orderkey] AS d FROM lineitem),
h AS (SELECT list_position(a, list_max(a)) AS best, d[list_position(a, list_max(a))] AS dist FROM s WHERE list_max(a) >= 0.05)
SELECT (['acceptor_gain', 'acceptor_loss', 'donor_gain', 'donor_loss'])[best] AS mechanism, count(*) AS n, count(CASE WHEN abs(dist) <= 2 THEN 1 END) AS n_within_2,
  sum(dist)::BIGINT AS sum_distance FROM h GROUP BY 1"""
)
def dominant_mechanism(t: Tables) -> DataFrame:
    """A-52, F-31: the strongest of several scores and the distance that belongs to it."""
    scores = [F.col("l_discount"), F.col("l_tax"), F.col("l_quantity") / 500, (F.col("l_partkey") % 10) / 100]
    places = [F.col("l_linenumber").cast("bigint"), F.col("l_suppkey"), F.col("l_partkey"), F.col("l_orderkey")]
    names = ["acceptor_gain", "acceptor_loss", "donor_gain", "donor_loss"]
    best = rollup.dominant_with_place(scores, places, names)
    rows = t.lineitem.select(*[c.alias(n) for n, c in best.items()]).where("score >= 0.05")
    return rows.groupBy("mechanism").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.abs("distance") <= 2).alias("n_within_2"),
        F.sum("distance").alias("sum_distance"),
    )


@query(
    """SELECT l_suppkey, count(*) AS n_strong FROM lineitem WHERE l_discount >= 0.08 GROUP BY 1 ORDER BY n_strong DESC, l_suppkey LIMIT 20"""
)
def strong_ranks(t: Tables) -> DataFrame:
    """A-51."""
    return rollup.strong_ranks(t.lineitem, "l_suppkey", F.col("l_discount") >= 0.08, 20)


@query(
    """WITH g AS (SELECT c_mktsegment, c_custkey, bool_or(o_orderpriority = '1-URGENT') AS a, bool_or(o_orderpriority = '2-HIGH') AS b, bool_or(o_orderpriority = '3-MEDIUM') AS c, bool_or(o_orderpriority = '5-LOW') AS d
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT c_mktsegment, (a::INTEGER + b::INTEGER + c::INTEGER + d::INTEGER) AS n_reached,
  CASE WHEN d THEN 'low' WHEN c THEN 'medium' WHEN b THEN 'high' WHEN a THEN 'urgent' ELSE 'none' END AS deepest, count(*) AS n
FROM g GROUP BY 1, 2, 3"""
)
def ladder_depth(t: Tables) -> DataFrame:
    """A-39: steps reached on a ladder and the deepest one."""
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    steps = {"urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM", "low": "5-LOW"}
    flags = t.customer.select("c_custkey", "c_mktsegment").join(orders, "c_custkey").groupBy(
        "c_custkey", "c_mktsegment"
    ).agg(*[F.max(F.col("o_orderpriority") == v).alias(k) for k, v in steps.items()])
    out = rollup.ladder([F.col(k) for k in steps], list(steps))
    return flags.groupBy("c_mktsegment", *[c.alias(n) for n, c in out.items()]).agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT CASE WHEN p_size > 40 THEN 'Spliceosomal' WHEN p_type = 'ECONOMY' THEN 'Ribosomal' WHEN p_name LIKE '%ring%' THEN 'Other RNP machine' ELSE 'Other RBPs' END AS class,
  count(*) AS n FROM part GROUP BY 1"""
)
def precedence_class(t: Tables) -> DataFrame:
    """F-41."""
    label = first_rule(
        [
            (F.col("p_size") > 40, "Spliceosomal"),
            (F.col("p_type") == "ECONOMY", "Ribosomal"),
            (F.col("p_name").contains("ring"), "Other RNP machine"),
        ],
        "Other RBPs",
    )
    return t.part.groupBy(label.alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH b AS (SELECT value::DECIMAL(18,2) AS v, value, unnest(list_filter([CASE WHEN event_type = 'error' THEN 'errors' END, CASE WHEN value >= 30 THEN 'large' END,
   CASE WHEN user_id < 20 THEN 'early_users' END], lambda x: x IS NOT NULL)) AS bucket FROM events)
SELECT bucket, count(*) AS n, sum(v)::DOUBLE / count(*) AS mean, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
  round(quantile_cont(value, 0.75), 6) AS q3 FROM b GROUP BY 1"""
)
def bucketed_distributions(t: Tables) -> DataFrame:
    """A-44: one row may be in several buckets."""
    rows = rollup.bucket_rows(
        t.events,
        {"errors": F.col("event_type") == "error", "large": F.col("value") >= 30, "early_users": F.col("user_id") < 20},
    )
    boxes = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    return scan.distribution(rows, "bucket", "value", boxes).withColumns({c: F.round(c, 6) for c in boxes})
