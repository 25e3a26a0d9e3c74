"""Wild type versus mutant queries.

Stand-in: the lowest vector id of a label is the wild type, the other vectors of it are mutants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtab.functions import delta as D
from helixtab.functions.rules import significance_group
from helixtab.operators import joins, rollup
from helixtab.operators.select import first_wins, top_rows
from helixtab.plans.registry import Tables, query

N_PARTS = 64
SCORE_COLUMNS = [f"s{i}" for i in range(1, 13)]

_PAIRS_SQL = """
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
w AS (SELECT label, min(vec_id) AS wid FROM e GROUP BY label),
p AS (
  SELECT m.vec_id, m.label, x.v AS wv, m.v AS mv
  FROM e m JOIN w ON w.label = m.label JOIN e x ON x.vec_id = w.wid WHERE m.vec_id <> w.wid),
d AS (
  SELECT vec_id, label,
         list_position(wv, list_max(wv)) AS wt_top, list_position(mv, list_max(mv)) AS mut_top,
         list_transform(list_zip(wv, mv), lambda z: z[2] - z[1]) AS dv
  FROM p),
s AS (
  SELECT vec_id, label, wt_top, mut_top, dv,
         list_max(list_transform(dv, lambda x: abs(x))) AS max_abs_delta,
         list_sum(list_transform(dv, lambda x: abs(x))) AS total_abs_delta
  FROM d)
"""


def scored_pairs(t: Tables) -> DataFrame:
    """J-06, F-28 to F-32 over the vectors."""
    scores = t.embeddings.select(
        "vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v")
    )
    # W-01 on ids alone: the vectors need not travel to find the wild types
    wild = first_wins(scores.select("label", "vec_id"), "label", "vec_id").select(
        "label", F.col("vec_id").alias("accession")
    )
    variants = (
        scores.select("vec_id", "label").join(wild, "label").where("vec_id <> accession")
    )
    pairs = joins.pair_with_wild_type(
        variants, scores, "accession", "vec_id", "vec_id", ["v"]
    ).where("pair_status = 'paired'")
    gaps = D.delta_vector(F.col("WT_v"), F.col("MUT_v"))
    return pairs.select(
        "vec_id",
        "label",
        D.argmax_position(F.col("WT_v")).alias("wt_top"),
        D.argmax_position(F.col("MUT_v")).alias("mut_top"),
        gaps.alias("dv"),
        D.max_abs(gaps).alias("max_abs_delta"),
        D.total_abs_delta(F.col("WT_v"), F.col("MUT_v")).alias("total_abs_delta"),
    )


@query(
    _PAIRS_SQL
    + """
SELECT label, count(*) AS n, count(CASE WHEN wt_top <> mut_top THEN 1 END) AS n_label_changed,
       count(CASE WHEN wt_top <> mut_top THEN 1 END) / count(*) AS frac_label_changed,
       round(avg(max_abs_delta), 6) AS mean_max_abs_delta,
       round(avg(total_abs_delta), 6) AS mean_total_abs_delta
FROM s GROUP BY label"""
)
def wt_mut_delta(t: Tables) -> DataFrame:
    """J-06, W-01, F-28, F-30 to F-32, A-15."""
    changed = F.col("wt_top") != F.col("mut_top")
    return scored_pairs(t).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(changed).alias("n_label_changed"),
        (F.count_if(changed) / F.count(F.lit(1))).alias("frac_label_changed"),
        F.round(F.avg("max_abs_delta"), 6).alias("mean_max_abs_delta"),
        F.round(F.avg("total_abs_delta"), 6).alias("mean_total_abs_delta"),
    )


@query(
    _PAIRS_SQL
    + """
SELECT vec_id, label, wt_top, mut_top, max_abs_delta FROM s
ORDER BY max_abs_delta DESC, vec_id LIMIT 25"""
)
def top_movers(t: Tables) -> DataFrame:
    """T-02."""
    rows = scored_pairs(t).select("vec_id", "label", "wt_top", "mut_top", "max_abs_delta")
    return top_rows(rows, [F.col("max_abs_delta").desc(), F.col("vec_id").asc()], 25)


@query(
    _PAIRS_SQL
    + """
SELECT 'part_' || wt_top || ' -> part_' || mut_top AS transition, count(*) AS n
FROM s WHERE wt_top <> mut_top GROUP BY 1 ORDER BY n DESC, transition LIMIT 20"""
)
def label_transitions(t: Tables) -> DataFrame:
    """A-19, A-46."""
    name = lambda c: F.concat(F.lit("part_"), F.col(c).cast("string"))
    return rollup.transitions(scored_pairs(t), name("wt_top"), name("mut_top"), 20)


@query(
    _PAIRS_SQL
    + """
SELECT label, count(*) AS n_scored, count(CASE WHEN wt_top <> mut_top THEN 1 END) AS n_dominant_changed,
       count(CASE WHEN max_abs_delta >= 0.3 THEN 1 END) AS n_strong,
       count(CASE WHEN max_abs_delta >= 0.2 THEN 1 END) / count(*) AS frac_ge_02,
       count(CASE WHEN max_abs_delta >= 0.3 THEN 1 END) / count(*) AS frac_ge_03
FROM s GROUP BY label"""
)
def dominant_flips(t: Tables) -> DataFrame:
    """A-18, A-46: dominant class flips and threshold rates per category."""
    return scored_pairs(t).groupBy("label").agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(F.col("wt_top") != F.col("mut_top")).alias("n_dominant_changed"),
        F.count_if(F.col("max_abs_delta") >= 0.3).alias("n_strong"),
        (F.count_if(F.col("max_abs_delta") >= 0.2) / F.count(F.lit(1))).alias("frac_ge_02"),
        (F.count_if(F.col("max_abs_delta") >= 0.3) / F.count(F.lit(1))).alias("frac_ge_03"),
    )


def raw_scores(t: Tables) -> DataFrame:
    """Twelve score cells as text, with too-long and out-of-memory marks."""
    mark = (
        F.when(F.col("vec_id") % 11 == 0, "NA").when(F.col("vec_id") % 13 == 0, "OOM")
    )
    cell = lambda i: F.format_string("%.4f", F.get("embedding", F.lit(i)).cast("double"))
    cells = [cell(i).alias(c) for i, c in enumerate(SCORE_COLUMNS)]
    cells[2] = F.coalesce(mark, cell(2)).alias(SCORE_COLUMNS[2])
    return t.embeddings.select("vec_id", "label", *cells)


_RAW_SQL = (
    "WITH r AS (SELECT vec_id, label, "
    + ", ".join(
        f"printf('%.4f', embedding[{i}]::DOUBLE) AS s{i}"
        if i != 3
        else "CASE WHEN vec_id % 11 = 0 THEN 'NA' WHEN vec_id % 13 = 0 THEN 'OOM' "
        "ELSE printf('%.4f', embedding[3]::DOUBLE) END AS s3"
        for i in range(1, 13)
    )
    + " FROM embeddings), w AS (SELECT label, min(vec_id) AS wid FROM r GROUP BY label) "
)


@query(
    _RAW_SQL
    + """, p AS (
  SELECT CASE WHEN x.s3 = 'OOM' THEN 'out_of_memory' WHEN x.s3 = 'NA' THEN 'too_long' ELSE 'scored' END AS wt_status,
         CASE WHEN m.s3 = 'OOM' THEN 'out_of_memory' WHEN m.s3 = 'NA' THEN 'too_long' ELSE 'scored' END AS mut_status,
         """
    + " + ".join(f"abs(try_cast(m.s{i} AS DOUBLE) - try_cast(x.s{i} AS DOUBLE))" for i in range(1, 13))
    + """ AS total
  FROM r m JOIN w ON w.label = m.label JOIN r x ON x.vec_id = w.wid WHERE m.vec_id <> w.wid)
SELECT wt_status, mut_status, count(*) AS n, count(total) AS n_scored,
       coalesce(round(avg(total), 6), -1.0) AS mean_total_abs_delta
FROM p GROUP BY 1, 2"""
)
def delta_with_missing(t: Tables) -> DataFrame:
    """J-07, F-29: pairs by score state; a row with any missing score has no total."""
    scores = joins.numeric_scores(raw_scores(t), SCORE_COLUMNS)
    wild = first_wins(scores.select("label", "vec_id"), "label", "vec_id").select(
        "label", F.col("vec_id").alias("accession")
    )
    variants = scores.select("vec_id", "label").join(wild, "label").where("vec_id <> accession")
    pairs = joins.pair_with_wild_type(
        variants, scores, "accession", "vec_id", "vec_id", ["score_status", *SCORE_COLUMNS]
    )
    total = D.total_abs_delta(
        F.array(*[f"WT_{c}" for c in SCORE_COLUMNS]), F.array(*[f"MUT_{c}" for c in SCORE_COLUMNS])
    )
    return (
        pairs.withColumn("total", total)
        .groupBy(F.col("WT_score_status").alias("wt_status"), F.col("MUT_score_status").alias("mut_status"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("total").alias("n_scored"),
            F.coalesce(F.round(F.avg("total"), 6), F.lit(-1.0)).alias("mean_total_abs_delta"),
        )
    )


@query(
    _PAIRS_SQL
    + """, m AS (
  SELECT s.vec_id, s.dv[1] AS delta,
         CASE WHEN l.doc_id IS NULL THEN 'Other/Unknown'
              WHEN l.toxic = 1 THEN 'Pathogenic/Likely pathogenic'
              WHEN l.quality = 1 THEN 'Benign/Likely benign' ELSE 'Uncertain significance' END AS sig_group
  FROM s LEFT JOIN labels l ON l.doc_id = s.vec_id)
SELECT sig_group, count(CASE WHEN delta > 0 THEN 1 END) AS n_increase, count(CASE WHEN delta < 0 THEN 1 END) AS n_decrease,
       count(CASE WHEN delta = 0 THEN 1 END) AS n_equal, count(CASE WHEN delta IS NULL THEN 1 END) AS n_unscored
FROM m GROUP BY sig_group"""
)
def direction_counts(t: Tables) -> DataFrame:
    """J-26, A-45, F-27: direction of change by wording of a joined label."""
    wording = (
        F.when(F.col("toxic") == 1, "Likely pathogenic")
        .when(F.col("quality") == 1, "Benign")
        .otherwise("Uncertain significance")
    )
    meta = t.labels.select(F.col("doc_id").alias("vec_id"), wording.alias("wording"))
    rows = scored_pairs(t).select("vec_id", F.get("dv", F.lit(0)).alias("delta"))
    joined = joins.dedup_then_join(rows, meta, "vec_id", ["wording"], {"wording": "wording"})
    d = F.col("delta")
    return joined.groupBy(significance_group(F.col("wording")).alias("sig_group")).agg(
        F.count_if(d > 0).alias("n_increase"),
        F.count_if(d < 0).alias("n_decrease"),
        F.count_if(d == 0).alias("n_equal"),
        F.count_if(d.isNull()).alias("n_unscored"),
    )


@query(
    _PAIRS_SQL
    + """
SELECT l.quality, l.toxic, count(*) AS n, count(CASE WHEN s.max_abs_delta >= 0.3 THEN 1 END) AS n_first,
       count(CASE WHEN s.wt_top <> s.mut_top THEN 1 END) AS n_second, count(CASE WHEN s.max_abs_delta >= 0.3 AND s.wt_top <> s.mut_top THEN 1 END) AS n_both
FROM s JOIN labels l ON l.doc_id = s.vec_id GROUP BY 1, 2"""
)
def tool_cooccurrence(t: Tables) -> DataFrame:
    """J-27: two result tables joined on the variant, strong hits counted together."""
    meta = t.labels.select(F.col("doc_id").alias("vec_id"), "quality", "toxic")
    strong = F.col("max_abs_delta") >= 0.3
    flipped = F.col("wt_top") != F.col("mut_top")
    return joins.cooccurrence(scored_pairs(t), meta, "vec_id", strong, flipped, ["quality", "toxic"])


def event_scan(t: Tables) -> DataFrame:
    """Each event against the first event of its user, as a scan of (wt, mut, protein) rows."""
    events = t.events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("v"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.concat(F.lit("D"), (F.weekday("ts") + 1).cast("string")).alias("weekday"),
    )
    base = first_wins(events, "user_id", ["ts", "event_id"]).select(
        "user_id", F.col("v").alias("base_v"), F.col("k").alias("base_k"), F.col("event_type").alias("base_type")
    )
    return joins.enrich(events, base, "user_id", blanks=False).select(
        F.col("event_type").alias("wt_aa"),
        F.col("weekday").alias("mut_aa"),
        F.col("user_id").alias("protein"),
        F.abs(F.col("v") - F.col("base_v")).alias("dv"),
        F.abs(F.col("k") - F.col("base_k")).alias("dk"),
        (F.col("event_type") != F.col("base_type")).alias("changed"),
    )


_SCAN_SQL = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value::DECIMAL(18,2) AS v,
         (props->>'$.k')::INTEGER AS k, 'D' || isodow(ts) AS weekday FROM events),
b AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM e)
  WHERE rn = 1),
s AS (
  SELECT e.event_type AS wt_aa, e.weekday AS mut_aa, e.user_id AS protein, abs(e.v - b.v) AS dv,
         abs(e.k - b.k) AS dk, e.event_type <> b.event_type AS changed
  FROM e JOIN b ON b.user_id = e.user_id)
"""


@query(
    _SCAN_SQL
    + """
SELECT CASE WHEN grouping(protein) = 0 THEN 'protein'
            WHEN grouping(wt_aa) = 0 AND grouping(mut_aa) = 0 THEN 'wt_aa+mut_aa'
            WHEN grouping(wt_aa) = 0 THEN 'wt_aa' ELSE 'mut_aa' END AS "grouping",
       coalesce(wt_aa, '') AS wt_aa, coalesce(mut_aa, '') AS mut_aa,
       coalesce(protein::VARCHAR, '') AS protein, count(*) AS n_mutations,
       sum(dv)::DOUBLE / count(*) AS mean_value_delta,
       sum(dk)::DOUBLE / count(*) AS mean_k_delta,
       count(CASE WHEN changed THEN 1 END) / count(*) AS frac_changed
FROM s GROUP BY GROUPING SETS ((wt_aa), (mut_aa), (wt_aa, mut_aa), (protein))"""
)
def delta_by_group(t: Tables) -> DataFrame:
    """A-13: four groupings in one pass."""
    out = rollup.grouped_means(
        event_scan(t),
        [["wt_aa"], ["mut_aa"], ["wt_aa", "mut_aa"], ["protein"]],
        {
            "mean_value_delta": F.sum("dv").cast("double") / F.count(F.lit(1)),
            "mean_k_delta": F.sum("dk").cast("double") / F.count(F.lit(1)),
            "frac_changed": F.count_if("changed") / F.count(F.lit(1)),
        },
        "n_mutations",
    )
    return out.fillna("", subset=["wt_aa", "mut_aa", "protein"])


@query(
    _SCAN_SQL
    + "SELECT wt_aa, "
    + ", ".join(
        f"coalesce(sum(dv) FILTER (WHERE mut_aa = 'D{i}')::DOUBLE / "
        f"nullif(count(*) FILTER (WHERE mut_aa = 'D{i}'), 0), -1.0) AS D{i}"
        for i in range(1, 8)
    )
    + " FROM s GROUP BY wt_aa"
)
def substitution_matrix(t: Tables) -> DataFrame:
    """A-14."""
    days = [f"D{i}" for i in range(1, 8)]
    cell = F.sum("dv").cast("double") / F.count(F.lit(1))
    return rollup.matrix(event_scan(t), "wt_aa", "mut_aa", days, cell).fillna(-1.0, subset=days)
