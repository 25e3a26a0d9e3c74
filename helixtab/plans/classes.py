"""Rule classification, term lists and cell cleaning queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions import cells, rules, terms
from helixtab.operators import rollup
from helixtab.plans.registry import Tables, query
from helixtab.workspace import spread

# one text for both engines: a gene name and symbol list written from the keys of a part
_KIND = "p_partkey % 11"
_GENE_NAME = f"""CASE {_KIND} WHEN 0 THEN 'T cell receptor alpha' WHEN 1 THEN 'Ig kappa chain' WHEN 2 THEN 'linc' || p_name
 WHEN 3 THEN 'Mitochondrial ' || p_name ELSE p_name END"""
_GENE_SYMBOLS = f"""CASE {_KIND} WHEN 4 THEN 'ABCP;XYZP' WHEN 5 THEN 'ABC-AS1' WHEN 6 THEN 'IGHV' || CAST(p_size AS STRING) WHEN 7 THEN 'MT-ND' || CAST(p_size AS STRING)
 WHEN 8 THEN 'TRBV' || CAST(p_size AS STRING) ELSE 'GENE' || CAST(p_size AS STRING) END"""


def _any_sql(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


_CATEGORY_SQL = f"""
WITH g AS (SELECT p_partkey, p_size, {_GENE_NAME} AS nm, {_GENE_SYMBOLS} AS sy FROM part),
b AS (SELECT *, lower(nm || ' ' || sy) AS txt FROM g),
c AS (SELECT *, CASE WHEN {_any_sql('txt', terms.TCR_WORDS)} THEN 'TCR gene segment'
  WHEN {_any_sql('txt', terms.IG_WORDS + terms.IG_NAME_WORDS)} THEN 'Immunoglobulin gene segment'
  WHEN trim(txt) LIKE '%p' AND NOT contains(txt, '-as1') AND len(list_filter(string_split(sy, ';'), lambda x: x LIKE '%P')) > 0 THEN 'Pseudogene (gene symbol ends in P)'
  WHEN {_any_sql('txt', terms.NONCODING_WORDS)} THEN 'Antisense/lncRNA/uncharacterized locus'
  WHEN contains(lower(sy), 'mt-') OR contains(txt, 'mitochondri') THEN 'Mitochondrial-encoded micropeptide'
  WHEN p_size < 10 THEN 'No ensembl_gene at all' ELSE 'Other/unclassified (searched all transcripts, no exact match)' END AS category FROM b)
"""


def genes(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_size", F.expr(_GENE_NAME).alias("nm"), F.expr(_GENE_SYMBOLS).alias("sy")).withColumn(
        "category", rules.gene_category(F.col("nm"), F.col("sy"), F.col("p_size") >= 10)
    )


@query(_CATEGORY_SQL + "SELECT category, count(*) AS n, min(p_partkey) AS first_part FROM c GROUP BY 1")
def rule_classify(t: Tables) -> DataFrame:
    """F-17."""
    return genes(t).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_part")
    )


_BIOTYPE = """CASE p_size % 9 WHEN 0 THEN 'IG_V_gene' WHEN 1 THEN 'TR_J_gene' WHEN 2 THEN 'Mt_tRNA' WHEN 3 THEN 'processed_pseudogene' WHEN 4 THEN 'lncRNA'
 WHEN 5 THEN 'protein_coding' WHEN 6 THEN 'NOT_FOUND' WHEN 7 THEN 'TEC' ELSE 'misc_RNA' END"""
_TRUE_SQL = """CASE p_size % 9 WHEN 0 THEN 'Immunoglobulin gene segment' WHEN 1 THEN 'TCR gene segment' WHEN 2 THEN 'Mitochondrial-encoded micropeptide' WHEN 3 THEN 'Pseudogene'
 WHEN 4 THEN 'Antisense/lncRNA/uncharacterized locus' WHEN 5 THEN 'Protein-coding (genuine no-exact-match case)' WHEN 6 THEN 'Ensembl ID not found / retired'
 WHEN 7 THEN 'Antisense/lncRNA/uncharacterized locus' ELSE 'Other biotype: misc_RNA' END"""


@query(
    _CATEGORY_SQL
    + f""", n AS (SELECT CASE WHEN category LIKE 'Pseudogene%' THEN 'Pseudogene' WHEN category LIKE 'Other/unclassified%' THEN 'Other/unclassified' ELSE category END AS ours, {_TRUE_SQL} AS tc FROM c)
SELECT CASE WHEN ours = tc THEN 'agree' ELSE 'disagree' END AS verdict, ours, tc AS resolves_to, count(*) AS n FROM n GROUP BY 1, 2, 3"""
)
def two_way_labels(t: Tables) -> DataFrame:
    """A-32, F-18, F-19: keyword categories against authoritative ones."""
    authority = rules.normal_label(rules.biotype_category(F.expr(_BIOTYPE)))
    return rollup.label_agreement(genes(t), rules.normal_label(F.col("category")), authority)


@query(
    """WITH m AS (SELECT l.quality, l.toxic, CASE WHEN d.n_chars > 2000 THEN 1 ELSE 0 END AS ruled FROM labels l JOIN documents d ON d.doc_id = l.doc_id)
SELECT CASE WHEN ruled = quality THEN 'agree' ELSE 'disagree' END AS verdict, ruled::VARCHAR AS ours, quality::VARCHAR AS resolves_to, count(*) AS n FROM m GROUP BY 1, 2, 3"""
)
def label_agreement(t: Tables) -> DataFrame:
    """A-32: a length rule against the given label."""
    both = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    ruled = F.when(F.col("n_chars") > 2000, "1").otherwise("0")
    return rollup.label_agreement(both, ruled, F.col("quality").cast("string"))


# a packed term list of three entries per line, out of the real vocabulary
_CC = [*terms.RIBOSOME_TERMS.items(), *terms.RELABELLED_TERMS.items(), *list(terms.SPLICEOSOME_TERMS.items())[:9]]
_CC_NAMES = [f"{i}:{n}" for i, n in _CC] + [
    "GO:0005785:signal recognition particle receptor complex",
    "GO:0005786:signal recognition particle, endoplasmic reticulum targeting",
    "GO:0005634:nucleus",
    "GO:0005643:nuclear pore complex",
    "bad",
]
_MF_IDS = [i for ids in terms.RNA_CLASS_FUNCTION_IDS.values() for i in ids]
_MF_NAMES = [f"{i}:function {n}" for n, i in enumerate(_MF_IDS)] + [f"{terms.GENERAL_RNA_BINDING}:RNA binding"] * 20 + ["GO:0005515:protein binding"] * 8
_BP_IDS = [i for ids in terms.RNA_CLASS_PROCESS_IDS.values() for i in ids[:4]]
_BP_NAMES = [f"{i}:process of mRNA {n}" for n, i in enumerate(_BP_IDS)] + ["GO:0008150:other tRNA step"] * 9
_FAMILIES = [f for fs in terms.RNA_CLASS_FAMILIES.values() for f in fs] + ["Ring finger proteins"] * 5


_CC_INDEXES = ("l_partkey", "l_suppkey + l_linenumber", "l_orderkey")


def _pick(names: list[str], index: str) -> str:
    """One entry of a list by a whole-number expression, in the text both engines read."""
    joined = "|".join(n.replace("'", "''") for n in names)
    return f"split_part('{joined}', '|', CAST(({index}) % {len(names)} + 1 AS INT))"


_CC_TEXT = " || ';' || ".join(_pick(_CC_NAMES, i) for i in _CC_INDEXES)
_MF_TEXT = f"{_pick(_MF_NAMES, 'l_partkey')} || ';' || {_pick(_MF_NAMES, 'l_orderkey + 3')}"
_BP_TEXT = f"{_pick(_BP_NAMES, 'l_suppkey')} || ';' || {_pick(_BP_NAMES, 'l_orderkey')} || ';'"
_FAM_TEXT = _pick(_FAMILIES, "l_linenumber + l_suppkey")

def _sql_list(names) -> str:
    quoted = ", ".join("'" + n.replace("'", "''") + "'" for n in names)
    return f"[{quoted}]"


def _machine_sql() -> str:
    def labels(table: dict[str, str]) -> str:
        pairs = ", ".join("'" + i + "': '" + n.replace("'", "''") + "'" for i, n in table.items())
        return "MAP {" + pairs + "}"

    def listed(table: dict[str, str]) -> str:
        return (
            f"array_to_string(list_transform(list_sort(list_distinct(list_filter(ids, lambda x: list_contains({_sql_list(table)}, x)))), "
            f"lambda x: x || ':' || {labels(table)}[x]), ';')"
        )

    return f"""WITH c AS (SELECT {_CC_TEXT} AS cc FROM lineitem),
e AS (SELECT cc, count(*) AS n, list_filter(string_split(cc, ';'), lambda x: len(string_split(x, ':')) >= 3) AS ents FROM c GROUP BY 1),
i AS (SELECT *, list_transform(ents, lambda x: string_split(x, ':')[1] || ':' || string_split(x, ':')[2]) AS ids FROM e),
o AS (SELECT *, {listed(terms.RIBOSOME_TERMS)} AS ribo, {listed(terms.SPLICEOSOME_TERMS)} AS splice,
  list_distinct(flatten(list_transform(list_filter(ents, lambda x: NOT starts_with(x, 'GO:0005785')), lambda x: list_filter({_sql_list(terms.OTHER_MACHINE_KEYWORDS)}, lambda k: contains(lower(x), k))))) AS kw,
  list_transform(list_filter({_sql_list(terms.RELABELLED_TERMS)}, lambda x: list_contains(ids, x)), lambda x: {labels(terms.RELABELLED_TERMS)}[x]) AS rel FROM i),
f AS (SELECT n, ribo, splice, array_to_string(list_sort(list_concat(kw, rel)), ';') AS other FROM o)
SELECT CASE WHEN ribo <> '' THEN 'Y' ELSE 'N' END AS ribosomal, CASE WHEN splice <> '' THEN 'Y' ELSE 'N' END AS spliceosomal,
  CASE WHEN other <> '' THEN 'Y' ELSE 'N' END AS other_machine, sum(n)::BIGINT AS n, max(ribo) AS last_ribo, max(splice) AS last_splice, max(other) AS last_other
FROM f GROUP BY 1, 2, 3"""


@query(_machine_sql())
def machine_flags(t: Tables) -> DataFrame:
    """F-20 to F-22, K-10: exact-id and keyword flags with evidence."""
    # lines with the same three entries have one cell: it is written and classified once
    picks = [F.expr(f"({index}) % {len(_CC_NAMES)}").alias(f"pick{k}") for k, index in enumerate(_CC_INDEXES)]
    names = [f"pick{k}" for k in range(len(picks))]
    counted = t.lineitem.select(*picks).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    text = " || ';' || ".join(_pick(_CC_NAMES, name) for name in names)
    flagged = rules.with_machine_flags(counted.select("n", F.expr(text).alias("cc")), "cc")
    # the evidence of the keyword flag comes in entry order; the report sorts it
    other = F.array_join(F.array_sort(F.split("Other_RNP_machine_terms", ";")), ";")
    return flagged.groupBy(
        F.col("Ribosomal_protein").alias("ribosomal"),
        F.col("Spliceosomal_protein").alias("spliceosomal"),
        F.col("Other_RNP_machine").alias("other_machine"),
    ).agg(
        F.sum("n").alias("n"),
        F.max("Ribosomal_protein_terms").alias("last_ribo"),
        F.max("Spliceosomal_protein_terms").alias("last_splice"),
        F.max(other).alias("last_other"),
    )


_CLASSES = list(terms.RNA_CLASS_FUNCTION_IDS)


def _flags_sql() -> str:
    cases = ", ".join(
        f"list_filter(string_split(mf, ';'), lambda x: x <> '' AND list_contains({_sql_list(ids)}, left(x, 10))) AS h_{c}"
        for c, ids in terms.RNA_CLASS_FUNCTION_IDS.items()
    )
    return f"""WITH m AS (SELECT {_MF_TEXT} AS mf, {_BP_TEXT} AS bp, {_FAM_TEXT} AS fam FROM lineitem), h AS (SELECT *, {cases} FROM m)"""


@query(
    _flags_sql()
    + " UNION ALL ".join(
        f" SELECT '{c}' AS class, count(CASE WHEN len(h_{c}) > 0 THEN 1 END) AS n, coalesce(max(array_to_string(h_{c}, ';')), '') AS last_terms FROM h"
        for c in _CLASSES
    )
)
def flags_with_terms(t: Tables) -> DataFrame:
    """F-23: nine classes from one packed cell, with the entries that matched."""
    flagged = rules.with_prefix_classes(spread(t.lineitem).select(F.expr(_MF_TEXT).alias("mf")), "mf")
    row = flagged.agg(
        *[F.count_if(F.col(c) == "Y").alias(c) for c in _CLASSES],
        *[F.max(f"{c}_terms").alias(f"{c}_terms") for c in _CLASSES],
    )
    items = [F.struct(F.lit(c).alias("class"), F.col(c).alias("n"), F.col(f"{c}_terms").alias("last_terms")) for c in _CLASSES]
    return row.select(F.explode(F.array(*items)).alias("i")).select("i.*")


def _gap_sql() -> str:
    any_ = " OR ".join(f"len(h_{c}) > 0" for c in _CLASSES)
    cols, outs = [], []
    for c in _CLASSES:
        ids = _sql_list(terms.RNA_CLASS_PROCESS_IDS[c])
        bp = f"len(list_filter(string_split(bp, ';'), lambda x: list_contains({ids}, left(x, 10)))) > 0"
        fams = terms.RNA_CLASS_FAMILIES.get(c, [])
        fam = "(" + " OR ".join(f"contains(fam, '{f}')" for f in fams) + ")" if fams else "false"
        cols.append(
            f"CASE WHEN len(h_{c}) > 0 THEN 'MF' WHEN gap AND {bp} AND {fam} THEN 'BP+Family' WHEN gap AND {bp} THEN 'BP' WHEN gap AND {fam} THEN 'Family' ELSE '' END AS s_{c}"
        )
        outs.append(f" SELECT '{c}' AS class, s_{c} AS source, count(*) AS n FROM s WHERE s_{c} <> '' GROUP BY 2")
    return (
        _flags_sql()
        + f", g AS (SELECT *, contains(mf, '{terms.GENERAL_RNA_BINDING}') AND NOT ({any_}) AS gap FROM h), s AS (SELECT {', '.join(cols)} FROM g)"
        + " UNION ALL ".join(outs)
    )


def classified(t: Tables) -> DataFrame:
    packed = spread(t.lineitem).select(
        F.expr(_MF_TEXT).alias("mf"), F.expr(_BP_TEXT).alias("bp"), F.expr(_FAM_TEXT).alias("fam")
    )
    return rules.with_prefix_classes(packed, "mf")


@query(_gap_sql())
def gap_fill(t: Tables) -> DataFrame:
    """F-24: classes filled from two more sources, with provenance."""
    filled = rules.gap_filled(classified(t), "mf", "bp", "fam", _CLASSES)
    pairs = F.array(*[F.struct(F.lit(c).alias("class"), F.col(f"{c}_source").alias("source")) for c in _CLASSES])
    return (
        filled.select(F.explode(pairs).alias("p")).select("p.*").where("source <> ''")
        .groupBy("class", "source").agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    _flags_sql()
    + f""", c AS (SELECT contains(mf, '{terms.GENERAL_RNA_BINDING}') AS gen, ({" OR ".join(f"len(h_{c}) > 0" for c in _CLASSES)}) AS anyc, * FROM h)
SELECT 'total' AS measure, count(*) AS n FROM c UNION ALL SELECT 'general_term', count(CASE WHEN gen THEN 1 END) FROM c
UNION ALL SELECT 'any_class', count(CASE WHEN anyc THEN 1 END) FROM c UNION ALL SELECT 'gap', count(CASE WHEN gen AND NOT anyc THEN 1 END) FROM c """
    + " ".join(f"UNION ALL SELECT '{c}', count(CASE WHEN len(h_{c}) > 0 THEN 1 END) FROM c" for c in _CLASSES)
)
def class_coverage(t: Tables) -> DataFrame:
    """A-49, F-25."""
    return rules.class_coverage(classified(t), "mf", _CLASSES, terms.GENERAL_RNA_BINDING)


@query(
    f"""WITH w AS (SELECT unnest(string_split({_BP_TEXT}, ';')) AS term FROM lineitem), c AS (SELECT term, count(*) AS n FROM w WHERE term <> '' GROUP BY 1)
SELECT 'mRNA' AS keyword, term, n FROM c WHERE term LIKE '% mRNA %' UNION ALL SELECT 'tRNA', term, n FROM c WHERE term LIKE '% tRNA %'"""
)
def candidate_terms(t: Tables) -> DataFrame:
    """A-48."""
    packed = t.lineitem.select(F.expr(_BP_TEXT).alias("bp"))
    return rules.candidate_terms(packed, "bp", terms.RNA_KEYWORD_PATTERNS)


_ID_TEXT = "CASE WHEN l_tax = 0 THEN '' ELSE 'ENSP' || CAST(l_partkey AS STRING) || '.' || CAST(l_linenumber AS STRING) || ';ENSP' || CAST(l_suppkey AS STRING) || '.1' END"
_SYMBOL_TEXT = "CASE l_linenumber WHEN 1 THEN '[]' WHEN 2 THEN 'ABC {ECO:0001}' WHEN 3 THEN '\"x' ELSE 'ABC' END"
_FLAG_TEXT = "CASE l_linenumber WHEN 1 THEN ' True' WHEN 2 THEN '1' WHEN 3 THEN 'YES' WHEN 4 THEN 't' WHEN 5 THEN 'true ' ELSE 'no' END"


@query(
    f"""WITH i AS (SELECT {_ID_TEXT} AS ids, {_SYMBOL_TEXT} AS sy, {_FLAG_TEXT} AS fl FROM lineitem),
c AS (SELECT coalesce(nullif(split_part(split_part(ids, ';', 1), '.', 1), ''), 'none') AS bare, ids, contains(sy, '{{ECO:') OR sy IN ('[]', '{{}}') OR contains(sy, '"') OR contains(sy, '{{') AS corrupt,
   trim(lower(fl)) IN ('true', '1', 'yes', 't') AS loose, trim(fl) IN ('1', 'True', 'true') AS strict FROM i)
SELECT bare, CASE WHEN bare = 'none' THEN 'none' ELSE '9606.' || bare END AS prefixed, count(*) AS n,
  max(len(list_distinct(list_transform(list_filter(string_split(ids, ';'), lambda x: x <> ''), lambda x: split_part(x, '.', 1)))))::INTEGER AS max_distinct,
  count(CASE WHEN corrupt THEN 1 END) AS n_corrupt, count(CASE WHEN loose THEN 1 END) AS n_loose, count(CASE WHEN strict THEN 1 END) AS n_strict
FROM c GROUP BY 1, 2"""
)
def clean_ids(t: Tables) -> DataFrame:
    """P-02 to P-04, P-14, F-05, F-45."""
    rows = t.lineitem.select(
        F.expr(_ID_TEXT).alias("ids"), F.expr(_SYMBOL_TEXT).alias("sy"), F.expr(_FLAG_TEXT).alias("fl")
    )
    bare = F.coalesce(cells.first_item(F.col("ids")), F.lit("none"))
    prefixed = F.when(bare == "none", bare).otherwise(
        cells.add_prefix(cells.strip_prefix(cells.add_prefix(bare, "9606."), "9606."), "9606.")
    )
    return rows.groupBy(bare.alias("bare"), prefixed.alias("prefixed")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(cells.n_distinct_bare(F.col("ids"))).alias("max_distinct"),
        F.count_if(cells.corrupt_symbol(F.col("sy"))).alias("n_corrupt"),
        F.count_if(cells.truthy(F.col("fl"))).alias("n_loose"),
        F.count_if(cells.truthy_exact(F.col("fl"))).alias("n_strict"),
    )


_NUMBER_TEXT = """CASE CAST(user_id % 6 AS INT) WHEN 0 THEN '12' WHEN 1 THEN ' 3.75 ' WHEN 2 THEN '1d' WHEN 3 THEN '' WHEN 4 THEN '-2.5e1' ELSE 'NA' END"""


@query(
    f"""WITH n AS (SELECT trim({_NUMBER_TEXT}) AS t, event_type FROM events),
p AS (SELECT event_type, CASE WHEN regexp_full_match(t, '[+-]?[0-9.]+(e[+-]?[0-9]+)?') THEN try_cast(t AS DOUBLE) END AS v, CASE WHEN regexp_full_match(t, '[0-9]+') THEN t::BIGINT END AS i FROM n)
SELECT event_type, count(*) AS n, count(v) AS n_numbers, count(i) AS n_whole, sum(coalesce(v, 0)) AS total, sum(trunc(v))::BIGINT AS total_cut FROM p GROUP BY 1"""
)
def safe_numbers(t: Tables) -> DataFrame:
    """F-46: three ways to read a number from text."""
    rows = t.events.select("event_type", F.expr(_NUMBER_TEXT).alias("t"))
    c = F.col("t")
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(cells.parse_float(c)).alias("n_numbers"),
        F.count(cells.parse_strict_int(c)).alias("n_whole"),
        F.sum(cells.parse_float(c, 0.0)).alias("total"),
        F.sum(cells.parse_int(c)).alias("total_cut"),
    )


def _terms_of(kind: str, n: Column) -> Column:
    return F.concat(F.lit(kind), F.lit(":name "), n.cast("string"))


@query(
    """WITH r AS (SELECT event_id, user_id, event_type, value, (props->>'$.k')::INTEGER AS k FROM events),
a AS (SELECT CASE WHEN k < 30 THEN 'C' WHEN k < 60 THEN 'P' WHEN k < 90 THEN 'F' ELSE 'noaspect' END AS aspect, 'name ' || k AS name, k, user_id, event_type, value FROM r),
p AS (SELECT user_id, aspect, name, count(*) AS n FROM a WHERE aspect <> 'noaspect' GROUP BY 1, 2, 3)
SELECT user_id, coalesce(string_agg('GO:' || replace(name, 'name ', '') || ':' || name, ';' ORDER BY name) FILTER (WHERE aspect = 'C'), '') AS c,
  coalesce(string_agg('GO:' || replace(name, 'name ', '') || ':' || name, ';' ORDER BY name) FILTER (WHERE aspect = 'P'), '') AS p,
  coalesce(string_agg('GO:' || replace(name, 'name ', '') || ':' || name, ';' ORDER BY name) FILTER (WHERE aspect = 'F'), '') AS f
FROM p GROUP BY 1"""
)
def packed_columns(t: Tables) -> DataFrame:
    """F-47, K-08: term rows to three packed columns, one per aspect."""
    k = F.get_json_object("props", "$.k").cast("int")
    aspect = F.when(k < 30, "C").when(k < 60, "P").when(k < 90, "F")
    term = F.concat_ws(":", aspect, F.concat(F.lit("name "), k.cast("string")))
    rows = t.events.select("user_id", F.concat(F.lit("GO:"), k.cast("string")).alias("id"), term.alias("term"))
    part, name = cells.aspect_and_name(F.col("term"))
    entries = (
        rows.select("user_id", "id", part.alias("aspect"), name.alias("name"))
        .where("aspect is not null").distinct()
    )
    # at most one entry per id of the vocabulary and user
    listed = F.array_sort(F.collect_list(F.struct("name", "id")))
    wide = entries.groupBy("user_id").pivot("aspect", ["C", "P", "F"]).agg(listed)
    return wide.select("user_id", *[cells.pack_pairs(F.col(a)).alias(a.lower()) for a in ("C", "P", "F")])


@query(
    """WITH r AS (SELECT o_orderkey, o_totalprice, [o_custkey, o_orderkey] AS a, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice / 3 END AS med FROM orders)
SELECT o_orderkey, 'tissue' || (a[1] % 7) || '|' || 'src' || '|' || CASE WHEN med IS NULL THEN '' ELSE printf('%.4f', med) END || '|TPM;blood|src||TPM' AS packed,
  2 AS n_entries, a[1] AS range_start, a[1] + 5 AS range_end, 'RRM' AS family FROM r"""
)
def packed_cells(t: Tables) -> DataFrame:
    """F-37, F-38, K-08: struct lists to text, and Python-literal cells back to ranges."""
    median = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 3)
    entry = lambda name, med: F.struct(
        name.alias("tissue"), F.lit("src").alias("source"), med.cast("double").alias("median"), F.lit("TPM").alias("unit")
    )
    rows = F.array(
        entry(F.concat(F.lit("tissue"), (F.col("o_custkey") % 7).cast("string")), median),
        entry(F.lit("blood"), F.lit(None)),
    )
    literal = F.format_string("{'RRM': [(%d, %d)]}", F.col("o_custkey"), F.col("o_custkey") + 5)
    ranges = cells.python_ranges(literal)
    first = F.get(F.try_element_at(ranges, F.lit("RRM")), F.lit(0))
    return t.orders.select(
        "o_orderkey",
        cells.pack_measurements(rows).alias("packed"),
        F.size(rows).alias("n_entries"),
        F.get(first, F.lit(0)).cast("bigint").alias("range_start"),
        F.get(first, F.lit(1)).cast("bigint").alias("range_end"),
        F.get(F.map_keys(ranges), F.lit(0)).alias("family"),
    )


_TOKENS = """CASE WHEN user_id % 9 = 0 THEN 'FAILED' WHEN user_id % 9 = 1 THEN 'AGG 1.5 BETA 2' ELSE
 'AGG ' || CAST(event_id AS STRING) || ' AMYLO 0.5 TURN ' || CAST(user_id AS STRING) || ' HELIX 3 HELAGG 4 BETA 5' END"""
SCORE_FIELDS = ["AGG", "AMYLO", "TURN", "HELIX", "HELAGG", "BETA"]


@query(
    """SELECT event_type, count(*) AS n, count(CASE WHEN user_id % 9 > 1 THEN 1 END) AS n_complete,
  coalesce(sum(CASE WHEN user_id % 9 > 1 THEN event_id + user_id END), 0)::BIGINT AS total FROM events GROUP BY 1"""
)
def token_lines(t: Tables) -> DataFrame:
    """F-34: score lines of names and values; an incomplete line is no record."""
    rows = t.events.select("event_type", cells.token_record(F.expr(_TOKENS), SCORE_FIELDS).alias("r"))
    number = lambda f: F.col(f"r.{f}").cast("bigint")
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("r").alias("n_complete"),
        F.coalesce(F.sum(number("AGG") + number("TURN")), F.lit(0)).alias("total"),
    )
