"""Translation, notation, mutant and motif queries.

Stand-ins: the A, C, G and T of a whole text are a transcript; its residue letters are a protein.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions import codon, motif, mutate, notation
from helixtab.functions.cells import n_distinct_bare
from helixtab.operators import intervals, joins, rollup
from helixtab.plans.registry import Tables, query
from helixtab.workspace import spread

_CODON_MAP = "MAP {" + ", ".join(f"'{c}': '{a}'" for c, a in codon.codon_table().items()) + "}"


def _translate_sql(cds: str) -> str:
    return (
        f"split_part(array_to_string(list_transform(regexp_extract_all({cds}, '...'), "
        f"lambda c: coalesce({_CODON_MAP}[c], 'X')), ''), '*', 1)"
    )


_CODING_SQL = """
WITH r AS (SELECT doc_id, lang, source, upper(regexp_replace(text, '[^ACGTacgt]', '', 'g')) AS rna FROM documents),
c AS (SELECT *, CASE WHEN strpos(rna, 'ATG') > 0 THEN substr(rna, strpos(rna, 'ATG')) ELSE '' END AS cds FROM r)
"""


def coding(t: Tables) -> DataFrame:
    """rna: all bases of a text; cds: from its first ATG on."""
    rna = F.upper(F.regexp_replace("text", "[^ACGTacgt]", ""))
    start = F.instr("rna", "ATG")
    return spread(t.documents).select("doc_id", "lang", "source", rna.alias("rna")).withColumn(
        "cds", F.when(start > 0, F.substr("rna", start)).otherwise("")
    )


def _checksum(c: Column) -> Column:
    """Sum of digest heads: differs when any of the texts differs."""
    head = F.conv(F.left(F.md5(c.cast("binary")), F.lit(7)), 16, 10)
    return F.sum(head.cast("bigint"))


def _md5(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.md5(c.cast("binary"))


@query(
    _CODING_SQL
    + f"""SELECT doc_id, length(cds) AS n_bases, length(p) AS n_residues, md5(p) AS digest, length(q) AS n_residues_raw
FROM (SELECT doc_id, cds, {_translate_sql('cds')} AS p, {_translate_sql('rna')} AS q FROM c)"""
)
def codon_translate(t: Tables) -> DataFrame:
    """F-01."""
    rows = coding(t).withColumn("p", codon.translate(F.col("cds")))
    return rows.select(
        "doc_id",
        F.length("cds").cast("bigint").alias("n_bases"),
        F.length("p").cast("bigint").alias("n_residues"),
        _md5("p").alias("digest"),
        F.length(codon.translate(F.col("rna"))).cast("bigint").alias("n_residues_raw"),
    )


@query(
    _CODING_SQL
    + """SELECT starts_with(cds, 'ATG') AS starts_atg, length(cds) % 3 = 0 AS len_multiple_of_3,
  right(cds, 3) IN ('TAA', 'TAG', 'TGA') AS ends_in_stop, regexp_full_match(cds, '[ACGTN]*') AS valid_bases,
  contains(rna, cds) AS cds_in_rna, count(*) AS n FROM c GROUP BY 1, 2, 3, 4, 5"""
)
def cds_checks(t: Tables) -> DataFrame:
    """F-02, F-03."""
    flags = codon.cds_checks(F.col("cds"), F.col("rna"))
    return coding(t).groupBy(*[c.alias(n) for n, c in flags.items()]).agg(F.count(F.lit(1)).alias("n"))


_STORED_SQL = (
    _CODING_SQL
    + f""", t AS (SELECT *, {_translate_sql('cds')} AS p0 FROM c),
s AS (
  SELECT doc_id, lang, source, CASE WHEN lang = 'de' AND cds <> '' THEN 'NNN' || cds ELSE cds END AS cds,
    CASE WHEN lang IN ('es', 'en') AND length(rna) % 2 = 1 THEN p0 || 'W' ELSE p0 END AS protein, p0,
    CASE WHEN source LIKE '%1' THEN 'G1.1;G2.4;' ELSE 'G1.1;G1.2' END AS genes FROM t),
x AS (SELECT s.*, CASE WHEN lang = 'de' AND cds <> '' THEN 'X' || p0 ELSE p0 END AS translated,
    l.toxic IS NOT NULL AND l.toxic = 1 AS known, CASE WHEN source LIKE '%1' THEN 2 ELSE 1 END AS n_genes
  FROM s LEFT JOIN labels l ON l.doc_id = s.doc_id),
k AS (SELECT *, CASE WHEN cds = '' OR protein = '' THEN 'no_cds_or_protein' WHEN translated = protein THEN 'exact_match'
  WHEN translated = 'X' || protein THEN 'x_prefix_benign' WHEN known THEN 'selenoprotein_explained'
  WHEN n_genes > 1 THEN 'multigene_ambiguous' ELSE 'unexplained_mismatch' END AS category FROM x)
"""
)


def stored_proteins(t: Tables) -> DataFrame:
    """Coding sequences with a stored protein that agrees with them or not, and the class of each."""
    rows = coding(t).withColumn("p0", codon.translate(F.col("cds")))
    longer = F.col("lang").isin("es", "en") & (F.length("rna") % 2 == 1)
    prefixed = (F.col("lang") == "de") & (F.col("cds") != "")
    rows = rows.withColumns(
        {
            "protein": F.when(longer, F.concat("p0", F.lit("W"))).otherwise(F.col("p0")),
            "genes": F.when(F.col("source").endswith("1"), "G1.1;G2.4;").otherwise("G1.1;G1.2"),
            "cds": F.when(prefixed, F.concat(F.lit("NNN"), "cds")).otherwise(F.col("cds")),
        }
    )
    known = t.labels.where("toxic = 1").select("doc_id")
    rows = joins.flag_membership(rows, known, "doc_id", "known")
    rows = rows.withColumn("translated", codon.translate(F.col("cds")))
    return rows.withColumn(
        "category",
        codon.mismatch_class(
            F.col("cds"), F.col("protein"), F.col("translated"), F.col("known"), n_distinct_bare(F.col("genes"))
        ),
    )


_CATEGORIES = [
    "exact_match",
    "x_prefix_benign",
    "selenoprotein_explained",
    "multigene_ambiguous",
    "unexplained_mismatch",
]


@query(
    _STORED_SQL
    + "SELECT lang, count(*) AS rows, count(CASE WHEN category <> 'no_cds_or_protein' THEN 1 END) AS checked, "
    + ", ".join(f"count(CASE WHEN category = '{c}' THEN 1 END) AS {c}" for c in _CATEGORIES)
    + ", "
    + ", ".join(
        f"coalesce(round((count(CASE WHEN category = '{c}' THEN 1 END) * 100.0 / nullif(count(CASE WHEN category <> 'no_cds_or_protein' THEN 1 END), 0))::DOUBLE, 6), 0.0) AS pct_{c}"
        for c in _CATEGORIES
    )
    + " FROM k GROUP BY lang"
)
def mismatch_taxonomy(t: Tables) -> DataFrame:
    """F-04, F-05, A-33."""
    out = rollup.method_breakdown(stored_proteins(t), "lang", "category", _CATEGORIES, "no_cds_or_protein")
    return out.withColumns({f"pct_{c}": F.round(F.col(f"pct_{c}").cast("double"), 6) for c in _CATEGORIES})


@query(
    _STORED_SQL
    + """SELECT CASE WHEN length(translated) < length(protein) THEN 'shorter' WHEN length(translated) > length(protein) THEN 'longer'
  ELSE 'same_length' END AS relation, substr(cds, length(translated) * 3 + 1, 3) AS codon, count(*) AS n
FROM k WHERE category NOT IN ('exact_match', 'no_cds_or_protein') GROUP BY 1, 2"""
)
def truncation_points(t: Tables) -> DataFrame:
    """F-06."""
    wrong = stored_proteins(t).where(~F.col("category").isin("exact_match", "no_cds_or_protein"))
    return wrong.groupBy(
        codon.length_relation(F.col("translated"), F.col("protein")).alias("relation"),
        codon.stopping_codon(F.col("cds"), F.col("translated")).alias("codon"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    _CODING_SQL
    + f""", p AS (SELECT doc_id, source, {_translate_sql('cds')} AS protein FROM c),
f AS (SELECT source, protein, min(doc_id) AS tx FROM p WHERE protein <> '' GROUP BY 1, 2)
SELECT p.doc_id, coalesce(f.tx, -1) AS tx, CASE WHEN f.tx IS NULL THEN 'no_match' ELSE 'exact_translation_match' END AS method
FROM p LEFT JOIN f ON f.source = p.source AND f.protein = p.protein"""
)
def exact_match_pick(t: Tables) -> DataFrame:
    """J-16: the first transcript of the gene whose translation equals the protein."""
    made = coding(t).select("doc_id", "source", codon.translate(F.col("cds")).alias("protein"))
    products = made.withColumnRenamed("doc_id", "tx")
    out = joins.exact_product(made, products, "source", "protein", "tx", "tx")
    return out.select("doc_id", F.coalesce("tx", F.lit(-1)).alias("tx"), "method")


# one text for both engines: a change written from the keys of a line
_NAMES = "Ala,Arg,Asn,Asp,Cys,Gln,Glu,Gly,His,Ile,Leu,Lys,Met,Phe,Pro,Ser,Thr,Trp,Tyr,Val,Ter,Sec,Xaa"
_A = f"split_part('{_NAMES}', ',', CAST(l_partkey % 23 + 1 AS INT))"
_B = f"split_part('{_NAMES}', ',', CAST(l_suppkey % 23 + 1 AS INT))"
_P = "CAST(l_partkey % 200 + 1 AS STRING)"
_Q = "CAST(l_partkey % 200 + 1 + l_linenumber AS STRING)"
_SHAPE = "(l_orderkey + l_linenumber * 5) % 17"


def _change(a: str) -> str:
    span = f"{a} || {_P} || '_' || {_B} || {_Q}"
    return f"""CASE {_SHAPE}
 WHEN 0 THEN '=' WHEN 1 THEN {a} || {_P} || '=' WHEN 2 THEN {a} || {_P} || 'fs'
 WHEN 3 THEN {span} || 'delinsTrp' || {_B} WHEN 4 THEN {a} || {_P} || 'delinsTrpTer'
 WHEN 5 THEN {span} || 'insTer' WHEN 6 THEN {span} || 'insAla' || {_B} WHEN 7 THEN {span} || 'del'
 WHEN 8 THEN {a} || {_P} || 'del' WHEN 9 THEN {span} || 'dup' WHEN 10 THEN {a} || {_P} || 'dup'
 WHEN 15 THEN {_P} || 'PG[3]' WHEN 16 THEN {a} || {_P} || 'delinsTr' ELSE {a} || {_P} || {_B} END"""


def _summary(df: DataFrame) -> DataFrame:
    total = lambda f: F.coalesce(F.sum(f"details.{f}"), F.lit(0))
    return df.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"),
        total("pos").alias("sum_pos"),
        total("start").alias("sum_start"),
        total("end").alias("sum_end"),
        total("after").alias("sum_after"),
        total("keep_to").alias("sum_keep"),
        total("n_inserted").alias("n_inserted"),
        _checksum(F.coalesce("details.inserted", F.lit(""))).alias("inserted_check"),
        F.count_if("details.truncate").alias("n_truncated"),
        _checksum(F.coalesce(F.concat_ws("-", "details.wt_start", "details.wt_end"), F.lit(""))).alias("ends_check"),
    )


_SUMMARY_SQL = """
SELECT category, count(*) AS n, coalesce(sum(pos), 0)::BIGINT AS sum_pos, coalesce(sum(s), 0)::BIGINT AS sum_start,
  coalesce(sum(e), 0)::BIGINT AS sum_end, coalesce(sum(aft), 0)::BIGINT AS sum_after, coalesce(sum(keep), 0)::BIGINT AS sum_keep,
  coalesce(sum(n_ins), 0)::BIGINT AS n_inserted, sum(('0x' || left(md5(coalesce(ins, '')), 7))::BIGINT)::BIGINT AS inserted_check,
  count(CASE WHEN trunc THEN 1 END) AS n_truncated,
  sum(('0x' || left(md5(coalesce(ends, '')), 7))::BIGINT)::BIGINT AS ends_check FROM d GROUP BY 1"""

_CODES = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in {**notation.THREE_TO_ONE, "Sec": "U"}.items()) + "}"


def _parsed_sql(source: str) -> str:
    """Category and details of a three-letter change in SQL, from column ``ch`` of ``source``."""
    return f"""
m AS (SELECT *,
    regexp_extract(ch, '^([A-Za-z]{{3}})(\\d+)(?:_([A-Za-z]{{3}})(\\d+))?(delins|ins|del|dup)?([A-Za-z]*)$', ['w1', 'p1', 'w2', 'p2', 'op', 'tail']) AS g
  FROM {source}),
n AS (SELECT *, g.w1 AS w1, try_cast(g.p1 AS INTEGER) AS p1, g.w2 AS w2, try_cast(g.p2 AS INTEGER) AS p2, g.op AS op, g.tail AS tail,
    regexp_extract_all(g.tail, '.{{1,3}}') AS toks FROM m),
k AS (SELECT *, coalesce(toks[-1] = 'Ter', false) AS cut,
    CASE WHEN coalesce(toks[-1] = 'Ter', false) THEN toks[:-2] ELSE toks END AS kept,
    len(list_filter(toks, lambda x: NOT list_contains(string_split('{_NAMES}', ','), x))) = 0 AS ok FROM n),
c AS (SELECT *, CASE
    WHEN ch LIKE '%=' THEN 'synonymous_explicit' WHEN ch LIKE '%fs%' THEN 'frameshift'
    WHEN op = 'delins' AND tail <> '' THEN CASE WHEN ok THEN 'delins' ELSE 'unparsed' END
    WHEN op = 'ins' AND p2 IS NOT NULL AND tail = 'Ter' THEN 'nonsense'
    WHEN op = 'ins' AND p2 IS NOT NULL AND tail <> '' THEN CASE WHEN ok THEN 'ins' ELSE 'unparsed' END
    WHEN op = 'del' AND tail = '' THEN 'del' WHEN op = 'dup' AND tail = '' THEN 'dup'
    WHEN op = '' AND p2 IS NULL AND length(tail) = 3 THEN CASE
      WHEN NOT list_contains(string_split('{_NAMES}', ','), w1) OR NOT ok THEN 'unparsed' WHEN w1 = tail THEN 'synonymous'
      WHEN tail = 'Ter' THEN 'nonsense' WHEN w1 = 'Ter' THEN 'stoploss' ELSE 'missense' END
    ELSE 'unparsed' END AS category FROM k),
d AS (SELECT *,
    CASE WHEN category IN ('missense', 'synonymous', 'stoploss') THEN p1 END AS pos,
    CASE WHEN category IN ('delins', 'del', 'dup') THEN p1 END AS s, CASE WHEN category IN ('delins', 'del', 'dup') THEN coalesce(p2, p1) END AS e,
    CASE WHEN category = 'ins' THEN p1 END AS aft, CASE WHEN category = 'nonsense' THEN CASE WHEN op = 'ins' THEN p1 ELSE p1 - 1 END END AS keep,
    CASE WHEN category IN ('ins', 'delins') THEN len(kept) END AS n_ins,
    CASE WHEN category IN ('ins', 'delins') THEN array_to_string(list_filter(list_transform(kept, lambda x: {_CODES}[x]), lambda y: y IS NOT NULL), '') END AS ins,
    CASE WHEN category IN ('ins', 'delins') THEN cut END AS trunc,
    CASE WHEN category IN ('delins', 'del', 'dup') THEN w1 || '-' || coalesce(nullif(w2, ''), w1) END AS ends FROM c)
"""


@query(f"WITH l AS (SELECT {_change(_A)} AS ch FROM lineitem), {_parsed_sql('l')} {_SUMMARY_SQL}")
def notation_classify(t: Tables) -> DataFrame:
    """F-07, F-10."""
    changes = spread(t.lineitem).select(F.expr(_change(_A)).alias("ch"))
    return _summary(notation.parse_three_letter(changes, "ch"))


_LETTERS = "ACDEFGHIKLMNPQRSTVWYBX"
_A1 = f"substr('{_LETTERS}', CAST(l_partkey % 22 + 1 AS INT), 1)"
_B1 = f"substr('{_LETTERS}*', CAST(l_suppkey % 23 + 1 AS INT), 1)"
_SPAN1 = f"'p.' || {_A1} || {_P} || '_' || {_A1} || {_Q}"
_CHANGE1 = f"""CASE {_SHAPE}
 WHEN 0 THEN '' WHEN 1 THEN 'c.12' WHEN 2 THEN {_SPAN1} || 'delinsW' || {_A1} WHEN 3 THEN 'p.' || {_A1} || {_P} || 'delinsWK'
 WHEN 4 THEN {_SPAN1} || 'insGG' WHEN 5 THEN {_SPAN1} || 'del' WHEN 6 THEN 'p.' || {_A1} || {_P} || 'del'
 WHEN 7 THEN {_SPAN1} || 'dup' WHEN 8 THEN 'p.' || {_A1} || {_P} || 'dup' WHEN 9 THEN 'p.?' ELSE 'p.' || {_A1} || {_P} || {_B1} END"""
_DESCR1 = """CASE WHEN l_returnflag = 'A' AND l_tax = 0 THEN 'Substitution - coding silent'
 WHEN l_returnflag = 'N' AND l_tax = 0 THEN 'Frameshift' ELSE 'Substitution - Missense' END"""


@query(
    f"WITH l AS (SELECT {_CHANGE1} AS ch, {_DESCR1} AS ds FROM lineitem),"
    + r"""
g AS (SELECT ch, ds, regexp_extract(ch, '^p\.([A-Z])(\d+)(?:_([A-Z])(\d+))?(delins|ins|del|dup)?([A-Z*]*)$', ['w1', 'p1', 'w2', 'p2', 'op', 'tail']) AS g FROM l),
n AS (SELECT ch, ds, g.w1 AS w1, g.w2 AS w2, try_cast(g.p1 AS INTEGER) AS p1, try_cast(g.p2 AS INTEGER) AS p2, g.op AS op, g.tail AS tail,
  regexp_full_match(g.tail, '[ACDEFGHIKLMNPQRSTVWY]+') AS ok FROM g),
c AS (SELECT *, CASE WHEN ds = 'Substitution - coding silent' THEN 'synonymous' WHEN ds = 'Frameshift' THEN 'frameshift_or_stoploss'
  WHEN ch NOT LIKE 'p.%' THEN 'no_protein_notation'
  WHEN op = 'delins' AND tail <> '' AND tail NOT LIKE '%*%' THEN CASE WHEN ok THEN 'delins' ELSE 'unparsed' END
  WHEN op = 'ins' AND p2 IS NOT NULL AND tail <> '' THEN CASE WHEN ok THEN 'ins' ELSE 'unparsed' END
  WHEN op = 'del' AND tail = '' THEN 'del' WHEN op = 'dup' AND tail = '' THEN 'dup'
  WHEN op = '' AND p2 IS NULL AND length(tail) = 1 THEN CASE WHEN w1 IN ('B', 'X') THEN 'unparsed' WHEN w1 = tail THEN 'synonymous'
    WHEN tail = '*' THEN 'nonsense' WHEN NOT ok THEN 'unparsed' ELSE 'missense' END
  ELSE 'unparsed' END AS category FROM n),
d AS (SELECT category, CASE WHEN category = 'missense' THEN p1 END AS pos, CASE WHEN category IN ('del', 'dup', 'delins') THEN p1 END AS s,
  CASE WHEN category IN ('del', 'dup', 'delins') THEN coalesce(p2, p1) END AS e, CASE WHEN category = 'ins' THEN p1 END AS aft,
  CASE WHEN category = 'nonsense' THEN p1 - 1 END AS keep, CASE WHEN category IN ('ins', 'delins') THEN length(tail) END AS n_ins,
  CASE WHEN category IN ('ins', 'delins') THEN tail END AS ins, false AS trunc,
  CASE WHEN category IN ('del', 'dup', 'delins') THEN w1 || '-' || coalesce(nullif(w2, ''), w1) END AS ends FROM c)
"""
    + _SUMMARY_SQL
)
def notation_classify_one_letter(t: Tables) -> DataFrame:
    """F-09."""
    changes = spread(t.lineitem).select(F.expr(_CHANGE1).alias("ch"), F.expr(_DESCR1).alias("ds"))
    return _summary(notation.parse_one_letter(changes, "ch", "ds"))


_FULL_NAME = f"""CASE WHEN l_tax = 0 THEN 'NC_000001.11:g.' || {_P} || 'A>G'
 ELSE 'NM_' || CAST(l_suppkey AS STRING) || '.2(GENE' || CAST(l_suppkey AS STRING) || '):c.' || {_P} || 'A>G (p.' || {_A} || {_P} || {_B} || ')' END"""


@query(
    f"WITH l AS (SELECT {_FULL_NAME} AS nm FROM lineitem)"
    + r"""
SELECT accession, count(*) AS n, max(CASE WHEN accession <> 'none' THEN change ELSE '' END) AS last_change
FROM (SELECT change, CASE WHEN regexp_full_match(head, '[A-Z]{2}_[0-9]+[.][0-9]+') AND change <> '' THEN head ELSE 'none' END AS accession
  FROM (SELECT split_part(nm, '(', 1) AS head, CASE WHEN contains(split_part(nm, '(p.', 2), ')') THEN split_part(split_part(nm, '(p.', 2), ')', 1) ELSE '' END AS change FROM l)) GROUP BY 1"""
)
def variant_name_split(t: Tables) -> DataFrame:
    """F-08."""
    acc, change = notation.split_name(F.expr(_FULL_NAME))
    rows = spread(t.lineitem).select(F.coalesce(acc, F.lit("none")).alias("accession"), change.alias("change"))
    return rows.groupBy("accession").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max("change"), F.lit("")).alias("last_change")
    )


_RESIDUES = "regexp_replace(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g')"
_ONE = notation.ONE_LETTER
_BY_CODE = ",".join(n for n, _ in sorted(notation.THREE_TO_ONE.items(), key=lambda x: x[1]))
# half of the single changes name the residue that really stands there
_REAL = f"""CASE WHEN sequence IS NOT NULL AND l_tax < 0.05 AND instr('{_ONE}', substr(sequence, CAST(l_partkey % 200 + 1 AS INT), 1)) > 0
 AND length(sequence) > l_partkey % 200
 THEN split_part('{_BY_CODE}', ',', CAST(instr('{_ONE}', substr(sequence, CAST(l_partkey % 200 + 1 AS INT), 1)) AS INT)) ELSE {_A} END"""


def proteins(t: Tables) -> DataFrame:
    """Residue letters of the benchmark texts."""
    ascii_only = F.upper(F.regexp_replace("text", "[^A-Za-z]", ""))
    return spread(t.benchmark).select(
        F.col("item_id").alias("accession"),
        F.regexp_replace(ascii_only, f"[^{_ONE}]", "").alias("sequence"),
    )


def _built_sql() -> str:
    return (
        f"""WITH w AS (SELECT item_id AS accession, {_RESIDUES} AS sequence FROM benchmark),
j AS (SELECT l.*, w.sequence FROM lineitem l LEFT JOIN w ON w.accession = l.l_suppkey),
l AS (SELECT sequence, {_change(_REAL)} AS ch FROM j), {_parsed_sql('l')},
b AS (SELECT *, length(sequence) AS ln, {_CODES}[w1] AS c1, {_CODES}[tail] AS c2 FROM d),
x AS (SELECT category, sequence, CASE category
   WHEN 'missense' THEN CASE WHEN c1 IS NOT NULL AND c2 IS NOT NULL AND pos <= ln AND sequence[pos] = c1 THEN sequence[:pos - 1] || c2 || sequence[pos + 1:] END
   WHEN 'nonsense' THEN CASE WHEN keep >= 0 AND keep <= ln THEN left(sequence, keep) END
   WHEN 'del' THEN CASE WHEN s >= 1 AND e <= ln AND s <= e THEN left(sequence, s - 1) || sequence[e + 1:] END
   WHEN 'dup' THEN CASE WHEN s >= 1 AND e <= ln AND s <= e THEN left(sequence, e) || sequence[s:e] || sequence[e + 1:] END
   WHEN 'ins' THEN CASE WHEN length(ins) = n_ins AND aft <= ln THEN left(sequence, aft) || ins || CASE WHEN trunc THEN '' ELSE sequence[aft + 1:] END END
   WHEN 'delins' THEN CASE WHEN length(ins) = n_ins AND s >= 1 AND e <= ln AND s <= e THEN left(sequence, s - 1) || ins || CASE WHEN trunc THEN '' ELSE sequence[e + 1:] END END
  END AS mutant FROM b),
o AS (SELECT mutant, CASE WHEN category NOT IN ('missense', 'nonsense', 'del', 'ins', 'delins', 'dup') THEN 'skip_' || category
   WHEN sequence IS NULL THEN 'skip_no_wt_seq' WHEN mutant IS NULL THEN 'mismatch_or_invalid' WHEN mutant = '' THEN 'empty_mutant'
   ELSE 'built_' || category END AS outcome FROM x)
"""
    )


def built(t: Tables) -> DataFrame:
    wild = proteins(t)
    lines = spread(t.lineitem).withColumn("accession", F.col("l_suppkey"))
    joined = lines.join(wild, "accession", "left")
    changes = joined.select("accession", F.expr(_change(_REAL)).alias("ch"))
    return mutate.mutants_of(notation.parse_three_letter(changes, "ch"), wild)


@query(
    _built_sql()
    + """SELECT outcome, count(*) AS n, coalesce(sum(length(mutant)), 0)::BIGINT AS n_residues,
  sum(('0x' || left(md5(mutant), 7))::BIGINT)::BIGINT AS checksum FROM o WHERE outcome LIKE 'built_%' GROUP BY 1"""
)
def mutant_build(t: Tables) -> DataFrame:
    """F-11, F-13, P-11."""
    return built(t).where("outcome like 'built_%'").groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("mutant")).alias("n_residues"),
        _checksum(F.col("mutant")).alias("checksum"),
    )


@query(_built_sql() + "SELECT outcome, count(*) AS n FROM o GROUP BY 1")
def mutant_outcomes(t: Tables) -> DataFrame:
    """Q-11: every change ends in one outcome."""
    return built(t).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH w AS (SELECT item_id, {_RESIDUES} AS s FROM benchmark),
p AS (SELECT item_id, s, unnest(range(1, length(s) + 1)) AS pos FROM w WHERE s <> ''),
m AS (SELECT p.*, substr(s, pos, 1) AS wt_aa, unnest(string_split('{",".join(_ONE)}', ',')) AS mut_aa FROM p),
x AS (SELECT wt_aa, mut_aa, substr(s, 1, pos - 1) || mut_aa || substr(s, pos + 1) AS mutant,
   item_id || '|G' || item_id || '|' || wt_aa || pos || mut_aa AS id FROM m WHERE wt_aa <> mut_aa)
SELECT wt_aa, mut_aa, count(*) AS n, sum(('0x' || left(md5(mutant), 7))::BIGINT)::BIGINT AS mutant_check, sum(('0x' || left(md5(id), 7))::BIGINT)::BIGINT AS id_check FROM x GROUP BY 1, 2"""
)
def point_mutation_scan(t: Tables) -> DataFrame:
    """F-14, F-15: every position and other residue of every protein."""
    rows = mutate.point_mutations(proteins(t), "sequence")
    mutant = mutate.substituted(F.col("sequence"), F.col("position"), F.col("mut_aa"))
    acc = F.col("accession").cast("string")
    mid = notation.mutation_id(acc, F.concat(F.lit("G"), acc), F.col("wt_aa"), F.col("position"), F.col("mut_aa"))
    return rows.groupBy("wt_aa", "mut_aa").agg(
        F.count(F.lit(1)).alias("n"), _checksum(mutant).alias("mutant_check"), _checksum(mid).alias("id_check")
    )


MOTIFS = {
    "HELIX": "A.[TI].",
    "PROLINE": "[ST]H[AE]",
    "ACIDIC": "[DE].[ST]",
    "REPEAT": "H[AE]{1,3}[TN]",
    "BROKEN": "([A",
}
_GOOD = {k: v for k, v in MOTIFS.items() if k != "BROKEN"}


def motif_instances(t: Tables) -> DataFrame:
    """All motif matches, each with its own place, as the JSON cells of an annotation table, unpacked again."""
    ranges, classes, seqs = [], [], []
    for name, pattern in [*_GOOD.items(), ("UNKNOWN", "W.")]:
        found = F.regexp_extract_all("sequence", F.lit(pattern), 0)
        ranges.append(motif.match_ranges(F.col("sequence"), pattern, found))
        classes.append(F.array_repeat(F.lit(name), F.size(found)))
        seqs.append(found)
    cells = proteins(t).select(
        "accession",
        F.to_json(F.concat(*ranges)).alias("SLiM_range"),
        F.to_json(F.concat(*classes)).alias("SLiM_class"),
        F.to_json(F.concat(*seqs)).alias("SLiM_discrete_seq"),
    )
    unpacked = motif.unpack_instances(F.col("SLiM_range"), F.col("SLiM_class"), F.col("SLiM_discrete_seq"))
    return cells.select("accession", F.explode(unpacked).alias("i")).select("accession", "i.*")


def _instances_sql() -> str:
    parts = [
        f"SELECT accession, '{n}' AS motif, regexp_extract_all(s, '{p}') AS ms, string_split_regex(s, '{p}') AS gaps FROM w"
        for n, p in _GOOD.items()
    ]
    cases = " ".join(f"WHEN '{n}' THEN NOT regexp_full_match(mm, '{p}')" for n, p in _GOOD.items())
    return f"""WITH w AS (SELECT item_id AS accession, {_RESIDUES} AS s FROM benchmark),
f AS ({" UNION ALL ".join(parts)}),
i AS (SELECT *, unnest(range(1, len(ms) + 1)) AS nth FROM f),
j AS (SELECT accession, motif, ms[nth] AS m, 1 + coalesce(length(array_to_string(gaps[1:nth], '')), 0) + coalesce(length(array_to_string(ms[1:nth - 1], '')), 0) AS st FROM i),
o AS (SELECT *, unnest(range(1, length(m) + 1)) AS k FROM j),
a AS (SELECT *, substr(m, k, 1) AS wt_aa, unnest(string_split('{",".join(_ONE)}', ',')) AS mut_aa FROM o),
b AS (SELECT *, substr(m, 1, k - 1) || mut_aa || substr(m, k + 1) AS mm FROM a WHERE wt_aa <> mut_aa),
d AS (SELECT accession, motif, st + k - 1 AS position, wt_aa, mut_aa, CASE motif {cases} END AS disrupts FROM b)
"""


@query(
    _instances_sql()
    + """SELECT motif, wt_aa, count(*) AS n, count(CASE WHEN disrupts THEN 1 END) AS n_disrupting, sum(position)::BIGINT AS sum_position
FROM d GROUP BY 1, 2"""
)
def motif_disruption(t: Tables) -> DataFrame:
    """F-16, F-38, J-19: mutations inside annotated instances and whether they break the class."""
    scan = motif.motif_disruptions(motif_instances(t), MOTIFS)
    return scan.groupBy("motif", "wt_aa").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("disrupts").alias("n_disrupting"),
        F.sum("position").cast("bigint").alias("sum_position"),
    )


@query(
    _instances_sql()
    + """, g AS (SELECT accession || '|G|' || wt_aa || position || mut_aa AS id, motif, disrupts FROM d)
SELECT id, count(*) AS n_items, string_agg(motif, ';' ORDER BY motif) AS items,
  CASE WHEN count(CASE WHEN disrupts THEN 1 END) > 0 THEN 'Y' ELSE 'N' END AS any_flagged,
  coalesce(string_agg(motif, ';' ORDER BY motif) FILTER (WHERE disrupts), '') AS flagged_items
FROM g GROUP BY 1 HAVING count(*) > 1"""
)
def motif_collapse(t: Tables) -> DataFrame:
    """A-31: mutations inside more than one instance, collapsed to one row each."""
    scan = motif.motif_disruptions(motif_instances(t), MOTIFS)
    mid = notation.mutation_id(
        F.col("accession").cast("string"), F.lit("G"), F.col("wt_aa"), F.col("position"), F.col("mut_aa")
    )
    rows = scan.select(mid.alias("id"), "motif", "disrupts")
    return rollup.packed_summary(rows, "id", "motif", F.col("disrupts")).where("n_items > 1")


@query(
    _instances_sql()
    + f"""SELECT c.motif, c.n_pairs, c.n_positions FROM (
  SELECT motif, count(*) AS n_pairs, count(DISTINCT (p.accession, p.pos)) AS n_positions
  FROM (SELECT accession, unnest(range(1, length(s) + 1)) AS pos FROM w) p JOIN j ON j.accession = p.accession AND p.pos BETWEEN st AND st + length(m) - 1
  GROUP BY 1) c"""
)
def positions_in_motifs(t: Tables) -> DataFrame:
    """J-19: points inside overlapping spans."""
    points = proteins(t).select(
        "accession", F.posexplode(F.regexp_extract_all("sequence", F.lit("."), 0)).alias("_p", "aa")
    ).select("accession", (F.col("_p") + 1).alias("pos"))
    spans = motif_instances(t).where("motif <> 'UNKNOWN'").select("accession", "motif", "start", "end")
    pairs = intervals.points_in_spans(points, spans, "accession", "pos", "start", "end")
    return pairs.groupBy("motif").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.count_distinct(F.struct("accession", "pos")).alias("n_positions")
    )


@query(
    f"""WITH w AS (SELECT item_id AS accession, {_RESIDUES} AS s FROM benchmark),
l AS (SELECT w.s, {_CHANGE1.replace(_A1, "substr(w.s, CAST(l_partkey % 200 + 1 AS INT), 1)")} AS ch FROM lineitem JOIN w ON w.accession = l_suppkey),
"""
    + r"""g AS (SELECT s, regexp_extract(ch, '^p\.([A-Z])(\d+)([A-Z*])$', ['w', 'p', 'm']) AS g FROM l),
p AS (SELECT s, g.w AS w, try_cast(g.p AS INTEGER) AS pos, g.m AS m FROM g WHERE g.w <> ''),
k AS (SELECT *, CASE WHEN w = m THEN 'skip_synonymous' WHEN m = '*' THEN 'nonsense' WHEN m IN ('B', 'X') THEN 'skip_unparsed' ELSE 'missense' END AS kind FROM p),
b AS (SELECT kind, CASE WHEN kind = 'missense' AND pos <= length(s) AND s[pos] = w THEN s[:pos - 1] || m || s[pos + 1:]
   WHEN kind = 'nonsense' AND pos - 1 <= length(s) THEN left(s, pos - 1) END AS mutant FROM k),
o AS (SELECT mutant, CASE WHEN kind LIKE 'skip%' THEN kind WHEN mutant IS NULL THEN 'mismatch_or_invalid' WHEN mutant = '' THEN 'empty_mutant' ELSE 'built_' || kind END AS outcome FROM b)
SELECT outcome, count(*) AS n, coalesce(sum(length(mutant)), 0)::BIGINT AS n_residues,
  coalesce(sum(('0x' || left(md5(mutant), 7))::BIGINT), 0)::BIGINT AS checksum FROM o GROUP BY 1"""
)
def mutant_build_one_letter(t: Tables) -> DataFrame:
    """F-12: single changes in the one-letter dialect."""
    wild = proteins(t)
    real = "substr(sequence, CAST(l_partkey % 200 + 1 AS INT), 1)"
    lines = spread(t.lineitem).withColumn("accession", F.col("l_suppkey")).join(wild, "accession")
    changes = lines.select(
        "accession", F.expr(_CHANGE1.replace(_A1, real)).alias("ch"), F.lit("").alias("described")
    ).where(F.col("ch").rlike(r"^p\.[A-Z]\d+[A-Z*]$"))
    out = mutate.mutants_of(notation.parse_one_letter(changes, "ch", "described"), wild, three_letter=False)
    return out.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.length("mutant")), F.lit(0)).alias("n_residues"),
        F.coalesce(_checksum(F.col("mutant")), F.lit(0)).alias("checksum"),
    )
