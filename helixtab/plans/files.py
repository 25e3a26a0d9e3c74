"""File formats, batch scoring and resumable ingest.

Each query writes data it derives from the tables to a new folder of the work area, in the format in
question, reads it back and summarises what came back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtab.functions import cells
from helixtab.operators import joins, rollup, scan, scoring
from helixtab.plans.registry import Tables, query
from helixtab.plans.sequences import _RESIDUES, proteins
from helixtab.sources import readers, writers
from helixtab.sources.spec import DatasetSpec
from helixtab.streaming import ingest
from helixtab.workspace import new_folder, spread


def _summary(df: DataFrame, label: str, key: str, *texts: str) -> DataFrame:
    """Rows, distinct keys and the characters that came back, as one labelled row."""
    chars = sum((F.length(F.coalesce(F.col(c), F.lit(""))) for c in texts), F.lit(0))
    return df.agg(
        F.lit(label).alias("format"),
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(key).alias("n_keys"),
        F.coalesce(F.sum(chars), F.lit(0)).cast("bigint").alias("n_chars"),
    )


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


@query(
    """SELECT 'csv' AS format, count(*) AS n, count(DISTINCT doc_id) AS n_keys, sum(length(text) + length(source))::BIGINT AS n_chars FROM documents
UNION ALL SELECT 'tsv', count(*), count(DISTINCT p_partkey), sum(length(p_name) + length(p_type))::BIGINT FROM part
UNION ALL SELECT 'gzip', count(*), count(DISTINCT c_custkey), sum(length(c_name) + length(c_mktsegment))::BIGINT FROM customer
UNION ALL SELECT 'edges', count(*), count(DISTINCT 'N' || l_partkey), sum(length('N' || l_partkey) + length('N' || l_suppkey))::BIGINT FROM lineitem
UNION ALL SELECT 'ids', count(DISTINCT o_custkey), count(DISTINCT o_custkey), (SELECT sum(length(x)) FROM (SELECT DISTINCT o_custkey::VARCHAR AS x FROM orders))::BIGINT FROM orders
UNION ALL SELECT 'json', count(*), count(DISTINCT event_id), sum(length(props) + length(event_type))::BIGINT FROM events
UNION ALL SELECT 'parquet', count(*), count(DISTINCT event_id), sum(length(event_type))::BIGINT FROM events"""
)
def file_roundtrip(t: Tables) -> DataFrame:
    """S-01 to S-04, S-07, S-13, S-14, S-16, S-17, K-01, K-06, K-07."""
    spark, base = t.spark, new_folder(t.spark, "formats")
    docs = t.documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "source")
    writers.write_table(docs, f"{base}/csv")
    parts = t.part.select(F.col("p_partkey").cast("string").alias("#p_partkey"), "p_name", "p_type")
    writers.write_table(parts, f"{base}/tsv", sep="\t")
    people = t.customer.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_mktsegment")
    writers.write_table(people, f"{base}/gz", sep="\t", compression="gzip")
    node = lambda c: F.concat(F.lit("N"), F.col(c).cast("string"))
    t.lineitem.select(F.concat_ws(" ", node("l_partkey"), node("l_suppkey"))).write.text(f"{base}/edges")
    t.orders.select(F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit("\n"))).write.text(f"{base}/ids")
    writers.write_json(t.events.select("event_id", "event_type", "props"), f"{base}/json")
    writers.write_parquet(t.events, f"{base}/parquet")

    spec = DatasetSpec("documents", {"doc_id": "bigint", "text": "string", "source": "string"}, ("doc_id",))
    csv_back = readers.read_table(spark, f"{base}/csv", schema=spec.raw_schema())
    back = [
        _summary(csv_back, "csv", "doc_id", "text", "source"),
        _summary(readers.clean_headers(readers.read_tsv(spark, f"{base}/tsv")), "tsv", "p_partkey", "p_name", "p_type"),
        _summary(readers.land_gzip(spark, f"{base}/gz", 4), "gzip", "c_custkey", "c_name", "c_mktsegment"),
        _summary(readers.read_pairs(spark, f"{base}/edges"), "edges", "a", "a", "b"),
        _summary(readers.read_id_list(spark, f"{base}/ids"), "ids", "id", "id"),
        _summary(spark.read.schema("event_id bigint, event_type string, props string").json(f"{base}/json"), "json", "event_id", "props", "event_type"),
        _summary(readers.read_columns(spark, f"{base}/parquet", ["event_id", "event_type"]), "parquet", "event_id", "event_type"),
    ]
    return _stack(back)


@query(
    """SELECT n_name AS region_nation, 3 + n_nationkey AS n_fields, n_regionkey::VARCHAR AS region FROM nation WHERE n_name <> ''"""
)
def preamble_table(t: Tables) -> DataFrame:
    """S-05, S-06, Q-02: a commented preamble before the header, and rows of uneven length."""
    spark, base = t.spark, new_folder(t.spark, "preamble")
    body = t.nation.select(F.concat_ws("\t", F.format_string('"%s"', "n_name"), (F.col("n_nationkey") + 3).cast("string"), F.col("n_regionkey").cast("string")).alias("value"), F.lit(1).alias("o"), "n_nationkey")
    lines = spark.createDataFrame([("# made by a tool", 0, 0), ("title\tof\tsheet", 0, 1), ('"Name"\tn\tregion', 0, 2)], "value string, o int, n_nationkey int")
    body.unionByName(lines).coalesce(1).sortWithinPartitions("o", "n_nationkey").select("value").write.text(f"{base}/t")
    table = readers.read_after_preamble(spark, f"{base}/t", '"Name"')
    return table.select(F.col("Name").alias("region_nation"), F.col("n").cast("int").alias("n_fields"), "region")


@query(
    f"""WITH w AS (SELECT item_id, {_RESIDUES} AS s FROM benchmark)
SELECT 'plain' AS format, count(*) AS n, count(DISTINCT item_id) AS n_keys, sum(length(s))::BIGINT AS n_chars, min(md5(s)) AS first_digest FROM w
UNION ALL SELECT 'uniprot', count(*), count(DISTINCT item_id), sum(length(s))::BIGINT, min(md5(s)) FROM w
UNION ALL SELECT 'chunks', count(*), count(DISTINCT item_id), sum(length(s))::BIGINT, min(md5(s)) FROM w
UNION ALL SELECT 'records', count(*), count(DISTINCT item_id), sum(length(s))::BIGINT, min(md5(s)) FROM w
UNION ALL SELECT 'lengths', count(*), count(DISTINCT item_id), sum(length(s))::BIGINT, '' FROM w"""
)
def fasta_roundtrip(t: Tables) -> DataFrame:
    """S-08, S-09, S-11, K-02, K-03, A-21: sequence files of several layouts."""
    spark, base = t.spark, new_folder(t.spark, "fasta")
    rows = proteins(t).withColumn("id", F.concat(F.lit("Q"), F.col("accession").cast("string")))
    # long sequences are wrapped, as sequence files usually are
    wrapped = rows.withColumn("seq", F.regexp_replace("sequence", "(.{60})", "$1\n"))
    writers.write_fasta(wrapped, "id", "seq", f"{base}/plain")
    header = F.concat(F.lit("sp|"), "id", F.lit("|NAME_HUMAN Some protein GN=G"), F.col("accession").cast("string"), F.lit(" PE=1"))
    writers.write_fasta(wrapped.withColumn("header", header), "header", "seq", f"{base}/uniprot")
    chunked = scan.chunk_numbers(rows.select("accession", "id", "sequence"), "accession", 5)
    writers.write_fasta_chunks(chunked, "id", "sequence", "chunk", f"{base}/chunks")
    record = F.concat(
        F.lit("LOCUS       X\nVERSION     "), "id", F.lit('\n     CDS             1..9\n                     /protein_id="P'),
        F.col("accession").cast("string"), F.lit('"\n                     /translation="'),
        F.regexp_replace("sequence", "(.{50})", "$1\n                     "), F.lit('"\nORIGIN\n//'),
    )
    rows.select(record).write.text(f"{base}/records")

    def summary(df: DataFrame, label: str, key: str, seq: str) -> DataFrame:
        digest = F.min(F.md5(F.col(seq).cast("binary"))) if label != "lengths" else F.lit("")
        n_chars = F.sum(F.length(seq) if label != "lengths" else F.col(seq)).cast("bigint")
        return df.agg(
            F.lit(label).alias("format"), F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("n_keys"),
            n_chars.alias("n_chars"), digest.alias("first_digest"),
        )

    plain = readers.read_fasta(spark, f"{base}/plain")
    uniprot = readers.read_uniprot_fasta(spark, f"{base}/uniprot").where("gene = concat('G', substr(accession, 2))")
    return _stack(
        [
            summary(plain, "plain", "id", "seq"),
            summary(uniprot, "uniprot", "accession", "seq"),
            summary(readers.read_fasta(spark, f"{base}/chunks"), "chunks", "id", "seq"),
            summary(readers.read_flat_records(spark, f"{base}/records"), "records", "accession", "sequence"),
            summary(writers.contig_lengths(plain), "lengths", "id", "length"),
        ]
    )


@query(
    """WITH r AS (SELECT event_id, user_id, event_type, value, CASE event_type WHEN 'error' THEN '.' WHEN 'view' THEN 'SpliceAI=A|G|.|.|.|.|.|.|.|.'
   WHEN 'signup' THEN 'SpliceAI=A|G|0.1' ELSE 'SpliceAI=A|G|' || printf('%.5f', value / 1000) || '|0.00|0.10|0.00|1|-2|3|4' END AS info FROM events),
s AS (SELECT *, CASE WHEN event_type IN ('click', 'purchase') THEN try_cast(split_part(info, '|', 3) AS DOUBLE) END AS score FROM r)
SELECT 'chr' || (user_id % 22 + 1) AS chrom, count(*) AS n, count(score) AS n_scored, coalesce(sum(score::DECIMAL(18,5))::DOUBLE, 0.0) AS total,
  sum(event_id)::BIGINT AS id_check FROM s GROUP BY 1"""
)
def vcf_scores(t: Tables) -> DataFrame:
    """S-10, K-05, F-33: variant files in chunks with a header each, and the scores read back."""
    spark, base = t.spark, new_folder(t.spark, "vcf")
    made = F.concat(F.lit("SpliceAI=A|G|"), F.format_string("%.5f", F.col("value") / 1000), F.lit("|0.00|0.10|0.00|1|-2|3|4"))
    info = (
        F.when(F.col("event_type") == "error", ".")
        .when(F.col("event_type") == "view", "SpliceAI=A|G|" + "|".join("." * 8))
        .when(F.col("event_type") == "signup", "SpliceAI=A|G|0.1")
        .otherwise(made)
    )
    variants = t.events.select(
        F.concat(F.lit("chr"), (F.col("user_id") % 22 + 1).cast("string")).alias("chrom"),
        (F.col("event_id") + 1).alias("pos"),
        F.col("event_id").alias("id"),
        F.lit("A").alias("ref"),
        F.lit("G").alias("alt"),
        info.alias("info"),
    )
    # contig lengths come from a sequence table in the real job; here every contig is as long as the table
    n = t.events.count() + 1
    header = writers.vcf_header({f"chr{c}": n for c in [*range(1, 23), "X", "Y", "M"]})
    writers.write_vcf_chunks(scan.fixed_chunks(variants, "id", 2000), f"{base}/chunks", header)
    back = readers.read_vcf(spark, f"{base}/chunks")
    scores = cells.score_parts(F.col("info"))
    first = cells.parse_float(F.get(scores, F.lit(0)))
    return back.groupBy("chrom").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(first).alias("n_scored"),
        F.coalesce(rollup.exact_sum(first), F.lit(0.0)).alias("total"),
        F.sum(F.col("id").cast("bigint")).alias("id_check"),
    )


@query(
    """WITH c AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
SELECT (i // ceil(n / 8)::BIGINT + 1)::INTEGER AS chunk, count(*) AS n_rows, count(DISTINCT lang) AS n_langs, min(doc_id) AS first_id FROM c GROUP BY 1"""
)
def chunk_files(t: Tables) -> DataFrame:
    """S-15, K-03, K-04, U-04, W-12: one result file per chunk, read back with its number."""
    base = new_folder(t.spark, "chunks")
    chunked = scan.chunk_numbers(t.documents.select("doc_id", "lang"), "doc_id", 8)
    writers.write_table_chunks(chunked, "chunk", f"{base}/out")
    back = readers.read_chunks(t.spark, f"{base}/out", expected=8)
    return back.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("lang").alias("n_langs"),
        F.min(F.col("doc_id").cast("bigint")).alias("first_id"),
    )


@query(
    """SELECT l_returnflag AS uniprot_accession, l_linestatus AS rbp_name, count(*) AS n_mutants FROM lineitem GROUP BY 1, 2"""
)
def manifest(t: Tables) -> DataFrame:
    """K-04: rows per key of a chunked export."""
    rows = t.lineitem.select(F.col("l_returnflag").alias("uniprot_accession"), F.col("l_linestatus").alias("rbp_name"))
    return writers.manifest(rows, ["uniprot_accession", "rbp_name"])


@query(
    """SELECT user_id::VARCHAR AS key, count(*) AS n_events, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1"""
)
def keyed_json(t: Tables) -> DataFrame:
    """S-12, K-06: JSON objects that map keys to records."""
    base = new_folder(t.spark, "keyed")
    per = t.events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    )
    entry = F.to_json(F.create_map(F.col("user_id").cast("string"), F.struct("n_events", "total")))
    per.select(entry).write.text(f"{base}/maps")
    back = readers.read_keyed_json(t.spark, f"{base}/maps", "struct<n_events:bigint,total:double>", whole_file=False)
    return back.select("key", "value.n_events", "value.total")


@query(
    """WITH a AS (SELECT DISTINCT p_partkey, p_brand FROM part), b AS (SELECT DISTINCT p_partkey, p_size FROM part), c AS (SELECT DISTINCT p_partkey, p_type FROM part WHERE p_size > 10)
SELECT a.p_brand, count(*) AS n, sum(p_size)::BIGINT AS total_size, count(p_type) AS n_typed FROM a JOIN b ON b.p_partkey = a.p_partkey LEFT JOIN c ON c.p_partkey = a.p_partkey GROUP BY 1"""
)
def attribute_groups(t: Tables) -> DataFrame:
    """S-18: attribute tables pulled apart and joined again on their ids."""
    groups = [
        t.part.select("p_partkey", "p_brand").unionAll(t.part.select("p_partkey", "p_brand")),
        t.part.select("p_partkey", "p_size"),
        t.part.where("p_size > 10").select("p_partkey", "p_type"),
    ]
    return readers.merge_attribute_groups(groups, ["p_partkey"]).groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("total_size"), F.count("p_type").alias("n_typed")
    )


@query(
    """SELECT event_type AS chrom, count(*) AS n, count(CASE WHEN value >= 5 THEN 1 END) AS n_valued, sum(CASE WHEN value >= 5 THEN value::DECIMAL(18,2) END)::DOUBLE AS total FROM events GROUP BY 1"""
)
def signal_file(t: Tables) -> DataFrame:
    """S-19: a signal track file; missing values stay missing."""
    base = new_folder(t.spark, "track")
    value = F.when(F.col("value") >= 5, F.col("value").cast("decimal(18,2)").cast("string")).otherwise("NaN")
    place = F.col("event_id").cast("string")
    t.events.select(F.concat_ws("\t", "event_type", place, (F.col("event_id") + 1).cast("string"), value)).write.text(f"{base}/t")
    back = readers.read_signal(t.spark, f"{base}/t")
    return back.groupBy("chrom").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("n_valued"), rollup.exact_sum(F.col("value")).alias("total")
    )


@query(
    """WITH r AS (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders),
d AS (SELECT o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders)
SELECT o_custkey, count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM r JOIN d ON d.i = r.i GROUP BY 1"""
)
def positional_pairing(t: Tables) -> DataFrame:
    """J-25: two files paired row by row, with a check of their lengths."""
    left = t.orders.select("o_orderkey", "o_custkey")
    right = t.orders.select(F.col("o_orderkey").alias("k"), "o_totalprice")
    return joins.attach_by_position(left, right, "o_orderkey", "k").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), rollup.exact_sum(F.col("o_totalprice")).alias("total")
    )


@query(
    """SELECT c_custkey, 'nation' AS aspect, c_nationkey::VARCHAR AS id, c_mktsegment AS name FROM customer
UNION ALL SELECT c_custkey, 'balance', 'low', c_mktsegment FROM customer WHERE c_acctbal < 1000"""
)
def long_export(t: Tables) -> DataFrame:
    """K-09: nested columns as rows."""
    entry = lambda id_: F.struct(id_.alias("id"), F.col("c_mktsegment").alias("name"))
    nested = t.customer.select(
        "c_custkey",
        F.array(entry(F.col("c_nationkey").cast("string"))).alias("nations"),
        F.when(F.col("c_acctbal") < 1000, F.array(entry(F.lit("low")))).alias("balances"),
    )
    return writers.long_form(nested, "c_custkey", {"nations": "nation", "balances": "balance"})


@query(
    """SELECT p_partkey, p_name, CASE WHEN p_size > 45 THEN 'Y' ELSE 'N' END AS large, CASE WHEN p_retailprice > 1090 THEN 'Y' ELSE 'N' END AS dear
FROM part WHERE p_size > 45 OR p_retailprice > 1090"""
)
def audit_rows(t: Tables) -> DataFrame:
    """K-10: only the flagged rows, with their evidence."""
    yes = lambda c: F.when(c, "Y").otherwise("N")
    flagged = t.part.withColumns({"large": yes(F.col("p_size") > 45), "dear": yes(F.col("p_retailprice") > 1090)})
    return writers.flagged_only(flagged, ["large", "dear"], ["p_partkey", "p_name", "large", "dear"])


_SCORED = "AEHT"


@query(
    f"""WITH w AS (SELECT doc_id, regexp_replace(text, '[^A-Za-z]', '', 'g') AS s0 FROM documents), u AS (SELECT doc_id, upper(s0) AS s FROM w)
SELECT doc_id, 'scored' AS score_status, """
    + ", ".join(
        f"coalesce(round(CASE WHEN length(s) = 0 THEN 0.0 ELSE (length(s) - length(replace(s, '{x}', ''))) / length(s) END, 9), -1.0) AS share_{x.lower()}"
        for x in _SCORED
    )
    + " FROM u"
)
def batch_score(t: Tables) -> DataFrame:
    """X-01, T-07: every sequence scored once, whole, in batches by length."""
    letters = F.upper(F.regexp_replace("text", "[^A-Za-z]", ""))
    rows = spread(t.documents).select("doc_id", letters.alias("seq"))
    names = [f"share_{x.lower()}" for x in _SCORED]
    out = scoring.score_sequences(rows, "doc_id", "seq", scoring.ResidueShare(_SCORED), names)
    return out.withColumns({n: F.coalesce(F.round(n, 9), F.lit(-1.0)) for n in names})


def _runs_sql(table: str, key: str) -> str:
    return f"""SELECT DISTINCT {key}, array_to_string(w[k:k + 4], ' ') AS run FROM (SELECT {key}, w, unnest(range(1, len(w) - 3)) AS k
  FROM (SELECT {key}, list_filter(string_split_regex(text, '[ \n\t\r]+'), lambda x: x <> '') AS w FROM {table}))"""


@query(
    f"""WITH a AS ({_runs_sql("benchmark", "item_id")}), b AS ({_runs_sql("documents", "doc_id")}),
n AS (SELECT item_id, count(*) AS n FROM a GROUP BY 1), p AS (SELECT item_id, doc_id, count(*) AS m FROM a JOIN b USING (run) GROUP BY 1, 2)
SELECT item_id, doc_id, round(m / n, 4) AS matching_share FROM p JOIN n USING (item_id)"""
)
def similar_pairs(t: Tables) -> DataFrame:
    """F-42, X-02: how much of one whole text, in runs of five words, is found in each text that shares any."""
    shared = scoring.shared_runs(t.benchmark, t.documents, "item_id", "doc_id")
    return shared.withColumn("matching_share", F.round("matching_share", 4))


@query(
    """SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_ids, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1"""
)
def resume_stream(t: Tables) -> DataFrame:
    """R-01: chunk files ingested in two runs, each exactly once."""
    spark, base = t.spark, new_folder(t.spark, "stream")
    _arriving(t, f"{base}/in")
    for _ in range(2):
        stream = ingest.read_chunk_stream(spark, f"{base}/in", _EVENT_SCHEMA)
        ingest.ingest_new(stream, f"{base}/out", f"{base}/ck").awaitTermination()
    return spark.read.schema(_EVENT_SCHEMA).parquet(f"{base}/out").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_ids"), rollup.exact_sum(F.col("value")).alias("total")
    )


_EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"


def _arriving(t: Tables, path: str) -> None:
    t.events.select("event_id", "user_id", "event_type", "value").repartitionByRange(6, "event_id").write.parquet(path)


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_counts(t: Tables) -> DataFrame:
    """R-02: running counts per key while files arrive."""
    spark, base = t.spark, new_folder(t.spark, "counts")
    _arriving(t, f"{base}/in")
    stream = ingest.read_chunk_stream(spark, f"{base}/in", _EVENT_SCHEMA, max_files=3)
    ingest.running_counts(stream, ["user_id", "event_type"], f"{base}/out", f"{base}/ck").awaitTermination()
    return ingest.latest_counts(spark, f"{base}/out", ["user_id", "event_type"])


ARRIVALS = 3


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def stream_distinct(t: Tables) -> DataFrame:
    """R-03: the first row of every id over all batches, by a query that is started anew for each arrival."""
    spark, base = t.spark, new_folder(t.spark, "distinct")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    last = rows.agg(F.max("event_id")).first()[0]
    width = last // ARRIVALS + 1
    for i in range(ARRIVALS):
        rows.where(F.col("event_id").between(i * width, (i + 1) * width - 1)).write.mode("append").parquet(f"{base}/in")
        stream = ingest.read_chunk_stream(spark, f"{base}/in", _EVENT_SCHEMA)
        ingest.ingest_distinct(stream, ["user_id"], f"{base}/out", f"{base}/ck", ["event_id"]).awaitTermination()
    return ingest.read_distinct(spark, f"{base}/out").select("user_id", "event_id")
