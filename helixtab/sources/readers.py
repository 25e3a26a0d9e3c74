"""Readers for delimited, sequence, variant, record and signal files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixtab.operators.quality import QualityError
from helixtab.operators.select import first_rows
from helixtab.workspace import stage


def with_ord(df: DataFrame) -> DataFrame:
    """Input order as a column: rising within a file, by split."""
    return df.withColumn("ord", F.monotonically_increasing_id())


def read_table(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    schema: T.StructType | None = None,
    multiline: bool = True,
    header: bool = True,
    comment: str | None = None,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """S-01, S-02, S-05, S-07: a delimited table with all cells as text.

    Quotes are doubled and may hold line breaks.  ``multiline=False`` reads large plain files in
    splits.  Without a schema the header gives the names.
    """
    reader = (
        spark.read.option("sep", sep).option("header", header).option("quote", '"')
        .option("escape", '"').option("multiLine", multiline).option("mode", mode)
        .option("maxCharsPerColumn", -1).option("encoding", "UTF-8")
    )
    if comment:
        reader = reader.option("comment", comment)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_tsv(spark: SparkSession, path: str | list[str], **kw) -> DataFrame:
    """S-02."""
    return read_table(spark, path, sep="\t", **kw)


def land_gzip(spark: SparkSession, path: str | list[str], n_files: int, **kw) -> DataFrame:
    """S-03: a gzipped TSV, which one task must unpack per file, spread out and kept as Parquet.

    A later job reads the Parquet in splits and by column.
    """
    return stage(read_tsv(spark, path, multiline=False, **kw).repartition(n_files), "landed")


def clean_headers(df: DataFrame, strip: str = "#") -> DataFrame:
    """S-04: drop a leading mark from column names."""
    return df.toDF(*[c.lstrip(strip) for c in df.columns])


def read_after_preamble(spark: SparkSession, path: str | list[str], header_start: str, sep: str = "\t") -> DataFrame:
    """S-06: a table whose header is, in each file, the first line that starts with a known token.

    Headers are found by an aggregate over all lines; the driver sees the distinct ones.  Files whose
    columns differ are put together by name.
    """
    place = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), place.alias("_at"))
    is_header = F.startswith("value", F.lit(header_start))
    text = F.regexp_replace("value", "\r$", "")
    heads = stage(
        lines.where(F.trim(text) != "").groupBy("_file").agg(F.min(F.when(is_header, F.struct("_at", text.alias("header")))).alias("_head")),
        "headers",
    )
    without = heads.where(F.col("_head").isNull()).agg(F.min("_file")).first()[0]
    headers = heads.where(F.col("_head").isNotNull()).groupBy("_head.header").agg(F.min("_file").alias("_first")).orderBy("_first").collect()
    if without is not None or not headers:
        raise ValueError(f"no line of {without or path} starts with {header_start!r}")
    out = None
    for header in (r.header for r in headers):
        ddl = ", ".join(f"`{n}` string" for n in (x.strip('"') for x in header.split(sep)))
        parsed = F.from_csv(text, ddl, {"sep": sep, "quote": '"', "escape": '"'})
        body = lines.join(heads.where(F.col("_head.header") == header), "_file").where(F.col("_at") > F.col("_head._at"))
        table = body.where(F.trim("value") != "").select(parsed.alias("_r")).select("_r.*")
        out = table if out is None else out.unionByName(table, allowMissingColumns=True)
    return out


def _records(spark: SparkSession, path: str | list[str], line_sep: str) -> DataFrame:
    return spark.read.option("lineSep", line_sep).text(path)


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S-08: (header, id, seq); sequence lines are joined, the id is the header's first word.

    Records are cut at ``>`` at a line start, so files are read in splits.
    """
    rec = F.regexp_replace(F.regexp_replace("value", "^>", ""), "\r", "")
    header = F.substring_index("rec", "\n", 1)
    body = F.when(F.contains("rec", F.lit("\n")), F.substr("rec", F.length(header) + 1)).otherwise("")
    return (
        _records(spark, path, "\n>")
        .select(rec.alias("rec"))
        .where(F.trim("rec") != "")
        .select(
            header.alias("header"),
            F.regexp_extract(header, r"^(\S*)", 1).alias("id"),
            F.regexp_replace(body, r"\s", "").alias("seq"),
        )
    )


def split_header(header: Column, sep: str = "|") -> tuple[Column, Column]:
    """S-08: ``gene|acc`` headers."""
    return F.substring_index(header, sep, 1), F.substr(header, F.instr(header, sep) + 1)


def read_uniprot_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S-09: (accession, gene, seq) from ``sp|ACC|NAME … GN=gene …`` headers."""
    parts = F.split("header", r"\|")
    gene = F.regexp_extract("header", r"(?:^|\s)GN=(\S+)(?!.*\sGN=)", 1)
    return read_fasta(spark, path).select(
        F.when(F.size(parts) >= 2, F.get(parts, F.lit(1))).otherwise(F.col("id")).alias("accession"),
        F.when(gene != "", gene).alias("gene"),
        "seq",
    )


VCF_COLUMNS = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info")


def read_vcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S-10: the body of variant files; position as a number."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in VCF_COLUMNS])
    raw = read_table(
        spark, path, sep="\t", schema=schema, multiline=False, header=False, comment="#"
    )
    return raw.withColumn("pos", F.col("pos").try_cast("bigint"))


def read_flat_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S-11: accession, protein id and translation of the first coding block of ``//`` records.

    Records without accession, coding block or translation are left out.
    """
    # The layout of the flat-file format.
    cds = r"(?ms)^     CDS .*?(?=^     \S|\z)"
    rec = F.regexp_replace("value", "\r", "")
    block = F.regexp_extract(rec, cds, 0)
    seq = F.regexp_replace(F.regexp_extract(block, r'(?s)/translation="([^"]+)"', 1), r"\s+", "")
    protein = F.regexp_extract(block, r'/protein_id="([^"]+)"', 1)
    return (
        _records(spark, path, "\n//\n")
        .select(
            F.regexp_extract(rec, r"(?m)^VERSION\s+(\S+)", 1).alias("accession"),
            F.when(protein != "", protein).alias("protein_id"),
            seq.alias("sequence"),
        )
        .where("accession <> '' and sequence <> ''")
    )


def read_keyed_json(
    spark: SparkSession, path: str | list[str], value_type: str, whole_file: bool = True
) -> DataFrame:
    """S-12: ``{key: {…}}`` objects to (key, value), one object per file or one per line.

    A whole file is one row to Spark; large maps should come as lines.
    """
    parsed = F.from_json("value", f"map<string,{value_type}>")
    return (
        spark.read.text(path, wholetext=whole_file)
        .select(F.explode(parsed).alias("key", "value"))
    )


def read_pairs(spark: SparkSession, path: str | list[str], names: Sequence[str] = ("a", "b")) -> DataFrame:
    """S-13: two columns parted by a tab or spaces."""
    parts = F.split(F.trim("value"), r"[\t ]+")
    return (
        spark.read.text(path).where(F.trim("value") != "")
        .select(F.get(parts, F.lit(0)).alias(names[0]), F.get(parts, F.lit(1)).alias(names[1]))
    )


def read_id_list(spark: SparkSession, path: str | list[str], name: str = "id") -> DataFrame:
    """S-14: distinct non-blank lines."""
    return spark.read.text(path).select(F.trim("value").alias(name)).where(F.col(name) != "").distinct()


def chunk_of_file(pattern: str = r"chunk[_=](\d+)") -> Column:
    """Chunk number in the path a row was read from."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast("int")


def read_chunks(spark: SparkSession, path: str, expected: int | None = None, sep: str = "\t") -> DataFrame:
    """S-15: all result files below a folder with their chunk number.

    Raises when a chunk has more than one file or when chunks are missing; the check reads names.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.csv*").load(path)
    listed = files.select(F.regexp_extract("path", r"chunk[_=](\d+)", 1).alias("chunk"))
    counts = listed.where("chunk <> ''").groupBy("chunk").count()
    if not counts.where("count > 1").isEmpty():
        raise QualityError("a chunk has more than one result file")
    if expected is not None and counts.count() != expected:
        raise QualityError(f"{counts.count()} chunks instead of {expected}")
    rows = (
        spark.read.option("header", True).option("sep", sep).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv*").csv(path)
    )
    return rows.select("*", chunk_of_file().alias("chunk"))


def read_columns(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """S-16, S-17: only the named Parquet columns reach the scan."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path)).select(*columns)


def merge_attribute_groups(groups: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """S-18: attribute tables pulled apart, one row per key each, joined again on the ids.

    Exact duplicates are dropped first; of the rest the first table gives the rows.
    """
    base = groups[0].distinct()
    for extra in groups[1:]:
        base = base.join(extra.distinct(), list(keys), "left")
    return base


def read_signal(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S-19: (chrom, start0, end, value) intervals; a missing value is null, track lines are skipped."""
    parts = F.split(F.trim("value"), r"[\t ]+")
    value = F.get(parts, F.lit(3)).try_cast("double")
    return (
        spark.read.text(path)
        .where(~F.col("value").rlike(r"^\s*(#|track|browser|$)"))
        .select(
            F.get(parts, F.lit(0)).alias("chrom"),
            F.get(parts, F.lit(1)).try_cast("bigint").alias("start0"),
            F.get(parts, F.lit(2)).try_cast("bigint").alias("end"),
            F.when(~F.isnan(value), value).alias("value"),
        )
    )


def first_record_per_id(df: DataFrame, key: str) -> DataFrame:
    """The first record of each id in input order."""
    return first_rows(with_ord(df), key, [F.col("ord").asc()]).drop("ord")
