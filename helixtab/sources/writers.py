"""Writers for delimited, sequence, variant, JSON and Parquet files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions.terms import CONTIGS


def write_table(df: DataFrame, path: str, sep: str = ",", compression: str | None = None) -> None:
    """K-01, K-07: CSV or TSV with a header; nulls are written as nothing."""
    writer = (
        df.write.option("header", True).option("sep", sep).option("escape", '"')
        .option("emptyValue", "").option("nullValue", "")
    )
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def fasta_lines(id_: Column, seq: Column) -> Column:
    return F.concat(F.lit(">"), id_, F.lit("\n"), seq)


def write_fasta(df: DataFrame, id_col: str, seq_col: str, path: str) -> None:
    """K-02."""
    df.select(fasta_lines(F.col(id_col), F.col(seq_col))).write.text(path)


def write_fasta_chunks(df: DataFrame, id_col: str, seq_col: str, chunk: str, path: str) -> None:
    """K-03: one FASTA file per chunk folder; a chunk has a bounded number of rows."""
    lines = df.select(chunk, id_col, fasta_lines(F.col(id_col), F.col(seq_col)).alias("line"))
    (
        lines.repartition(F.col(chunk)).sortWithinPartitions(chunk, id_col).select("line", chunk)
        .write.partitionBy(chunk).text(path)
    )


def write_table_chunks(df: DataFrame, chunk: str, path: str, sep: str = "\t") -> None:
    """K-03, K-04: one delimited file per chunk folder."""
    df.repartition(F.col(chunk)).write.option("header", True).option("sep", sep).partitionBy(chunk).csv(path)


def manifest(df: DataFrame, keys: Sequence[str], name: str = "n_mutants") -> DataFrame:
    """K-04: rows per key, the companion of a chunked export."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def contig_lengths(fasta: DataFrame) -> DataFrame:
    """A-21: residues per sequence id, summed over its records."""
    return fasta.groupBy("id").agg(F.sum(F.length("seq")).alias("length"))


def vcf_header(lengths: Mapping[str, int]) -> list[str]:
    """K-05: header lines with the contigs in genome order; ``lengths`` must name each of them."""
    names = ["chr" + ("M" if c == "MT" else c) for c in CONTIGS]
    return [
        "##fileformat=VCFv4.2",
        *[f"##contig=<ID={c},length={lengths[c]}>" for c in names],
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
    ]


def write_vcf_chunks(
    df: DataFrame, path: str, header: Sequence[str], chunk: str = "chunk", order: Sequence[str] = ("chrom", "pos", "id")
) -> None:
    """K-05: one variant file per chunk folder, the header on top of each.

    Expects chrom, pos, id, ref and alt; the other columns are written as missing.
    """
    dot = F.lit(".")
    info = F.col("info") if "info" in df.columns else dot
    line = F.concat_ws(
        "\t", "chrom", F.col("pos").cast("string"), F.col("id").cast("string"), "ref", "alt", dot, dot, info
    )
    spec = F.struct(*[F.col(c) for c in order])
    body = df.select(chunk, F.lit(1).alias("_part"), F.lit(0).alias("_n"), spec.alias("_o"), line.alias("value"))
    tops = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(h).alias("h")) for i, h in enumerate(header)])
    null_order = F.lit(None).cast(body.schema["_o"].dataType)
    head = (
        df.select(chunk).distinct().withColumn("_h", F.explode(tops))
        .select(chunk, F.lit(0).alias("_part"), F.col("_h.i").alias("_n"), null_order.alias("_o"), F.col("_h.h").alias("value"))
    )
    (
        body.unionAll(head).repartition(F.col(chunk))
        .sortWithinPartitions(chunk, "_part", "_n", "_o")
        .select("value", chunk).write.partitionBy(chunk).text(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    """K-06."""
    df.write.json(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K-07: zstd Parquet."""
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Score tables that are joined again on one key, pre-partitioned so the join needs no shuffle."""
    df.write.bucketBy(buckets, key).sortBy(key).mode("errorifexists").saveAsTable(table)


def long_form(df: DataFrame, key: str, nested: Mapping[str, str], aspect: str = "aspect") -> DataFrame:
    """K-09: array-of-struct columns as rows of (key, aspect, fields)."""
    parts = None
    for column, label in nested.items():
        part = df.select(key, F.lit(label).alias(aspect), F.explode(column).alias("_e")).select(
            key, aspect, "_e.*"
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def flagged_only(df: DataFrame, flags: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """K-10: the rows with any ``Y`` flag, with their evidence columns."""
    any_ = F.lit(False)
    for f in flags:
        any_ = any_ | (F.col(f) == "Y")
    return df.where(any_).select(*columns)
