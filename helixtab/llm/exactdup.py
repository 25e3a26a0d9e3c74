"""Exact duplicates by a tree merge of sorted digest runs.

Every partition sorts its digests into a run in which each digest stands once, with the identifier
to retain so far and a count.  The runs are then merged in binomial rounds: in each round a partition
exchanges with the ``fan_in - 1`` partners whose number differs from its own in one group of bits,
keeps its share of the digest range and merges what it receives, again one record for each digest.
After the last round every partition holds one slice of the digest range, merged over all runs, so
no task ever holds more than its slice and a digest with very many copies travels as one record per run.

A record is matched on SHA-256 digest, byte length and a second, independent 64-bit hash at every
level, so texts are only joined when all three agree.

Defined results: a null text counts as empty; a null id is below every other id; of rows that agree
in id and text one is retained; an empty table gives an empty table; other columns, whatever their
names, are carried by ``drop_copies`` and not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, discard, shuffle_partitions, stage, text_or_empty, unused_name

RUN = "digest binary, n_bytes long, second long, id long, row long, n long, slot int"
_KEY = ("digest", "n_bytes", "second")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _merge_run(keep_largest: bool):
    """Adjacent records of a sorted run that agree in the key become one."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            names = table.schema
            if held is not None:
                table = pa.concat_tables([held, table])
            # within a digest the rows come with the one to retain first
            done = (
                table.group_by(list(_KEY), use_threads=False)
                .aggregate([("id", "first"), ("row", "first"), ("n", "sum"), ("slot", "first")])
                .rename_columns({"id_first": "id", "row_first": "row", "n_sum": "n", "slot_first": "slot"})
                .select(names.names)
                .cast(names)
            )
            # the last digest may go on in the next batch
            last = done.column("digest")[-1].as_py()
            cut = done.num_rows - 1
            while cut and done.column("digest")[cut - 1].as_py() == last:
                cut -= 1
            yield from done.slice(0, cut).combine_chunks().to_batches()
            held = done.slice(cut)
        if held is not None:
            yield from held.combine_chunks().to_batches()

    return merge


def _sorted_merge(runs: DataFrame, keep_largest: bool) -> DataFrame:
    best = (
        [F.col("id").desc_nulls_last(), F.col("row").asc()]
        if keep_largest
        else [F.col("id").asc_nulls_last(), F.col("row").asc()]
    )
    return runs.sortWithinPartitions(*_KEY, *best).mapInArrow(_merge_run(keep_largest), RUN)


def merge_runs(entries: DataFrame, keep_largest: bool = False, round_bits: int = 4) -> DataFrame:
    """(digest, n_bytes, second, id, row) entries to one record per digest: id and row to retain, n.

    The number of slices is the largest power of two within the shuffle partitions of the session;
    ``round_bits`` bits of it are settled in each round, so a merge joins ``2 ** round_bits`` runs.
    """
    bits = max(1, shuffle_partitions(entries.sparkSession).bit_length() - 1)
    slices = 1 << bits
    runs = entries.select(
        *_KEY, "id", "row", F.lit(1).cast("long").alias("n"), F.pmod(F.spark_partition_id(), F.lit(slices)).alias("slot")
    )
    runs = _sorted_merge(runs, keep_largest)
    # the leading bits of the digest name the slice in which its merge ends
    goal = F.shiftright(F.conv(F.hex(F.substring("digest", 1, 3)), 16, 10).cast("int"), 24 - bits)
    settled = 0
    while settled < bits:
        settled = min(bits, settled + round_bits)
        low = (1 << (bits - settled)) - 1
        runs = runs.withColumn("slot", (goal.bitwiseAND(F.lit(~low)) + F.col("slot").bitwiseAND(F.lit(low))).cast("int"))
        runs = _sorted_merge(runs.repartitionById(slices, "slot"), keep_largest)
    return runs


def _entries(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = ascii_lower(text_or_empty(text_col))
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        digest_of(text).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.xxhash64(text).alias("second"),
        F.monotonically_increasing_id().alias("row"),
    )


def copy_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_largest: bool = False
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    entries = stage(_entries(docs, id_col, text_col), "copies")
    merged = merge_runs(entries, keep_largest).select(
        *_KEY, F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("n").alias("group_size")
    )
    return entries.join(merged, list(_KEY)).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_largest: bool = False
) -> DataFrame:
    """``docs`` without the rows whose text another retained row has; all columns stay."""
    entries = stage(_entries(docs, id_col, text_col), "copies")

    def key(digest: Column, ident: Column) -> Column:
        return F.concat(digest, F.coalesce(F.unhex(F.lpad(F.hex(ident), 16, "0")), F.lit(b"")))

    name = unused_name(docs.columns, "__copy_key")
    kept = merge_runs(entries, keep_largest).select(key(F.col("digest"), F.col("id")).alias(name))
    kept = stage(kept, "retained")
    discard(entries)
    keyed = docs.withColumn(
        name, key(digest_of(ascii_lower(text_or_empty(text_col))), F.col(id_col).cast("long"))
    )
    # rows equal in id and text share the key: one of them stays
    return keyed.join(kept, name, "left_semi").dropDuplicates([name]).drop(name)
