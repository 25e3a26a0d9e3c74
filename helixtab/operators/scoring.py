"""Batch scoring of sequences by a pluggable scorer, and pairwise sequence similarity."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixtab.workspace import stage

# the functions below travel to the workers whole, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Scorer = Callable[[Sequence[str]], Sequence[Sequence[float]]]

# Sequences per call by length, the longest limit first.
BATCH_SIZES = ((2000, 2), (1000, 4), (0, 8))


def batch_size(length: int) -> int:
    return next(size for limit, size in BATCH_SIZES if length > limit or limit == 0)


def score_sequences(
    df: DataFrame,
    id_col: str,
    seq_col: str,
    scorer: Scorer,
    names: Sequence[str],
    max_len: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """X-01, T-07: one output row per input id with scores and a status.

    Every distinct sequence is scored once and joined back.  Work is spread by cost: sequences are
    dealt to partitions by hash within their length class, so a run of very long ones does not land
    in one task, and are sorted by length inside a partition so that a call gets sequences of
    similar size.  Over-long sequences are marked and not scored; a failing call is repeated one
    by one, and only the sequences that fail again are marked.
    """
    schema = T.StructType(
        [
            T.StructField("_key", T.StringType()),
            *[T.StructField(n, T.DoubleType()) for n in names],
            T.StructField("score_status", T.StringType()),
        ]
    )

    def call(batch: list[tuple[str, str]]) -> list[tuple]:
        try:
            rows = scorer([seq for _, seq in batch])
            return [(k, *map(float, row), "scored") for (k, _), row in zip(batch, rows, strict=True)]
        except Exception:
            if len(batch) == 1:
                return [(batch[0][0], *[None] * len(names), "failed")]
            return [r for one in batch for r in call([one])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            pending: list[tuple[str, str]] = []
            for item in zip(pdf["_key"], pdf["_seq"]):
                if pending and len(pending) >= batch_size(len(pending[0][1])):
                    rows += call(pending)
                    pending = []
                pending.append(item)
            if pending:
                rows += call(pending)
            yield pd.DataFrame(rows, columns=[f.name for f in schema.fields])

    spark = df.sparkSession
    n_parts = partitions or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    # the digest stands for the sequence in the distinct and in the join back
    keyed = df.select(id_col, F.sha2(seq_col, 256).alias("_key"), F.col(seq_col).alias("_seq"))
    fits = F.col("_seq").isNotNull() if max_len is None else F.length("_seq") <= max_len
    scored = (
        keyed.where(fits)
        .select("_key", "_seq")
        .dropDuplicates(["_key"])
        .withColumn("_len", F.length("_seq"))
        .repartition(n_parts, F.floor(F.log2(F.col("_len") + 1)), F.col("_key"))
        .sortWithinPartitions("_len")
        .select("_key", "_seq")
        .mapInPandas(run, schema)
    )
    status = F.coalesce(
        F.col("score_status"), F.when(F.col("_key").isNull(), "no_sequence").otherwise("too_long")
    )
    return (
        keyed.select(id_col, "_key")
        .join(scored, "_key", "left")
        .select(id_col, *names, status.alias("score_status"))
    )


class ResidueShare:
    """A repeatable stand-in for a model: share of each listed letter in the sequence."""

    def __init__(self, letters: str):
        self.letters = letters

    def __call__(self, seqs: Sequence[str]) -> list[list[float]]:
        return [[s.count(x) / len(s) if s else 0.0 for x in self.letters] for s in seqs]


def word_runs(table: DataFrame, key: str, text: str, width: int = 5) -> DataFrame:
    """(key, h1, h2): 128 bits of every run of ``width`` words of each text, once a row; a null or shorter text has none."""
    words = F.filter(F.split(text, "[ \n\t\r]+"), lambda x: x != "")
    starts = F.when(F.size("w") >= width, F.sequence(F.lit(1), F.size("w") - (width - 1)))
    run = lambda k: F.array_join(F.slice("w", k, F.lit(width)), " ")
    runs = F.array_distinct(F.transform(starts, run))
    rows = table.select(key, words.alias("w")).select(key, F.explode(runs).alias("run"))
    return rows.select(key, F.xxhash64("run").alias("h1"), F.xxhash64(F.lit(7), "run").alias("h2"))


def shared_runs(
    first: DataFrame, second: DataFrame, first_key: str, second_key: str, text: str = "text", width: int = 5, name: str = "matching_share"
) -> DataFrame:
    """F-42, X-02: share of the distinct word runs of one text that stand in another, for all pairs with any.

    A coverage by common runs; blocks shorter than ``width`` words count as nothing.  Pairs come from an equi-join on
    128-bit hashes of the runs, so texts that share nothing never meet.  The runs of ``first`` are written before the join, so that
    Spark knows their size and need not move those of ``second`` to a small table; repeats of a key are put together after the join.
    """
    own = stage(word_runs(first, first_key, text, width).distinct(), "runs")
    sizes = own.groupBy(first_key).agg(F.count(F.lit(1)).alias("_n"))
    met = own.join(word_runs(second, second_key, text, width), ["h1", "h2"])
    shared = met.distinct().groupBy(first_key, second_key).agg(F.count(F.lit(1)).alias("_m"))
    return shared.join(sizes, first_key).select(first_key, second_key, (F.col("_m") / F.col("_n")).alias(name))
