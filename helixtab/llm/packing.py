"""Packing by minimum bin slack.

Documents are encoded, ended with one id and, where longer than a sequence, cut into whole sequences
with the remainder as their first piece.  Packing then works on lengths alone: of the lengths still
at hand the largest opens a bin, and a bitset subset-sum over the others finds the fullest feasible
combination, which is removed as often as the counts allow.  Each removal uses up a length, so the
plan has a bounded number of patterns (at most a few for each length up to ``capacity``) for any number of
documents, and it is the only thing that passes through the driver.  The pieces get their places by a join on
their rank within their length; ranks come from counts per task, so a very common length is never
gathered in one place.

Defined results: a null text counts as empty (a piece of the end id alone); repeated rows are packed
each; null ids are packed like others; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import returning_memory, stage_texts
from .tokens import encoded, encoder

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long, ids binary"


# --- the plan: lengths and counts only --------------------------------------------------------


def _fullest(seed: int, counts: Counter, capacity: int) -> Counter:
    """The fullest bin that holds one piece of the largest length and others at hand.

    ``reach[k]`` is a bitset of the fills that the first k groups of pieces can make; groups are the
    lengths, largest first, their counts in binary shares.  Among equal fills the way back takes a
    group only when the groups before it can't make the fill, so long pieces go first.
    """
    room = capacity - seed
    mask = (1 << (room + 1)) - 1
    groups: list[tuple[int, int]] = []
    reach = [1]
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left = min(counts[length] - (length == seed), room // length)
        share = 1
        while left > 0:
            take = min(share, left)
            groups.append((length, take))
            reach.append((reach[-1] | reach[-1] << (length * take)) & mask)
            left -= take
            share *= 2
        if reach[-1] >> room & 1:
            break
    fill = reach[-1].bit_length() - 1
    bin_ = Counter({seed: 1})
    for k in range(len(groups), 0, -1):
        if not reach[k - 1] >> fill & 1:
            length, take = groups[k - 1]
            bin_[length] += take
            fill -= length * take
    return bin_


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, Counter]]:
    """(times, content) patterns that use up the histogram of lengths."""
    counts = Counter({k: v for k, v in histogram.items() if v > 0})
    patterns = []
    while counts:
        bin_ = _fullest(max(counts), counts, capacity)
        times = min(counts[length] // n for length, n in bin_.items())
        patterns.append((times, bin_))
        for length, n in bin_.items():
            counts[length] -= times * n
            if not counts[length]:
                del counts[length]
    return patterns


def plan_rows(patterns: list[tuple[int, Counter]]) -> pd.DataFrame:
    """One row per pattern and length: ranks ``first_rank ..`` of the length lie in bins ``first_bin ..``,
    ``per_bin`` of them in each, from ``offset`` on."""
    used: Counter = Counter()
    rows, bins = [], 0
    for times, bin_ in patterns:
        offset = 0
        for length in sorted(bin_, reverse=True):
            rows.append((length, used[length], bins, bin_[length], offset))
            used[length] += times * bin_[length]
            offset += length * bin_[length]
        bins += times
    return pd.DataFrame(rows, columns=["length", "first_rank", "first_bin", "per_bin", "offset"], dtype="int64")


# --- the pieces -------------------------------------------------------------------------------


def _cut(n: int, capacity: int) -> list[int]:
    """Piece bounds of a document of n ids: the remainder first, then whole sequences."""
    return [0, *range(n % capacity or min(n, capacity), n + 1, capacity)]


def _pieces(vocabulary: str | None, end_id: int, capacity: int, dtype: str, schema: pa.Schema):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen: Counter = Counter()
        end = np.array([end_id], dtype)
        held = encoder(vocabulary, dtype)  # for the whole task
        for batch in batches:
            names = batch.column("doc_id")
            out: dict[str, list] = {n: [] for n in schema.names}
            for row, ids in encoded(batch, "text", held.vocabulary, dtype):
                ids = np.concatenate((ids, end))
                bounds = _cut(len(ids), capacity)
                for piece, (low, high) in enumerate(zip(bounds, bounds[1:])):
                    own = ids[low:high]
                    out["doc_id"].append(names[row].as_py())
                    out["piece"].append(piece)
                    out["start"].append(low)
                    out["length"].append(high - low)
                    out["ids_crc32"].append(zlib.crc32(own.astype("<u4")))
                    out["task"].append(task)
                    out["place"].append(seen[high - low])
                    out["ids"].append(own.tobytes())
                    seen[high - low] += 1
                if len(out["ids"]) >= 1024:
                    yield pa.RecordBatch.from_pydict(out, schema)
                    out = {n: [] for n in schema.names}
            if out["ids"]:
                yield pa.RecordBatch.from_pydict(out, schema)

    return cut


def _schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in PIECE.split(", "))])


def cut_pieces(
    docs: DataFrame,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    end_id: int = 0,
    dtype: str = "<u2",
) -> DataFrame:
    """The pieces of all documents with their ids, written once: places are tied to the tasks that wrote them."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stage_texts(rows.mapInArrow(returning_memory(_pieces(vocabulary, end_id, capacity, dtype, _schema())), PIECE), "pieces")


def place_pieces(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(
        "length",
        "task",
        (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"),
    )
    # at most one row per length up to the capacity
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_rows(plan_bins(histogram, capacity)).sort_values(["length", "first_rank"])
    by_length = {k: g.to_numpy().T for k, g in plan.groupby("length")}
    table = spark.sparkContext.broadcast(by_length)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((2, len(length)), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for value in np.unique(lengths):
            here = np.flatnonzero(lengths == value)
            _, first_rank, first_bin, per_bin, offset = table.value[value]
            row = np.searchsorted(first_rank, ranks[here], side="right") - 1
            past = ranks[here] - first_rank[row]
            out[0, here] = first_bin[row] + past // per_bin[row]
            out[1, here] = offset[row] + past % per_bin[row] * value
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    ranked = pieces.join(before, ["length", "task"]).withColumn("rank", F.col("place") + F.col("before"))
    return ranked.withColumn("at", place("length", "rank")).select(
        *[c for c in pieces.columns if c not in ("task", "place")], "at.sequence_id", "at.offset"
    )


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, n_ids, ids (bytes of all pieces in place)."""
    parts: Column = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])
    # a sequence has at most ``capacity`` ids, so its pieces are bounded
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_ids"),
        F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
    )
