"""A store of token ids with keyed access.

``write_store`` sorts the documents by id over range partitions, encodes them and writes shards.  A
shard is one row: the raw little-endian ids of a run of documents, the place of every document in
them, and a minimal perfect hash index over the shard's keys.  A shard ends once it holds
``shard_ids`` ids, so only a document that is itself longer makes a larger one.  The files are
written by Spark's own committer into the folder that the caller names: a lost executor repeats its
task, and any store that Spark writes to will do.

The index of a shard: a key is hashed to a bucket; the bucket's seed, or for buckets of one key the
slot itself, leads to the key's slot; the slot's 32-bit fingerprint tells foreign keys; its entry
names the first row of the key and the number of its rows.  Reading a key costs the same for any
number of keys.

Defined results: a null text counts as empty and still has the end id; rows with a null id come
first, can be scanned, and can't be looked up; equal ids lie side by side, in the order of their
texts' hashes, and a lookup returns all of them; an empty table gives an empty store; only the two named columns are
read, so others may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mix64, shuffle_partitions
from .tokens import encoded, encoder

SHARD = (
    "part int, shard int, before long, n_docs int, n_ids long, first_key long, last_key long,"
    "keys array<long>, places array<long>, payload binary,"
    "seeds binary, prints binary, first_row binary, n_rows binary"
)
SHARD_IDS = 1 << 21
_STEP = 0x9E3779B97F4A7C15
_EMPTY = np.zeros(0, np.int32)


# --- the perfect hash index -------------------------------------------------------------------


def _place(keys: np.ndarray, seed: np.ndarray | int, n: int) -> np.ndarray:
    shift = np.asarray(seed, np.uint64) * np.uint64(_STEP)
    return (mix64(keys + shift) % np.uint64(n)).astype(np.int64)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of a minimal perfect hash over distinct 64-bit keys, and the slot of every key.

    Buckets with several keys try seeds 1, 2, ... until their keys fall on free slots, largest
    bucket first; a bucket of one key takes any free slot, kept as ``-slot - 1``.
    """
    n = len(keys)
    seeds = np.zeros(n, np.int32)
    slots = np.zeros(n, np.int64)
    if not n:
        return seeds, slots
    keys = keys.astype(np.uint64)
    bucket = _place(keys, 0, n)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    sizes = np.diff(edges, append=n)
    free = np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        if sizes[b] == 1:
            break
        members = order[edges[b] : edges[b] + sizes[b]]
        own = keys[members]
        low = 1
        while True:
            tried = np.arange(low, low + 16, dtype=np.uint64)
            at = _place(own[None, :] + np.zeros((16, 1), np.uint64), tried[:, None], n)
            ranked = np.sort(at, axis=1)
            good = free[at].all(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if good.any():
                hit = int(np.argmax(good))
                seeds[bucket[members[0]]] = low + hit
                slots[members] = at[hit]
                free[at[hit]] = False
                break
            low += 16
    single = order[edges[sizes == 1]]
    slots[single] = np.flatnonzero(free)[: len(single)]
    seeds[bucket[single]] = -slots[single] - 1
    return seeds, slots


def find(keys: np.ndarray, seeds: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 where the fingerprint says that the key is not in the index."""
    n = len(seeds)
    if not n:
        return np.full(len(keys), -1, np.int64)
    keys = keys.astype(np.uint64)
    seed = seeds[_place(keys, 0, n)].astype(np.int64)
    slot = np.where(seed < 0, -seed - 1, _place(keys, np.maximum(seed, 0).astype(np.uint64), n))
    return np.where(prints[slot] == _fingerprint(keys), slot, -1)


# --- writing ----------------------------------------------------------------------------------


def _shard_row(part: int, shard: int, before: int, keys: list, ids: list[np.ndarray]) -> dict:
    places = np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype=np.int64)))
    known = np.array([k is not None for k in keys])
    numbers = np.array([k for k in keys if k is not None], np.int64)
    rows = np.flatnonzero(known)
    distinct, first, count = np.unique(numbers, return_index=True, return_counts=True)
    seeds, slots = build_index(distinct.view(np.uint64))
    prints, first_row, n_rows = np.zeros(len(slots), np.uint32), _EMPTY.copy(), _EMPTY.copy()
    first_row.resize(len(slots))
    n_rows.resize(len(slots))
    prints[slots] = _fingerprint(distinct.view(np.uint64))
    first_row[slots] = rows[first]
    n_rows[slots] = count
    return {
        "part": part,
        "shard": shard,
        "before": before,
        "n_docs": len(keys),
        "n_ids": int(places[-1]),
        "first_key": int(distinct[0]) if len(distinct) else None,
        "last_key": int(distinct[-1]) if len(distinct) else None,
        "keys": keys,
        "places": places,
        "payload": b"".join(x.tobytes() for x in ids),
        "seeds": seeds.tobytes(),
        "prints": prints.tobytes(),
        "first_row": first_row.tobytes(),
        "n_rows": n_rows.tobytes(),
    }


def _shard_writer(vocabulary: str | None, end_id: int, dtype: str, shard_ids: int, schema: pa.Schema):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        shard = before = size = 0
        keys: list = []
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_shard_row(part, shard, before, keys, held)], schema)

        end = np.array([end_id], dtype)
        own = encoder(vocabulary, dtype)  # for the whole task
        for batch in batches:
            names = batch.column("key").to_pylist()
            for row, ids in encoded(batch, "text", own.vocabulary, dtype):
                keys.append(names[row])
                held.append(np.concatenate((ids, end)))
                size += len(held[-1])
                if size >= shard_ids:
                    yield close()
                    shard, before = shard + 1, before + size
                    keys, held, size = [], [], 0
        if keys:
            yield close()

    return write


def _arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in SHARD.split(","))])


def write_store(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    end_id: int = 2,
    dtype: str = "<u2",
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode whole texts and write them in ascending order of the id, each followed by ``end_id``."""
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    # the hash and the row number part rows of one id, so a repeated id can't fill one task
    tied = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    by_key = tied.repartitionByRange(
        shuffle_partitions(docs.sparkSession), F.col("key").asc_nulls_first(), "tie", "row"
    ).sortWithinPartitions(F.col("key").asc_nulls_first(), "tie", "row")
    by_key.select("key", "text").mapInArrow(
        _shard_writer(vocabulary, end_id, dtype, shard_ids, _arrow_schema()), SHARD
    ).write.option("compression", "zstd").parquet(path)


# --- reading ----------------------------------------------------------------------------------

_FOUND = "part int, shard int, place long, doc_id long, n_ids long, ids_crc32 long, ids binary"


def _read_rows(shard: dict, dtype: str, wanted: np.ndarray | None, with_ids: bool) -> dict[str, list]:
    """The rows of the wanted keys through the index; of every key of the header, if none is given."""
    keys, places = shard["keys"], np.asarray(shard["places"])
    ids = np.frombuffer(shard["payload"], dtype)
    if wanted is None:
        wanted = np.unique(np.array([k for k in keys if k is not None], np.int64))
        rows = [r for r, k in enumerate(keys) if k is None]
    else:
        rows = []
    slots = find(
        wanted.view(np.uint64), np.frombuffer(shard["seeds"], np.int32), np.frombuffer(shard["prints"], np.uint32)
    )
    slots = slots[slots >= 0]
    first, count = (np.frombuffer(shard[x], np.int32)[slots] for x in ("first_row", "n_rows"))
    rows = np.concatenate((np.array(rows, np.int64), np.repeat(first, count) + _runs(count)))
    held = set(wanted.tolist())
    out: dict[str, list] = {x.split()[0]: [] for x in _FOUND.split(", ")}
    for r in rows.tolist():
        if keys[r] is not None and keys[r] not in held:
            continue  # another key with the same fingerprint
        own = ids[places[r] : places[r + 1]].astype("<u4")
        out["part"].append(shard["part"])
        out["shard"].append(shard["shard"])
        out["place"].append(int(shard["before"] + places[r]))
        out["doc_id"].append(keys[r])
        out["n_ids"].append(len(own))
        out["ids_crc32"].append(zlib.crc32(own))
        out["ids"].append(own.tobytes() if with_ids else None)
    return out


def _runs(count: np.ndarray) -> np.ndarray:
    ends = np.cumsum(count, dtype=np.int64)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)


def _found_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in _FOUND.split(", "))])


def scan_store(spark: SparkSession, path: str, dtype: str = "<u2", with_ids: bool = False) -> DataFrame:
    """Every document of the store, read back through the indexes of its shards, without a shuffle of
    ids: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, part, shard, ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
                yield pa.RecordBatch.from_pydict(_read_rows(shard, dtype, None, with_ids), _found_schema())

    store = spark.read.schema(SHARD).parquet(path)
    # one row per part, so the running sum runs over as many rows as there were writing tasks
    parts = store.groupBy("part").agg(F.sum("n_ids").alias("size"))
    parts = parts.select(
        "part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("base")
    )
    found = store.mapInArrow(read, _FOUND)
    return found.join(parts, "part").select(
        "doc_id",
        (F.col("base") + F.col("place")).alias("start"),
        F.col("n_ids").alias("n_tokens"),
        "ids_crc32",
        "part",
        "shard",
        *(["ids"] if with_ids else []),
    )


def lookup(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "doc_id", dtype: str = "<u2") -> DataFrame:
    """The documents with the given ids: doc_id, n_tokens, ids_crc32, ids.

    The keys meet the directory of shards (first and last key, no payload) and go only to the shards
    that can hold them; there the index answers.
    """
    wanted = keys.select(F.col(key_col).cast("long").alias("key")).where("key is not null").distinct()
    store = spark.read.schema(SHARD).parquet(path)
    directory = store.select("part", "shard", "first_key", "last_key").where("first_key is not null")
    step = directory.agg(F.max(F.col("last_key") - F.col("first_key")).alias("w")).first().w
    width = max(1, (step or 0) + 1)
    # a shard is listed in each stretch of ids that it touches, two at most
    listed = directory.withColumn(
        "stretch", F.explode(F.sequence(F.expr(f"first_key div {width} - 1"), F.expr(f"last_key div {width} + 1")))
    )
    routed = (
        wanted.withColumn("stretch", F.expr(f"key div {width}"))
        .join(listed, "stretch")
        .where("key between first_key and last_key")
        .groupBy("part", "shard")
        .agg(F.collect_set("key").alias("wanted"))
    )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                want = np.sort(np.asarray(row.pop("wanted"), np.int64))
                out = _read_rows(row, dtype, want, True)
                yield pd.DataFrame(out)

    names = [x.split()[0] for x in SHARD.split(",")]
    return (
        store.join(routed, ["part", "shard"])
        .select(*names, "wanted")
        .mapInPandas(read, _FOUND)
        .select("doc_id", F.col("n_ids").alias("n_tokens"), "ids_crc32", "ids")
    )
