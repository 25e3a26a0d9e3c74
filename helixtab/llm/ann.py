"""Approximate nearest neighbours by adaptive dimension scans of inverted lists.

Unit vectors are turned by a random rotation and dealt to lists by their nearest centre.  A query
probes its nearest lists.  Within a list the vectors lie in column blocks of a few dimensions; a scan
adds up squared distances block by block and, after each, tests the hypothesis that the candidate is
nearer than the k-th best so far: of a rotated vector, the partial distance over ``b`` of ``d``
dimensions, scaled by ``d / b``, exceeds the true one by more than a factor ``(1 + epsilon / sqrt(b)) ** 2``
only with small probability, so candidates beyond that are abandoned.  What survives all dimensions
is scored exactly, in double precision on the original vectors.

Centres, rotation and the number of probed lists come from a sample of at most ``sample_rows``
vectors (lowest hashes of their ids); every row is indexed.  The number of probed lists is the least
that holds ``target`` of the sample's own true neighbours.  A list with many vectors is split into blocks of
about ``block_rows``, which different tasks scan; queries go to all blocks of a list.

Defined results: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do null ids; of rows with equal ids the smallest vector
counts; equal scores go to the smaller id; with fewer than k candidates all are returned; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SAMPLE_ROWS = 10_000
BLOCK_ROWS = 8192
STEP = 16
EPSILON = 2.1
TARGET = 0.985
FOUND = "query_id long, vec_id long, score double"


@dataclass
class Index:
    """What is fitted on the sample: rotation, centres of the lists, and how many lists a query probes."""

    rotation: np.ndarray
    centres: np.ndarray
    probes: int


def clean_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector): usable vectors in double precision, one for each id."""
    vector = F.col(vector_col).cast("array<double>")
    usable = (
        F.col(id_col).isNotNull()
        & vector.isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )
    rows = table.where(usable).select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _unit(x: np.ndarray) -> np.ndarray:
    x = _near_one(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :]


def fit_index(sample: np.ndarray, rows: int, k: int, target: float = TARGET, seed: int = 7) -> Index:
    """``sample``: vectors of the sample; ``rows``: how many vectors there are in all."""
    random = np.random.default_rng(seed)
    size = sample.shape[1]
    rotation = np.linalg.qr(random.standard_normal((size, size)))[0]
    own = _unit(sample) @ rotation
    lists = int(np.clip(round(rows**0.5 / 2), 1, min(1024, max(1, len(own) // 8))))
    centres = own[random.choice(len(own), lists, replace=False)]
    for _ in range(6):
        near = _distances(own, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, own)
        count = np.bincount(near, minlength=lists)[:, None]
        centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
    near = _distances(own, centres).argmin(axis=1)
    asked = random.choice(len(own), min(len(own), 400), replace=False)
    apart = _distances(own[asked], own)
    apart[np.arange(len(asked)), asked] = np.inf
    best = np.argsort(apart, axis=1)[:, :k]
    turn = np.argsort(np.argsort(_distances(own[asked], centres), axis=1), axis=1)
    ranks = np.take_along_axis(turn, near[best], axis=1)
    probes = int(np.quantile(ranks, target, method="higher")) + 1 if ranks.size else lists
    return Index(rotation, centres, probes)


def scan(query: np.ndarray, blocks: list[np.ndarray], k: int, epsilon: float = EPSILON, chunk: int = 1024) -> np.ndarray:
    """Rows that may be among the k nearest, by partial distances over column blocks.

    ``blocks[j]`` holds dimensions ``j * STEP ..`` of all rows.  The bound is the k-th distance among
    the rows already scanned; ties survive.
    """
    size = sum(b.shape[1] for b in blocks)
    rows = len(blocks[0])
    bound = np.inf
    kept: list[np.ndarray] = []
    known = np.zeros(0)
    for low in range(0, rows, chunk):
        alive = np.arange(low, min(low + chunk, rows))
        far = np.zeros(len(alive))
        seen = 0
        for block in blocks:
            gap = block[alive] - query[seen : seen + block.shape[1]]
            far += np.einsum("ij,ij->i", gap, gap)
            seen += block.shape[1]
            if bound < np.inf:
                slack = (1 + epsilon / np.sqrt(seen)) ** 2 if seen < size else 1.0
                stay = far * (size / seen) <= bound * slack + 1e-5
                alive, far = alive[stay], far[stay]
        kept.append(np.column_stack((alive, far)))
        known = np.sort(np.concatenate((known, far)))[:k]
        if len(known) == k:
            bound = known[-1]
    every = np.concatenate(kept)
    return every[every[:, 1] <= bound + 1e-5, 0].astype(int)


def _near_one(x: np.ndarray) -> np.ndarray:
    """Vectors times a power of two that brings their largest component below 1: no sum of squares overflows or
    vanishes, and no digit changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1])


def exact_scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision; equal vectors get equal scores."""
    query, vectors = _near_one(query), _near_one(vectors)
    dot = (vectors * query).sum(axis=1)
    return dot / (np.sqrt((query * query).sum()) * np.sqrt((vectors * vectors).sum(axis=1)))


def _search(k: int, epsilon: float):
    def search(queries: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(part):
            vectors = np.stack(part["vector"].to_numpy())
            turned = np.stack([np.frombuffer(x, np.float32) for x in part["turned"]])
            blocks = [np.ascontiguousarray(turned[:, j : j + STEP]) for j in range(0, turned.shape[1], STEP)]
            ids = part["vec_id"].to_numpy()
            for name, vector, own in zip(queries["query_id"], queries["q_vector"], queries["q_turned"]):
                # one more than k: the query itself may be among them
                found = scan(np.frombuffer(own, np.float32), blocks, k + 1, epsilon)
                found = found[ids[found] != name]
                score = exact_scores(np.asarray(vector), vectors[found])
                best = np.lexsort((ids[found], -score))[:k]
                out["query_id"] += [name] * len(best)
                out["vec_id"] += ids[found][best].tolist()
                out["score"] += score[best].tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return search


def nearest(
    table: DataFrame,
    k: int = 5,
    every: int = 50,
    sample_rows: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS,
    target: float = TARGET,
    epsilon: float = EPSILON,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest of each row whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    spark = table.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = stage(clean_vectors(table, id_col, vector_col), "vectors")
    sizes = usable.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not sizes:
        return empty
    size, rows = sizes[0]["size"], sizes[0]["count"]
    usable = usable.where(F.size("vector") == size)
    # bounded by its parameter
    sample = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vector").collect()
    index = spark.sparkContext.broadcast(fit_index(np.array([r.vector for r in sample]), rows, k, target))

    def deal(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            own = _unit(np.stack(part["vector"].to_numpy())) @ index.value.rotation
            apart = _distances(own, index.value.centres)
            nearby = np.argsort(apart, axis=1, kind="stable")
            yield pd.DataFrame(
                {
                    "vec_id": part["vec_id"],
                    "vector": part["vector"],
                    "turned": [x.tobytes() for x in own.astype(np.float32)],
                    "list": nearby[:, 0].astype(np.int32),
                    "probes": [
                        x[: index.value.probes].astype(np.int32).tolist() if v % every == 0 else None
                        for v, x in zip(part["vec_id"], nearby)
                    ],
                }
            )

    dealt = stage(
        usable.mapInPandas(deal, "vec_id long, vector array<double>, turned binary, list int, probes array<int>"), "lists"
    )
    # one row per list
    counts = dealt.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    parts = dealt.join(F.broadcast(counts), "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block"), "vec_id", "vector", "turned"
    )
    queries = (
        dealt.where("probes is not null")
        .select(F.col("vec_id").alias("query_id"), F.col("vector").alias("q_vector"), F.col("turned").alias("q_turned"), F.explode("probes").alias("list"))
        .join(F.broadcast(counts), "list")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
        .drop("blocks")
    )
    found = queries.groupBy("list", "block").cogroup(parts.groupBy("list", "block")).applyInPandas(_search(k, epsilon), FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
