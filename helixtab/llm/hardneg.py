"""Hard negatives by angular triangle filtering.

Each vector is stored with its length and its angles to a few reference directions.  The angle between an anchor and
a row lies between the difference and the sum of their angles to any reference (going round past a half turn), so all
references together give an interval for the cosine; times both lengths, and widened by what rounding
may do, it bounds the score.  Only rows whose interval meets a window of wanted scores are scored, as integers.

Positives: the rows of an anchor's label lie in blocks.  A scan of a block starts with the rows of the highest
bounds and leaves off when no bound reaches the last of the best so far.  Negatives: rows lie in blocks of one nearest
reference; per positive the window goes from ``low_percent`` % of its score up to the score.  Anchors and rows meet block by
block, both of bounded size; per anchor a block hands on only its own first ones.

References are centres fitted on at most ``sample_rows`` rows (lowest hashes of their ids).  They decide how many rows are
scored, never the result.

Scores are inner products of the components scaled by ``scale`` and rounded down.  They are exact: in doubles while
all partial sums fit, in 64-bit integers while those do, otherwise in Python's integers; one beyond 64 bits is returned as the nearest long.

Defined results: rows with a null id, label or vector, with a null or non-finite component, with another length than most
rows, or with a component that isn't finite once scaled take no part; a zero vector scores 0 with all; rows of equal ids are rows of their
own, each an anchor if its id is one; ties go to the smaller id; an anchor without positives, or without rows in
a window, has no row in the result; an empty table gives an empty table; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

REFERENCES = 16
SAMPLE_ROWS = 4096
BLOCK_ROWS = 8192
BLOCK_ANCHORS = 512
SCALE = 256.0
SLACK = 2e-7  # of angles: more than arccos errs by anywhere

_STORED = "row long, vec_id long, label long, vector binary, angles binary, length double, home int"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def clean_rows(table: DataFrame, label: Column, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(vec_id, label, vector): usable rows with whole-numbered components, held as doubles."""
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x * F.lit(scale))
    # floor() of a double gives a long; large components stay doubles here
    whole = F.transform("vector", lambda x: F.when(F.rint(x) > x, F.rint(x) - 1).otherwise(F.rint(x)))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), scaled.alias("vector"))
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & usable).withColumn("vector", whole)


def lengths_of(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths; components may be large."""
    top = np.abs(x).max(axis=1, initial=0)
    safe = np.where(top > 0, top, 1)[:, None]
    return top * np.sqrt(((x / safe) ** 2).sum(axis=1))


def _units(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, initial=0)
    x = x / np.where(top > 0, top, 1)[:, None]
    size = np.sqrt((x * x).sum(axis=1))
    return x / np.where(size > 0, size, 1)[:, None]


def fit_references(sample: np.ndarray, count: int = REFERENCES, seed: int = 11) -> np.ndarray:
    """Unit directions near the sample's clusters."""
    own = _units(sample)
    own = own[np.abs(own).max(axis=1, initial=0) > 0]
    if not len(own):
        return np.eye(1, sample.shape[1])
    random = np.random.default_rng(seed)
    at = own[random.choice(len(own), min(count, len(own)), replace=False)]
    for _ in range(6):
        near = (own @ at.T).argmax(axis=1)
        sums = np.zeros_like(at)
        np.add.at(sums, near, own)
        moved = _units(sums)
        at = np.where(np.abs(moved).max(axis=1, keepdims=True) > 0, moved, at)
    return at


def angles_to(x: np.ndarray, references: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_units(x) @ references.T, -1, 1))


def score_bounds(angles: np.ndarray, length: float, row_angles: np.ndarray, row_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that rows may have with an anchor; never narrower than the truth."""
    least = np.abs(row_angles - angles).max(axis=1, initial=0) - SLACK
    total = row_angles + angles
    most = np.minimum(total, 2 * np.pi - total).min(axis=1, initial=np.pi) + SLACK
    with np.errstate(over="ignore", invalid="ignore"):
        size = row_lengths * length * (1 + 1e-9)
        extra = size * 1e-9 + 1
        high = size * np.cos(np.clip(least, 0, np.pi)) + extra
        low = size * np.cos(np.clip(most, 0, np.pi)) - extra
    return low, high


def integer_scores(anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered doubles, as 64-bit integers."""
    if not len(rows):
        return np.zeros(0, np.int64)
    largest = float(np.abs(anchor).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if largest < 2.0**53:
        return (rows @ anchor).astype(np.int64)
    if largest < 2.0**62 and float(np.abs(anchor).max()) < 2.0**62 and float(np.abs(rows).max()) < 2.0**62:
        return rows.astype(np.int64) @ anchor.astype(np.int64)
    own = [int(v) for v in anchor]
    ends = np.iinfo(np.int64)
    return np.array([min(max(sum(int(a) * b for a, b in zip(row, own)), ends.min), ends.max) for row in rows], np.int64)


class _Part:
    """Rows of a group as arrays."""

    def __init__(self, part: pd.DataFrame):
        n = len(part)
        self.row, self.vec_id, self.label = (part[c].to_numpy() for c in ("row", "vec_id", "label"))
        self.vector = np.frombuffer(b"".join(part["vector"]), np.float64).reshape(n, -1)
        self.angles = np.frombuffer(b"".join(part["angles"]), np.float64).reshape(n, -1)
        self.length = part["length"].to_numpy()


def _positives(k: int, step: int = 64):
    def find(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(anchors) and len(rows):
            a, x = _Part(anchors), _Part(rows)
            for i in range(len(a.row)):
                _, high = score_bounds(a.angles[i], a.length[i], x.angles, x.length)
                high = np.where(np.isnan(high), np.inf, high)
                high[x.row == a.row[i]] = -np.inf  # itself
                order = np.argsort(-high, kind="stable")
                order = order[high[order] > -np.inf]
                ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
                low, width = 0, step
                while low < len(order) and not (len(scores) >= k and high[order[low]] < scores[-1]):
                    part = order[low : low + width]
                    ids = np.concatenate((ids, x.vec_id[part]))
                    scores = np.concatenate((scores, integer_scores(a.vector[i], x.vector[part])))
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                    low, width = low + width, width * 2
                out += [(a.row[i], v, s) for v, s in zip(ids, scores)]
        return pd.DataFrame(out, columns=["anchor", "vec_id", "score"]).astype("int64")

    return find


def _negatives(k: int, low_percent: int):
    def find(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(anchors) and len(rows):
            a, x = _Part(anchors), _Part(rows)
            for i, tops in enumerate(anchors["tops"]):
                tops = [int(t) for t in tops]
                low, high = score_bounds(a.angles[i], a.length[i], x.angles, x.length)
                meets = np.zeros(len(x.row), bool)
                for top in {t for t in tops if t >= 0}:  # below 0 a window is empty
                    # windows a little wider than they are, as bounds are floats
                    meets |= ~(high < top * (low_percent / 100) * (1 - 1e-9) - 1) & ~(low > top * (1 + 1e-9) + 1)
                near = np.flatnonzero(meets & (x.label != a.label[i]))
                scores = integer_scores(a.vector[i], x.vector[near])
                best = np.lexsort((x.vec_id[near], -scores))
                near, scores = near[best], scores[best]
                for place, top in enumerate(tops):
                    first = int(np.searchsorted(-scores, -top, "left"))
                    for j in range(first, min(first + k, len(scores))):
                        score = int(scores[j])
                        if 100 * score < low_percent * top:
                            break
                        out.append((a.row[i], place, x.vec_id[near[j]], score))
        return pd.DataFrame(out, columns=["anchor", "place", "vec_id", "score"]).astype("int64")

    return find


def _numbers(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1))


def hard_negatives(
    table: DataFrame,
    label: Column | None = None,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    scale: float = SCALE,
    references: int = REFERENCES,
    sample_rows: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per anchor (id divisible by ``every``) and positive, the first negatives of the window below the positive's score."""
    spark = table.sparkSession
    usable = clean_rows(table, F.col("label") if label is None else label, id_col, vector_col, scale)
    usable = stage(usable.withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = usable.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], _RESULT)
    usable = usable.where(F.size("vector") == sizes[0]["size"])
    # bounded by its parameter
    sample = usable.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(sample_rows).select("vector").collect()
    fitted = spark.sparkContext.broadcast(fit_references(np.array([r.vector for r in sample], np.float64).reshape(len(sample), -1), references))

    def store(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            vector = np.stack(part["vector"].to_numpy()).astype(np.float64)
            angles = angles_to(vector, fitted.value)
            yield pd.DataFrame(
                {
                    "row": part["row"],
                    "vec_id": part["vec_id"],
                    "label": part["label"],
                    "vector": [v.tobytes() for v in vector],
                    "angles": [v.tobytes() for v in angles],
                    "length": lengths_of(vector),
                    "home": angles.argmin(axis=1).astype(np.int32),
                }
            )

    stored = stage(usable.select("row", "vec_id", "label", "vector").mapInPandas(store, _STORED), "angles")
    is_anchor = F.col("vec_id") % every == 0

    # positives: blocks of one label
    shares = stored.groupBy("label").agg(
        F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.count_if(is_anchor) / block_anchors)).alias("parts"),
    )
    held = stored.join(shares, "label")
    keys = ("label", "block", "part")
    dealt = held.withColumns({"block": F.pmod(F.xxhash64("row"), F.col("blocks")), "part": _numbers(F.col("parts"))})
    asked = held.where(is_anchor).withColumns({"part": F.pmod(F.xxhash64("row"), F.col("parts")), "block": _numbers(F.col("blocks"))})
    asked = asked.toDF(*asked.columns)  # columns of its own beside those of the rows
    found = asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(_positives(positives), "anchor long, vec_id long, score long")
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    chosen = found.withColumn("place", F.row_number().over(first) - 1).where(F.col("place") < positives)
    chosen = stage(chosen, "positives")

    # negatives: blocks of one nearest reference, numbered through; one row per reference is collected
    homes = stored.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks")).orderBy("home").collect()
    parts = max(1, -(-stored.where(is_anchor).count() // block_anchors))
    total, block = 0, F.lit(None).cast("long")
    for h in homes:
        block = F.when(F.col("home") == h.home, total + F.pmod(F.xxhash64("row"), F.lit(h.blocks))).otherwise(block)
        total += h.blocks
    tops = chosen.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("tops"))
    tops = tops.withColumn("tops", F.col("tops.score"))  # as many as positives
    asked = stored.where(is_anchor).join(tops, "row")
    asked = asked.withColumns({"part": F.pmod(F.xxhash64("row"), F.lit(parts)), "block": _numbers(F.lit(total))})
    asked = asked.toDF(*asked.columns)
    dealt = stored.withColumns({"block": block, "part": _numbers(F.lit(parts))})
    found = asked.groupBy("block", "part").cogroup(dealt.groupBy("block", "part"))
    found = found.applyInPandas(_negatives(negatives, low_percent), "anchor long, place int, vec_id long, score long")
    first = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id")
    mined = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    named = chosen.select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = stored.where(is_anchor).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        mined.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        .join(named, ["anchor", "place"])
        .join(ids, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
