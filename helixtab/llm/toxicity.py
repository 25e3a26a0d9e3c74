"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other.  A category's model is a ridge logistic regression
over the presence of words and word beginnings, and over the probabilities of all categories before
it.  While training, those earlier probabilities are out-of-fold predictions, so that a later model
learns from what the earlier ones will say about texts they haven't seen; for scoring, each model is
fitted on all of the sample.

The models are fitted on a sample of at most ``sample_rows`` labelled documents (lowest hashes of
their ids); everything fitted stays bounded by it.  Scoring reads whole texts of all documents.

Defined results: a null or empty text has no features and gets the score that the models give to it;
labels that are null are left out, the largest of repeated labels counts; without labelled documents
of both kinds a category's probability is its share among the labelled (0 without any); repeated rows are scored
each; other columns, whatever their names, are carried along.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, stage, unused_name

SAMPLE_ROWS = 8000
FEATURES = 160
FOLDS = 3
WORD = re.compile(r"[^\W\d_]+|[^\w\s]+")
BEGINNINGS = range(3, 9)
LEAST_COUNT = 4
MOST_KEPT = 300_000
LONGEST_WORD = 40
THRESHOLD = 0.5


def word_features(word: str) -> list[str]:
    """A word and its beginnings; beginnings end with a blank, so no word equals one."""
    return [word[:LONGEST_WORD], *[word[:k] + " " for k in BEGINNINGS if k < len(word)]]


def text_features(text: str | None) -> set[str]:
    out: set[str] = set()
    for word in set(WORD.findall((text or "").lower())):
        out.update(word_features(word))
    return out


@dataclass
class Link:
    """One category: its features, and weights for them, for the earlier probabilities and a constant."""

    category: str
    features: list[str]
    weights: np.ndarray

    def probability(self, present: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return _sigmoid(np.hstack([present, earlier, np.ones((len(present), 1))]) @ self.weights)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 12) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's steps; the last column, a constant, is free."""
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.0, 1e-9, 1 - 1e-9)
        w[-1] = np.log(share / (1 - share))
        return w
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-5:
            break
    return w


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    categories: Mapping[str, Column],
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """At most ``sample_rows`` rows: text and one 0/1 column per category."""
    known = labels.select(F.col(id_col).alias("__id"), *[c.cast("int").alias(f"__y_{n}") for n, c in categories.items()])
    known = known.dropna().groupBy("__id").agg(*[F.max(f"__y_{n}").alias(f"__y_{n}") for n in categories])
    picked = known.orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
    # the sample is bounded by its parameter; a repeated id is one row of it, with the first of its texts in order
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    marks = [f"__y_{n}" for n in categories]
    return texts.join(F.broadcast(picked), "__id").groupBy("__id", *marks).agg(F.min("__text").alias("__text")).select("__id", "__text", *marks)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of a task have each feature, and how many of them are positive by category."""
    for batch in batches:
        marks = [batch.column(k).to_pylist() for k in range(1, batch.num_columns)]
        total: Counter = Counter()
        positive: list[Counter] = [Counter() for _ in marks]
        for row, text in enumerate(batch.column(0).to_pylist()):
            features = text_features(text)
            total.update(features)
            for counter, mark in zip(positive, marks):
                if mark[row]:
                    counter.update(features)
        names = list(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([total[x] for x in names], pa.int64()),
                pa.array([[c[x] for c in positive] for x in names], pa.list_(pa.int64())),
            ],
            names=["feature", "n", "positive"],
        )


def choose_features(sample: DataFrame, names: Sequence[str], most: int = FEATURES) -> list[list[str]]:
    """Per category, the features whose presence tells most about it (signed root of the log-likelihood ratio)."""
    counts = sample.select("__text", *[f"__y_{n}" for n in names]).mapInArrow(
        _count_features, "feature string, n long, positive array<long>"
    )
    counts = counts.groupBy("feature").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("positive")[k]).alias(f"p{k}") for k in range(len(names))]
    ).where(F.col("n") >= LEAST_COUNT)
    sizes = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"__y_{n}").alias(f"p{k}") for k, n in enumerate(names)]).first()
    counts = stage(counts, "features")
    out = []
    for k in range(len(names)):
        share = min(max((sizes[f"p{k}"] or 0) / max(sizes["n"], 1), 1e-9), 1 - 1e-9)
        n, p = F.col("n").cast("double"), F.col(f"p{k}").cast("double")

        def part(seen: Column, expected: Column) -> Column:
            return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

        gain = part(p, n * share) + part(n - p, n * (1 - share))
        top = counts.select("feature", gain.alias("gain")).orderBy(F.desc("gain"), "feature").limit(most)
        out.append([r.feature for r in top.collect()])
    discard(counts)
    return out


def _presence(features: Sequence[str]):
    place = {f: k for k, f in enumerate(features)}

    def row(text: str | None) -> bytes:
        mark = np.zeros(len(place), np.uint8)
        mark[[place[f] for f in text_features(text) if f in place]] = 1
        return np.packbits(mark).tobytes()

    return row


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Mapping[str, Column],
    sample_rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
    folds: int = FOLDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> list[Link]:
    """The chain for ``categories`` (name to a 0/1 expression over ``labels``), in their order."""
    names = list(categories)
    sample = stage(labelled_sample(docs, labels, categories, sample_rows, id_col, text_col), "labelled")
    chosen = choose_features(sample, names, features)
    union = sorted({f for x in chosen for f in x})
    mark = F.udf(_presence(union), T.BinaryType())
    # rows of a bounded sample: a bit per chosen feature, and the labels
    rows = sample.select("__id", mark("__text").alias("bits"), *[f"__y_{n}" for n in names]).orderBy(
        F.xxhash64("__id"), "__id"
    ).collect()
    bits = np.array([np.unpackbits(np.frombuffer(r.bits, np.uint8), count=len(union)) for r in rows], float)
    bits = bits.reshape(len(rows), len(union))
    discard(sample)
    at = {f: k for k, f in enumerate(union)}
    fold = np.arange(len(rows)) % folds
    earlier = np.zeros((len(rows), 0))
    chain = []
    for name, own in zip(names, chosen):
        y = np.array([r[f"__y_{name}"] for r in rows], float)
        x = np.hstack([bits[:, [at[f] for f in own]], earlier, np.ones((len(rows), 1))])
        unseen = np.zeros(len(rows))
        for k in range(folds):
            there = fold != k
            unseen[~there] = _sigmoid(x[~there] @ fit_logistic(x[there], y[there]))
        chain.append(Link(name, own, fit_logistic(x, y)))
        earlier = np.hstack([earlier, unseen[:, None]])
    return chain


def score_texts(texts: Sequence[str | None], chain: Sequence[Link], known: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Probabilities, one column per category.  ``known`` keeps the chosen features of words met."""
    union = sorted({f for link in chain for f in link.features})
    at = {f: k for k, f in enumerate(union)}
    present = np.zeros((len(texts), len(union)))
    for row, text in enumerate(texts):
        hits: set[int] = set()
        for word in set(WORD.findall((text or "").lower())):
            own = known.get(word)
            if own is None:
                own = tuple(at[f] for f in word_features(word) if f in at)
                if len(known) < MOST_KEPT and len(word) <= LONGEST_WORD:
                    known[word] = own
            hits.update(own)
        present[row, list(hits)] = 1
    earlier = np.zeros((len(texts), 0))
    for link in chain:
        p = link.probability(present[:, [at[f] for f in link.features]], earlier)
        earlier = np.hstack([earlier, p[:, None]])
    return earlier


def score(docs: DataFrame, chain: Sequence[Link], text_col: str = "text", name: str = "scores") -> DataFrame:
    """``docs`` with the struct column ``name``: one probability per category."""
    table = docs.sparkSession.sparkContext.broadcast(list(chain))  # bounded: features per category
    fields = ", ".join(f"`{link.category}` double" for link in chain)
    names = [link.category for link in chain]

    @F.pandas_udf(fields)
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[int, ...]] = {}
        for texts in parts:
            yield pd.DataFrame(score_texts(list(texts), table.value, known), columns=names).round(9)

    return docs.withColumn(name, scored(F.col(text_col)))


def label_categories() -> dict[str, Column]:
    """The categories that ``labels`` knows, in the order of the chain."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents whose toxicity reaches the threshold."""
    chain = fit_chain(docs, labels, label_categories())
    name = unused_name(docs.columns, "__scores")
    return score(docs, chain, name=name).where(F.col(f"{name}.toxic") < threshold).drop(name)
