"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``.  All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtab.llm import exactdup, mixing, neardup, packing, toxicity
from helixtab.llm.common import new_folder, read_table, stage_texts, unused_name

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on ``labels``, doesn't call toxic."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest id."""
    return exactdup.drop_copies(docs, keep_largest=True)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return neardup.drop_near_copies(docs, width=5)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights take them."""
    columns = docs.columns
    domain, counted, tokens, copies = (unused_name(columns, f"__{x}") for x in ("domain", "counted", "tokens", "copies"))
    wide = mixing.with_domain(docs, name=domain).withColumn(counted, mixing.token_count(F.col("text")))
    wide = stage_texts(wide, "counted")
    tree = (domain, "lang", "source")
    weights = {domain: mixing.WEIGHTS["domain"], "lang": mixing.WEIGHTS["lang"], "source": mixing.WEIGHTS["source"]}
    chosen = mixing.mix(wide, F.col(counted), tree=tree, weights=weights, tokens_name=tokens, copies_name=copies)
    return mixing.repeated(chosen, columns, copies)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 2048 ids."""
    return packing.place_pieces(packing.cut_pieces(docs, capacity=2048, end_id=0), capacity=2048).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: Signatures, a fitted classifier and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        path = new_folder(spark, name.replace(" ", "-"))
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
