"""Queries on tables in which one key holds a third of the rows, with every larger key split."""

import os

import pytest
from oracle import check, connect
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")

# table, row key, columns that get one value in a third of the rows
HOT = {
    "lineitem": ("l_extendedprice", ["l_orderkey", "l_partkey", "l_suppkey"]),
    "orders": ("o_orderkey", ["o_custkey"]),
    "events": ("event_id", ["user_id", "event_type"]),
    "documents": ("doc_id", ["source"]),
    "embeddings": ("vec_id", ["label"]),
    "part": ("p_partkey", ["p_brand"]),
}
NAMES = [
    "wt_mut_delta", "delta_by_group", "key_audit", "mapping_cardinality", "entity_rollup", "dup_rows_agree",
    "group_members_agree", "inflation_audit", "first_wins", "last_wins", "longest_per_group", "transcript_select",
    "best_per_group", "tagged_pick", "percentile_tier", "rolling_mean", "rank_stats", "rank_sum_test",
    "chunk_numbering", "systematic_sample", "enrich_left", "enrich_multi", "expand_join", "product_join",
    "fourway_merge", "bridge_filter", "exploded_key_join", "synonym_resolve", "composite_key_match", "alias_rewrite",
    "id_bridge", "exact_match_pick", "notation_classify", "mutant_outcomes", "edge_build", "partner_lists",
    "reciprocity", "jaccard_methods", "partner_distribution", "segment_signal", "transcript_signal",
    "codon_positions", "boundaries", "interval_overlap", "column_profile", "rate_by_group", "bucketed_distributions",
    "having_filters", "strong_ranks", "chunk_check", "table_diff", "packed_columns", "batch_score", "positional_pairing",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("skewed")
    for path in os.listdir(FOLDER):
        name = path[: -len(".parquet")]
        df = spark.read.parquet(f"{FOLDER}/{path}")
        if name in HOT:
            key, columns = HOT[name]
            hot = F.pmod(F.xxhash64(key), F.lit(3)) == 0
            for c in columns:
                value = {"event_type": F.lit("view"), "source": F.lit("src1"), "p_brand": F.lit("Brand#1")}.get(c, F.lit(3))
                df = df.withColumn(c, F.when(hot, value.cast(df.schema[c].dataType)).otherwise(F.col(c)))
        df.write.parquet(f"{base}/{path}")
    return str(base)


@pytest.fixture(scope="module")
def con(skewed):
    return connect(skewed)


@pytest.fixture
def split(spark):
    spark.conf.set("helixtab.maxGroupRows", "60")
    yield
    spark.conf.unset("helixtab.maxGroupRows")


@pytest.mark.parametrize("name", NAMES)
def test_query_with_a_hot_key(spark, con, skewed, split, name):
    check(spark, con, skewed, queries()[name], oracle_sql()[name])
