"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helixtab.plans import QUERIES  # noqa: E402
from helixtab.workspace import build_session  # noqa: E402

HEADLINE = [
    "wt_mut_delta",
    "top_movers",
    "delta_by_group",
    "substitution_matrix",
    "key_audit",
    "mapping_cardinality",
    "entity_rollup",
    "distinct_variants",
    "inflation_audit",
    "exploded_frequency",
    "first_wins",
    "longest_per_group",
    "transcript_select",
    "percentile_tier",
    "rolling_mean",
    "rank_stats",
    "enrich_multi",
    "fourway_merge",
    "bridge_filter",
    "composite_key_match",
    "synonym_resolve",
    "product_join",
    "reject_reasons",
    "codon_translate",
    "notation_classify",
    "mutant_build",
    "point_mutation_scan",
    "motif_disruption",
    "edge_build",
    "partner_lists",
    "jaccard_methods",
    "segment_signal",
    "transcript_signal",
    "codon_positions",
    "interval_overlap",
    "column_profile",
    "machine_flags",
    "gap_fill",
    "table_diff",
    "batch_score",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("HELIXTAB_SHUFFLE", cores)
    spark = build_session("bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # start the JVM, its code generator and the Python workers before timing
    for name in ("value_distribution", "wt_mut_delta"):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
