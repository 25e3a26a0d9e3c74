"""Time operators at the row counts the published timings are given for.

The rows are copies of the given lineitem table with shifted keys, written once to a folder.

usage: python tools/scale.py <folder> [fraction of the published row counts]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from helixtab.operators import edges, joins, rollup  # noqa: E402
from helixtab.workspace import build_session  # noqa: E402

SOURCE = "/root/testdata/sf0.1/lineitem.parquet"
PUBLISHED = {
    "entity_rollup": (62_770_000, 20 * 60.0),
    "mapping_cardinality": (114_900_000, 72 * 60.0),
    "edge_scan": (10_800_000, 11.0),
    "merge_four_tables": (31_525_484, None),
    "grouped_deltas": (31_525_484, None),
}


def main() -> None:
    folder, fraction = sys.argv[1], float(sys.argv[2]) if len(sys.argv) > 2 else 1.0
    spark = build_session("scale", 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    base = spark.read.parquet(SOURCE)
    n_base = base.count()

    def table(rows: int):
        path = f"{folder}/lines-{rows}"
        if not os.path.isdir(path):
            copies = -(-rows // n_base)
            r = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("r")
            big = base.repartition(16).select("*", r).withColumns(
                {
                    "l_orderkey": F.col("l_orderkey") + F.col("r") * 1_000_000,
                    "l_partkey": F.col("l_partkey") + F.col("r") % 7 * 20_000,
                    "row_id": F.col("r") * n_base + F.pmod(F.xxhash64("l_orderkey", "l_extendedprice"), F.lit(n_base)),
                }
            )
            big.write.parquet(path)
        return spark.read.parquet(path)

    def entity_rollup(t):
        return rollup.entity_rollup(
            t, "l_partkey", {"mutations": "l_orderkey", "samples": "l_suppkey"},
            {
                "confirmed": F.col("l_returnflag") == "R",
                "missense": F.col("l_linestatus").contains("O"),
                "truncating": F.col("l_returnflag").contains("A") | F.col("l_linestatus").contains("F"),
            },
        )

    def mapping_cardinality(t):
        return rollup.mapping_cardinality(t, "l_partkey", "l_suppkey")

    def edge_scan(t):
        return edges.directed(t, "l_partkey", "l_suppkey", "l_quantity", 35)

    def merge_four_tables(t):
        keyed = t.dropDuplicates(["row_id"])
        parts = [keyed.select("row_id", c) for c in ("l_quantity", "l_tax", "l_discount")]
        flags = t.where("l_returnflag = 'R'").select("row_id", "l_linestatus", "l_tax")
        packed = rollup.packed_summary(flags, "row_id", "l_linestatus", F.col("l_tax") > 0.04)
        return joins.merge_tables(parts, "row_id", [packed])

    def grouped_deltas(t):
        delta = F.abs(F.col("l_discount") - F.col("l_tax"))
        measures = {"mean_delta": F.avg(delta), "frac": F.avg((delta > 0.03).cast("int"))}
        groups = [["l_linenumber"], ["l_returnflag"], ["l_linenumber", "l_returnflag"], ["l_partkey"]]
        return rollup.grouped_means(t, groups, measures)

    out = {}
    for name, fn in list(locals().items()):
        if name not in PUBLISHED:
            continue
        rows, seconds = PUBLISHED[name]
        t = table(int(rows * fraction))
        start = time.perf_counter()
        fn(t).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        n = t.count()
        out[name] = {
            "rows": n,
            "seconds": round(took, 1),
            "rows_per_second": round(n / took),
            "published_rows_per_second": round(rows / seconds) if seconds else None,
        }
        print(name, out[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
