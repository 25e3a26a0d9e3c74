import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from helixtab.operators import edges, intervals, scoring


def test_edges(spark):
    raw = spark.createDataFrame([("A", "B", 900), ("B", "A", 800), ("A", "C", 699), ("A", "A", 950)], "p string, q string, s int")
    both = edges.directed(raw, "p", "q", "s")
    assert rows(both) == [("A", "A"), ("A", "B"), ("B", "A")]
    nodes = spark.createDataFrame([("A",), ("Z",)], "n string")
    assert rows(edges.of_sources(both, nodes, "n")) == [("A", "A"), ("A", "B")]
    one_way = spark.createDataFrame([("A", "B"), ("B", "A"), ("A", "C")], "src string, dst string")
    assert rows(edges.reciprocity(one_way)) == [("A", "B", True), ("A", "C", False), ("B", "A", True)]


@pytest.mark.parametrize("limit", ["1000000", "5"])
def test_partner_lists_in_parts(spark, limit):
    data = [("hub", f"n{i:03d}") for i in range(25)] + [("x", "y")]
    df = spark.createDataFrame(data, "src string, dst string").repartition(4)
    spark.conf.set("helixtab.maxGroupRows", limit)
    try:
        got = rows(edges.partner_lists(df, 10))
    finally:
        spark.conf.unset("helixtab.maxGroupRows")
    names = [f"n{i:03d}" for i in range(25)]
    assert got == [
        ("hub", 0, 10, ";".join(names[:10])), ("hub", 1, 10, ";".join(names[10:20])),
        ("hub", 2, 5, ";".join(names[20:])), ("x", 0, 1, "y"),
    ]


def test_method_comparison(spark):
    nodes = spark.createDataFrame([(n,) for n in "ABCDE"], "n string")
    a = spark.createDataFrame([("A", "x"), ("A", "y"), ("A", "y"), ("B", "x"), ("C", "x")], "src string, dst string")
    b = spark.createDataFrame([("A", "x"), ("A", "z"), ("B", "x"), ("D", "q")], "src string, dst string")
    got = {r.src: (r.comparison, r.jaccard) for r in edges.compare_methods(nodes, "n", a, b).collect()}
    assert got == {
        "A": ("overlapping", 1 / 3), "B": ("identical", 1.0), "C": ("one_empty", None), "D": ("one_empty", None), "E": ("both_empty", None)
    }
    arrays = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], [])], "l array<string>, r array<string>")
    got = arrays.select(edges.jaccard_of_lists(F.col("l"), F.col("r")), edges.is_subset(F.col("l"), F.col("r"))).collect()
    assert [tuple(r) for r in got] == [(1 / 3, False), (None, True)]


def test_list_checks(spark):
    nodes = spark.createDataFrame([("P12345",), ("Q99999",)], "n string")
    full = spark.createDataFrame([("P12345", "P12345"), ("P12345", "O11111"), ("P12345", "O11111")], "src string, dst string")
    inside = spark.createDataFrame([("P12345", "O11111"), ("P12345", "bad")], "src string, dst string")
    got = rows(edges.list_checks(nodes, "n", full, inside))
    assert got == [("P12345", True, True, True, True, 2, 2), ("Q99999", None, None, None, None, None, None)]


@pytest.mark.parametrize("limit", ["1000000", "5"])
def test_overlaps(spark, limit):
    rng = random.Random(2)
    data = [(rng.choice(["p", "p", "q"]), rng.choice("XY"), rng.randint(1, 60), i) for i in range(80)]
    data = [(k, f, s, s + rng.randint(0, 12), i) for k, f, s, i in data]
    df = spark.createDataFrame(data, "k string, f string, s int, e int, i int").repartition(5)
    spark.conf.set("helixtab.maxGroupRows", limit)
    try:
        out = intervals.overlaps(df, ["k"], "s", "e", ["i"], family="f").collect()
    finally:
        spark.conf.unset("helixtab.maxGroupRows")
    want = {}
    for key in "pq":
        srt = sorted([r for r in data if r[0] == key], key=lambda r: (r[2], r[4]))
        for n, r in enumerate(srt):
            prev = srt[n - 1] if n else None
            want[r[4]] = (
                bool(prev and prev[3] > r[2]), bool(prev and prev[3] >= r[2]),
                any(p[3] > r[2] for p in srt[:n]), bool(prev and prev[3] > r[2] and prev[1] != r[1]),
            )
    assert {r.i: (r.overlaps_previous, r.touches_previous, r.overlaps_earlier, r.overlaps_other_family) for r in out} == want
    # a nested interval two places on is only found by the complete mode
    nested = spark.createDataFrame([("p", 1, 100, 1), ("p", 5, 6, 2), ("p", 50, 60, 3)], "k string, s int, e int, i int")
    flags = intervals.overlaps(nested, ["k"], "s", "e", ["i"]).orderBy("i").collect()
    assert [(r.overlaps_previous, r.overlaps_earlier) for r in flags] == [(False, False), (True, True), (False, True)]


def test_signal_against_bases(spark, small_groups):
    rng = random.Random(4)
    signal, base = [], {}
    pos = 0
    while pos < 3000:
        length = rng.randint(1, 300)
        value = rng.choice([None, 0.25, 1.5, 2.0, 7.75])
        if rng.random() < 0.8:
            signal.append(("c1", pos, pos + length, value))
            for b in range(pos, pos + length):
                base[b] = value
        pos += length
    segs = [(rng.choice(["t1", "t2", "t3"]), "c1", s := rng.randint(0, 2900), s + rng.randint(0, 700), i) for i in range(12)]
    segs += [("t4", "c2", 0, 10, 99)]
    sdf = spark.createDataFrame(segs, "tx string, chrom string, start0 long, end long, i int")
    gdf = spark.createDataFrame(signal, "chrom string, start0 long, end long, value double")
    out = {r.i: r for r in intervals.segment_signal(sdf, gdf).collect()}
    for tx, chrom, s, e, i in segs:
        vs = [base[b] for b in range(s, e) if chrom == "c1" and base.get(b) is not None]
        assert (out[i].n_bases, out[i].covered) == (e - s, len(vs))
        assert out[i]["mean"] is None if not vs else abs(out[i]["mean"] - sum(vs) / len(vs)) < 1e-9
    got = {r.tx: r for r in intervals.transcript_signal(sdf, gdf, "tx", 1.6).collect()}
    for tx in {s[0] for s in segs}:
        vs = [
            base[b] for t, c, s, e, _ in segs if t == tx for b in range(s, e) if c == "c1" and base.get(b) is not None
        ]
        total = sum(e - s for t, _, s, e, _ in segs if t == tx)
        r = got[tx]
        assert (r.cds_bases, r.covered_bases) == (total, len(vs))
        if vs:
            ordered = sorted(vs)
            n = len(ordered)
            median = (ordered[(n - 1) // 2] + ordered[n // 2]) / 2
            assert (round(r["mean"], 9), r.median) == (round(sum(vs) / n, 9), median)
            assert r.frac_conserved == sum(v >= 1.6 for v in vs) / n
            assert r.coverage == n / total


@pytest.mark.parametrize("limit", ["1000000", "2"])
def test_per_base(spark, limit):
    segs = [("t1", 1, 100, 104, 1), ("t1", 2, 200, 200, 1), ("t1", 3, 300, 305, 1), ("t2", 1, 500, 503, -1), ("t2", 2, 400, 407, -1), ("t3", 1, 9, 8, 1)]
    df = spark.createDataFrame(segs, "tx string, exon_rank int, s long, e long, strand int")
    spark.conf.set("helixtab.maxGroupRows", limit)
    try:
        out = intervals.per_base(df, "tx", ["exon_rank"], "s", "e", "strand")
        got = {(r.tx, r.cds_pos): (r.genomic_pos, r.exon_rank, r.codon_number, r.codon_position) for r in out.collect()}
        edges_ = rows(intervals.boundaries(out, ["tx"], ["cds_pos"], "exon_rank").select("tx", "cds_pos"))
    finally:
        spark.conf.unset("helixtab.maxGroupRows")
    want = {}
    for tx in ("t1", "t2"):
        n = 0
        for _, rank, s, e, strand in sorted(r for r in segs if r[0] == tx):
            for g in range(s, e + 1) if strand == 1 else range(e, s - 1, -1):
                n += 1
                want[(tx, n)] = (g, rank, (n - 1) // 3 + 1, (n - 1) % 3 + 1)
    assert got == want
    assert edges_ == [("t1", 6), ("t1", 7), ("t2", 5)]


def test_per_residue_skips_missing(spark):
    df = spark.createDataFrame(
        [("t", 1, 1, 2.0), ("t", 1, 2, None), ("t", 1, 3, 9.0), ("t", 2, 1, None), ("t", 2, 2, None), ("t", 2, 3, 1.0)],
        "tx string, codon_number int, codon_position int, v double",
    )
    assert rows(intervals.per_residue(df, "tx", "v")) == [("t", 1, 5.5, 2.0), ("t", 2, 1.0, None)]


def _segments(spark):
    """Segments of 0 to 9 bases, so that codons lie in up to three of them; the rank has repeats and gaps."""
    own = random.Random(4)
    segs = []
    for tx in ("t1", "t2", "t3", None):
        for i in range(30):
            start = own.randrange(1, 400)
            segs.append((tx, i, start, start + own.choice([0, 0, 1, 2, 3, 6, 9]) - 1, own.choice([1, -1]), own.choice([1, 2, None])))
    segs.append(("t4", 0, 5, 5, 1, 1))
    return spark.createDataFrame(segs, "tx string, i int, s long, e long, strand int, rank int")


@pytest.mark.parametrize("limit", ["1000000", "2"])
def test_codons_and_edges_from_segments(spark, limit):
    """The same codons and edges as from bases."""
    df = _segments(spark)
    value = lambda place, position: F.when(place % 5 > 0, place * 0.1 + position / 7)
    spark.conf.set("helixtab.maxGroupRows", limit)
    try:
        bases = intervals.per_base(df, "tx", ["i"], "s", "e", "strand")
        valued = bases.withColumn("v", value(F.col("genomic_pos"), F.col("codon_position")))
        want = rows(intervals.per_residue(valued, "tx", "v"))
        got = rows(intervals.segment_residues(df, "tx", ["i"], "s", "e", "strand", value))
        edges_ = rows(intervals.boundaries(bases, ["tx"], ["cds_pos"], "rank").select("tx", "i", "cds_pos"))
        from_segments = rows(intervals.segment_boundaries(df, "tx", ["i"], "s", "e", "rank").select("tx", "i", "cds_pos"))
    finally:
        spark.conf.unset("helixtab.maxGroupRows")
    assert got == want and len(want) > 50
    assert from_segments == edges_ and len(edges_) > 10


def _plan(spark, name):
    from __spark_entry__ import queries

    return queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="tables are not here")
def test_rows_per_base_are_not_sorted_or_grouped(spark):
    assert "_k" not in _plan(spark, "per_residue").replace("_keys", "")
    assert "Generate" not in _plan(spark, "boundaries")
    assert "decimal" not in _plan(spark, "codon_positions")


def test_intervals_of_all_lengths_meet(spark):
    """Against all pairs: single bases, spans at bin edges, whole contigs, empty and repeated spans."""
    own = random.Random(9)
    lengths = [0, 1, 1, 2, 255, 256, 257, 1024, 5000, 70_000, 10**6, 10**9]

    def some(n):
        out = []
        for _ in range(n):
            length = own.choice(lengths)
            start = own.choice([0, 255, 256, 1023, 1024, own.randrange(10**6), own.randrange(10**9)])
            out.append((own.choice("ab"), start, start + length))
        return out

    left, right = some(150), [*some(150), ("a", 256, 512), ("a", 256, 512)]
    one = spark.createDataFrame([(k, *x) for k, x in enumerate(left)], "i int, c string, s long, e long")
    other = spark.createDataFrame([(k, *x) for k, x in enumerate(right)], "j int, c string, x long, y long")
    got = rows(intervals.meeting(one, other, ["c"], ("s", "e"), ("x", "y")).select("i", "j"))
    want = [(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if a[0] == b[0] and max(a[1], b[1]) < min(a[2], b[2])]
    assert got == sorted(want, key=repr) and len(want) > 2000


def test_long_spans_have_few_rows(spark):
    long = spark.createDataFrame([(5, 5 + 10**9), (0, 3 * 10**9), (7, 8)], "s long, e long")
    levels = list(range(intervals.LEVELS + 1))
    own = intervals._level(F.col("s"), F.col("e"))
    touched = long.withColumn("own", own).select("s", intervals._touched(F.col("s"), F.col("e"), F.col("own"), levels))
    assert all(r["count"] <= 30 for r in touched.groupBy("s").count().collect())


def test_points_in_spans(spark):
    pts = spark.createDataFrame([("p", i) for i in range(1, 600)], "k string, pos long")
    spans = spark.createDataFrame([("p", "a", 250, 260), ("p", "b", 255, 520), ("q", "c", 1, 9)], "k string, n string, s long, e long")
    got = rows(intervals.points_in_spans(pts, spans, "k", "pos", "s", "e").groupBy("n").count())
    assert got == [("a", 11), ("b", 266)]


def test_scoring_keeps_every_id(spark):
    class Fussy:
        """Fails on any batch that holds a Z, and always on ZZ."""

        def __call__(self, seqs):
            if len(seqs) > 1 and any("Z" in s for s in seqs) or "ZZ" in seqs:
                raise RuntimeError("out of memory")
            return [[float(len(s)), float(s.count("A"))] for s in seqs]

    data = [(1, "AAK"), (2, "AAK"), (3, "Z"), (4, "ZZ"), (5, "A" * 50), (6, None), (7, "")]
    df = spark.createDataFrame(data, "id int, s string")
    out = scoring.score_sequences(df, "id", "s", Fussy(), ["n", "a"], max_len=20, partitions=2)
    assert rows(out) == sorted(
        [
            (1, 3.0, 2.0, "scored"), (2, 3.0, 2.0, "scored"), (3, 1.0, 0.0, "scored"), (4, None, None, "failed"),
            (5, None, None, "too_long"), (6, None, None, "no_sequence"), (7, 0.0, 0.0, "scored"),
        ],
        key=repr,
    )
    assert [scoring.batch_size(n) for n in (10, 1000, 1001, 2000, 2001)] == [8, 8, 4, 4, 2]


def test_shared_runs(spark):
    texts = {1: "a b c d e f g", 2: "x a b c d e y", 3: "a b c d", 4: None, 5: "a b c d e f g", 6: "b  c\td e\nf a b c d e f"}
    df = spark.createDataFrame(list(texts.items()), "i int, text string")

    def runs(text):
        words = (text or "").split()
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    want = {(i, j): len(runs(a) & runs(b)) / len(runs(a)) for i, a in texts.items() for j, b in texts.items() if runs(a) & runs(b)}
    got = scoring.shared_runs(df, df.withColumnRenamed("i", "j"), "i", "j").collect()
    assert {(r.i, r.j): r.matching_share for r in got} == want and len(want) == len(got) == 16


def test_shared_runs_of_repeated_keys(spark):
    """Runs count once per key; the longer table isn't moved to a short one."""
    items = spark.createDataFrame([(1, "a b c d e f"), (1, "b c d e f g")], "i int, text string")
    docs = spark.createDataFrame([(7, "a b c d e f a b c d e"), (7, "a b c d e"), (8, "b c d e f"), (9, "a b c d")], "j int, text string")
    out = scoring.shared_runs(items, docs, "i", "j")
    assert rows(out) == [(1, 7, 2 / 3), (1, 8, 1 / 3)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not [line for line in plan.splitlines() if "Exchange" in line and "run#" in line]
