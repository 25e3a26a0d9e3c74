import pytest
from conftest import rows
from pyspark.sql import functions as F

from helixtab.operators import filters, joins, select, sets, skew
from helixtab.operators.quality import QualityError


def test_first_last_longest(spark):
    df = spark.createDataFrame(
        [("a", 2, "xx"), ("a", 1, "y"), ("a", 3, "zz"), ("b", 4, ""), (None, 5, "long"), ("", 6, "longer")],
        "k string, ord int, t string",
    )
    assert rows(select.first_wins(df.where("k in ('a','b')"), "k", "ord")) == [("a", 1, "y"), ("b", 4, "")]
    assert rows(select.last_wins(df.where("k in ('a','b')"), "k", "ord")) == [("a", 3, "zz"), ("b", 4, "")]
    assert rows(select.longest(df, "k", "t", "ord")) == [("a", 2, "xx"), ("b", 4, "")]


def test_first_values_may_mix_rows(spark):
    df = spark.createDataFrame([("g", 1, None, "p"), ("g", 2, "q", None), ("g", 3, "r", "s")], "k string, o int, a string, b string")
    assert rows(select.first_values(df, "k", ["a", "b"], F.col("o"))) == [("g", "q", "p")]
    assert rows(select.best_row(df, "k", [F.col("o").asc()], "n")) == [("g", 1, None, "p", 3)]


def test_transcript_and_tag_choice(spark):
    c = spark.createDataFrame(
        [("g", "t2", False, False, True, 90), ("g", "t1", False, False, True, 90), ("g", "t3", False, False, False, 300),
         ("h", "t4", True, False, False, 30), ("h", "t5", False, True, True, 60)],
        "gene string, tx string, fits boolean, mane boolean, canon boolean, len int",
    )
    out = select.transcript_choice(c, "gene", "tx", "fits", "mane", "canon", "len")
    assert rows(out.select("gene", "tx", "selection_rule", "n_candidate_transcripts")) == [
        ("g", "t1", "Ensembl_canonical", 3), ("h", "t4", "longest_CDS", 2)
    ]
    refs = spark.createDataFrame(
        [("P1", "x", "P1-2", 1), ("P1", "y", "P1-1", 2), ("P2", "z", "P2-3", 1), ("P2", "w", "P2-4", 2), ("P3", "v", None, 1)],
        "acc string, enst string, iso string, ord int",
    )
    owners = spark.createDataFrame([(p,) for p in ("P1", "P2", "P3", "P4")], "acc string")
    got = select.tagged_choice(owners, refs, "acc", "enst", "iso", "ord")
    assert rows(got) == [
        ("P1", "y", "canonical_isoform_match"), ("P2", "z", "fallback_no_canonical_tag"),
        ("P3", "v", "canonical_isoform_match"), ("P4", None, "no_ensembl_xref"),
    ]


def test_top_per_metric_drops_nulls(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 3.0, 2.0), ("c", 2.0, 2.0)], "id string, m double, n double")
    got = rows(select.top_per_metric(df, ["id"], ["m", "n"], 2))
    assert got == [("b", "m", 3.0, 1), ("b", "n", 2.0, 1), ("c", "m", 2.0, 2), ("c", "n", 2.0, 2)]


def test_first_rows_limits_before_the_shuffle(spark):
    plan = select.first_rows(spark.range(100).withColumn("k", F.col("id") % 3), "k", [F.col("id").asc()], 2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_enrich(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    right = spark.createDataFrame([(2, "x", 5)], "k int, t string, n int")
    got = joins.enrich(left, right, "k", matched="hit")
    assert rows(got) == [(1, "a", "", None, False), (2, "b", "x", 5, True), (2, "c", "x", 5, True)]
    with pytest.raises(QualityError):
        joins.enrich(left, spark.createDataFrame([(1, "z")], "k int, v string"), "k")
    with pytest.raises(QualityError):
        joins.enrich(left, right.union(right), "k", verify_unique=True)
    other = spark.createDataFrame([(1, "z")], "k int, v string")
    assert rows(joins.enrich(left, other, "k", on_clash="overwrite", blanks=False).where("k = 1")) == [(1, "z")]
    assert rows(joins.enrich(left, other, "k", on_clash="skip")) == rows(left)


def test_product_profile_equals_product(spark):
    left = spark.createDataFrame([("h", i % 2) for i in range(30)] + [("a", 0), ("z", 1)], "k string, l int")
    right = spark.createDataFrame([("h", i % 3) for i in range(20)] + [("a", 1)], "k string, r int")
    want = joins.expand(left, right, "k").groupBy("l", "r").count()
    assert rows(joins.product_profile(left, right, "k", ["l"], ["r"])) == rows(want)
    for how in ("inner", "left"):
        assert rows(skew.salted_join(left, right, "k", how, salts=4).select("k", "l", "r")) == rows(
            left.join(right, "k", how).select("k", "l", "r")
        )
    assert rows(skew.heavy_keys(left, "k", 0.2)) == [("h",)]


def test_wild_type_pairs(spark):
    v = spark.createDataFrame([("m1", "w1"), ("m2", "w9"), ("m9", "w1")], "mut string, acc string")
    s = spark.createDataFrame([("w1", "0.5"), ("m1", "NA"), ("m2", "1")], "id string, a string")
    got = joins.pair_with_wild_type(v, s, "acc", "mut", "id", ["a"])
    assert rows(got.select("mut", "WT_a", "MUT_a", "pair_status")) == [
        ("m1", "0.5", "NA", "paired"), ("m2", None, "1", "missing_wt"), ("m9", "0.5", None, "missing_mut")
    ]
    raw = spark.createDataFrame([("1", "OOM"), ("NA", "2"), ("3", "4"), ("", "1")], "a string, b string")
    assert rows(joins.numeric_scores(raw, ["a", "b"])) == sorted(
        [(1.0, None, "out_of_memory"), (None, 2.0, "too_long"), (3.0, 4.0, "scored"), (None, 1.0, "blank")], key=repr
    )


def test_resolution(spark):
    t = spark.createDataFrame(
        [(1, "G1", "A", "B;C", "D"), (2, "G2", "B", "", "A"), (3, "", "Z", "", ""), (4, "G4", "Z", None, "C")],
        "ord int, sym string, p string, sec string, can string",
    )
    assert rows(joins.synonym_table(t, "sym", "p", ["sec", "can"], "ord")) == [
        ("A", "G1"), ("B", "G1"), ("C", "G1"), ("D", "G1"), ("Z", "G4")
    ]
    left = spark.createDataFrame([("a1", "s1"), ("a2", "s2"), ("a3", "s3")], "acc string, sym string")
    right = spark.createDataFrame([("a1", "q", 1), ("b", "s2", 2), ("c", "s2", 3)], "ra string, rs string, v int")
    got = joins.fallback_join(left, right, ("acc", "ra"), ("sym", "rs"))
    assert rows(got.select("acc", "v", "match_type")) == sorted(
        [("a1", 1, "uniprot"), ("a2", 2, "symbol"), ("a2", 3, "symbol"), ("a3", None, "none")], key=repr
    )
    names = spark.createDataFrame([("a1", "S1"), ("a2", "s2")], "acc string, official string")
    assert rows(joins.rewrite_alias(left, names, "acc", "sym", "official")) == [
        ("a1", "S1", "fixed"), ("a2", "s2", "ok"), ("a3", "s3", "unmapped")
    ]
    old = spark.createDataFrame([("a1", "n1")], "o string, n string")
    assert [r.acc_resolved for r in joins.canonical_id(left, "acc", old, "o", "n").orderBy("acc").collect()] == ["n1", "a2", "a3"]


def test_exact_product_takes_first(spark):
    r = spark.createDataFrame([(1, "g", "MK"), (2, "g", "MX"), (3, "h", "MK")], "id int, g string, p string")
    p = spark.createDataFrame([("t2", "g", "MK", 2), ("t1", "g", "MK", 5), ("t3", "g", "", 1)], "tx string, g string, p string, o int")
    got = joins.exact_product(r, p, "g", "p", "tx", "o")
    assert rows(got.select("id", "tx", "method")) == [(1, "t2", "exact_translation_match"), (2, None, "no_match"), (3, None, "no_match")]


def test_fill_and_alternates(spark):
    df = spark.createDataFrame([(1, ""), (2, "kept"), (3, None)], "k int, v string")
    look = spark.createDataFrame([(1, "n1"), (2, "n2")], "k int, s string")
    assert rows(joins.backfill(df, look, "k", "v", "s")) == sorted([(1, "n1"), (2, "kept"), (3, None)], key=repr)
    alt = spark.createDataFrame([(1, ["x", "b", "a"]), (2, ["x"]), (3, [])], "k int, alts array<string>")
    known = spark.createDataFrame([("a", "A"), ("b", "B")], "alt string, val string")
    got = joins.first_alternate(alt, "k", "alts", known, "alt", "val")
    assert rows(got.select("k", "alt", "val", "alternate_status")) == [
        (1, "b", "B", "alternate_after_retired_id"), (2, None, None, "unrecoverable"), (3, None, None, "unrecoverable")
    ]


def test_lists(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "id string")
    b = spark.createDataFrame([("y",), ("z",)], "id string")
    assert rows(sets.union_ids([a, b])) == [("x",), ("y",), ("z",)]
    assert rows(sets.difference(a, b)) == [("x",)]
    assert rows(sets.intersection(a, b)) == [("y",)]
    assert rows(sets.keep_existing(b, a, "id")) == [("x",), ("y",), ("z",)]
    assert tuple(sets.overlap_report(a, b, "id").first()) == (2, 2, 1, 1, 1)
    theirs = spark.createDataFrame([("o1",), ("n1",), ("u1",), ("x",)], "sym string")
    ours = spark.createDataFrame([("x",), ("cur",)], "sym string")
    res = spark.createDataFrame([("o1", "cur"), ("n1", "fresh")], "sym string, cur string")
    got = joins.reconcile_lists(theirs, ours, res, "sym", "cur").select("sym", "list_status")
    assert rows(got) == [("n1", "new"), ("o1", "already_covered"), ("u1", "unresolved")]


def test_pairing_checks_length(spark):
    a = spark.createDataFrame([(2, "b"), (1, "a")], "i int, x string")
    b = spark.createDataFrame([(10, "p"), (20, "q")], "j int, y string")
    assert rows(joins.attach_by_position(a, b, "i", "j").select("x", "y")) == [("a", "p"), ("b", "q")]
    with pytest.raises(ValueError):
        joins.attach_by_position(a, b.limit(1), "i", "j")


def test_filters(spark):
    v = spark.createDataFrame(
        [("1", "5"), ("MT", "7"), ("Un", "5"), ("X", "na"), ("2", "0"), ("3", "-4"), (None, "1")], "c string, p string"
    )
    got = [tuple(r) for r in v.select(filters.variant_reason(F.col("c"), F.col("p")), filters.contig_name(F.col("c"))).collect()]
    assert [r[0] for r in got] == ["usable", "usable", "unplaced", "bad_position", "bad_position", "bad_position", "unplaced"]
    assert got[1][1] == "chrM"
    w = spark.createDataFrame([("7:1-2", "A", "G"), ("7:1-2", "-", "G"), ("99:1-2", "A", "G"), ("x", "A", "G")], "t string, r string, a string")
    assert [r[0] for r in w.select(filters.coordinate_reason(F.col("t"), F.col("r"), F.col("a"))).collect()] == [
        "usable", "bad_allele", "no_position", "no_position"
    ]
    df = spark.createDataFrame([(1, "old")], "k int, flag string")
    once = filters.replace_columns(df, ["flag"], {"flag": F.lit("Y")})
    assert once.columns == ["k", "flag"] == filters.replace_columns(once, ["flag"], {"flag": F.lit("Y")}).columns
    assert filters.prefix_columns(df, "wt_", ["k"]).columns == ["k", "wt_flag"]
    heads = ["Mouse gene stable ID", "Mouse homology type", "%id. target Mouse gene identical to query gene", "%id. query gene identical to target Mouse gene"]
    o = spark.createDataFrame([("g", "h", "1", "2")], heads)
    assert filters.canonical_headers(o, filters.ORTHOLOGY_HEADERS).columns == ["gene", "orthology_type", "pid_target", "pid_query"]
    with pytest.raises(ValueError):
        filters.canonical_headers(df, filters.ORTHOLOGY_HEADERS)
    clean, bad = filters.split_quarantine(df, F.col("flag") == "old")
    assert (clean.count(), bad.count()) == (0, 1)
