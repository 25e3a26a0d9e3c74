import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from helixtab.functions import rules
from helixtab.operators import profile, quality, rollup


def test_key_audit_and_groups(spark):
    df = spark.createDataFrame(
        [("P1", "u1", "1"), ("P1", "u2", "True"), ("P2", "u2", "no"), ("", "u3", "1"), (None, "u4", "1")],
        "uid string, uniq string, dom string",
    )
    assert rows(rollup.key_audit(df, ["uid", "uniq"])) == [("uid", 5, 2, 2, 1, 2), ("uniq", 5, 0, 4, 1, 2)]
    groups = rollup.flagged_groups(df.where("uid <> ''"), "uid", F.col("dom").isin("1", "True"))
    assert rows(groups) == [("P1", 2, 2), ("P2", 1, 0)]
    assert rows(rollup.group_size_histogram(groups.where("n_flagged = 0"))) == [(1, 1)]
    assert rows(rollup.distinct_composites(df, ["uid", "uniq"], "n")) == [(4,)]


def test_rollup_ignores_empty_ids(spark):
    df = spark.createDataFrame(
        [("g", "m1", "missense_variant"), ("g", "m1", "stop_gained"), ("g", "", "frameshift"), ("", "m9", "x")],
        "gene string, mut string, d string",
    )
    d = F.col("d")
    got = rollup.entity_rollup(
        df, "gene", {"n_mut": "mut"},
        {"mis": d.contains("missense_variant"), "trunc": d.contains("stop_gained") | d.contains("frameshift")},
    )
    assert rows(got) == [("g", 3, 1, 1, 2)]


def test_inflation_and_cardinality(spark):
    df = spark.createDataFrame([("p", 1, 5.0), ("p", 2, 5.0), ("q", 3, 1.0)], "id string, ord int, v double")
    assert rows(rollup.inflation(df, "id", ["ord"], ["v"])) == [("deduplicated", 2, 6.0), ("naive", 3, 11.0)]
    m = spark.createDataFrame([("s", "e1"), ("s", "e2"), ("t", "e2"), ("", "e3"), ("u", None)], "sym string, ens string")
    assert rows(rollup.mapping_cardinality(m, "sym", "ens")) == [("ens->sym", 2, 1, 2), ("sym->ens", 2, 1, 2)]
    c = spark.createDataFrame([(1.0, 0.0), (0.0, 2.0), (1.0, 1.0), (0.0, None)], "path double, vus double")
    assert dict(rows(rollup.class_presence(c, ["path", "vus"]))) == {
        "entities": 4, "any": 3, "has_path": 2, "only_path": 1, "has_vus": 2, "only_vus": 1
    }


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, None), ("b", 1, 2), ("b", 1, 3)], "k string, x int, y int")
    assert rows(rollup.duplicates_agree(df, "k", ["x", "y"])) == [("a", 2, 1), ("b", 2, 2)]
    s = spark.createDataFrame([("a", "S"), ("a", "S"), ("b", "S"), ("b", "T"), ("c", "S"), ("c", None)], "k string, s string")
    assert rows(rollup.members_agree(s, "k", "s")) == [("a", 2, "identical"), ("b", 2, "different"), ("c", 2, "incomplete")]


def test_completeness(spark):
    df = spark.createDataFrame([("x", "nan", "1")] + [("x", "", "")] * 24, "a string, b string, c string")
    got = {r.item: (r.columns, r.missing_columns, r.worst_pct, r.verdict) for r in rollup.completeness(
        df, {"full": ["a"], "none": ["b"], "few": ["c", "zz"], "gone": ["zz"], "no": []}).collect()}
    assert got == {
        "full": ("a", "", 100.0, ""), "none": ("b", "", 0.0, "ESSENTIALLY EMPTY"),
        "few": ("c", "zz", 4.0, "ESSENTIALLY EMPTY"), "gone": ("", "zz", -1.0, "COLUMN(S) NOT FOUND"),
        "no": ("", "", -1.0, "NO MATCHING COLUMN IN TABLE"),
    }


def test_packed_summary(spark):
    df = spark.createDataFrame(
        [("m", "E2", 1, False), ("m", "E1", 2, True), ("m", "E1", 3, False), ("n", "E3", 4, False)],
        "id string, e string, ord int, f boolean",
    )
    by_name = rollup.packed_summary(df, "id", "e", F.col("f"))
    assert rows(by_name) == [("m", 3, "E1;E1;E2", "Y", "E1"), ("n", 1, "E3", "N", "")]
    by_first = rollup.packed_summary(df, "id", "e", F.col("f"), order="ord")
    assert rows(by_first)[0] == ("m", 3, "E2;E1;E1", "Y", "E1")


def test_ladder(spark):
    df = spark.createDataFrame([(True, False, True), (False, False, False), (True, None, False)], "a boolean, b boolean, c boolean")
    out = rollup.ladder([F.col(c) for c in "abc"], ["chimp", "mouse", "yeast"])
    assert [tuple(r) for r in df.select(*out.values()).collect()] == [(2, "yeast"), (0, "none"), (1, "chimp")]


def test_profiles(spark):
    df = spark.createDataFrame([("0", "a;b;", "x"), ("2.9", "", ""), ("oops", "c", "x"), ("", None, "y")], "n string, l string, c string")
    full = profile.numeric_profile(df, "t", ["n"]).first()
    assert (full.n_populated, full["min"], full["max"]) == (2, 2.9, 2.9)
    strict = profile.numeric_profile(df, "t", ["n"], count_zero_as_populated=False).first()
    assert strict.n_populated == 1
    zeros = profile.numeric_profile(df, "t", ["n"], exclude_zero=False).first()
    assert (zeros["min"], zeros["mean"], zeros["median"]) == (0.0, 1.45, 1.45)
    lists = profile.list_profile(df, "t", ["l"]).first()
    assert (lists.n_populated, lists["min"], lists["max"]) == (2, 1.0, 3.0)
    cat = profile.category_profile(df, "t", ["c"]).first()
    assert (cat.n_distinct, cat.notes) == (3, "x=2 (50.0%); (none)=1 (25.0%); y=1 (25.0%)")
    gen = profile.generic_profile(df, "t", ["c"]).first()
    assert (gen.n_populated, gen.n_distinct, gen.pct_populated) == (3, 2, 75.0)
    ex = profile.first_examples(df.withColumn("o", F.monotonically_increasing_id()), ["l", "c"], "o")
    assert rows(ex) == [("c", 3, 75.0, "x"), ("l", 2, 50.0, "a;b;")]
    assert rows(profile.mean_and_invalid(df, ["n"])) == [("n", 2, 2, 1.45)]


def test_digest_tree(spark):
    """Copies agree whatever their order and partitions; changed cells are found by the ranges they lie in."""
    base = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 17).alias("v"), F.concat(F.lit("t"), "id").alias("w"))
    base = base.unionByName(base.where("k < 40"))  # repeated keys
    tree = quality.digest_tree(base, "k", bits=10)
    sums = {r["level"]: r for r in tree.groupBy("level").agg(F.count("range").alias("nodes"), F.sum("rows").alias("rows"), F.sum("keys").alias("keys"), F.sum("repeated").alias("repeated"), F.sum("d1").alias("d1")).collect()}
    assert sorted(sums) == [0, 1, 2] and sums[0].nodes == 1 and sums[1].nodes <= 16 and 16 < sums[2].nodes <= 1024
    assert len({(r["rows"], r["keys"], r["repeated"], r.d1) for r in sums.values()}) == 1
    assert (sums[0]["rows"], sums[0]["keys"], sums[0].repeated) == (5040, 5000, 40)
    same = quality.digest_tree(base.orderBy(F.desc("w")).repartition(5), "k", bits=10)
    assert quality.differing_ranges(tree, same, bits=10).count() == 0

    changed = base.withColumn("v", F.when(F.col("k").isin(100, 2000, 4999), None).otherwise(F.col("v")))
    ranges = quality.differing_ranges(tree, quality.digest_tree(changed, "k", bits=10), bits=10)
    assert 1 <= ranges.count() <= 3
    near = quality.rows_in_ranges(base, ranges, "k", bits=10)
    assert {100, 2000, 4999} <= {r.k for r in near.collect()} and near.count() < 60
    diff = {r.check: (r.n, r.sample) for r in quality.table_diff(base, changed, "k", bits=10).collect()}
    assert diff["mismatch:v"] == (3, "100: 15 -> null") and diff["mismatch:w"] == (0, "")
    assert (diff["rows_old"][0], diff["repeated_old"][0], diff["only_old"][0]) == (5040, 40, 0)
    # a value that moves to the next column, and rows that are gone or there twice
    moved = spark.createDataFrame([(1, None, "a"), (2, "b", None)], "k int, v string, w string")
    other = spark.createDataFrame([(1, "a", None), (2, "b", None)], "k int, v string, w string")
    assert {r.check: r.n for r in quality.table_diff(moved, other, "k").collect()}["mismatch:v"] == 1
    less = {r.check: r.n for r in quality.table_diff(base, base.where("k <> 77"), "k").collect()}
    assert (less["only_old"], less["rows_new"]) == (1, 5039)
    none = {r.check: r.n for r in quality.table_diff(base.limit(0), base, "k").collect()}
    assert (none["rows_old"], none["only_new"], none["repeated_new"]) == (0, 5040, 40)


def test_diff_and_guards(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", "z")], "k int, v string, w string")
    new = spark.createDataFrame([(1, "a", "n", 1), (2, "B", None, 1), (4, "d", "q", 1)], "k int, v string, w string, extra int")
    got = {r.check: (r.n, r.sample) for r in quality.table_diff(old, new, "k").collect()}
    assert got == {
        "rows_old": (3, ""), "rows_new": (3, ""), "only_old": (1, ""), "only_new": (1, ""),
        "repeated_old": (0, ""), "repeated_new": (0, ""),
        "mismatch:v": (1, "2: b -> B"), "mismatch:w": (1, "1: x -> n"),
        "columns_added": (1, "extra"), "columns_lost": (0, ""),
    }
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    got = {r.check: r.n for r in quality.table_diff(twice, twice, "k").collect()}
    assert (got["rows_old"], got["rows_new"], got["repeated_old"], got["mismatch:v"]) == (3, 3, 1, 0)
    with pytest.raises(quality.QualityError):
        quality.check_diff_clean(quality.table_diff(old, new, "k"))
    quality.check_diff_clean(quality.table_diff(old, old.withColumn("e", F.lit(1)), "k"))
    with pytest.raises(quality.QualityError):
        quality.check_unique(old.union(old), "k")
    with pytest.raises(quality.QualityError):
        quality.check_columns(old, ["k", "v"])
    with pytest.raises(quality.QualityError):
        quality.check_columns(old, ["k", "v", "w", "w"])
    with pytest.raises(quality.QualityError):
        quality.check_columns(old, 2)
    quality.check_columns(old, {"k": "", "v": "", "w": ""})
    with pytest.raises(quality.QualityError):
        quality.check_same_keys({"old": old, "new": new}, "k")
    quality.check_same_keys({"a": old, "b": old}, "k")


def test_chunks(spark):
    i = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (3, "d")], "chunk int, id string")
    o = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d"), (3, "e")], "chunk int, id string")
    report = quality.chunk_report(i, o, "chunk", "id")
    assert rows(report) == [
        (1, 2, 2, 1, 1, 0, "incomplete"), (2, 2, 1, 1, 0, 0, "duplicate_ids"), (3, 1, 1, 2, 0, 1, "complete")
    ]
    with pytest.raises(quality.QualityError):
        quality.check_chunks_complete(report)


def test_rules(spark):
    df = spark.createDataFrame(
        [
            ("T cell receptor beta", "TRBV1"), ("Ig kappa chain", "X"), ("Some protein", "ABCP"), ("thing", "ABC-AS1"),
            ("Mitochondrial x", "G"), ("plain", "G"), ("Pseudo p", "XP;Y"), (None, None),
        ],
        "n string, s string",
    )
    got = [r[0] for r in df.select(rules.gene_category(F.col("n"), F.col("s"), F.col("s").isNotNull())).collect()]
    assert got == [
        "TCR gene segment", "Immunoglobulin gene segment", "Pseudogene (gene symbol ends in P)",
        "Antisense/lncRNA/uncharacterized locus", "Mitochondrial-encoded micropeptide",
        "Other/unclassified (searched all transcripts, no exact match)",
        "Other/unclassified (searched all transcripts, no exact match)", "No ensembl_gene at all",
    ]
    fix = df.select(rules.gene_category(F.col("n"), F.col("s"), variant="fixable")).collect()
    assert fix[1][0] == "UNCLASSIFIED (potentially fixable)" and fix[2][0] == "Pseudogene (symbol ends in P)"
    first = df.limit(1).select(rules.gene_category(F.col("n"), F.col("s"), F.lit(False), id_test_first=True)).first()
    assert first[0] == "No ensembl_gene at all"
    bt = spark.createDataFrame([(b,) for b in ("IG_V_gene", "TR_J_pseudogene", "Mt_tRNA", "processed_pseudogene", "TEC", "protein_coding", "NOT_FOUND", "snRNA")], "b string")
    assert [r[0] for r in bt.select(rules.normal_label(rules.biotype_category(F.col("b")))).collect()] == [
        "Immunoglobulin gene segment", "TCR gene segment", "Mitochondrial-encoded micropeptide", "Pseudogene",
        "Antisense/lncRNA/uncharacterized locus", "Protein-coding (genuine no-exact-match case)",
        "Ensembl ID not found / retired", "Other biotype: snRNA",
    ]
    sig = spark.createDataFrame([(x,) for x in ("Likely pathogenic", "Benign", "Conflicting classifications of pathogenicity", "Uncertain significance", "Pathogenic; Benign", None)], "x string")
    assert [tuple(r) for r in sig.select(rules.significance_bucket(F.col("x")), rules.significance_group(F.col("x"))).collect()] == [
        ("pathogenic", "Pathogenic/Likely pathogenic"), ("benign", "Benign/Likely benign"), ("uncertain", "Conflicting"),
        ("uncertain", "Uncertain significance"), ("uncertain", "Other/Unknown"), ("uncertain", "Other/Unknown"),
    ]
    t = spark.createDataFrame([(80.0, True), (10.0, True), (50.0, True), (None, True), (99.0, False)], "p double, m boolean")
    assert [r[0] for r in t.select(rules.tier(F.col("p"), F.col("m"))).collect()] == ["high", "low", "medium", "medium", ""]


def test_machine_flags(spark):
    cells = {
        "GO:0005840:ribosome;GO:0005682:U5 snRNP": ("Y", "GO:0005840:ribosome", "Y", "GO:0005682:U5 snRNP", "N", ""),
        "GO:0120259:7SK snRNP": ("N", "", "N", "", "Y", "7SK snRNP (RNA Pol II elongation control, not splicing)"),
        "GO:0005785:signal recognition particle receptor complex": ("N", "", "N", "", "N", ""),
        "GO:0048500:signal recognition particle;GO:0005643:Nuclear pore complex": (
            "N", "", "N", "", "Y", "signal recognition particle;nuclear pore complex"),
        "": ("N", "", "N", "", "N", ""),
    }
    df = spark.createDataFrame([(c,) for c in cells], "cc string")
    out = rules.with_machine_flags(df, "cc")
    cols = [f"{c}{s}" for c in ("Ribosomal_protein", "Spliceosomal_protein", "Other_RNP_machine") for s in ("", "_terms")]
    assert {r.cc: tuple(r[c] for c in cols) for r in out.collect()} == cells


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="tables are not here")
def test_machine_flags_are_worked_out_once_a_cell(spark):
    from __spark_entry__ import queries

    plan = queries()["machine_flags"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    classified = max(k for k, line in enumerate(lines) if "array_intersect" in line)
    assert any("Aggregate" in line for line in lines[classified + 1 :])


def test_gap_fill(spark):
    df = spark.createDataFrame(
        [
            ("GO:0003729:mRNA binding", "GO:0006418:x", ""),
            ("GO:0003723:RNA binding", "GO:0006418:tRNA aminoacylation", "Aminoacyl tRNA synthetases, Class I"),
            ("GO:0003723:RNA binding", "GO:0006397:mRNA processing;bad", ""),
            ("GO:0003723:RNA binding", "", "MicroRNA protein coding host genes"),
            ("GO:0005515:protein binding", "GO:0006397:mRNA processing", ""),
        ],
        "mf string, bp string, fam string",
    )
    classes = ["mRNA_binding", "tRNA_binding", "miRNA_binding"]
    out = rules.gap_filled(rules.with_prefix_classes(df, "mf"), "mf", "bp", "fam", classes)
    got = [tuple(r[c] for c in ("mRNA_binding", "mRNA_binding_source", "tRNA_binding", "tRNA_binding_source", "miRNA_binding_source")) for r in out.collect()]
    assert got == [
        ("Y", "MF", "N", "", ""), ("N", "", "Y", "BP+Family", ""), ("Y", "BP", "N", "", ""), ("N", "", "N", "", ""), ("N", "", "N", "", "")
    ]
