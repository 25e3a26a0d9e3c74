from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helixtab.functions import codon

TABLE = codon.codon_table()


def model(cds):
    out = ""
    for i in range(0, len(cds) // 3 * 3, 3):
        aa = TABLE.get(cds[i : i + 3], "X")
        if aa == "*":
            break
        out += aa
    return out


def test_table_has_all_codons():
    assert len(TABLE) == 64
    assert TABLE["ATG"] == "M" and TABLE["TGG"] == "W"
    assert sorted(c for c, a in TABLE.items() if a == "*") == ["TAA", "TAG", "TGA"]


def test_translate_cases(spark):
    cases = ["", "AT", "ATG", "ATGTAA", "ATGNNNGCTTGA", "ATGGCTTAAGCT", "TGAATG", "ATGAC", "atg", "AT\nGCT"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r.p for r in df.select(codon.translate(F.col("s")).alias("p")).collect()]
    assert got == [model(c) for c in cases]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ACGTN", max_size=60), min_size=20, max_size=40))
def test_translate_matches_model(spark, seqs):
    df = spark.createDataFrame(list(enumerate(seqs)), "i int, s string")
    got = {r.i: r.p for r in df.select("i", codon.translate(F.col("s")).alias("p")).collect()}
    assert got == {i: model(s) for i, s in enumerate(seqs)}


def test_checks_and_taxonomy(spark):
    df = spark.createDataFrame(
        [
            ("ATGGCTTAA", "CCATGGCTTAACC", "MA", False, 1),
            ("NNNATGTAA", "ATG", "M", False, 1),
            ("ATGGCT", "ATGGCT", "MK", True, 1),
            ("ATGGCT", "ATGGCT", "MK", False, 2),
            ("ATGGCT", "ATGGCT", "MK", False, 1),
            ("", "", "M", False, 1),
            ("ATGXCT", "A", None, False, 1),
        ],
        "cds string, rna string, protein string, known boolean, n int",
    )
    checks = codon.cds_checks(F.col("cds"), F.col("rna"))
    first = df.select(*[c.alias(n) for n, c in checks.items()]).first()
    assert tuple(first) == (True, True, True, True, True)
    assert df.select(codon.only_bases(F.col("cds"))).collect()[6][0] is False
    kinds = df.select(
        codon.mismatch_class(
            F.col("cds"), F.col("protein"), codon.translate(F.col("cds")), F.col("known"), F.col("n")
        )
    ).collect()
    assert [k[0] for k in kinds] == [
        "exact_match",
        "x_prefix_benign",
        "selenoprotein_explained",
        "multigene_ambiguous",
        "unexplained_mismatch",
        "no_cds_or_protein",
        "no_cds_or_protein",
    ]


def test_lengths_and_positions(spark):
    df = spark.createDataFrame([("ATGTGAGCT", "MUA")], "cds string, protein string")
    t = codon.translate(F.col("cds"))
    row = df.select(
        codon.length_relation(t, F.col("protein")),
        codon.stopping_codon(F.col("cds"), t),
        codon.encodes_length(F.lit(12), F.lit(3)),
        codon.half_open(F.lit(7)),
    ).first()
    assert tuple(row) == ("shorter", "TGA", True, 6)
    pos = spark.range(1, 8).select(
        codon.codon_number(F.col("id")), codon.codon_position(F.col("id")), codon.residue_at(F.lit("MK"), F.col("id"))
    )
    assert [tuple(r) for r in pos.collect()] == [
        (1, 1, "M"), (1, 2, "K"), (1, 3, "*"), (2, 1, ""), (2, 2, ""), (2, 3, ""), (3, 1, "")
    ]
