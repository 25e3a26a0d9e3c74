import pytest
from pyspark.sql import functions as F

from helixtab.functions import mutate, notation

# one branch of the three-letter parser each
THREE = {
    "=": ("synonymous_explicit", {}),
    "Gly12=": ("synonymous_explicit", {}),
    "Leu473fs": ("frameshift", {}),
    "Gly10_Ala12delinsTrpVal": ("delins", {"start": 10, "end": 12, "wt_start": "Gly", "wt_end": "Ala", "inserted": "WV", "n_inserted": 2, "truncate": False}),
    "Gly10delinsTrpTer": ("delins", {"start": 10, "end": 10, "wt_start": "Gly", "wt_end": "Gly", "inserted": "W", "n_inserted": 1, "truncate": True}),
    "Gly10delinsTer": ("delins", {"start": 10, "end": 10, "wt_start": "Gly", "wt_end": "Gly", "inserted": "", "n_inserted": 0, "truncate": True}),
    "Gly10delinsTrpVa": ("unparsed", {}),
    "Gly10delinsFoo": ("unparsed", {}),
    "Gly10delinsTerTrp": ("delins", {"start": 10, "end": 10, "wt_start": "Gly", "wt_end": "Gly", "inserted": "W", "n_inserted": 2, "truncate": False}),
    "Thr33_Trp34insTer": ("nonsense", {"keep_to": 33}),
    "Ala42_Ala43insAspAla": ("ins", {"after": 42, "inserted": "DA", "n_inserted": 2, "truncate": False}),
    "Ala42_Ala43insXaa": ("ins", {"after": 42, "inserted": "", "n_inserted": 1, "truncate": False}),
    "Ala42insAla": ("unparsed", {}),
    "Glu10_Gly12del": ("del", {"start": 10, "end": 12, "wt_start": "Glu", "wt_end": "Gly"}),
    "Glu315del": ("del", {"start": 315, "end": 315, "wt_start": "Glu", "wt_end": "Glu"}),
    "Ala5_Gly7dup": ("dup", {"start": 5, "end": 7, "wt_start": "Ala", "wt_end": "Gly"}),
    "Thr123dup": ("dup", {"start": 123, "end": 123, "wt_start": "Thr", "wt_end": "Thr"}),
    "Gly1046Arg": ("missense", {"pos": 1046, "wt": "Gly", "mut": "Arg"}),
    "Gly12Gly": ("synonymous", {"pos": 12, "wt": "Gly", "mut": "Gly"}),
    "Arg5Ter": ("nonsense", {"keep_to": 4}),
    "Ter100Gln": ("stoploss", {"pos": 100, "mut": "Gln"}),
    "Foo5Gln": ("unparsed", {}),
    "138PG[3]": ("unparsed", {}),
    "Gly10": ("unparsed", {}),
    "?": ("unparsed", {}),
}

ONE = {
    ("p.G12D", "Substitution - Missense"): ("missense", {"pos": 12, "wt": "G", "mut": "D"}),
    ("p.G12D", "Substitution - coding silent"): ("synonymous", {}),
    ("p.G12fs*3", "Frameshift"): ("frameshift_or_stoploss", {}),
    ("", ""): ("no_protein_notation", {}),
    ("c.12A>G", ""): ("no_protein_notation", {}),
    ("p.?", ""): ("unparsed", {}),
    ("p.R5*", ""): ("nonsense", {"keep_to": 4}),
    ("p.G12G", ""): ("synonymous", {}),
    ("p.B12G", ""): ("unparsed", {}),
    ("p.G12B", ""): ("unparsed", {}),
    ("p.E5_K7del", ""): ("del", {"start": 5, "end": 7, "wt_start": "E", "wt_end": "K"}),
    ("p.E5del", ""): ("del", {"start": 5, "end": 5, "wt_start": "E", "wt_end": "E"}),
    ("p.E5_K7dup", ""): ("dup", {"start": 5, "end": 7, "wt_start": "E", "wt_end": "K"}),
    ("p.E5dup", ""): ("dup", {"start": 5, "end": 5, "wt_start": "E", "wt_end": "E"}),
    ("p.E5_K6insGG", ""): ("ins", {"after": 5, "inserted": "GG", "n_inserted": 2, "truncate": False}),
    ("p.E5_K6insGX", ""): ("unparsed", {}),
    ("p.E5_K7delinsW", ""): ("delins", {"start": 5, "end": 7, "wt_start": "E", "wt_end": "K", "inserted": "W", "n_inserted": 1, "truncate": False}),
    ("p.E5delinsWK", ""): ("delins", {"start": 5, "end": 5, "wt_start": "E", "wt_end": "E", "inserted": "WK", "n_inserted": 2, "truncate": False}),
}


def filled(details):
    return {k: v for k, v in details.asDict().items() if v is not None}


def test_three_letter(spark):
    df = spark.createDataFrame([(c,) for c in THREE], "ch string")
    got = {r.ch: (r.category, filled(r.details)) for r in notation.parse_three_letter(df, "ch").collect()}
    assert got == THREE


def test_one_letter(spark):
    df = spark.createDataFrame(list(ONE), "ch string, ds string")
    out = notation.parse_one_letter(df, "ch", "ds").collect()
    assert {(r.ch, r.ds): (r.category, filled(r.details)) for r in out} == ONE


def test_name_and_id(spark):
    df = spark.createDataFrame(
        [("NM_014630.3(ZNF592):c.3136G>A (p.Gly1046Arg)",), ("NC_000001.11:g.5A>G",)], "n string"
    )
    acc, change = notation.split_name(F.col("n"))
    assert [tuple(r) for r in df.select(acc, change).collect()] == [("NM_014630.3", "Gly1046Arg"), (None, None)]
    parts = notation.parse_mutation_id(F.col("m"))
    ids = spark.createDataFrame([("P1|GENE;ALIAS|W123A",), ("P1|G|W1",)], "m string")
    assert [tuple(r) for r in ids.select(*parts.values()).collect()] == [
        ("P1", "GENE;ALIAS", "W", 123, "A"), (None,) * 5
    ]
    made = ids.limit(1).select(
        notation.mutation_id(F.lit("P1"), F.lit("G"), F.lit("W"), F.lit(123), F.lit("A"))
    ).first()[0]
    assert made == "P1|G|W123A"


def test_selenocysteine_map(spark):
    df = spark.createDataFrame([("Sec",)], "r string")
    row = df.select(notation.residue_code(F.col("r")), notation.residue_code(F.col("r"), False)).first()
    assert tuple(row) == ("U", None)


SEQ = "MGAKLTWEDV"
BUILT = {
    "Gly2Arg": ("MRAKLTWEDV", "built_missense"),
    "Ala2Arg": (None, "mismatch_or_invalid"),
    "Gly20Arg": (None, "mismatch_or_invalid"),
    "Lys4Ter": ("MGA", "built_nonsense"),
    "Met1Ter": ("", "empty_mutant"),
    "Thr30_Trp31insTer": (None, "mismatch_or_invalid"),
    "Thr6_Trp7insTer": ("MGAKLT", "built_nonsense"),
    "Ala3_Leu5del": ("MGTWEDV", "built_del"),
    "Leu5_Ala3del": (None, "mismatch_or_invalid"),
    "Cys3del": ("MGKLTWEDV", "built_del"),
    "Val10_Val11del": (None, "mismatch_or_invalid"),
    "Gly2_Ala3insTrpCys": ("MGWCAKLTWEDV", "built_ins"),
    "Gly2_Ala3insTrpTer": ("MGW", "built_ins"),
    "Gly2_Ala3insXaa": (None, "mismatch_or_invalid"),
    "Gly2_Lys4delinsTrp": ("MWLTWEDV", "built_delins"),
    "Gly2delinsTrpTer": ("MW", "built_delins"),
    "Gly2_Lys4dup": ("MGAKGAKLTWEDV", "built_dup"),
    "Val10dup": ("MGAKLTWEDVV", "built_dup"),
    "Leu4fs": (None, "skip_frameshift"),
}


def test_mutants(spark):
    wild = spark.createDataFrame([("NM_1", SEQ)], "accession string, sequence string")
    changes = spark.createDataFrame([("NM_1", c) for c in BUILT] + [("NM_2", "Gly2Arg")], "accession string, ch string")
    out = mutate.mutants_of(notation.parse_three_letter(changes, "ch"), wild).collect()
    assert {r.ch: (r.mutant, r.outcome) for r in out if r.accession == "NM_1"} == BUILT
    assert [r.outcome for r in out if r.accession == "NM_2"] == ["skip_no_wt_seq"]
    assert len(out) == len(BUILT) + 1


@pytest.mark.parametrize(
    "change, want",
    [("p.G2R", "MRAKLTWEDV"), ("p.A2R", None), ("p.K4*", "MGA"), ("p.G2_K4delinsW", "MWLTWEDV"), ("p.E8dup", "MGAKLTWEEDV")],
)
def test_one_letter_mutants(spark, change, want):
    df = spark.createDataFrame([("a", change, "")], "accession string, ch string, ds string")
    wild = spark.createDataFrame([("a", SEQ)], "accession string, sequence string")
    out = mutate.mutants_of(notation.parse_one_letter(df, "ch", "ds"), wild, three_letter=False).first()
    assert out.mutant == want


def test_point_mutations(spark):
    df = spark.createDataFrame([("a", "MKX")], "id string, s string")
    out = mutate.point_mutations(df, "s").withColumn(
        "m", mutate.substituted(F.col("s"), F.col("position"), F.col("mut_aa"))
    ).collect()
    assert len(out) == 19 + 19 + 20
    want = {
        ("MKX"[:i] + a + "MKX"[i + 1 :])
        for i in range(3) for a in notation.ONE_LETTER if a != "MKX"[i]
    }
    assert {r.m for r in out} == want
