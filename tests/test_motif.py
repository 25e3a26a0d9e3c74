import re

from pyspark.sql import functions as F

from helixtab.functions import motif
from helixtab.functions.notation import ONE_LETTER

CLASSES = {"SP": "[ST]P", "NES": "L.{2}[LIV]", "BAD": "([A"}


def test_disruption_against_model(spark):
    cells = [
        ("P1", "[[2,3],[5,8]]", '["SP","NES"]', '["SP","LAAL"]'),
        ("P2", "[[1,2]]", '["UNKNOWN"]', '["AA"]'),
        ("P3", "[[1,3]]", '["SP"]', '["SP"]'),
        ("P4", "[[1,2]]", '["SP"]', '["AP"]'),
        ("P5", "[[1,2]]", '["SP","SP"]', '["SP"]'),
        ("P6", "not json", '["SP"]', '["SP"]'),
        ("P7", "[[1,2]]", '["BAD"]', '["AA"]'),
    ]
    df = spark.createDataFrame(cells, "acc string, r string, c string, s string")
    unpacked = motif.unpack_instances(F.col("r"), F.col("c"), F.col("s"))
    inst = df.select("acc", F.explode(unpacked).alias("i")).select("acc", "i.*")
    assert {r.acc for r in inst.collect()} == {"P1", "P2", "P3", "P4", "P7"}
    status = {
        r.acc: r.st
        for r in inst.withColumn(
            "st", motif.instance_status({c: F.col(c) for c in ("start", "end", "motif", "matched")}, CLASSES)
        ).collect()
    }
    assert status == {
        "P1": "used", "P2": "unknown_class", "P3": "seq_mismatch", "P4": "seq_mismatch", "P7": "unknown_class"
    }
    got = {
        (r.acc, r.motif, r.position, r.wt_aa, r.mut_aa): r.disrupts
        for r in motif.motif_disruptions(inst, CLASSES).collect()
    }
    want = {}
    for name, start, seq in (("SP", 2, "SP"), ("NES", 5, "LAAL")):
        for i, wt in enumerate(seq):
            for a in ONE_LETTER:
                if a != wt:
                    hit = re.fullmatch(CLASSES[name], seq[:i] + a + seq[i + 1 :])
                    want[("P1", name, start + i, wt, a)] = hit is None
    assert got == want


def test_every_match_has_its_own_place(spark):
    """Equal matches at several places are all listed."""
    df = spark.createDataFrame([("AXTIAXTI-AXTI",), ("none",), ("",), (None,)], "s string")
    found = F.regexp_extract_all("s", F.lit("A.[TI]."), 0)
    out = df.select(motif.match_ranges(F.col("s"), "A.[TI].", found).alias("r")).collect()
    assert [r.r for r in out] == [[[1, 4], [5, 8], [10, 13]], [], [], None]
