from pyspark.sql import functions as F

from helixtab.functions import cells, delta


def one(spark, col, *values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col(F.col("v"))).collect()]


def test_ids(spark):
    assert one(spark, cells.strip_version, "ENST1.3", "ENST1") == ["ENST1", "ENST1"]
    assert one(spark, cells.first_item, "ENSG1.2;ENSG2", " ENSG3 ;x", "", ";a", None) == [
        "ENSG1", "ENSG3", None, None, None
    ]
    assert one(spark, lambda c: cells.strip_prefix(c, "9606."), "9606.E1", "E1") == ["E1", "E1"]
    assert one(spark, lambda c: cells.add_prefix(c, "9606."), "9606.E1", "E1") == ["9606.E1", "9606.E1"]
    assert one(spark, cells.n_distinct_bare, "G1.1;G1.2; ;G2", "", None) == [2, 0, 0]
    assert one(spark, cells.valid_accession, "P12345", "A0A024RBG1", "p12345", "Q9", "O95996") == [
        True, True, False, False, True
    ]


def test_blanks_and_truth(spark):
    assert one(spark, cells.is_filled, "x", "  ", "", None) == [True, False, False, False]
    assert one(spark, cells.is_informative, "x", "NaN", " [] ", "{}", "none", "0") == [
        True, False, False, False, False, True
    ]
    assert one(spark, cells.truthy, " TRUE", "1", "t", "Y", None) == [True, True, True, False, False]
    assert one(spark, cells.truthy_exact, "True", "TRUE", "1", "t") == [True, False, True, False]


def test_numbers(spark):
    texts = ["12", " 3.5 ", "1e3", "1d", "1f", "NA", "", None, "-2.9", "Infinity"]
    assert one(spark, cells.parse_float, *texts) == [12.0, 3.5, 1000.0, None, None, None, None, None, -2.9, None]
    assert one(spark, lambda c: cells.parse_float(c, 0.0), "x", "2") == [0.0, 2.0]
    assert one(spark, cells.parse_int, *texts) == [12, 3, 1000, None, None, None, None, None, -2, None]
    assert one(spark, cells.parse_strict_int, "12", "3.5", "-4") == [12, None, -4]
    assert one(spark, cells.nan_to_null, 1.0, float("nan"), schema="v double") == [1.0, None]


def test_packed(spark):
    assert one(spark, cells.packed_items, "a; b;;", "", None) == [["a", "b"], [], []]
    assert one(spark, lambda c: cells.packed_items(c, "|"), "Cytoplasm|Nucleus") == [["Cytoplasm", "Nucleus"]]
    got = one(spark, cells.id_term_entries, "GO:1:ribosome;GO:2;bad;GO:3:a:b")[0]
    assert [tuple(x) for x in got] == [("GO:1", "GO:1:ribosome"), ("GO:3", "GO:3:a:b")]
    df = spark.createDataFrame([("C:nucleus: inner",), ("noaspect",)], "t string")
    assert [tuple(r) for r in df.select(*cells.aspect_and_name(F.col("t"))).collect()] == [
        ("C", "nucleus: inner"), (None, None)
    ]
    facts = spark.createDataFrame([("P12345", ["P12345", "x", "x"])], "own string, l array<string>").select(
        *cells.list_facts(F.col("own"), F.col("l")).values()
    )
    assert tuple(facts.first()) == (True, True, True)


def test_literals(spark):
    ok = "{'RRM': [(55, 134), (1, 2)], 'KH': [[3, 4]]}"
    got = one(spark, cells.python_ranges, ok, "{}", "{broken")
    assert got == [{"RRM": [[55, 134], [1, 2]], "KH": [[3, 4]]}, {}, None]
    assert one(spark, cells.python_list, "['a', 'b']") == [["a", "b"]]
    c = cells.coordinate(F.col("v"))
    df = spark.createDataFrame([("7:123-125",), ("7:x",)], "v string")
    assert [tuple(r) for r in df.select(*c.values()).collect()] == [("7", 123, 125), (None, None, None)]


def test_scores(spark):
    full = "SpliceAI=A|G|0.1|0.2|0.3|0.4|1|2|3|4"
    got = one(spark, cells.score_parts, full, "SpliceAI=A|G|" + "|".join("." * 8), "SpliceAI=A|G|1", ".", "X=1")
    assert got == [["0.1", "0.2", "0.3", "0.4", "1", "2", "3", "4"], None, None, None, None]
    fields = ["AGG", "AMYLO", "BETA"]
    got = one(spark, lambda c: cells.token_record(c, fields), " AGG 1.5 AMYLO 2  BETA 3 ", "AGG 1 BETA 3", "")
    assert [tuple(x) if x else None for x in got] == [("1.5", "2", "3"), None, None]


def test_packing(spark):
    df = spark.createDataFrame(
        [([("liver", "src", 1.23456, "TPM"), ("blood", "src", None, None)],)],
        "r array<struct<tissue:string,source:string,median:double,unit:string>>",
    )
    assert df.select(cells.pack_measurements(F.col("r"))).first()[0] == "liver|src|1.2346|TPM;blood|src||"
    pairs = spark.createDataFrame([([("GO:1", "x")],), (None,)], "p array<struct<id:string,name:string>>")
    assert [r[0] for r in pairs.select(cells.pack_pairs(F.col("p"))).collect()] == ["GO:1:x", ""]
    par = spark.createDataFrame([("a;b", "1;2")], "d string, s string")
    got = par.select(cells.unpack_parallel(disease=F.col("d"), score=F.col("s"))).first()[0]
    assert [(x.disease, x.score) for x in got] == [("a", "1"), ("b", "2")]


def test_deltas(spark):
    df = spark.createDataFrame(
        [([0.1, 0.9, 0.9], [0.5, 0.2, 0.9]), ([1.0], [None]), ([1.0, 2.0], [1.0])], "w array<double>, m array<double>"
    )
    w, m = F.col("w"), F.col("m")
    out = df.select(
        delta.delta_vector(w, m).alias("d"), delta.total_abs_delta(w, m).alias("t"),
        delta.argmax_name(w, ["a", "b", "c"]).alias("n"),
    ).collect()
    assert [round(x, 6) for x in out[0].d] == [0.4, -0.7, 0.0]
    assert round(out[0].t, 6) == 1.1 and out[1].t is None and out[2].t is None
    assert out[0].n == "b"  # the first of equal members
    assert one(spark, delta.score_status, "0.5", "NA", "OOM", " ", None) == [
        "scored", "too_long", "out_of_memory", "blank", "blank"
    ]
    assert one(spark, delta.direction, 1.0, -1.0, 0.0, None, schema="v double") == [
        "increase", "decrease", "equal", None
    ]
    assert one(spark, delta.fixed4, 1.23456, schema="v double") == ["1.2346"]
