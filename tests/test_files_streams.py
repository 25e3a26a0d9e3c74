import gzip

import pytest
from conftest import rows
from pyspark.sql import functions as F

from helixtab.operators import quality, scan
from helixtab.sources import readers, writers
from helixtab.sources.spec import DatasetSpec
from helixtab.streaming import ingest


def put(path, text, mode="w"):
    path.write_text(text, newline="") if mode == "w" else None
    return str(path)


def test_quoted_csv(spark, tmp_path):
    p = put(tmp_path / "t.csv", 'id,text,n\r\nP1,"a ""quoted"" word\nand a line, with comma",1\r\nP2,é;x;,NA\r\n')
    got = rows(readers.read_table(spark, p).withColumn("n", F.regexp_replace("n", "\r", "")))
    assert got == [("P1", 'a "quoted" word\nand a line, with comma', "1"), ("P2", "é;x;", "NA")]


def test_headers_comments_preamble(spark, tmp_path):
    p = put(tmp_path / "v.tsv", "#AlleleID\tName\n1\ta\n")
    assert readers.clean_headers(readers.read_tsv(spark, p)).columns == ["AlleleID", "Name"]
    p = put(tmp_path / "c.tsv", '#made\n#by\n"Id"\t"Regex"\n"E1"\t"a""b"\n')
    assert rows(readers.read_tsv(spark, p, comment="#")) == [("E1", 'a"b')]
    p = put(tmp_path / "p.tsv", 'Title\n\nnote "Uniprot_ID"\n"Uniprot_ID"\tstatus\r\n"P1"\tRBP\r\n"P2"\tx\n')
    assert rows(readers.read_after_preamble(spark, p, '"Uniprot_ID"')) == [("P1", "RBP"), ("P2", "x")]
    with pytest.raises(ValueError):
        readers.read_after_preamble(spark, p, "absent")


def test_preamble_of_each_file(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    put(folder / "a.tsv", "note\tof a tool\n" * 1500 + '"Id"\tn\n"A1"\t1\n\n"A2"\t2\n')
    put(folder / "b.tsv", 'Title\n"Id"\tn\r\n"B1"\t3\r\n')
    put(folder / "c.tsv", 'n\n\nx\n"Id"\tn\tmore\n"C1"\t4\ty\n"Id"\tagain\tz\n')
    got = readers.read_after_preamble(spark, str(folder), '"Id"')
    assert got.columns == ["Id", "n", "more"]
    assert rows(got) == rows(spark.createDataFrame([("A1", "1", None), ("A2", "2", None), ("B1", "3", None), ("C1", "4", "y"), ("Id", "again", "z")], "a string, b string, c string"))
    put(folder / "d.tsv", "no header\n")
    with pytest.raises(ValueError):
        readers.read_after_preamble(spark, str(folder), '"Id"')


def test_gzip_lands_as_parquet(spark, tmp_path):
    with gzip.open(tmp_path / "m.tsv.gz", "wt") as f:
        f.write("GENE\tN\n" + "".join(f"g{i % 3}\t{i}\n" for i in range(50)))
    df = readers.land_gzip(spark, str(tmp_path / "m.tsv.gz"), 4)
    assert df.count() == 50 and df.select("N").distinct().count() == 50


def test_fasta(spark, tmp_path):
    text = ">sp|P1|A_HUMAN Some -> thing GN=GA PE=1\nMK\nTA\r\n>sp|P2|B_HUMAN No gene\nMM\n>plain desc\n\n>x|y|z GN=\nAA"
    p = put(tmp_path / "a.fasta", text)
    assert rows(readers.read_fasta(spark, p).select("id", "seq")) == [
        ("plain", ""), ("sp|P1|A_HUMAN", "MKTA"), ("sp|P2|B_HUMAN", "MM"), ("x|y|z", "AA")
    ]
    assert rows(readers.read_uniprot_fasta(spark, p)) == sorted(
        [("P1", "GA", "MKTA"), ("P2", None, "MM"), ("plain", None, ""), ("y", None, "AA")], key=repr
    )
    gene, acc = readers.split_header(F.lit("TP53|P04637"))
    assert tuple(spark.range(1).select(gene, acc).first()) == ("TP53", "P04637")


def test_flat_records(spark, tmp_path):
    rec = (
        "LOCUS       NM_1\nVERSION     NM_1.2\nFEATURES\n     gene            1..9\n     CDS             1..9\n"
        '                     /protein_id="NP_1.1"\n                     /translation="MKT\n                     AYI"\n'
        "     CDS             10..19\n                     /translation=\"NOTME\"\nORIGIN\n"
    )
    p = put(tmp_path / "r.gb", rec + "//\n" + "LOCUS       X\nVERSION     NM_2.1\n     gene   1..2\n//\n")
    assert rows(readers.read_flat_records(spark, p)) == [("NM_1.2", "NP_1.1", "MKTAYI")]


def test_small_readers(spark, tmp_path):
    p = put(tmp_path / "v.vcf", "##fileformat=VCFv4.2\n#CHROM\tPOS\n1\t10\tid1\tA\tG\t.\t.\tX=1\n")
    assert rows(readers.read_vcf(spark, p)) == [("1", 10, "id1", "A", "G", ".", ".", "X=1")]
    p = put(tmp_path / "pairs.txt", "a\tb\nc d\n\n")
    assert rows(readers.read_pairs(spark, p)) == [("a", "b"), ("c", "d")]
    p = put(tmp_path / "ids.txt", "x\n\n x \ny\n")
    assert rows(readers.read_id_list(spark, p)) == [("x",), ("y",)]
    p = put(tmp_path / "k.json", '{"P1": {"C": [["GO:1", "n"]], "n": 2},\n "P2": {"n": 3}}')
    got = readers.read_keyed_json(spark, p, "struct<C:array<array<string>>,n:int>")
    assert rows(got.select("key", "value.n", "value.C")) == [("P1", 2, [["GO:1", "n"]]), ("P2", 3, None)]
    p = put(tmp_path / "s.bed", "track x\nchr1\t0\t5\t1.5\nchr1\t5\t6\tNaN\n")
    assert rows(readers.read_signal(spark, p)) == sorted([("chr1", 0, 5, 1.5), ("chr1", 5, 6, None)], key=repr)
    lines = spark.read.text(put(tmp_path / "rag.tsv", "a\tb\tc\n1\t2\n1\t2\t3\n"))
    assert rows(quality.ragged_rows(lines, 3)) == [(2, 1)]


def test_spec(spark):
    spec = DatasetSpec("t", {"k": "string", "n": "int", "x": "double", "b": "boolean", "l": "list"}, ("k",))
    raw = spark.createDataFrame([("a", "2.9", "1d", "Y", "p;q;"), (" ", "", "2.5", "no", None)], spec.raw_schema())
    assert [tuple(r) for r in spec.typed(raw).collect()] == [("a", 2, None, True, ["p", "q"]), (None, None, 2.5, False, [])]
    with pytest.raises(quality.QualityError):
        spec.verify_key(raw.unionAll(raw))
    with pytest.raises(quality.QualityError):
        spec.typed(raw.drop("l"))


def test_chunk_files(spark, tmp_path):
    df = spark.range(10).select(F.col("id"), F.concat(F.lit("S"), F.col("id").cast("string")).alias("seq"))
    chunked = scan.chunk_numbers(df, "id", 3)
    writers.write_fasta_chunks(chunked, "id", "seq", "chunk", str(tmp_path / "fa"))
    files = sorted(p.parent.name for p in (tmp_path / "fa").rglob("part-*"))
    assert files == ["chunk=1", "chunk=2", "chunk=3"]
    first = next((tmp_path / "fa" / "chunk=1").glob("part-*")).read_text()
    assert first == ">0\nS0\n>1\nS1\n>2\nS2\n>3\nS3\n"
    writers.write_table_chunks(chunked, "chunk", str(tmp_path / "tsv"))
    back = readers.read_chunks(spark, str(tmp_path / "tsv"), expected=3)
    assert rows(back.groupBy("chunk").count()) == [(1, 4), (2, 4), (3, 2)]
    with pytest.raises(quality.QualityError):
        readers.read_chunks(spark, str(tmp_path / "tsv"), expected=4)
    chunked.where("chunk = 2").write.mode("append").option("header", True).option("sep", "\t").partitionBy("chunk").csv(str(tmp_path / "tsv"))
    with pytest.raises(quality.QualityError):
        readers.read_chunks(spark, str(tmp_path / "tsv"))


def test_vcf_chunks_have_headers(spark, tmp_path):
    lengths = {f"chr{c}": 100 for c in [*range(1, 23), "X", "Y", "M"]}
    header = writers.vcf_header(lengths)
    assert len(header) == 27 and header[25] == "##contig=<ID=chrM,length=100>"
    df = spark.createDataFrame([(c, "chr1", p, f"v{p}", "A", "G") for c, p in ((1, 9), (1, 3), (2, 5))], "chunk int, chrom string, pos long, id string, ref string, alt string")
    writers.write_vcf_chunks(df, str(tmp_path / "v"), header)
    text = next((tmp_path / "v" / "chunk=1").glob("part-*")).read_text().splitlines()
    assert text[:27] == header
    assert text[27:] == ["chr1\t3\tv3\tA\tG\t.\t.\t.", "chr1\t9\tv9\tA\tG\t.\t.\t."]
    assert rows(readers.read_vcf(spark, str(tmp_path / "v")).select("id", "pos")) == [("v3", 3), ("v5", 5), ("v9", 9)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 'q"x', ["1"]), ("b", "t", "", None)], "k string, n string, q string, l array<string>")
    writers.write_table(df.drop("l").coalesce(1), str(tmp_path / "csv"))
    assert rows(readers.read_table(spark, str(tmp_path / "csv"))) == [("a", None, 'q"x'), ("b", "t", None)]
    writers.write_parquet(df, str(tmp_path / "pq"))
    assert readers.read_columns(spark, str(tmp_path / "pq"), ["k"]).columns == ["k"]
    flagged = spark.createDataFrame([("a", "Y", "N"), ("b", "N", "N")], "k string, f string, g string")
    assert rows(writers.flagged_only(flagged, ["f", "g"], ["k", "f"])) == [("a", "Y")]
    assert rows(writers.manifest(flagged, ["f"])) == [("N", 1), ("Y", 1)]


SCHEMA = "id long, k string"


def drop(spark, folder, n, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / "in"))


def test_ingest_resumes(spark, tmp_path):
    where = {"out": str(tmp_path / "out"), "checkpoint": str(tmp_path / "ck")}

    def run():
        stream = ingest.read_chunk_stream(spark, str(tmp_path / "in"), SCHEMA)
        ingest.ingest_new(stream, **where).awaitTermination()
        return spark.read.schema(SCHEMA).parquet(where["out"]).count()

    drop(spark, tmp_path, 1, [(1, "a"), (2, "b")])
    assert run() == 2
    assert run() == 2
    drop(spark, tmp_path, 2, [(3, "a")])
    assert run() == 3


def test_counts_and_distinct_over_batches(spark, tmp_path):
    def counts():
        stream = ingest.read_chunk_stream(spark, str(tmp_path / "in"), SCHEMA, max_files=1)
        ingest.running_counts(stream, ["k"], str(tmp_path / "c"), str(tmp_path / "cck")).awaitTermination()
        return rows(ingest.latest_counts(spark, str(tmp_path / "c"), ["k"]))

    def firsts():
        stream = ingest.read_chunk_stream(spark, str(tmp_path / "in"), SCHEMA, max_files=1)
        ingest.ingest_distinct(stream, ["k"], str(tmp_path / "d"), str(tmp_path / "dck"), ["id"]).awaitTermination()
        return rows(ingest.read_distinct(spark, str(tmp_path / "d")).select("k", "id"))

    drop(spark, tmp_path, 1, [(2, "a"), (1, "a"), (3, "b")])
    assert counts() == [("a", 2), ("b", 1)]
    assert firsts() == [("a", 1), ("b", 3)]
    drop(spark, tmp_path, 2, [(0, "a"), (9, "c")])
    assert counts() == [("a", 3), ("b", 1), ("c", 1)]
    assert firsts() == [("a", 1), ("b", 3), ("c", 9)]


def test_distinct_over_restarts(spark, tmp_path):
    """Each start is a new query on the old checkpoint; files that were ingested may go, as nothing reads them again."""

    def go():
        stream = ingest.read_chunk_stream(spark, str(tmp_path / "in"), SCHEMA)
        done = ingest.ingest_distinct(stream, ["k"], str(tmp_path / "d"), str(tmp_path / "dck"), ["id"])
        done.awaitTermination()
        return rows(ingest.read_distinct(spark, str(tmp_path / "d")).select("k", "id")), done

    drop(spark, tmp_path, 1, [(k, f"k{k % 7}") for k in range(100)] + [(0, None), (-1, None)])
    first, _ = go()
    assert first == sorted([(f"k{k}", k) for k in range(7)] + [(None, -1)], key=repr)
    drop(spark, tmp_path, 2, [(k, f"k{k % 9}") for k in range(100, 200)])
    # 100 % 9 is 1: the first rows of the new ids are 106 and 107
    second, _ = go()
    assert second == sorted([*first, ("k7", 106), ("k8", 107)], key=repr)
    third, last = go()
    assert third == second
    drop(spark, tmp_path, 3, [(500, "k3"), (501, "new")])
    fourth, last = go()
    assert fourth == sorted([*second, ("new", 501)], key=repr)
    assert last.recentProgress[-1]["numInputRows"] == 2
    assert last.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] >= 11
    with pytest.raises(ValueError):
        stream = ingest.read_chunk_stream(spark, str(tmp_path / "in"), SCHEMA)
        ingest.ingest_distinct(stream, ["k"], str(tmp_path / "d"), str(tmp_path / "other"), ["id"])
