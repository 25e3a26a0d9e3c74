"""The registered queries against SQL, and the pipeline on awkward rows."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))

from cases import nothing, ugly  # noqa: E402
from oracle import check, connect  # noqa: E402

import corpus_pipeline  # noqa: E402
from helixtab.llm.common import new_folder  # noqa: E402
from helixtab.llm.queries import QUERIES, SQL  # noqa: E402

FOLDER = "/root/testdata/sf0.01"
here = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


@here
@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    check(spark, connect(FOLDER), FOLDER, QUERIES[name], SQL[name])


def test_one_query_each():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("table", ["given", "ugly"])
def test_mix_query_by_tokens(spark, table):
    """The query against the rule in SQL, over counts by the plain vocabulary file; clashing columns are there too."""
    from tokenizers import Tokenizer

    from helixtab.llm import mixing, tokens

    if table == "given" and not os.path.isdir(FOLDER):
        pytest.skip("tables are not here")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet") if table == "given" else ugly(spark)
    docs = docs.withColumns({n: F.lit("mine") for n in ("domain", "n_tokens", "copies")})
    folder = new_folder(spark, "tables")
    docs.write.parquet(f"{folder}/documents.parquet")
    plain = Tokenizer.from_file(tokens.vocabulary_path())
    counted = docs.select("doc_id", "lang", "source", "text").toPandas().astype({"doc_id": "Int64"})
    counted["n"] = [len(plain.encode(t or "", add_special_tokens=False).ids) for t in counted.pop("text")]
    con = duckdb.connect()
    con.register("documents", counted)
    check(spark, con, folder, QUERIES["op3_source_mix"], mixing.oracle(tokens="n"))


def test_pipeline_mixes_by_tokens(spark, monkeypatch):
    """Budgets are tokens of the vocabulary, not bytes: both languages have the same bytes, one twice the tokens."""
    from tokenizers import Tokenizer

    from helixtab.llm import mixing, tokens

    plain = Tokenizer.from_file(tokens.vocabulary_path())
    texts = [("en", f"the house of the people {k:05d} and the water") for k in range(60)]
    texts += [("fr", f"q0z x9w 7kj v3b 8hg zzq {k:05d} jx k2w 0p4 3v") for k in range(60)] + [("en", None), ("fr", "a<|endoftext|>b")]
    docs = spark.createDataFrame([(k, t, lang, "src0") for k, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string, source string")
    seen = []
    mix = mixing.mix
    monkeypatch.setattr(mixing, "mix", lambda *a, **b: seen.append(mix(*a, **b)) or seen[-1])
    corpus_pipeline.mixed(spark, docs, "").count()
    rows = seen[0].collect()
    want = {k: len(plain.encode(t or "", add_special_tokens=False).ids) for k, (_, t) in enumerate(texts)}
    assert {r.doc_id: r["__tokens"] for r in rows} == want
    # the mix's budget is 80 % of these tokens, 5:2 between the languages as far as their supplies reach
    supply = {x: sum(want[k] for k, (lang, _) in enumerate(texts) if lang == x) for x in ("en", "fr")}
    share = {"en": min(2 * supply["en"], sum(want.values()) * 8 // 10 * 50 // 70)}
    share["fr"] = sum(want.values()) * 8 // 10 - share["en"]
    for lang in share:
        used = sum(want[r.doc_id] * r["__copies"] for r in rows if r.lang == lang)
        assert share[lang] - max(want.values()) - 1 <= used <= share[lang] + 1


@pytest.mark.parametrize("table", [ugly, nothing])
def test_pipeline(spark, table):
    folder = new_folder(spark, "tables")
    # names that the stages work with
    docs = table(spark).withColumns({n: F.lit("mine") for n in ("__domain", "__counted", "__tokens", "__scores", "__who", "__copy_key", "__copies")})
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = new_folder(spark, "stage")
        stage(spark, now, folder).write.parquet(path)
        now = spark.read.parquet(path)
        assert now.columns == docs.columns, name
        assert {r["__who"] + r["__copies"] for r in now.collect()} <= {"minemine"}, name
    rows = corpus_pipeline.run(spark, folder).collect()
    assert (len(rows) > 0) == (table is ugly)
