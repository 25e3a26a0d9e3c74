"""The queries of this subpackage: each operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, exactdup, hardneg, linealign, manifest, mixing, neardup, ngramjoin, packing, sharding, substrings, token_store, toxicity
from .common import LOWER, UPPER, new_folder, read_table, stage_texts

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """Encode all documents into a store with perfect hash indexes, and read it back through them."""
    path = new_folder(spark, "token-store")
    token_store.write_store(read_table(spark, folder, "documents"), path, end_id=2)
    return token_store.scan_store(spark, path)


def op2_bin_slack_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pack all documents into sequences of at most 2048 ids."""
    pieces = packing.cut_pieces(read_table(spark, folder, "documents"), capacity=2048, end_id=0)
    return packing.place_pieces(pieces.drop("ids"), capacity=2048)


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How often each document enters a mix with target weights by domain, language and source."""
    docs = read_table(spark, folder, "documents")
    counted = stage_texts(docs.select("doc_id", "lang", "source", mixing.token_count(F.col("text")).alias("n")), "counted")
    mixed = mixing.mix(mixing.with_domain(counted), F.col("n"))
    return mixed.select("doc_id", "domain", "lang", "source", "n_tokens", "copies")


def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share 80 % of their four-word shingles."""
    classes = neardup.near_classes(read_table(spark, folder, "documents"), width=4)
    return classes.select(
        "doc_id",
        F.col("n_shingles").cast("long").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op5_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return ann.nearest(read_table(spark, folder, "embeddings"), k=5, every=50)


def op6_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities of all documents by a chain of classifiers fitted on the labels."""
    docs = read_table(spark, folder, "documents")
    chain = toxicity.fit_chain(docs, read_table(spark, folder, "labels"), toxicity.label_categories())
    scored = toxicity.score(docs.select("doc_id", "text"), chain)
    return scored.select(
        "doc_id",
        F.col("scores.low_quality").alias("p_low_quality"),
        F.col("scores.toxic").alias("p_toxic"),
        (F.col("scores.toxic") >= toxicity.THRESHOLD).alias("toxic"),
    )


def op7_virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes."""
    rows = sharding.shard_documents(read_table(spark, folder, "documents"), new_folder(spark, "slot-map"), shards=8)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
    )


def op8_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each document without the 400-byte strings that stand elsewhere too."""
    rows = substrings.drop_repeats(read_table(spark, folder, "documents"), length=400)
    return rows.withColumn("n_kept", F.col("n_bytes") - F.col("n_removed"))


def op9_exact_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """For every document, which one of those with its text stays."""
    return exactdup.copy_classes(read_table(spark, folder, "documents"), keep_largest=True)


OP9_SQL = f"""
with t as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as text from documents)
select doc_id, max(doc_id) over (partition by text) as keep_id, count(*) over (partition by text) as group_size,
  doc_id = max(doc_id) over (partition by text) as kept, sha256(text) as text_sha256 from t
"""


def op10_aligned_lines(spark: SparkSession, folder: str) -> DataFrame:
    """How many lines of each document stand in an earlier, aligned one, and the hash of the rest."""
    rows = linealign.drop_aligned_lines(read_table(spark, folder, "documents"))
    return rows.select("doc_id", "copy", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_prefix_tree_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share 90 % of their three-word shingles."""
    return ngramjoin.ngram_classes(read_table(spark, folder, "documents"), width=3, percent=90)


def op12_path_copying_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, root and proof of every document, and the root of the version without its line feeds."""
    rows = manifest.manifest(
        read_table(spark, folder, "documents"),
        tampered=manifest.newlines_removed(),
        when=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0,
    )
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        manifest.proof_digest().alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _hashed(text: str) -> str:
    values = ["doc_id", "source", "lang", "n_chars", text]
    fields = [f"case when {v} is null then '-' else strlen({v}::varchar) || ':' || {v} end" for v in values]
    return f"sha256({' || '.join(fields)})"


#: crc32 bit by bit over the decimal digits, trees and versions level by level
OP12_SQL = f"""
with recursive marked as (
  select *, 4294967295 - list_reduce(
    list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, case when xor(c, x) & 1 = 1 then 3988292384 else 0 end)) as crc from documents),
leaf as (
  select doc_id, source, {_hashed("text")} as leaf,
    case when crc % 2 = 0 then {_hashed("replace(text, chr(10), '')")} end as other from marked),
base as (
  select *, coalesce(':' || source, '-') as grp,
    row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by source) as n from leaf),
tree as (
  select 0 as lvl, grp, pos, n, leaf as digest from base
  union all
  select lvl + 1, grp, pos // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' order by pos)) from tree where n > 1
  group by lvl, grp, pos // 3),
subroot as (select grp, digest as subroot, row_number() over (order by grp) - 1 as place, count(*) over () as n from tree where n = 1),
upper as (
  select 0 as lvl, place as pos, n, subroot as digest from subroot
  union all
  select lvl + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' order by pos)) from upper where n > 1 group by lvl, pos // 3),
run as (select *, list(digest) over w as ds, list(pos) over w as ps
  from tree window w as (partition by lvl, grp, pos // 3 order by pos rows between unbounded preceding and unbounded following)),
side as (select lvl, grp, pos, n, array_to_string(ds[1:list_position(ps, pos) - 1], '') as l, array_to_string(ds[list_position(ps, pos) + 1:], '') as r from run where n > 1),
upper_run as (select *, list(digest) over w as ds, list(pos) over w as ps
  from upper window w as (partition by lvl, pos // 3 order by pos rows between unbounded preceding and unbounded following)),
upper_side as (select lvl, pos, array_to_string(ds[1:list_position(ps, pos) - 1], '') as l, array_to_string(ds[list_position(ps, pos) + 1:], '') as r from upper_run where n > 1),
fold as (
  select doc_id, leaf, 0 as lvl, grp, pos, coalesce(other, leaf) as now, '' as proof, row_number() over () as id from base
  union all
  select doc_id, leaf, f.lvl + 1, f.grp, f.pos // 3, sha256(l || now || r), proof || l || r, id
  from fold f join side s on f.lvl = s.lvl and f.grp = s.grp and f.pos = s.pos),
folded as (select * from fold qualify row_number() over (partition by id order by lvl desc) = 1),
up as (
  select doc_id, leaf, subroot, 0 as lvl, place as pos, now, proof, id from folded join subroot using (grp)
  union all
  select doc_id, leaf, subroot, u.lvl + 1, u.pos // 3, sha256(l || now || r), proof || l || r, id
  from up u join upper_side s on u.lvl = s.lvl and u.pos = s.pos),
done as (select * from up qualify row_number() over (partition by id order by lvl desc) = 1)
select doc_id, leaf, subroot, (select digest from upper where n = 1) as root, sha256(proof) as proof_sha256, now as folded_root,
  now = (select digest from upper where n = 1) as verified from done
"""


def op13_angular_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of another label that score nearly as high with every hundredth vector as its positives do."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(read_table(spark, folder, "embeddings"), label=moved, every=100)


OP13_SQL = """
with v as (
  select row_number() over () as row, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.row, a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.q, b.q)::bigint as score
  from v a join v b on a.row <> b.row where a.vec_id % 100 = 0),
positive as (
  select row, anchor_id, vec_id as positive_id, score as positive_score,
    row_number() over (partition by row order by score desc, vec_id) as place
  from scored where same qualify place <= 5)
select anchor_id, positive_id,
  row_number() over (partition by row, place order by score desc, vec_id)::int as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positive join scored using (row, anchor_id)
where not same and 100 * score between 80 * positive_score and 100 * positive_score
qualify rank <= 5
"""


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_store,
        op2_bin_slack_packing,
        op3_source_mix,
        op4_near_duplicates,
        op5_nearest_vectors,
        op6_toxicity_chain,
        op7_virtual_slots,
        op8_repeated_strings,
        op9_exact_duplicates,
        op10_aligned_lines,
        op11_prefix_tree_join,
        op12_path_copying_manifest,
        op13_angular_hard_negatives,
    )
}
SQL: dict[str, str] = {
    "op9_exact_duplicates": OP9_SQL,
    "op12_path_copying_manifest": OP12_SQL,
    "op13_angular_hard_negatives": OP13_SQL,
}
