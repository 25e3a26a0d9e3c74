"""Whole table builds over domain tables, composed from the operators.

Each function takes and returns DataFrames with the column names of the domain tables; reading and
writing stay with the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions import cells, codon, delta, mutate, notation, rules
from helixtab.operators import edges as E
from helixtab.operators import filters, joins, quality, rollup, scan, select

LOCATIONS = [
    "Cytoplasm", "Nucleus", "Extracellular", "Cell membrane", "Mitochondrion",
    "Plastid", "Endoplasmic reticulum", "Lysosome/Vacuole", "Golgi apparatus", "Peroxisome",
]
MEMBRANE_TYPES = ["Peripheral", "Transmembrane", "Lipid anchor", "Soluble"]


def variant_changes(variants: DataFrame, assembly_column: str = "Assembly") -> DataFrame:
    """P-05, F-08, F-07: protein changes of the variants of one assembly.

    Variants without a protein part keep their row with the category ``no_protein_notation``.
    """
    accession, change = notation.split_name(F.col("Name"))
    named = filters.of_assembly(variants, assembly_column).withColumns(
        {"accession": accession, "_change": change}
    )
    parsed = notation.parse_three_letter(named, "_change")
    category = F.when(F.col("_change").isNull(), "no_protein_notation").otherwise(F.col("category"))
    return parsed.withColumn("category", category).select(
        "VariationID", "GeneID", "GeneSymbol", "accession", "category", "details"
    )


def mutant_table(changes: DataFrame, wild_types: DataFrame, id_column: str = "VariationID", three_letter: bool = True) -> DataFrame:
    """F-11, F-12, Q-11: every change with its mutant, its id and its outcome."""
    built = mutate.mutants_of(changes, wild_types.select("accession", "sequence"), three_letter=three_letter)
    mutant_id = F.concat_ws("_", F.col(id_column).cast("string"), "accession")
    return built.withColumn("mutant_id", F.when(F.col("outcome").startswith("built_"), mutant_id))


def score_deltas(
    variants: DataFrame, scores: DataFrame, score_key: str, columns: Sequence[str], label: str | None = None
) -> DataFrame:
    """J-06, J-07, F-28, F-32: wild type and mutant scores side by side with their difference.

    Rows with a missing side or a missing score stay, with ``pair_status`` telling why they have no
    difference.
    """
    texts = {n for n, kind in scores.dtypes if kind == "string"}
    raw = [c for c in columns if c in texts]
    numeric = joins.numeric_scores(scores, raw) if raw else scores.withColumn("score_status", F.lit("scored"))
    carried = [*columns, "score_status", *([label] if label else [])]
    pairs = joins.pair_with_wild_type(variants, numeric, "accession", "mutant_id", score_key, carried)
    unscored = (F.col("WT_score_status") != "scored") | (F.col("MUT_score_status") != "scored")
    status = F.when((F.col("pair_status") == "paired") & unscored, "unscored").otherwise(F.col("pair_status"))
    out = pairs.withColumn("pair_status", status).withColumns(delta.delta_columns(columns))
    if label:
        out = out.withColumns(
            {
                "WT_label": F.col(f"WT_{label}"),
                "MUT_label": F.col(f"MUT_{label}"),
                "label_changed": delta.label_changed(F.col(f"WT_{label}"), F.col(f"MUT_{label}")),
            }
        )
    return out.drop("WT_score_status", "MUT_score_status")


def gene_mutation_summary(genes: DataFrame, mutations: DataFrame) -> DataFrame:
    """A-07, J-28: mutation counts of every referenced gene that has any."""
    d = F.coalesce(F.col("MUTATION_DESCRIPTION"), F.lit(""))
    counts = rollup.entity_rollup(
        mutations,
        "COSMIC_GENE_ID",
        {"Distinct_Genomic_Mutations": "GENOMIC_MUTATION_ID", "Distinct_Samples": "COSMIC_SAMPLE_ID"},
        {
            "Confirmed_Somatic_Rows": F.col("MUTATION_SOMATIC_STATUS") == "Confirmed somatic variant",
            "Missense_Rows": d.contains("missense_variant"),
            "Truncating_Rows": d.contains("stop_gained") | d.contains("frameshift"),
            "Synonymous_Rows": d.contains("synonymous_variant"),
        },
        rows="Total_Mutation_Rows",
    )
    reference = genes.withColumn("ENSEMBL_GENE_ID", cells.strip_version(F.trim("GENE_ACCESSION"))).select(
        "COSMIC_GENE_ID", "GENE_SYMBOL", "ENSEMBL_GENE_ID", "ENTREZ_ID", "HGNC_ID", "IN_CANCER_CENSUS", "IS_EXPERT_CURATED"
    )
    return reference.join(counts, "COSMIC_GENE_ID")


def exact_match_transcripts(
    proteins: DataFrame, gene_transcripts: DataFrame, transcript_cds: DataFrame, transcript_rna: DataFrame
) -> DataFrame:
    """P-03, F-01, J-16, P-22: transcripts whose translation is the stored protein.

    Matched rows get transcript, method, CDS and RNA; the other rows stay as they are.
    """
    candidates = proteins.select(
        "uniprot_accession",
        cells.first_item(F.col("ensembl_gene")).alias("gene_id"),
        cells.blank_to_null(F.col("sequence")).alias("protein"),
    ).dropna()
    products = (
        gene_transcripts.where("has_translation")
        .join(transcript_cds.select("transcript_id", F.col("seq").alias("_cds")), "transcript_id")
        .select("gene_id", "transcript_id", "ord", codon.translate(F.col("_cds")).alias("protein"))
    )
    matched = joins.exact_product(candidates, products, "gene_id", "protein", "transcript_id", "ord")
    found = (
        matched.where("transcript_id is not null").select("uniprot_accession", "transcript_id")
        .join(transcript_cds.select("transcript_id", F.col("seq").alias("_cds")), "transcript_id", "left")
        .join(transcript_rna.select("transcript_id", F.col("seq").alias("_rna")), "transcript_id", "left")
    )
    updated = proteins.join(found, "uniprot_accession", "left")
    return filters.override(
        updated,
        F.col("transcript_id").isNotNull(),
        ensembl_transcript_used=F.col("transcript_id"),
        transcript_selection_method=F.lit("exact_translation_match"),
        cds_sequence=F.coalesce("_cds", F.lit("")),
        rna_sequence=F.coalesce("_rna", F.lit("")),
    ).drop("transcript_id", "_cds", "_rna")


def partner_columns(
    proteins: DataFrame, edges: DataFrame, resolution: DataFrame, external: DataFrame, threshold: int = 700,
    prefix: str = "9606.", max_items: int = 1000,
) -> DataFrame:
    """P-03, P-04, P-09, J-20, J-21: packed partner lists of every protein, all and in-table.

    ``resolution`` maps a queried id to its current one, ``external`` foreign ids to accessions with
    their order.  Lists come in numbered parts of at most ``max_items`` partners.
    """
    queried = proteins.select(
        F.col("uniprot_accession").alias("accession"), cells.first_item(F.col("ensembl_protein")).alias("id")
    ).where("id is not null")
    current = joins.canonical_id(queried, "id", resolution, "query_id", "resolved_id")
    both = E.directed(edges, "protein1", "protein2", "score", threshold).select(
        *[cells.strip_prefix(F.col(c), prefix).alias(c) for c in ("src", "dst")]
    )
    own = select.by_priority(
        [
            queried.select(F.col("id").alias("dst"), "accession"),
            current.select(F.col("id_resolved").alias("dst"), "accession"),
        ],
        "dst",
        ["accession"],
    )
    foreign = select.first_wins(
        external.select(F.col("from").alias("dst"), F.col("to").alias("accession"), "ord"), "dst", "ord"
    )
    starts = current.select(F.col("id_resolved").alias("src"), F.col("accession").alias("owner"))
    named = joins.resolve_endpoint(both.join(starts, "src"), "dst", own, foreign, "dst", "accession")
    pairs = named.where("accession is not null").select(
        F.col("owner").alias("src"), F.col("accession").alias("dst")
    ).distinct()
    inside = E.within(pairs, proteins, "uniprot_accession")
    rename = lambda df, name: df.select(
        F.col("src").alias("uniprot_accession"), "part", F.col("partners").alias(name)
    )
    return rename(E.partner_lists(pairs, max_items), "PPI_UniProt_Partners").join(
        rename(E.partner_lists(inside, max_items), "PPI_UniProt_Partners_in_Dataframe"),
        ["uniprot_accession", "part"],
        "full_outer",
    )


def annotation_columns(
    proteins: DataFrame, go_terms: DataFrame, tissue_rows: DataFrame, disease: DataFrame
) -> DataFrame:
    """J-02, P-10, F-47, K-08: GO, tissue and disease columns appended to a protein table.

    Rows are made distinct before they are packed, so a cell has at most one entry per term, or per
    tissue measurement, however often a source repeats it.
    """
    go = go_terms.select("accession", "aspect", "go_id", "term").distinct().groupBy(F.col("accession").alias("uniprot_accession")).pivot("aspect", ["C", "P", "F"]).agg(
        F.array_sort(F.collect_list(F.struct(F.col("go_id").alias("id"), F.col("term").alias("name"))))
    )
    go = go.select(
        "uniprot_accession",
        cells.pack_pairs(F.col("C")).alias("GO_Cellular_Component"),
        cells.pack_pairs(F.col("P")).alias("GO_Biological_Process"),
        cells.pack_pairs(F.col("F")).alias("GO_Molecular_Function"),
    )
    bulk = filters.bulk_only(
        tissue_rows, "celltypeBiosampleFromSource", "tissueBiosampleName", "tissueBiosampleFromSource", "tissue"
    )
    once = bulk.select("gene_id", "tissue", "datasourceId", "median", "unit").distinct()
    measured = F.struct("tissue", F.col("datasourceId").alias("source"), "median", "unit")
    tissues = once.groupBy("gene_id").agg(F.array_sort(F.collect_list(measured)).alias("_t")).select(
        "gene_id", cells.pack_measurements(F.col("_t")).alias("Tissue_Expression_Bulk")
    )
    diseases = disease.select(
        F.col("accession").alias("uniprot_accession"),
        cells.pack(F.col("diseaseId")).alias("OpenTargets_DiseaseId"),
        cells.pack(F.col("datatypeId")).alias("OpenTargets_DatatypeId"),
        cells.pack(F.col("score")).alias("OpenTargets_Score"),
    )
    keyed = proteins.withColumn("gene_id", cells.first_item(F.col("ensembl_gene")))
    sources = [(go, "uniprot_accession"), (tissues, "gene_id"), (diseases, "uniprot_accession")]
    return joins.enrich_all(keyed, sources, on_clash="overwrite").drop("gene_id")


def scan_predictions(
    aggregation: DataFrame, condensate: DataFrame, localization: DataFrame, motifs: DataFrame, verify: bool = True
) -> DataFrame:
    """J-08, Q-06, A-31: the score tables of a saturation scan side by side.

    The first three must hold the same mutations; the motif rows are collapsed first, so the result
    has one row per mutation.
    """
    if verify:
        quality.check_same_keys(
            {"aggregation": aggregation, "condensate": condensate, "localization": localization}, "mutation_id"
        )
    collapsed = rollup.packed_summary(
        motifs, "mutation_id", "elm_identifier", F.col("disrupts_motif") == "Y"
    ).withColumnsRenamed(
        {
            "n_items": "slim_n_motifs_overlapping",
            "items": "slim_elm_identifiers",
            "any_flagged": "slim_any_disrupts_motif",
            "flagged_items": "slim_disrupted_elm_identifiers",
        }
    )
    return joins.merge_tables([aggregation, condensate, localization], "mutation_id", [collapsed])


def scan_changes(predictions: DataFrame, baseline: DataFrame, parts: Mapping[str, Sequence[str]], label: str) -> DataFrame:
    """F-14, F-29, F-32: total absolute change per tool and mutation against the protein's baseline.

    ``baseline`` is unique on ``accession``; ``parts`` maps the name of a change to its score columns.
    A score that cannot be read leaves the change of its tool empty.
    """
    number = lambda c: c if isinstance(c, Column) else cells.parse_float(F.col(c).cast("string"))
    wt = baseline.select(
        "accession",
        F.trim(label).alias("_wt_label"),
        *[F.array(*[number(c) for c in cols]).alias(f"_wt_{n}") for n, cols in parts.items()],
    )
    ids = notation.parse_mutation_id(F.col("mutation_id"))
    joined = predictions.withColumns(ids).where("accession is not null").join(wt, "accession", "left")
    changes = {
        n: delta.total_abs_delta(F.col(f"_wt_{n}"), F.array(*[number(c) for c in cols])) for n, cols in parts.items()
    }
    changed = F.trim(F.col(label)) != F.col("_wt_label")
    return joined.select(
        "mutation_id", *ids, *[c.alias(n) for n, c in changes.items()], changed.alias("label_changed")
    )


def scan_change_summary(changes: DataFrame, parts: Sequence[str]) -> DataFrame:
    """A-13: mean changes by wild-type residue, mutant residue, pair and protein."""
    measures = {f"mean_{p}": F.avg(p) for p in parts}
    measures["frac_label_changed"] = F.avg(F.col("label_changed").cast("int"))
    groups = [["wt_aa"], ["mut_aa"], ["wt_aa", "mut_aa"], ["accession"]]
    return rollup.grouped_means(changes, groups, measures, "n_mutations")


def observed_distributions(
    changes: DataFrame, observed: DataFrame, value: str, stride: int = 60
) -> DataFrame:
    """J-15, W-15, A-44: distribution of a change in observed variants and in a systematic background.

    ``observed`` has gene, position, wt_aa, mut_aa and bucket; a mutation counts in each of its buckets.
    """
    key = ["gene", "position", "wt_aa", "mut_aa"]
    matched = joins.composite_match(changes, observed, key, "bucket").select("bucket", value)
    background = scan.every_nth(changes.select("mutation_id", value), "mutation_id", stride).select(
        F.lit("background").alias("bucket"), value
    )
    return scan.distribution(
        matched.unionAll(background), "bucket", value, {"q1": 0.25, "median": 0.5, "q3": 0.75}
    )


def conservation_table(
    transcripts: DataFrame, conservation: DataFrame, similarity: DataFrame, orthologs: Mapping[str, DataFrame]
) -> DataFrame:
    """P-22, W-06, A-39: transcripts with conservation, similarity and the best ortholog per species.

    ``orthologs`` lists the species from near to far.
    """
    out = transcripts.join(similarity, ["GeneSymbol", "UniProtID"], "left")
    share = "input_residues_in_scored_protein"
    out = filters.override(out, F.coalesce(F.col("length_matches_input"), F.lit(False)), **{share: F.lit(1.0)})
    out = out.join(conservation, "ensembl_transcript_id", "left")
    for species, table in orthologs.items():
        known = table.where("gene is not null")
        order = [(F.col("orthology_type") == "ortholog_one2one").desc(), F.col("pid_query").desc_nulls_last(), F.col("gene").asc()]
        best = select.best_row(known, "ensembl_gene_id", order, "n_orthologs").select(
            "ensembl_gene_id", *[F.col(c).alias(f"{species}_{c}") for c in ("orthology_type", "pid_query", "n_orthologs")]
        )
        out = out.join(best, "ensembl_gene_id", "left")
    kind = lambda s: F.col(f"{s}_orthology_type")
    steps = rollup.ladder([kind(s).isNotNull() for s in orthologs], list(orthologs))
    one2one = F.lit(0)
    for s in orthologs:
        one2one = one2one + F.coalesce((kind(s) == "ortholog_one2one").cast("int"), F.lit(0))
    mapped = F.col("match_type") != "none"
    return out.withColumns(
        {
            "n_species_with_ortholog": F.when(mapped, steps["n_reached"]),
            "n_species_one2one": F.when(mapped, one2one),
            "deepest_ortholog_species": F.when(mapped, steps["deepest"]),
        }
    )


def conservation_summary(table: DataFrame, score: str, coverage: str) -> DataFrame:
    """W-07, W-08, F-40: percentile, tier and reliability of one conservation score."""
    mapped = F.col("match_type") != "none"
    ranked = scan.percentile_rank(table.withColumn("_s", F.when(mapped, F.col(score))), "_s", "_p")
    percentile = F.bround(F.col("_p") * 100, 1)
    reliable, note = rules.reliability(
        mapped,
        {
            "scored isoform covers <90% of the input protein": F.col("input_residues_in_scored_protein") >= 0.9,
            "<90% of CDS bases have alignment data": F.col(coverage) >= 0.9,
        },
        "not mapped to an Ensembl transcript",
    )
    return ranked.select(
        "GeneSymbol",
        "UniProtID",
        F.bround(score, 3).alias("score"),
        percentile.alias("conservation_percentile"),
        rules.tier(percentile, mapped).alias("conservation_tier"),
        reliable.alias("score_reliable"),
        note.alias("reliability_note"),
    )
