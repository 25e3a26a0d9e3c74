"""Whole builds on small domain tables."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from helixtab.operators.quality import QualityError, check_diff_clean, table_diff
from helixtab.plans import builds as B


def test_variants_to_deltas(spark):
    variants = spark.createDataFrame(
        [
            (1, 10, "G1", "NM_1.1(G1):c.5G>A (p.Gly2Arg)", "GRCh38"),
            (1, 10, "G1", "NM_1.1(G1):c.5G>A (p.Gly2Arg)", "GRCh37"),
            (2, 10, "G1", "NM_1.1(G1):c.5G>A (p.Ala2Arg)", "GRCh38"),
            (3, 10, "G1", "NM_1.1(G1):c.8del (p.Lys3fs)", "GRCh38"),
            (4, 10, "G1", "NC_1:g.5A>G", "GRCh38"),
            (5, 11, "G2", "NM_2.1(G2):c.1A>G (p.Lys3Ter)", "GRCh38"),
            (6, 12, "G3", "NM_1.1(G1):c.9A>G (p.Lys3Ter)", "GRCh38"),
        ],
        "VariationID int, GeneID int, GeneSymbol string, Name string, Assembly string",
    )
    wild = spark.createDataFrame([("NM_1.1", "NP_1", "MGKL")], "accession string, protein_id string, sequence string")
    mutants = B.mutant_table(B.variant_changes(variants), wild)
    assert {(r.VariationID, r.outcome, r.mutant, r.mutant_id) for r in mutants.collect()} == {
        (1, "built_missense", "MRKL", "1_NM_1.1"), (2, "mismatch_or_invalid", None, None), (3, "skip_frameshift", None, None),
        (4, "skip_no_protein_notation", None, None), (5, "skip_no_wt_seq", None, None), (6, "built_nonsense", "MG", "6_NM_1.1"),
    }
    scores = spark.createDataFrame(
        [("NM_1.1", "Nucleus", "0.25", "0.5"), ("1_NM_1.1", "Cytoplasm|Nucleus", "0.75", "0.5"), ("6_NM_1.1", "Nucleus", "OOM", "0.5")],
        "Protein_ID string, Localizations string, Nucleus string, Cytoplasm string",
    )
    built = mutants.where("mutant_id is not null").select("VariationID", "accession", "mutant_id")
    out = B.score_deltas(built, scores, "Protein_ID", ["Nucleus", "Cytoplasm"], "Localizations")
    got = {r.VariationID: (r.pair_status, r.DELTA_Nucleus, r.DELTA_Cytoplasm, r.label_changed) for r in out.collect()}
    assert got == {1: ("paired", 0.5, 0.0, 1), 6: ("unscored", None, 0.0, 0)}


def test_gene_summary(spark):
    genes = spark.createDataFrame(
        [("C1", "TP53", "ENSG1.5", "7157", "H1", "y", "n"), ("C2", "NOPE", "", "", "", "n", "n")],
        "COSMIC_GENE_ID string, GENE_SYMBOL string, GENE_ACCESSION string, ENTREZ_ID string, HGNC_ID string, IN_CANCER_CENSUS string, IS_EXPERT_CURATED string",
    )
    muts = spark.createDataFrame(
        [
            ("C1", "m1", "s1", "Confirmed somatic variant", "missense_variant"), ("C1", "m1", "s2", "x", "stop_gained"),
            ("C1", "", "", "x", "frameshift_variant"), ("", "m9", "s9", "x", "synonymous_variant"), ("C9", "m9", "s9", "x", None),
        ],
        "COSMIC_GENE_ID string, GENOMIC_MUTATION_ID string, COSMIC_SAMPLE_ID string, MUTATION_SOMATIC_STATUS string, MUTATION_DESCRIPTION string",
    )
    assert rows(B.gene_mutation_summary(genes, muts)) == [
        ("C1", "TP53", "ENSG1", "7157", "H1", "y", "n", 3, 1, 2, 1, 1, 2, 0)
    ]


def test_exact_match(spark):
    proteins = spark.createDataFrame(
        [("P1", "ENSG1.2;ENSG9", "MK", "old", "m", "x", "y"), ("P2", "ENSG2", "MV", "old", "m", "x", "y"), ("P3", "", "MK", "", "", "", "")],
        "uniprot_accession string, ensembl_gene string, sequence string, ensembl_transcript_used string, transcript_selection_method string, rna_sequence string, cds_sequence string",
    )
    tx = spark.createDataFrame(
        [("ENSG1", "T1", True, 1), ("ENSG1", "T2", True, 2), ("ENSG1", "T3", True, 3), ("ENSG2", "T4", True, 4), ("ENSG1", "T0", False, 0)],
        "gene_id string, transcript_id string, has_translation boolean, ord int",
    )
    cds = spark.createDataFrame([("T0", "ATGAAG"), ("T1", "ATGGTTTAA"), ("T2", "ATGAAATAA"), ("T3", "ATGAAGTAA"), ("T4", "ATGAAATAA")], "transcript_id string, seq string")
    rna = spark.createDataFrame([("T2", "GGATGAAATAACC")], "transcript_id string, seq string")
    out = B.exact_match_transcripts(proteins, tx, cds, rna)
    got = {r.uniprot_accession: (r.ensembl_transcript_used, r.transcript_selection_method, r.cds_sequence, r.rna_sequence) for r in out.collect()}
    assert got == {
        "P1": ("T2", "exact_translation_match", "ATGAAATAA", "GGATGAAATAACC"), "P2": ("old", "m", "y", "x"), "P3": ("", "", "", "")
    }
    assert sorted(out.columns) == sorted(proteins.columns)


def test_partner_columns(spark):
    proteins = spark.createDataFrame([("A", "E1.1;E7"), ("B", "E2"), ("C", "")], "uniprot_accession string, ensembl_protein string")
    edges = spark.createDataFrame(
        [("9606.E1x", "9606.E2", 900), ("9606.E2", "9606.E5", 800), ("9606.E1x", "9606.E6", 750), ("9606.E1x", "9606.E5", 100), ("9606.E1x", "9606.E99", 900)],
        "protein1 string, protein2 string, score int",
    )
    resolution = spark.createDataFrame([("E1", "E1x")], "query_id string, resolved_id string")
    external = spark.createDataFrame([("E5", "X5", 1), ("E5", "X5b", 2), ("E6", "C", 3), ("E2", "WRONG", 4)], "from string, to string, ord int")
    got = {r.uniprot_accession: (r.PPI_UniProt_Partners, r.PPI_UniProt_Partners_in_Dataframe) for r in B.partner_columns(proteins, edges, resolution, external).collect()}
    assert got == {"A": ("B;C", "B;C"), "B": ("A;X5", "A")}


def test_annotation_columns_leave_the_table_intact(spark):
    proteins = spark.createDataFrame([("A", "ENSG1.1", "s"), ("B", "ENSG2", "t")], "uniprot_accession string, ensembl_gene string, sequence string")
    go = spark.createDataFrame([("A", "C", "GO:2", "b"), ("A", "C", "GO:1", "a"), ("A", "F", "GO:3", "c")], "accession string, aspect string, go_id string, term string")
    tissue = spark.createDataFrame(
        [("ENSG1", None, "liver src", None, "d1", "t", "TPM", 1.23456), ("ENSG1", "blood", "x", "", "d1", "t", "TPM", None), ("ENSG1", "skin", "x", "T cell", "d1", "t", "TPM", 9.0)],
        "gene_id string, tissueBiosampleName string, tissueBiosampleFromSource string, celltypeBiosampleFromSource string, datasourceId string, datatypeId string, unit string, median double",
    )
    disease = spark.createDataFrame([("A", ["D1", "D2"], ["x", "y"], ["0.5", "0.1"])], "accession string, diseaseId array<string>, datatypeId array<string>, score array<string>")
    out = B.annotation_columns(proteins, go, tissue, disease)
    check_diff_clean(table_diff(proteins, out, "uniprot_accession"))
    got = {r.uniprot_accession: tuple(r)[3:] for r in out.select(*proteins.columns, "GO_Cellular_Component", "GO_Biological_Process", "GO_Molecular_Function", "Tissue_Expression_Bulk", "OpenTargets_DiseaseId", "OpenTargets_Score").collect()}
    assert got == {
        "A": ("GO:1:a;GO:2:b", "", "GO:3:c", "blood|d1||TPM;liver src|d1|1.2346|TPM", "D1;D2", "0.5;0.1"), "B": ("", "", "", "", "", "")
    }


def test_saturation_scan(spark):
    ids = ["P1|G|A1C", "P1|G|A1D", "P1|G|K2C", "odd"]
    agg = spark.createDataFrame([(i, str(n)) for n, i in enumerate(ids)], "mutation_id string, AGG string")
    con = spark.createDataFrame([(i, "0.5" if n else "NA", "0.25") for n, i in enumerate(ids)], "mutation_id string, c1 string, c2 string")
    loc = spark.createDataFrame([(i, "Nucleus" if n % 2 else "Cytoplasm") for n, i in enumerate(ids)], "mutation_id string, Localizations string")
    slim = spark.createDataFrame([(ids[0], "E2", "Y"), (ids[0], "E1", "N")], "mutation_id string, elm_identifier string, disrupts_motif string")
    wide = B.scan_predictions(agg, con, loc, slim)
    first = wide.where(F.col("mutation_id") == ids[0]).first()
    assert (first.slim_n_motifs_overlapping, first.slim_elm_identifiers, first.slim_any_disrupts_motif, first.slim_disrupted_elm_identifiers) == (2, "E1;E2", "Y", "E2")
    assert wide.count() == 4
    with pytest.raises(QualityError):
        B.scan_predictions(agg.limit(3), con, loc, slim)
    base = spark.createDataFrame([("P1", "1", "0.5", "0.5", "Nucleus ")], "accession string, AGG string, c1 string, c2 string, Localizations string")
    parts = {"agg": ["AGG"], "condensate": ["c1", "c2"]}
    changes = B.scan_changes(wide, base, parts, "Localizations")
    got = {r.mutation_id: (r.gene, r.position, r.agg, r.condensate, r.label_changed) for r in changes.collect()}
    assert got == {ids[0]: ("G", 1, 1.0, None, True), ids[1]: ("G", 1, 0.0, 0.25, False), ids[2]: ("G", 2, 1.0, 0.25, True)}
    summary = {(r.grouping, r.wt_aa, r.mut_aa, r.accession): (r.n_mutations, r.mean_agg) for r in B.scan_change_summary(changes, list(parts)).collect()}
    assert summary[("wt_aa", "A", None, None)] == (2, 0.5) and summary[("accession", None, None, "P1")] == (3, 2 / 3)
    observed = spark.createDataFrame([("G", 1, "A", "C", "pathogenic"), ("G", 1, "A", "C", "somatic"), ("G", 9, "A", "C", "benign")], "gene string, position int, wt_aa string, mut_aa string, bucket string")
    dist = {r.bucket: (r.n, r["mean"]) for r in B.observed_distributions(changes, observed, "agg", stride=2).collect()}
    assert dist == {"pathogenic": (1, 1.0), "somatic": (1, 1.0), "background": (2, 1.0)}


def test_conservation(spark):
    tx = spark.createDataFrame(
        [("G1", "P1", "uniprot", "T1", "E1", True), ("G2", "P2", "symbol", "T2", "E2", False), ("G3", "P3", "none", None, None, None), ("G4", "P4", "uniprot", "T4", "E4", False)],
        "GeneSymbol string, UniProtID string, match_type string, ensembl_transcript_id string, ensembl_gene_id string, length_matches_input boolean",
    )
    cons = spark.createDataFrame([("T1", 5.0, 0.95), ("T2", 1.0, 0.5), ("T4", 3.0, 1.0)], "ensembl_transcript_id string, m double, cov double")
    sim = spark.createDataFrame([("G2", "P2", 0.4)], "GeneSymbol string, UniProtID string, input_residues_in_scored_protein double")
    mouse = spark.createDataFrame([("E1", "a", "ortholog_one2many", 99.0), ("E1", "b", "ortholog_one2one", 80.0), ("E2", None, "ortholog_one2one", 1.0)], "ensembl_gene_id string, gene string, orthology_type string, pid_query double")
    yeast = spark.createDataFrame([("E1", "y", "ortholog_many2many", 20.0)], "ensembl_gene_id string, gene string, orthology_type string, pid_query double")
    table = B.conservation_table(tx, cons, sim, {"mouse": mouse, "yeast": yeast})
    got = {r.GeneSymbol: (r.mouse_pid_query, r.mouse_n_orthologs, r.n_species_with_ortholog, r.n_species_one2one, r.deepest_ortholog_species, r.input_residues_in_scored_protein) for r in table.collect()}
    assert got == {
        "G1": (80.0, 2, 2, 1, "yeast", 1.0), "G2": (None, None, 0, 0, "none", 0.4), "G3": (None, None, None, None, None, None), "G4": (None, None, 0, 0, "none", None)
    }
    out = {r.GeneSymbol: (r.conservation_percentile, r.conservation_tier, r.score_reliable, r.reliability_note) for r in B.conservation_summary(table, "m", "cov").collect()}
    assert out == {
        "G1": (100.0, "high", True, ""),
        "G2": (33.3, "medium", False, "scored isoform covers <90% of the input protein; <90% of CDS bases have alignment data"),
        "G3": (None, "", False, "not mapped to an Ensembl transcript"),
        "G4": (66.7, "medium", False, "scored isoform covers <90% of the input protein"),
    }
