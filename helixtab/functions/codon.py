"""Codon translation, coding-sequence checks and codon arithmetic as column expressions."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard genetic code, residues listed for codons in T, C, A, G order.
BASES = "TCAG"
RESIDUES = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"

STOP_CODONS = ("TAA", "TAG", "TGA")


def codon_table() -> dict[str, str]:
    return {"".join(c): aa for c, aa in zip(product(BASES, repeat=3), RESIDUES)}


def _codon_map() -> Column:
    cells: list[Column] = []
    for codon, aa in codon_table().items():
        cells += [F.lit(codon), F.lit(aa)]
    return F.create_map(*cells)


def translate(cds: Column) -> Column:
    """F-01: residues of the in-frame codons before the first stop.

    Trailing bases are ignored and an unknown codon reads as ``X``.
    The codons come from one regex pass: substrings by position would rescan the text each time.
    """
    codons = F.regexp_extract_all(cds, F.lit("(?s)..."), 0)
    table = _codon_map()
    residues = F.transform(codons, lambda c: F.coalesce(F.try_element_at(table, c), F.lit("X")))
    return F.substring_index(F.array_join(residues, ""), "*", 1)


def starts_with_atg(cds: Column) -> Column:
    return cds.startswith("ATG")


def whole_codons(cds: Column) -> Column:
    return F.length(cds) % 3 == 0


def ends_in_stop(cds: Column) -> Column:
    return F.right(cds, F.lit(3)).isin(*STOP_CODONS)


def only_bases(cds: Column) -> Column:
    """Only the letters A, C, G, T and N."""
    return cds.rlike("^[ACGTN]*$")


def cds_checks(cds: Column, rna: Column) -> dict[str, Column]:
    """F-02 and F-03: one flag per check."""
    return {
        "starts_atg": starts_with_atg(cds),
        "len_multiple_of_3": whole_codons(cds),
        "ends_in_stop": ends_in_stop(cds),
        "valid_bases": only_bases(cds),
        "cds_in_rna": F.contains(rna, cds),
    }


def mismatch_class(
    cds: Column, protein: Column, translated: Column, known_exception: Column, n_genes: Column
) -> Column:
    """F-04: why a translation does or does not equal the stored protein."""
    blank = lambda c: c.isNull() | (c == "")
    return (
        F.when(blank(cds) | blank(protein), "no_cds_or_protein")
        .when(translated == protein, "exact_match")
        .when(translated == F.concat(F.lit("X"), protein), "x_prefix_benign")
        .when(known_exception, "selenoprotein_explained")
        .when(n_genes > 1, "multigene_ambiguous")
        .otherwise("unexplained_mismatch")
    )


def length_relation(translated: Column, protein: Column) -> Column:
    """F-06: is the translation shorter or longer than the protein, or equally long."""
    return (
        F.when(F.length(translated) < F.length(protein), "shorter")
        .when(F.length(translated) > F.length(protein), "longer")
        .otherwise("same_length")
    )


def stopping_codon(cds: Column, translated: Column) -> Column:
    """F-06: the codon at which the translation ended."""
    return F.substr(cds, F.length(translated) * 3 + 1, F.lit(3))


def codon_number(cds_pos: Column) -> Column:
    """F-39: 1-based codon of a 1-based coding position."""
    return F.floor((cds_pos - 1) / 3).cast("bigint") + 1


def codon_position(cds_pos: Column) -> Column:
    """F-39: 1, 2 or 3, the place inside the codon."""
    return ((cds_pos - 1) % 3 + 1).cast("int")


def residue_at(peptide: Column, number: Column) -> Column:
    """F-39: residue by 1-based number, ``*`` right after the last one."""
    return F.substr(F.concat(peptide, F.lit("*")), number.cast("int"), F.lit(1))


def encodes_length(cds_length: Column, protein_length: Column) -> Column:
    """F-43: the coding length without its stop codon is the protein length."""
    return cds_length / 3 - 1 == protein_length


def half_open(start_1based: Column) -> Column:
    """F-44: 0-based start of a 1-based inclusive interval; the end stays as it is."""
    return start_1based - 1
