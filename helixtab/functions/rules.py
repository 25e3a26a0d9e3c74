"""Rule-based classification with evidence.  Rules are data; the functions build expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions import terms
from helixtab.functions.cells import id_term_entries, packed_items


def any_word(text: Column, words: Sequence[str]) -> Column:
    """Does the text contain one of the words?"""
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return hit


def first_rule(rules: Sequence[tuple[Column, str | Column]], otherwise: str | Column) -> Column:
    """F-41: label of the first rule that holds."""
    out = None
    for cond, label in rules:
        label = F.lit(label) if isinstance(label, str) else label
        out = F.when(cond, label) if out is None else out.when(cond, label)
    other = F.lit(otherwise) if isinstance(otherwise, str) else otherwise
    return other if out is None else out.otherwise(other)


def gene_category(
    name: Column,
    symbols: Column,
    has_gene_id: Column | None = None,
    variant: str = "missing",
    id_test_first: bool = False,
) -> Column:
    """F-17: ordered keyword category of a gene from its name and ``;``-joined symbols.

    ``variant`` picks one of the slightly different rule sets: ``missing`` and ``no_map`` test the
    wording of immunoglobulin chains and a trailing ``p`` of name and symbols together;
    ``fixable`` tests the symbols alone.  The keyword rules run before the test for a missing gene
    id, which undercounts that class; ``id_test_first`` runs it first.
    """
    both = F.lower(F.concat_ws(" ", F.coalesce(name, F.lit("")), F.coalesce(symbols, F.lit(""))))
    sym = F.coalesce(symbols, F.lit(""))
    if variant == "fixable":
        ig_words = terms.IG_WORDS
        pseudo = F.rtrim(F.regexp_replace(F.upper(sym), ";+$", "")).endswith("P")
        pseudo_label, other = "Pseudogene (symbol ends in P)", "UNCLASSIFIED (potentially fixable)"
    else:
        ig_words = [*terms.IG_WORDS, *terms.IG_NAME_WORDS]
        pseudo = F.trim(both).endswith("p") & F.exists(
            F.split(sym, ";"), lambda g: g.endswith("P")
        )
        pseudo_label = "Pseudogene (gene symbol ends in P)"
        other = (
            "Other/unclassified"
            if variant == "no_map"
            else "Other/unclassified (searched all transcripts, no exact match)"
        )
    rules: list[tuple[Column, str]] = [
        (any_word(both, terms.TCR_WORDS), "TCR gene segment"),
        (any_word(both, ig_words), "Immunoglobulin gene segment"),
        (pseudo & ~both.contains("-as1"), pseudo_label),
        (any_word(both, terms.NONCODING_WORDS), "Antisense/lncRNA/uncharacterized locus"),
        (
            F.lower(sym).contains("mt-") | both.contains("mitochondri"),
            "Mitochondrial-encoded micropeptide",
        ),
    ]
    if has_gene_id is not None:
        no_id = (~has_gene_id, "No ensembl_gene at all")
        rules = [no_id, *rules] if id_test_first else [*rules, no_id]
    return first_rule(rules, other)


def mismatch_category(
    symbols: Column, name: Column, listed_exception: Column
) -> Column:
    """F-17: functional category of a translation mismatch."""
    text = F.lower(F.concat_ws(" ", F.coalesce(symbols, F.lit("")), F.coalesce(name, F.lit(""))))
    nothing = (F.coalesce(symbols, F.lit("")) == "") & (F.coalesce(name, F.lit("")) == "")
    return first_rule(
        [
            (
                listed_exception | text.contains("selenoprotein"),
                "Selenoprotein (confirmed via UniProt annotation)",
            ),
            (
                any_word(
                    text,
                    ["immunoglobulin", "t cell receptor", " ig ", "kappa constant", "lambda constant"],
                ),
                "Immunoglobulin/TCR",
            ),
            (text.contains("mitochondri"), "Mitochondrial"),
            (text.contains("readthrough"), "Annotated readthrough gene"),
            (any_word(text, ["pseudogene", "putative"]), "Pseudogene/putative"),
            (nothing, "No UniProt annotation returned"),
        ],
        "Other/unclassified",
    )


def biotype_category(biotype: Column) -> Column:
    """F-18: category from an authoritative biotype."""
    listed = lambda words: biotype.isin(*words)
    return first_rule(
        [
            (listed(terms.IG_BIOTYPES), "Immunoglobulin gene segment"),
            (listed(terms.TCR_BIOTYPES), "TCR gene segment"),
            (listed(terms.MITO_BIOTYPES), "Mitochondrial-encoded micropeptide"),
            (biotype.endswith("pseudogene"), "Pseudogene"),
            (listed(terms.NONCODING_BIOTYPES), "Antisense/lncRNA/uncharacterized locus"),
            (biotype == "protein_coding", "Protein-coding (genuine no-exact-match case)"),
            (biotype == "NOT_FOUND", "Ensembl ID not found / retired"),
        ],
        F.concat(F.lit("Other biotype: "), biotype),
    )


def normal_label(label: Column, prefixes: Sequence[str] = ("Pseudogene", "Other/unclassified")) -> Column:
    """F-19: a label cut back to the prefix it starts with."""
    return first_rule([(label.startswith(p), p) for p in prefixes], label)


def listed_terms(entries: Column, labels: Mapping[str, str]) -> Column:
    """F-21: sorted ``id:label`` texts of the allowed ids present."""
    present = F.array_intersect(
        F.transform(entries, lambda e: e["id"]), F.array(*[F.lit(i) for i in sorted(labels)])
    )
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.transform(
        F.sort_array(present), lambda i: F.concat_ws(":", i, F.try_element_at(table, i))
    )


def keyword_hits(
    entries: Column, keywords: Sequence[str], excluded_ids: Sequence[str], relabelled: Mapping[str, str]
) -> Column:
    """F-22: keywords found in entries that are not excluded, then the labels of relabelled ids.

    Keywords come in the order of the entries that hold them, each once.
    """
    kept = F.filter(entries, lambda e: ~e["id"].isin(*excluded_ids))
    words = F.array(*[F.lit(k) for k in keywords])
    found = F.array_distinct(
        F.flatten(
            F.transform(
                kept, lambda e: F.filter(words, lambda k: F.contains(F.lower(e["entry"]), k))
            )
        )
    )
    ids = F.transform(entries, lambda e: e["id"])
    extra = F.filter(
        F.array(*[F.struct(F.lit(i).alias("id"), F.lit(t).alias("label")) for i, t in relabelled.items()]),
        lambda x: F.array_contains(ids, x["id"]),
    )
    return F.concat(found, F.transform(extra, lambda x: x["label"]))


def with_machine_flags(df: DataFrame, packed: str) -> DataFrame:
    """F-21 and F-22 together: Y/N flag and evidence of three kinds of RNA-protein machine.

    All of it is per-row work in one stage; the parsed cell is a column of its own, so that it is
    parsed once for all flags.
    """
    entries = F.col("_entries")
    evidence = {
        "Ribosomal_protein": listed_terms(entries, terms.RIBOSOME_TERMS),
        "Spliceosomal_protein": listed_terms(entries, terms.SPLICEOSOME_TERMS),
        "Other_RNP_machine": keyword_hits(
            entries,
            terms.OTHER_MACHINE_KEYWORDS,
            terms.OTHER_MACHINE_EXCLUDED,
            terms.RELABELLED_TERMS,
        ),
    }
    read = df.withColumn("_entries", id_term_entries(F.col(packed)))
    return _with_evidence(read, evidence).drop("_entries")


def _with_evidence(df: DataFrame, evidence: Mapping[str, Column]) -> DataFrame:
    """Evidence columns first and the flags from them, so that no evidence is worked out twice."""
    found = df.withColumns({f"{n}_terms": F.array_join(hits, ";") for n, hits in evidence.items()})
    return found.withColumns(
        {n: F.when(F.col(f"{n}_terms") != "", "Y").otherwise("N") for n in evidence}
    )


def with_prefix_classes(
    df: DataFrame, packed: str, classes: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """F-23: per class, Y/N and the entries that start with one of its ids (of equal length)."""
    if classes is None:
        classes = terms.RNA_CLASS_FUNCTION_IDS

    def matching(ids: Sequence[str]) -> Column:
        starts = lambda e: F.substr(e, F.lit(1), F.lit(len(ids[0]))).isin(*ids)
        return F.filter("_items", starts)

    read = df.withColumn("_items", packed_items(F.col(packed)))
    return _with_evidence(read, {c: matching(list(i)) for c, i in classes.items()}).drop("_items")


def substring_flag(packed: Column, term_id: str) -> Column:
    """F-25: the older form, an id anywhere in the cell."""
    return F.when(F.coalesce(packed, F.lit("")).contains(term_id), "Y").otherwise("N")


def gap_filled(
    df: DataFrame,
    function_terms: str,
    process_terms: str,
    family: str,
    classes: Sequence[str],
    general_id: str = terms.GENERAL_RNA_BINDING,
    process_ids: Mapping[str, Sequence[str]] | None = None,
    families: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """F-24: fill classes from two more sources where only the general term is known.

    Updates each class flag and adds ``<class>_source``: ``MF`` where the flag stood already,
    otherwise ``BP``, ``Family`` or ``BP+Family`` for a filled class and an empty text for none.
    """
    if process_ids is None:
        process_ids = terms.RNA_CLASS_PROCESS_IDS
    families = terms.RNA_CLASS_FAMILIES if families is None else families
    any_class = F.lit(False)
    for c in classes:
        any_class = any_class | (F.trim(F.col(c)) == "Y")
    is_gap = F.coalesce(F.col(function_terms), F.lit("")).contains(general_id) & ~any_class
    ids = F.transform(id_term_entries(F.col(process_terms)), lambda e: e["id"])
    # only gap rows have their other sources read
    rows = df.withColumn("_ids", F.when(is_gap, ids))
    sources: dict[str, Column] = {}
    for c in classes:
        wanted = F.array(*[F.lit(i) for i in process_ids.get(c, [])]).cast("array<string>")
        by_process = F.arrays_overlap("_ids", wanted)
        by_family = F.col("_ids").isNotNull() & any_word(
            F.coalesce(F.col(family), F.lit("")), list(families.get(c, []))
        )
        sources[f"{c}_source"] = F.when(F.trim(F.col(c)) == "Y", "MF").otherwise(
            F.concat_ws("+", F.when(by_process, "BP"), F.when(by_family, "Family"))
        )
    filled = {c: F.when(F.col(f"{c}_source") != "", "Y").otherwise(F.col(c)) for c in classes}
    return rows.withColumns(sources).withColumns(filled).drop("_ids")


def class_coverage(df: DataFrame, packed: str, flags: Sequence[str], general_id: str) -> DataFrame:
    """A-49: rows with the general term, with any class, with the term but no class, and per class."""
    general = F.coalesce(F.col(packed), F.lit("")).contains(general_id)
    any_class = F.lit(False)
    for f in flags:
        any_class = any_class | (F.col(f) == "Y")
    measures = {
        "total": F.lit(True),
        "general_term": general,
        "any_class": any_class,
        "gap": general & ~any_class,
        **{f: F.col(f) == "Y" for f in flags},
    }
    row = df.agg(*[F.count_if(c).alias(n) for n, c in measures.items()])
    return row.unpivot([], list(measures), "measure", "n")


def candidate_terms(
    df: DataFrame, packed: str, patterns: Mapping[str, str], sep: str = ";"
) -> DataFrame:
    """A-48: how often each term occurs among the entries that match a keyword.

    Entries are counted before keywords are tested, so each regex runs once per distinct term.
    """
    counts = (
        df.select(F.explode(packed_items(F.col(packed), sep)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    hits = F.filter(
        F.array(*[F.when(F.col("term").rlike(p), F.lit(k)) for k, p in patterns.items()]),
        lambda k: k.isNotNull(),
    )
    return counts.select(F.explode(hits).alias("keyword"), "term", "n")


def significance_bucket(label: Column) -> Column:
    """F-26: by exact label."""
    return first_rule(
        [(label.isin(*terms.PATHOGENIC), "pathogenic"), (label.isin(*terms.BENIGN), "benign")],
        "uncertain",
    )


def significance_group(label: Column) -> Column:
    """F-27: by wording, in order."""
    low = F.lower(F.coalesce(label, F.lit("")))
    return first_rule(
        [
            (low.contains("conflicting"), "Conflicting"),
            (low.contains("pathogenic") & ~low.contains("benign"), "Pathogenic/Likely pathogenic"),
            (low.contains("benign") & ~low.contains("pathogenic"), "Benign/Likely benign"),
            (low.contains("uncertain"), "Uncertain significance"),
        ],
        "Other/Unknown",
    )


def tier(percentile: Column, mapped: Column, high: float = 75, low: float = 25) -> Column:
    """W-08: high, low or medium; blank when unmapped.  A missing percentile reads as medium."""
    return first_rule(
        [(~mapped, ""), (percentile >= high, "high"), (percentile <= low, "low")], "medium"
    )


def reliability(mapped: Column, checks: Mapping[str, Column], unmapped_note: str) -> tuple[Column, Column]:
    """F-40: all checks hold, and the joined reasons where they do not."""
    ok = mapped
    for c in checks.values():
        ok = ok & F.coalesce(c, F.lit(False))
    reasons = F.concat_ws(
        "; ", *[F.when(~F.coalesce(c, F.lit(False)), F.lit(r)) for r, c in checks.items()]
    )
    return ok, F.when(~mapped, F.lit(unmapped_note)).otherwise(reasons)
