"""Protein-change notation to a category and its details, as column expressions.

A change is taken apart by one regex; an ordered list of rules over the parts then decides its
category and fills the details.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions.rules import first_rule

# Residue names of the three-letter dialect and their one-letter codes.
THREE_TO_ONE = {
    "Ala": "A", "Arg": "R", "Asn": "N", "Asp": "D", "Cys": "C",
    "Gln": "Q", "Glu": "E", "Gly": "G", "His": "H", "Ile": "I",
    "Leu": "L", "Lys": "K", "Met": "M", "Phe": "F", "Pro": "P",
    "Ser": "S", "Thr": "T", "Trp": "W", "Tyr": "Y", "Val": "V",
}
SELENOCYSTEINE = {"Sec": "U"}
EXTRA_NAMES = ("Ter", "Sec", "Xaa")
ONE_LETTER = "ACDEFGHIKLMNPQRSTVWY"
BUILDABLE = ("missense", "nonsense", "del", "ins", "delins", "dup")
DEFERRED_CLASSES = (
    "Deletion - Frameshift",
    "Insertion - Frameshift",
    "Complex - frameshift",
    "Frameshift",
    "Nonstop extension",
)
SILENT_CLASSES = ("Substitution - coding silent",)


def residue_code(name: Column, selenocysteine: bool = True) -> Column:
    """F-13: one-letter code of a three-letter residue name, null if it has none."""
    table = {**THREE_TO_ONE, **(SELENOCYSTEINE if selenocysteine else {})}
    cells = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*cells), name)


def split_name(name: Column) -> tuple[Column, Column]:
    """F-08: accession and protein part of a full variant name, both null without a protein part."""
    head = F.substring_index(name, "(", 1)
    # what follows the gene in brackets and a colon, from the protein part on
    rest = F.split(F.substring(name, F.length(head) + F.lit(1), F.length(name)), r"\):", 2)
    protein = F.get(F.split(F.get(rest, F.lit(1)), r"\(p\.", 2), F.lit(1))
    change = F.substring_index(protein, ")", 1)
    has = head.rlike(r"^[A-Z][A-Z]_[0-9]+[.][0-9]+$") & protein.contains(")") & (change != "")
    has = has & ~F.substring(F.get(rest, F.lit(0)), 2, 1_000_000).contains(")")
    return F.when(has, head), F.when(has, change)


def _int(c: Column) -> Column:
    return c.try_cast("int")


_SEP = "\u0001"
_THREE_SHAPE = r"^([A-Za-z]{3})(\d+)(?:_([A-Za-z]{3})(\d+))?(delins|ins|del|dup)?([A-Za-z]*)$"
_ONE_SHAPE = r"^p\.([A-Z])(\d+)(?:_([A-Z])(\d+))?(delins|ins|del|dup)?([A-Z*]*)$"


def _change_parts(change: Column, shape: str) -> Column:
    """First residue and position, second residue and position, operation and tail of a change.

    One regex pass per row; a change of another form gives an array of another size.
    """
    spelled = F.regexp_replace(change, shape, _SEP.join(f"${i}" for i in range(1, 7)))
    return F.split(spelled, _SEP)


class _Parts:
    """Names for the cells of the parts column."""

    def __init__(self, parts: Column):
        cell = lambda i: F.get(parts, F.lit(i))
        self.fits = F.size(parts) == 6
        self.residue, self.position = cell(0), _int(cell(1))
        self.is_range = cell(3) != ""
        self.end = F.when(self.is_range, _int(cell(3))).otherwise(self.position)
        self.end_residue = F.when(self.is_range, cell(2)).otherwise(self.residue)
        self.op, self.tail = cell(4), cell(5)

    def when(self, op: str, ranged: bool | None = None) -> Column:
        cond = self.fits & (self.op == op)
        return cond if ranged is None else cond & (self.is_range if ranged else ~self.is_range)

    def whole(self, op: str) -> Column:
        """A deletion or duplication, which has nothing after its name."""
        return self.when(op) & (self.tail == "")


def _details(
    category: Column, parts: _Parts, inserted: Column, n_inserted: Column, cut: Column, named: list[str]
) -> Column:
    """The fields each category fills; all others are null.

    ``named`` are the categories that keep their residues; spans name the residues at both ends.
    """
    filled = lambda value, *kinds: F.when(category.isin(*kinds), value)
    spans, inserts = ("del", "dup", "delins"), ("ins", "delins")
    stop = F.when(parts.op == "ins", parts.position).otherwise(parts.position - 1)
    return F.struct(
        filled(parts.position, "stoploss", *named).alias("pos"),
        filled(parts.residue, *named).alias("wt"),
        filled(parts.tail, "stoploss", *named).alias("mut"),
        filled(stop, "nonsense").alias("keep_to"),
        filled(parts.position, *spans).alias("start"),
        filled(parts.end, *spans).alias("end"),
        filled(parts.residue, *spans).alias("wt_start"),
        filled(parts.end_residue, *spans).alias("wt_end"),
        filled(parts.position, "ins").alias("after"),
        filled(inserted, *inserts).alias("inserted"),
        filled(n_inserted, *inserts).alias("n_inserted"),
        filled(cut, *inserts).alias("truncate"),
    )


def parse_three_letter(df: DataFrame, change: str) -> DataFrame:
    """F-07, F-10: adds ``category`` and ``details`` of changes such as ``Gly10_Ala12delinsTrpVal``.

    The parts are a column of their own, so that each row's regex runs once.  An inserted run is cut
    every three letters; a last ``Ter`` ends the protein there.  Names without a code are left out of
    the joined codes but counted, so the two lengths differ exactly when the insert cannot be built.
    Operations are read before the plain substitution, whose form a deletion of one residue would
    also have.
    """
    c, parts, tokens = F.col(change), _Parts(F.col("_parts")), F.col("_tokens")
    names = [*THREE_TO_ONE, *EXTRA_NAMES]
    known = (parts.tail != "") & F.forall(tokens, lambda t: t.isin(*names))
    wt, mut = parts.residue, parts.tail
    single = parts.when("", ranged=False) & (F.length(mut) == 3) & wt.isin(*names) & mut.isin(*names)
    category = first_rule(
        [
            (c.endswith("="), "synonymous_explicit"),
            (c.contains("fs"), "frameshift"),
            (parts.when("delins") & known, "delins"),
            (parts.when("ins", ranged=True) & (mut == "Ter"), "nonsense"),
            (parts.when("ins", ranged=True) & known, "ins"),
            (parts.whole("del"), "del"),
            (parts.whole("dup"), "dup"),
            (single & (wt == mut), "synonymous"),
            (single & (mut == "Ter"), "nonsense"),
            (single & (wt == "Ter"), "stoploss"),
            (single, "missense"),
        ],
        "unparsed",
    )
    cut = F.coalesce(F.try_element_at(tokens, F.lit(-1)) == "Ter", F.lit(False))
    kept = F.when(cut, F.slice(tokens, F.lit(1), F.size(tokens) - 1)).otherwise(tokens)
    codes = F.array_join(F.transform(kept, lambda t: residue_code(t)), "")
    details = _details(
        F.col("category"), parts, codes, F.size(kept), cut, ["missense", "synonymous"]
    )
    return (
        df.withColumn("_parts", _change_parts(c, _THREE_SHAPE))
        .withColumn("_tokens", F.regexp_extract_all(F.get("_parts", F.lit(5)), F.lit(".{1,3}"), 0))
        .withColumn("category", category)
        .withColumn("details", details)
        .drop("_parts", "_tokens")
    )


def parse_one_letter(df: DataFrame, change: str, described_as: str) -> DataFrame:
    """F-09: adds ``category`` and ``details`` of changes such as ``p.G12D``.

    Silent and deferred classes are decided by the description before the notation is read.
    """
    c, described, parts = F.col(change), F.col(described_as), _Parts(F.col("_parts"))
    letters = parts.tail.rlike(f"^[{ONE_LETTER}]+$")
    wt, mut = parts.residue, parts.tail
    single = parts.when("", ranged=False) & (F.length(mut) == 1) & wt.isin(*ONE_LETTER)
    category = first_rule(
        [
            (described.isin(*SILENT_CLASSES), "synonymous"),
            (described.isin(*DEFERRED_CLASSES), "frameshift_or_stoploss"),
            (c.isNull() | ~c.startswith("p."), "no_protein_notation"),
            (parts.when("delins") & letters, "delins"),
            (parts.when("ins", ranged=True) & letters, "ins"),
            (parts.whole("del"), "del"),
            (parts.whole("dup"), "dup"),
            (single & (wt == mut), "synonymous"),
            (single & (mut == "*"), "nonsense"),
            (single & mut.isin(*ONE_LETTER), "missense"),
        ],
        "unparsed",
    )
    details = _details(
        F.col("category"), parts, mut, F.length(mut), F.lit(False), ["missense"]
    )
    return (
        df.withColumn("_parts", _change_parts(c, _ONE_SHAPE))
        .withColumn("category", category)
        .withColumn("details", details)
        .drop("_parts")
    )


def mutation_id(accession: Column, gene: Column, wt: Column, position: Column, mut: Column) -> Column:
    """F-14: ``accession|gene|W123A``."""
    return F.concat_ws(
        "|", accession, gene, F.concat(wt, position.cast("string"), mut)
    )


def parse_mutation_id(mutation: Column) -> dict[str, Column]:
    """F-14: the parts of a mutation id; all null when it has another form."""
    parts = F.split(mutation, r"\|", -1)
    change = F.get(parts, F.lit(2))
    ok = (
        (F.size(parts) == 3)
        & (F.get(parts, F.lit(0)) != "")
        & (F.get(parts, F.lit(1)) != "")
        & change.rlike("^[A-Z][0-9]+[A-Z]$")
    )
    return {
        "accession": F.when(ok, F.get(parts, F.lit(0))),
        "gene": F.when(ok, F.get(parts, F.lit(1))),
        "wt_aa": F.when(ok, F.left(change, F.lit(1))),
        "position": F.when(ok, F.regexp_replace(change, "[A-Z]", "")).try_cast("int"),
        "mut_aa": F.when(ok, F.right(change, F.lit(1))),
    }
