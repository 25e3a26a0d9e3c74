"""Cleaning and parsing of single cells: ids, numbers, flags, packed lists and literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no value" in the completeness audit, and the accepted truths.
BLANK_WORDS = ("nan", "none", "null", "[]", "{}")
TRUE_WORDS = ("true", "1", "yes", "t")
STRICT_TRUE_WORDS = ("1", "True", "true")
ACCESSION_PATTERN = (
    "^[OPQ][0-9][A-Z0-9]{3}[0-9]$|^[A-NR-Z][0-9]([A-Z][A-Z0-9]{2}[0-9]){1,2}$"
)
_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def blank_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t != "", t)


def is_filled(c: Column) -> Column:
    """A non-empty cell."""
    return F.coalesce(F.trim(c) != "", F.lit(False))


def is_informative(c: Column) -> Column:
    """A cell that is neither empty nor one of the words for no value."""
    return is_filled(c) & ~F.lower(F.trim(c)).isin(*BLANK_WORDS)


def strip_version(c: Column) -> Column:
    """P-02: ``X001.3`` to ``X001``."""
    return F.substring_index(c, ".", 1)


def first_item(c: Column, sep: str = ";") -> Column:
    """P-03: first entry of a packed list, without its version, null if empty."""
    return blank_to_null(strip_version(F.trim(F.substring_index(c, sep, 1))))


def strip_prefix(c: Column, prefix: str) -> Column:
    """P-04: drop a namespace such as ``9606.``."""
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def add_prefix(c: Column, prefix: str) -> Column:
    return F.when(c.startswith(prefix), c).otherwise(F.concat(F.lit(prefix), c))


def packed_items(c: Column, sep: str = ";") -> Column:
    """Entries of a packed list, trimmed, empty ones dropped; an empty cell is an empty array."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), _quoted(sep)), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def _quoted(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def n_distinct_bare(c: Column) -> Column:
    """F-05: number of distinct entries after the version is stripped."""
    return F.size(F.array_distinct(F.transform(packed_items(c), strip_version)))


def parse_float(c: Column, default: float | None = None) -> Column:
    """F-46: number or null (or ``default``); suffixes such as ``1d`` are not numbers."""
    t = F.trim(c)
    value = F.when(t.rlike(_NUMBER), t.try_cast("double"))
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def parse_int(c: Column) -> Column:
    """Whole number of a decimal text, cut toward zero."""
    return parse_float(c).try_cast("bigint")


def parse_strict_int(c: Column) -> Column:
    """Only texts that are whole numbers already."""
    t = F.trim(c)
    return F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint"))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def truthy(c: Column, words: Sequence[str] = TRUE_WORDS) -> Column:
    """F-45: case-blind truth test."""
    return F.coalesce(F.lower(F.trim(c)).isin(*[w.lower() for w in words]), F.lit(False))


def truthy_exact(c: Column, words: Sequence[str] = STRICT_TRUE_WORDS) -> Column:
    """F-45: the variant that takes the words as spelled."""
    return F.coalesce(F.trim(c).isin(*words), F.lit(False))


def valid_accession(c: Column) -> Column:
    """F-35."""
    return c.rlike(ACCESSION_PATTERN)


def list_facts(own: Column, items: Column) -> dict[str, Column]:
    """F-36: does a list name its own row, and does it name anything twice."""
    return {
        "self_reference": F.array_contains(items, own),
        "has_duplicate": F.size(F.array_distinct(items)) != F.size(items),
        "bad_format": F.exists(items, lambda x: ~valid_accession(x)),
    }


def corrupt_symbol(c: Column) -> Column:
    """P-14: evidence codes or list remnants inside a symbol."""
    return c.contains("{ECO:") | c.isin("[]", "{}") | c.rlike(r'[{}\[\]"]')


def id_term_entries(c: Column) -> Column:
    """F-20: ``GO:0005840:ribosome;…`` to (id, entry); entries with fewer than two ``:`` dropped."""
    return F.transform(
        F.filter(packed_items(c), lambda e: F.size(F.split(e, ":")) >= 3),
        lambda e: F.struct(F.substring_index(e, ":", 2).alias("id"), e.alias("entry")),
    )


def aspect_and_name(term: Column) -> tuple[Column, Column]:
    """F-47: ``C:nucleus`` to its aspect and name; null without a ``:``."""
    ok = term.contains(":")
    return (
        F.when(ok, F.substring_index(term, ":", 1)),
        F.when(ok, F.substr(term, F.instr(term, ":") + 1)),
    )


def score_parts(info: Column, tag: str = "SpliceAI=", n_parts: int = 10) -> Column:
    """F-33: scores of ``TAG=allele|gene|s1|…``; null when untagged, of another length or all ``.``."""
    body = F.substr(info, F.lit(len(tag) + 1))
    parts = F.split(body, r"\|")
    scores = F.slice(parts, 3, n_parts - 2)
    scored = (
        info.startswith(tag)
        & (F.size(parts) == n_parts)
        & ~F.forall(scores, lambda v: v == ".")
    )
    return F.when(scored, scores)


def token_record(line: Column, fields: Sequence[str]) -> Column:
    """F-34: ``AGG 1.0 BETA 2.0 …`` to a struct of texts, null unless every field is there.

    Names stand at odd places and values at even ones; of a repeated name the last value counts.
    """
    text = F.trim(line)
    cells = [F.regexp_extract(text, rf"^(?:\S+\s+\S+\s+)*{f}\s+(\S+)", 1) for f in fields]
    complete = F.lit(True)
    for c in cells:
        complete = complete & (c != "")
    return F.when(complete, F.struct(*[c.alias(f) for c, f in zip(cells, fields)]))


def python_ranges(c: Column) -> Column:
    """F-37: ``{'RRM': [(55, 134)]}`` to map<string, array<array<int>>>, null if unreadable."""
    as_json = F.translate(c, "()'", '[]"')
    return F.from_json(as_json, "map<string,array<array<int>>>")


def python_list(c: Column, item: str = "string") -> Column:
    """F-37 for a list literal."""
    return F.from_json(F.translate(c, "()'", '[]"'), f"array<{item}>")


def pack(items: Column, sep: str = ";") -> Column:
    """K-08: list to text, null as empty."""
    return F.coalesce(F.array_join(items, sep), F.lit(""))


def pack_pairs(pairs: Column, first: str = "id", second: str = "name") -> Column:
    """K-08: ``id:name;id:name``."""
    return pack(F.transform(pairs, lambda p: F.concat_ws(":", p[first], p[second])))


def pack_measurements(rows: Column) -> Column:
    """K-08: ``tissue|source|%.4f|unit;…``; a missing number is written as nothing."""
    cell = lambda r: F.concat_ws(
        "|",
        F.coalesce(r["tissue"], F.lit("")),
        F.coalesce(r["source"], F.lit("")),
        F.when(r["median"].isNotNull(), F.format_string("%.4f", r["median"])).otherwise(""),
        F.coalesce(r["unit"], F.lit("")),
    )
    return pack(F.transform(rows, cell))


def unpack_parallel(**columns: Column) -> Column:
    """Index-aligned packed columns to one array of structs."""
    return F.arrays_zip(*[F.split(c, ";").alias(n) for n, c in columns.items()])


def coordinate(c: Column) -> dict[str, Column]:
    """P-07: ``7:123-125`` to its parts, null in another form."""
    halves = F.split(c, ":", -1)
    ends = F.split(F.get(halves, F.lit(1)), "-", -1)
    contig, start, stop = F.get(halves, F.lit(0)), F.get(ends, F.lit(0)), F.get(ends, F.lit(1))
    digits = "^[0-9]+$"
    # contigs are numbers or named by the letters of X, Y and MT
    ok = (
        (F.size(halves) == 2)
        & (F.size(ends) == 2)
        & (contig != "")
        & (F.translate(contig, "0123456789XYMT", "") == "")
        & start.rlike(digits)
        & stop.rlike(digits)
    )
    return {
        "contig": F.when(ok, contig),
        "start": F.when(ok, start).try_cast("bigint"),
        "stop": F.when(ok, stop).try_cast("bigint"),
    }
