"""Dataset descriptions: raw text columns, typed columns, key and grain."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixtab.functions.cells import blank_to_null, packed_items, parse_float, parse_int
from helixtab.operators.quality import check_columns, check_unique


@dataclass(frozen=True)
class DatasetSpec:
    """One table: its columns with typed forms, its key and what one row stands for.

    Types are ``string``, ``int``, ``bigint``, ``double``, ``boolean`` and ``list`` (packed by ``;``).
    """

    name: str
    columns: dict[str, str]
    key: tuple[str, ...] = ()
    grain: str = ""
    options: dict[str, str] = field(default_factory=dict)

    def raw_schema(self) -> T.StructType:
        """All columns as text, the form files are read in."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def typed(self, raw: DataFrame) -> DataFrame:
        """Raw text to typed columns; unreadable cells become null."""
        check_columns(raw.drop("ord"), list(self.columns))
        extra = [F.col("ord")] if "ord" in raw.columns else []
        return raw.select(*[_typed(c, t).alias(c) for c, t in self.columns.items()], *extra)

    def verify_key(self, df: DataFrame) -> DataFrame:
        check_unique(df, list(self.key))
        return df


def _typed(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind == "string":
        return blank_to_null(c)
    if kind in ("int", "bigint"):
        return parse_int(c).try_cast(kind)
    if kind == "double":
        return parse_float(c)
    if kind == "boolean":
        return F.lower(F.trim(c)).isin("1", "true", "yes", "t", "y")
    if kind == "list":
        return packed_items(c)
    raise ValueError(f"unknown column type {kind!r}")
