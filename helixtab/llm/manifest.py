"""A Merkle manifest of a table as a persistent tree with one version per tampered row.

Every row is a leaf; the leaves of a group, in order of their ids, are hashed in runs of ``ARITY`` up to
the group's subroot, and the subroots, in order of the groups, likewise to the root.

The tree is cut into aligned blocks of ``ARITY ** BLOCK_LEVELS`` consecutive nodes, each of which one
task builds.  The tops of the blocks are the leaves of the next round, until one node is left.  On
the way down each node learns the siblings of its path from its block and those above from the
block's top, which is one row per block.

Nodes never change.  A tampered leaf makes a new version: inside its block only the ancestors on its
path are copied, all other nodes are shared with the first version; above the block the version goes on with
copies of the block's own ancestors, whose siblings came with the path.  No version is built again
from its leaves, and none needs the rows of another block.

Positions are counted over the whole cluster: leaves are sorted by range, numbered within their
slice, and shifted by the rows of earlier slices, so a group that holds most of the rows is in many tasks.

Defined results: a null value is hashed as ``-``, any other one as its UTF-8 byte count, ``:`` and the
value; rows without a group form the first one; null ids come first; rows equal in group and id are
ordered by their leaf digest, so repeated rows are leaves of their own; a row with a null id isn't
tampered unless the caller says so; an empty table gives an empty table; columns that are not named
aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stage

ARITY = 3
BLOCK_LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

Node = tuple[str, tuple]

_PATH = "left array<string>, right array<string>, subroot string, root string"
_ROWS = "doc_id string, grp string, pos long, leaf string, {path}, tampered_leaf string, copied array<string>, folded_root string"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A value as it enters the leaf."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def depth_of(n: int, arity: int = ARITY) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels, reach = 0, 1
    while reach < n:
        levels, reach = levels + 1, reach * arity
    return levels


class Block:
    """A tree over consecutive nodes; a node is (digest, children) and is never changed."""

    def __init__(self, leaves: Sequence[str], levels: int, arity: int = ARITY):
        self.levels, self.arity = levels, arity
        row: list[Node] = [(x, ()) for x in leaves]
        for _ in range(levels):
            runs = [tuple(row[k : k + arity]) for k in range(0, len(row), arity)]
            row = [(digest(*[child[0] for child in run]), run) for run in runs]
        (self.top,) = row

    def path(self, at: int) -> list[tuple[Node, int]]:
        """The ancestors of a leaf from the top down, each with the place of the child that leads to it."""
        out, node = [], self.top
        span = self.arity**self.levels
        for _ in range(self.levels):
            span //= self.arity
            k, at = divmod(at, span)
            out.append((node, k))
            node = node[1][k]
        return out

    def siblings(self, at: int) -> tuple[list[str], list[str]]:
        """Per level from the leaf up: the digests left and right of its path, each put together."""
        path = self.path(at)[::-1]
        left = ["".join(child[0] for child in node[1][:k]) for node, k in path]
        right = ["".join(child[0] for child in node[1][k + 1 :]) for node, k in path]
        return left, right

    def version(self, at: int, leaf: str) -> list[Node]:
        """The nodes of a new version from the changed leaf to its top: copies of the path, all else shared."""
        copies: list[Node] = [(leaf, ())]
        for node, k in reversed(self.path(at)):
            children = (*node[1][:k], copies[-1], *node[1][k + 1 :])
            copies.append((digest(*[child[0] for child in children]), children))
        return copies


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, their place in ``grp`` in ``order``, and ``n``, the rows of ``grp``."""
    n = shuffle_partitions(rows.sparkSession)
    sliced = rows.repartitionByRange(n, "grp", *order).sortWithinPartitions("grp", *order)
    sliced = stage(sliced.withColumn("at", F.monotonically_increasing_id()), "ordered")
    slice_no = F.shiftright("at", 33)
    # at most one row per slice, and one per group that begins in it
    pieces = sliced.groupBy("grp", slice_no.alias("slice")).agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    whole = Window.partitionBy("grp")
    earlier = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        "grp",
        "slice",
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    placed = sliced.withColumn("slice", slice_no).join(offsets, ["grp", "slice"])
    return placed.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "slice", "shift")


def _tops(nodes: DataFrame, levels: int) -> DataFrame:
    """The tops of all blocks of ``nodes`` (grp, pos, n, digest), as nodes of the next round."""
    span = ARITY**levels

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        n = int(part["n"].iloc[0])
        block = Block(part["digest"].tolist(), min(levels, depth_of(n)))
        return pd.DataFrame({"grp": part["grp"].iloc[:1], "pos": part["pos"].iloc[:1] // span, "n": -(-n // span), "digest": [block.top[0]]})

    keyed = nodes.select("grp", "pos", "n", "digest", F.floor(F.col("pos") / span).alias("block"))
    return keyed.groupBy("grp", "block").applyInPandas(build, "grp string, pos long, n long, digest string")


def _down(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """Paths of ``nodes`` (grp, pos, n, digest) from the paths of their blocks' tops (grp, pos, path)."""
    span = ARITY**levels

    def extend(part: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        up = top.iloc[0]
        block = Block(part["digest"].tolist(), min(levels, depth_of(int(part["n"].iloc[0]))))
        own = [block.siblings(k) for k in range(len(part))]
        return pd.DataFrame(
            {
                "grp": part["grp"],
                "pos": part["pos"],
                "left": [[*a, *up["left"]] for a, _ in own],
                "right": [[*b, *up["right"]] for _, b in own],
                "subroot": up["subroot"],
                "root": up["root"],
            }
        )

    keyed = nodes.select("grp", "pos", "n", "digest", F.floor(F.col("pos") / span).alias("block"))
    both = keyed.groupBy("grp", "block").cogroup(above.withColumnRenamed("pos", "block").groupBy("grp", "block"))
    return both.applyInPandas(extend, f"grp string, pos long, {_PATH}")


def _versions(leaves: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """Like ``_down`` for the leaves themselves, with the version that each tampered one makes."""
    span = ARITY**levels

    def extend(part: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        up = top.iloc[0]
        block = Block(part["digest"].tolist(), min(levels, depth_of(int(part["n"].iloc[0]))))
        rows = []
        for k, (doc, grp, pos, leaf, other) in enumerate(
            zip(part["doc_id"], part["grp"], part["pos"], part["digest"], part["tampered_leaf"])
        ):
            left, right = block.siblings(k)
            now = leaf if other is None else other
            copies = [x[0] for x in block.version(k, now)]
            for a, b in zip(up["left"], up["right"]):
                copies.append(digest(a, copies[-1], b))
            rows.append(
                (doc, grp, pos, leaf, [*left, *up["left"]], [*right, *up["right"]], up["subroot"], up["root"], other,
                 copies[1:] if other is not None else None, copies[-1])
            )
        names = ["doc_id", "grp", "pos", "leaf", "left", "right", "subroot", "root", "tampered_leaf", "copied", "folded_root"]
        return pd.DataFrame(rows, columns=names)

    # ids travel as text: pandas would make a column with nulls one of floats
    keyed = leaves.select(F.col("doc_id").cast("string").alias("doc_id"), "grp", "pos", "n", "digest", "tampered_leaf", F.floor(F.col("pos") / span).alias("block"))
    both = keyed.groupBy("grp", "block").cogroup(above.withColumnRenamed("pos", "block").groupBy("grp", "block"))
    return both.applyInPandas(extend, _ROWS.format(path=_PATH)).withColumn("doc_id", F.col("doc_id").cast("long"))


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` and the tops of their blocks, round by round, until each group has one node."""
    out = [nodes]
    while (out[-1].agg(F.max("n").alias("n")).first().n or 1) > 1:
        out.append(stage(_tops(out[-1], levels), "tops"))
    return out


def _through(rounds: list[DataFrame], top: DataFrame, levels: int, last: int) -> DataFrame:
    """Paths carried from the top of each group down to the nodes of round ``last``, if there is one."""
    for nodes in rounds[-2::-1][: max(0, len(rounds) - 1 - last)]:
        top = stage(_down(nodes, top, levels), "paths")
    return top


def manifest(
    docs: DataFrame,
    tampered: dict[str, Column] | None = None,
    when: Column | None = None,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "source",
    levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, grp, pos (place in its group), leaf, left and right (the
    siblings of its path by level), subroot, root, tampered_leaf, copied (the ancestors that its version
    copied, from the leaf up) and folded_root (the root of its version; the root itself without one).

    ``tampered`` gives other values for some fields, which hold in the version of each row that meets ``when``.
    """
    other = {**{f: F.col(f) for f in fields}, **(tampered or {})}
    changed = leaf_of(*[other[f] for f in fields])
    leaves = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.when(F.col(group_col).isNull(), "-").otherwise(F.concat(F.lit(":"), F.col(group_col).cast("string"))).alias("grp"),
        leaf_of(*[F.col(f) for f in fields]).alias("digest"),
        F.when(when if when is not None else F.lit(False), changed).alias("tampered_leaf"),
        F.monotonically_increasing_id().alias("tie"),  # written, so it splits any number of equal rows
    )
    leaves = stage(_numbered(stage(leaves, "leaves"), ["doc_id", "digest", "tie"]).drop("tie"), "leaves")
    rounds = _rounds(leaves, levels)

    subroots = rounds[-1].select("grp", F.col("digest").alias("subroot"))
    ordered = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "subroot")
    ordered = stage(_numbered(ordered, ["of"]), "subroots")
    upper = _rounds(ordered.select("grp", "pos", "n", F.col("subroot").alias("digest")), levels)
    none = F.array().cast("array<string>")
    top = upper[-1].select(
        "grp", "pos", none.alias("left"), none.alias("right"), F.lit("").alias("subroot"), F.col("digest").alias("root")
    )
    top = _through(upper, top, levels, last=0).drop("grp", "subroot")
    top = top.join(ordered.select("pos", F.col("of").alias("grp"), "subroot"), "pos")
    top = stage(top.select("grp", F.lit(0).cast("long").alias("pos"), "left", "right", "subroot", "root"), "paths")
    return _versions(leaves, _through(rounds, top, levels, last=1), levels)


def newlines_removed(text_col: str = "text") -> dict[str, Column]:
    """The tampering of the registered query: the text without its line feeds."""
    return {text_col: F.replace(F.col(text_col), F.lit("\n"), F.lit(""))}


def proof_digest() -> Column:
    """The digest of a row's siblings, level by level and left to right."""
    return F.sha2(F.concat_ws("", F.zip_with("left", "right", lambda a, b: F.concat(a, b))), 256)
