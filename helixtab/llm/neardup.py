"""Near duplicates by an LSH forest over MinHash signatures.

A document is the set of its distinct word shingles.  Documents with equal sets are one class, which
a single representative stands for.  Representatives get ``TREES`` MinHash sequences of ``DEPTH``
values; each sequence is an order of all representatives, in which similar ones lie close together.
A region of an order is a run with a common prefix.  Its depth adapts: the shortest prefix (of
``FIRST_DEPTH`` values at least) that leaves no more than ``REGION`` members, the full depth where
even that leaves more.

Candidates are taken from regions in three rounds, each of which verifies pairs on full shingle sets
and then joins what is linked, so that large families need few pairs:

1. each member with the leader it meets in its regions, the member that most others share sequences with;
2. each member with the most promising neighbour in the orders that is still in another component;
3. whatever is left: in each region that still spans several components, the members outside its
   largest component with all members of other components.

Round 3 sets no limit on partners, so no pair that meets in a region is lost.  Pairs are skipped
without verification only if their set sizes rule out the similarity; if 128 signature bits say
it is out of reach (at a similarity of 0.8 a pair would have to be over five standard deviations off);
or, in regions larger than ``REGION``, if either has too few shingles that any other member of such a
region has, or if 1024-bit parity maps show that the sets differ by too many.  These last two bounds are
exact, and spare a family of very many differently changed copies the verification of all with all.

Two sets of similarity 0.8 meet in a region of a sparse order with probability above 0.999999.

Defined results: a text without words, or a null one, has an empty set and is linked with nothing;
fewer words than the shingle width make one shingle; null ids are larger than all others and never
name a component that has another id; rows with equal texts are of one class; an empty table gives
an empty table; other columns are carried by ``drop_near_copies`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, mix64, returning_memory, stage, stage_texts, unused_name
from .components import components
from .tokens import slices

TREES, DEPTH, FIRST_DEPTH, REGION = 20, 5, 3, 32
SKETCH_BITS = 128
PERCENT = 80


# --- shingle sets -----------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (no nulls).

    Words are runs of bytes other than blanks and the five control spaces, A-Z in lower case.  Words
    are dictionary-encoded over the batch, so only distinct ones are hashed one by one.
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    none = np.zeros(0, np.uint64)
    if first == last:
        return [none] * len(texts)
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[first:last]]
    starts = offsets - first
    solid = ~_GAP[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    heads = starts[:-1][starts[:-1] < len(data)]
    begins[heads] = solid[heads]
    place = np.flatnonzero(begins)
    if not len(place):
        return [none] * len(texts)
    solids = np.cumsum(solid, dtype=np.int32 if len(data) < 1 << 31 else np.int64)  # position among the solid bytes
    bounds = np.append(solids[place] - 1, solids[-1]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(place), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[solid]))]
    ).dictionary_encode()
    own = np.array([xxhash.xxh64_intdigest(w) for w in words.dictionary.to_pylist()], np.uint64)
    hashes = own[words.indices.to_numpy(zero_copy_only=False)]
    edges = np.searchsorted(place, starts)
    with np.errstate(over="ignore"):
        odd = np.uint64(0x9E3779B97F4A7C15)
        whole = max(0, len(hashes) - width + 1)
        rolled = np.zeros(whole, np.uint64)
        for k in range(width):
            rolled = mix64(rolled * odd + hashes[k : k + whole])
        out = []
        for low, high in zip(edges, edges[1:]):
            if high - low >= width:
                out.append(np.unique(rolled[low : high - width + 1]))
            elif high > low:
                one = np.zeros(1, np.uint64)
                for k in range(low, high):
                    one = mix64(one * odd + hashes[k])
                out.append(mix64(one + np.uint64(high - low)))
            else:
                out.append(none)
    return out


_random = np.random.default_rng(20)
_FACTORS = _random.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _random.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``TREES * DEPTH`` MinHash values of 32 bits."""
    least = np.full(len(_FACTORS), ~np.uint64(0))
    with np.errstate(over="ignore"):
        for low in range(0, len(shingles), 1024):
            own = np.multiply.outer(_FACTORS, shingles[low : low + 1024])
            own += _TERMS[:, None]
            np.minimum(least, own.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _describe(width: int, schema: pa.Schema):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            for low, high in slices(texts, 1 << 20):
                sets = shingle_sets(texts.slice(low, high - low), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        batch.column("text_key").slice(low, high - low),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    schema=schema,
                )

    return describe


_SETS = "doc_id long, text_key long, set_key binary, n int, signature binary"
_SETS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("set_key", pa.binary()), ("n", pa.int32()), ("signature", pa.binary())]
)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")
    )


# --- the forest -------------------------------------------------------------------------------

_TREE = "k long, r long, node long, n int, s1 long, s2 long"


def _plant(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per representative and tree: ``k`` the first values and ``r`` the further values of its sequence."""
    for part in batches:
        if not len(part):
            continue
        values = np.stack([np.frombuffer(x, np.uint32) for x in part["signature"]])
        bits = np.packbits((values[:, :SKETCH_BITS] & 1).astype(np.uint8), axis=1)
        spare = SKETCH_BITS // 8 - bits.shape[1]
        if spare > 0:  # fewer values than bits: take the next bit of the first ones
            more = np.packbits((values[:, : spare * 8] >> 1 & 1).astype(np.uint8), axis=1)
            bits = np.concatenate((bits, more[:, :spare]), axis=1)
        sketch = np.ascontiguousarray(bits[:, : SKETCH_BITS // 8]).view(np.int64)
        trees = values.reshape(len(values), TREES, DEPTH).astype(np.uint64)
        with np.errstate(over="ignore"):
            k = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), (len(values), TREES))
            for d in range(FIRST_DEPTH):
                k = mix64(k * np.uint64(0x9E3779B97F4A7C15) + trees[:, :, d])
            r = (trees[:, :, FIRST_DEPTH] << np.uint64(32)) | trees[:, :, FIRST_DEPTH + 1]
        yield pd.DataFrame(
            {
                "k": k.ravel().view(np.int64),
                "r": r.ravel().view(np.int64),
                "node": np.repeat(part["node"].to_numpy(), TREES),
                "n": np.repeat(part["n"].to_numpy(), TREES),
                "s1": np.repeat(sketch[:, 0], TREES),
                "s2": np.repeat(sketch[:, 1], TREES),
            }
        )


def _regions(trees: DataFrame) -> DataFrame:
    """Members of all regions: region, big (over ``REGION`` members at full depth), order and sketch."""
    out = None
    level = trees
    for depth in range(FIRST_DEPTH, DEPTH + 1):
        prefix = [F.col("k")] if depth == FIRST_DEPTH else [F.col("k"), F.shiftrightunsigned("r", 32 * (DEPTH - depth))]
        level = level.withColumn("region", F.xxhash64(F.lit(depth), *prefix))
        sizes = level.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        level = level.join(sizes, "region")
        if depth == FIRST_DEPTH:
            level = stage(level.withColumn("crowd", F.col("size")), "forest")
        last = depth == DEPTH
        done = level if last else level.where(F.col("size") <= REGION)
        done = done.withColumn("big", F.col("size") > REGION).drop("size")
        out = done if out is None else out.unionByName(done)
        if not last:
            level = level.where(F.col("size") > REGION).drop("size", "region")
    members = stage(out, "regions")
    return members


def _possible(a: str, b: str, percent: int) -> Column:
    """Neither the sizes nor the sketches rule the similarity out."""
    sizes = F.least(f"{a}n", f"{b}n") * 100 >= F.greatest(f"{a}n", f"{b}n") * percent
    off = sum(F.bit_count(F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}"))) for s in ("s1", "s2"))
    differ = (1 - percent / 100) / 2
    most = SKETCH_BITS * differ + 5.5 * (SKETCH_BITS * differ * (1 - differ)) ** 0.5
    return sizes & (off <= int(most))


def _apart(a: str, b: str) -> Column:
    return sum(F.bit_count(F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}"))) for s in ("s1", "s2"))


# --- verification -----------------------------------------------------------------------------


def _sets_of(docs: DataFrame, nodes: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the representatives named in ``nodes`` (node, doc_id, text_key)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            for low, high in slices(texts, 1 << 20):
                sets = shingle_sets(texts.slice(low, high - low), width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(low, high - low), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "shingles"],
                )

    wanted = nodes.select("node", F.xxhash64(F.col("doc_id"), F.col("text_key")).alias("who"))
    rows = _rows(docs, id_col, text_col).select(F.xxhash64("doc_id", "text_key").alias("who"), "text")
    # rows equal in id and text give the same set: one of them is enough
    return rows.join(wanted, "who").select("node", "text").mapInArrow(returning_memory(cut), "node long, shingles binary").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""

    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            keep = []
            for x, y in zip(part["x"], part["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield part.loc[np.array(keep, bool), ["a", "b"]]

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(compare, "a long, b long")


def _in(table: DataFrame, joined: DataFrame, column: str, name: str) -> DataFrame:
    """``table`` with the component of ``column`` as ``name``; a node without links is its own."""
    roots = joined.select(F.col("node").alias(column), F.col("root").alias("__root"))
    return table.join(roots, column, "left").withColumn(name, F.coalesce("__root", column)).drop("__root")


WORDS = 16  # of 64 bits, in the parity maps


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per node, for each of ``64 * WORDS`` shares of all shingles, whether its set has an odd number of
    them.  Two sets differ by at least as many shingles as their maps differ by bits."""
    for batch in batches:
        maps = np.zeros((batch.num_rows, 64 * WORDS), np.uint8)
        for row, shingles in enumerate(batch.column("shingles")):
            own = np.frombuffer(shingles.as_py(), np.uint64) % np.uint64(64 * WORDS)
            maps[row] = np.bincount(own.astype(np.int64), minlength=64 * WORDS) & 1
        words = np.packbits(maps, axis=1).view(np.int64).reshape(-1, WORDS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), *[pa.array(words[:, k]) for k in range(WORDS)]],
            names=["node", *[f"w{k}" for k in range(WORDS)]],
        )


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, shingles in zip(batch.column("node"), batch.column("shingles")):
            own = np.frombuffer(shingles.as_py(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array(np.full(len(own), node.as_py(), np.int64))], names=["shingle", "node"]
            )


def _cross_pairs(placed: DataFrame, percent: int, words: int = 0) -> DataFrame:
    """Pairs of members of one region in different components, those of its main component not among themselves.

    ``m`` bounds how many shingles a member shares with any other one.  A member outside the main
    component that can't reach the similarity with ``m``, whatever the sizes in its region, is out; and so is
    a pair whose parity maps (``words`` of them) differ by more than the sets may.
    """
    maps = [f"w{k}" for k in range(words)]

    def reach(m: Column, a: Column, b: Column) -> Column:
        return m * 100 >= (a + b - m) * percent

    least = placed.groupBy("region").agg(F.min("n").alias("least"))
    strays = placed.where("c != main").join(least, "region").where(reach(F.col("m"), F.col("n"), F.greatest("least", "m")))
    strays = strays.select("region", F.col("c").alias("d"), *[F.col(x).alias(f"q{x}") for x in ("node", "n", "s1", "s2", "m", *maps)])
    differ = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"q{w}"))) for w in maps), F.lit(0))
    return (
        strays.join(placed.select("region", "c", "main", "node", "n", "s1", "s2", "m", *maps), "region")
        .where(
            (F.col("c") != F.col("d"))
            & ((F.col("c") == F.col("main")) | (F.col("qnode") < F.col("node")))
            & reach(F.least("m", "qm"), F.col("n"), F.col("qn"))
            & _possible("", "q", percent)
            & (differ * (100 + percent) <= (F.col("n") + F.col("qn")) * (100 - percent))
        )
        .select(F.least("node", "qnode").alias("a"), F.greatest("node", "qnode").alias("b"))
        .distinct()
    )


def near_classes(
    docs: DataFrame, width: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_shingles, component_id (smallest id reachable)
    and root (an internal number of the component, null for empty sets)."""
    sets = stage_texts(_rows(docs, id_col, text_col).mapInArrow(returning_memory(_describe(width, _SETS_ARROW)), _SETS), "sets")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("who")
    reps = (
        sets.where("n > 0")
        .groupBy("set_key")
        .agg(first, F.first("n").alias("n"), F.first("signature").alias("signature"))
        .select("set_key", "who.doc_id", "who.text_key", "n", "signature", F.monotonically_increasing_id().alias("node"))
    )
    reps = stage(reps, "classes")  # the numbers are fixed by being written
    members = _regions(reps.select("node", "n", "signature").mapInPandas(_plant, _TREE))

    # the text from which a family was made shares most sequences with others: its regions are crowded
    score = members.groupBy("node").agg(F.sum("crowd").alias("score"))
    members = stage(members.drop("crowd").join(score, "node"), "scored")
    mine = F.struct("score", "node", "n", "s1", "s2")
    lead = members.groupBy("region").agg(F.max(mine).alias("l"))
    met = members.join(lead, "region").where(F.col("l.node") != F.col("node"))
    met = met.select("node", "n", "s1", "s2", "l.score", F.col("l.node").alias("m"), F.col("l.n").alias("ln"), F.col("l.s1").alias("ls1"), F.col("l.s2").alias("ls2"))
    stars = stage(
        met.where(_possible("", "l", percent))
        .groupBy("node")
        .agg(F.max(F.struct("score", "m")).alias("l"))
        .select(F.least("node", "l.m").alias("a"), F.greatest("node", "l.m").alias("b"))
        .distinct(),
        "stars",
    )
    order = Window.partitionBy("region").orderBy("r", "node")  # regions of bounded size
    before = members.where("not big").select("*", *[F.lag(c).over(order).alias(f"p{c}") for c in ("node", "n", "s1", "s2")])
    beside = stage(
        before.where("pnode is not null")
        .where(_possible("", "p", percent))
        .select(F.least("node", "pnode").alias("a"), F.greatest("node", "pnode").alias("b"), _apart("", "p").alias("off"))
        .distinct(),
        "neighbours",
    )
    named = stars.select(F.explode(F.array("a", "b")).alias("node")).unionByName(beside.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    shingles = stage_texts(_sets_of(docs, reps.join(named, "node"), width, id_col, text_col), "shingles")

    links = stage(_verified(stars, shingles, percent), "links")
    joined = components(links)

    # round 2: the nearest neighbour in another component, from either side
    open_ = _in(_in(beside, joined, "a", "ca"), joined, "b", "cb").where("ca != cb")
    sided = open_.select("a", "b", "off", F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
        open_.select("a", "b", "off", F.col("b").alias("x"), F.col("a").alias("y"))
    )
    best = sided.groupBy("x").agg(F.min(F.struct("off", "y", "a", "b")).alias("m")).select("m.a", "m.b").distinct()
    tried = stage(best.unionByName(stars).distinct(), "tried")
    links = stage(_verified(best, shingles, percent), "links")
    joined = components(links.unionByName(joined.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    # round 3: regions that still span several components
    placed = _in(members.select("region", "big", "node", "n", "s1", "s2"), joined, "node", "c")
    spread = placed.groupBy("region", "c").agg(F.count(F.lit(1)).alias("size"))
    main = spread.groupBy("region").agg(F.max_by("c", F.struct("size", "c")).alias("main"), F.count(F.lit(1)).alias("parts"))
    placed = stage(placed.join(main.where("parts > 1").drop("parts"), "region"), "open")
    rest = _cross_pairs(placed.where("not big").withColumn("m", F.col("n")), percent)
    crowded = placed.where("big").select("node").distinct()
    asked = rest.select(F.explode(F.array("a", "b")).alias("node")).unionByName(crowded).distinct()
    more = stage(reps.join(asked.join(shingles.select("node"), "node", "left_anti"), "node"), "more")
    if not more.isEmpty():
        shingles = shingles.unionByName(stage_texts(_sets_of(docs, more, width, id_col, text_col), "shingles"))
    # the members of regions without a bound on their size: what they share with any other of them
    single = (
        shingles.join(crowded, "node")
        .mapInArrow(_shingle_rows, "shingle long, node long")
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("df"), F.max("node").alias("node"))
        .where("df = 1")
        .groupBy("node")
        .agg(F.count(F.lit(1)).cast("int").alias("own"))
    )
    parity = shingles.join(crowded, "node").mapInArrow(_parities, "node long, " + ", ".join(f"w{k} long" for k in range(WORDS)))
    shared = placed.where("big").join(single, "node", "left").withColumn("m", F.col("n") - F.coalesce("own", F.lit(0)))
    rest = rest.unionByName(_cross_pairs(shared.drop("own").join(parity, "node"), percent, WORDS)).distinct().join(tried, ["a", "b"], "left_anti")
    rest = stage(rest, "rest")
    if not rest.isEmpty():
        links = stage(_verified(rest, shingles, percent), "links")
        joined = components(links.unionByName(joined.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    placed = _in(reps.select("set_key", "node", "doc_id"), joined, "node", "root")
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = stage(placed.select("set_key", "root").join(least, "root"), "components")
    rows = sets.select("doc_id", "text_key", "n", "set_key").where("n > 0").join(classes, "set_key")
    rows = rows.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id", "root")
    alone = sets.where("n = 0").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root")
    )
    return rows.unionByName(alone)


def drop_near_copies(
    docs: DataFrame, width: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id; all columns stay."""
    classes = near_classes(docs, width, percent, id_col, text_col)
    kept = classes.where("root is not null and doc_id <=> component_id").groupBy("root").agg(
        F.min("doc_id").alias("doc_id"), F.min("text_key").alias("text_key")
    )
    who = unused_name(docs.columns, "__who")
    kept = stage(kept.select(F.xxhash64("doc_id", "text_key").alias(who)), "kept")
    empty = stage(classes.where("root is null").select(F.xxhash64("doc_id", "text_key").alias(who)).distinct(), "wordless")
    keyed = docs.withColumn(who, F.xxhash64(F.col(id_col).cast("long"), F.xxhash64(text_col)))
    grouped = keyed.join(kept, who, "left_semi").dropDuplicates([who])
    return grouped.unionByName(keyed.join(empty, who, "left_semi")).drop(who)
