"""Jaccard join of n-gram sets by a prefix tree over globally ordered sets.

A document is the set of its distinct word n-grams; documents with equal sets are one class, which a
single representative stands for.  What can link is brought together first, what does is found by the
tree.

**Dealing.** Two sets of similarity ``p`` % differ by at most ``(100 - p) / (100 + p)`` of the sum of their
sizes.  All n-grams are divided into a few more classes than that many, so at least one class that
isn't empty is the same in both.  A set therefore has one key per class (a digest of its members there; the number
of classes depends on a band of sizes, and a set near the end of its band also has the keys of the next one).  Sets
that share a key, directly or over others, form a region: no link leaves a region, and a set is sent to its region once.

**The tree.** A task orders the n-grams of its sets by ascending frequency, ties by hash, the same
for all of them, and stores the ordered sets in a compressed prefix tree.  Each set walks down the
tree; all sets below a node share the overlap counted on the way to it.  A subtree is left when even all the n-grams
that remain, in the query after the last one passed and in the sets below by their lengths, can't give the
overlap that their sizes want; it is also left when all its sets are in the query's component already,
so that large families need few walks to their ends.

Regions of more than ``BLOCK_NGRAMS`` n-grams or ``BLOCK_SETS`` sets are split by hash.  Their blocks
are joined within themselves and with some members of the region that all blocks get.  What is then outside the
region's largest component meets all blocks of the region, part by part.  Nothing is capped or dropped.

Defined results: a null text, or one without words, has an empty set and is linked with nothing; fewer
words than the width make one n-gram; null ids are larger than all others and never name a component
that has another id; repeated rows are of one class; an empty table gives an empty table; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, mix64, returning_memory, shuffle_partitions, stage
from .components import components
from .neardup import shingle_sets
from .tokens import slices

PERCENT = 90
WIDTH = 3
BLOCK_NGRAMS = 2_000_000
BLOCK_SETS = 8192
LEADERS = 32
STEP, FRONT = 16, 256

# --- keys -------------------------------------------------------------------------------------


def _edges() -> np.ndarray:
    """First sizes of the bands: 1, 2, 3, 4, 6, 8, 12, ..., each about half as large again."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, edges[-1] * 3 // 2))
    return np.array(edges)


_BANDS = _edges()
_ODD = np.uint64(0x9E3779B97F4A7C15)


def bands_of(n: int, percent: int) -> list[int]:
    """The bands in which a set of ``n`` members can be linked with a larger or an equally large one."""
    own = int(np.searchsorted(_BANDS, n, "right")) - 1
    largest = n * 100 // percent
    return [own, own + 1] if largest >= _BANDS[own + 1] else [own]


def class_count(band: int, percent: int) -> tuple[int, int]:
    """Classes of a band, and how many of a set's classes may be empty without being named by keys."""
    top = int(_BANDS[band + 1]) - 1
    differ = 2 * top * (100 - percent) // (100 + percent)
    spare = differ // 16
    return differ + 1 + spare, spare


def keys_of(ngrams: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """64-bit keys of a set: two different sets that are similar enough have one in common."""
    out = []
    if not len(ngrams):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        own = mix64(ngrams + _ODD)
        for band in bands_of(len(ngrams), percent):
            classes, spare = class_count(band, percent)
            if classes == 1:  # only equal sets are similar enough
                continue
            salt = mix64(np.array([band], np.uint64) * _ODD)[0]
            of = (mix64(ngrams ^ salt) % np.uint64(classes)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            sizes = np.bincount(of, minlength=classes)
            full = np.flatnonzero(sizes)
            sums = np.zeros(classes, np.uint64)
            sums[full] = np.add.reduceat(own[order], (np.cumsum(sizes) - sizes)[full])
            named = full if classes - len(full) <= spare else np.arange(classes)
            out.append(mix64(sums[named] * _ODD + mix64(named.astype(np.uint64) + salt)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


_SETS = "doc_id long, who long, set_key binary, n int, keys binary"
_SETS_ARROW = pa.schema([("doc_id", pa.int64()), ("who", pa.int64()), ("set_key", pa.binary()), ("n", pa.int32()), ("keys", pa.binary())])


def _describe(width: int, percent: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            for low, high in slices(texts, 1 << 20):
                sets = shingle_sets(texts.slice(low, high - low), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        batch.column("who").slice(low, high - low),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([keys_of(s, percent).tobytes() for s in sets], pa.binary()),
                    ],
                    schema=_SETS_ARROW,
                )

    return describe


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of the first of a task's rows with each set."""
    seen: set[bytes] = set()
    for batch in batches:
        for low in range(0, batch.num_rows, 1000):
            part = batch.slice(low, 1000)
            keys, nodes = [np.zeros(0, np.int64)], []
            for set_key, own, node in zip(part.column("set_key").to_pylist(), part.column("keys"), part.column("node").to_pylist()):
                if set_key not in seen:
                    seen.add(set_key)
                    keys.append(np.frombuffer(own.as_py(), np.int64))
                    nodes.append(node)
            repeated = np.repeat(np.array(nodes, np.int64), [len(k) for k in keys[1:]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(repeated)], names=["key", "node"])


_MET = "a long, b long, key long"


def _sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a slice of (key, node) in order of the keys: each node (b) that shares a key with the key's first node
    here (a).  The first node of the slice's first and last key is also given with that key and no partner,
    as neighbouring slices may hold the same key."""

    def out(a, b, key) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, key)], names=["a", "b", "key"])

    last = None
    for batch in batches:
        key, node = (batch.column(c).to_numpy() for c in ("key", "node"))
        if not len(key):
            continue
        begins = np.concatenate(([True], key[1:] != key[:-1]))
        if last is None:
            yield out([node[0]], [None], [key[0]])
        lead = node[np.flatnonzero(begins)][np.cumsum(begins) - 1]
        if last is not None and key[0] == last[0]:
            lead[: int(np.argmax(begins[1:])) + 1 if begins[1:].any() else None] = last[1]
        met = lead != node
        if met.any():
            yield out(lead[met], node[met], np.full(int(met.sum()), key[0]))
        last = key[-1], lead[-1]
    if last is not None:
        yield out([last[1]], [None], [last[0]])


# --- the tree ---------------------------------------------------------------------------------


class PrefixTree:
    """Ordered sets in a compressed prefix tree; a node is a range of the sets in lexicographic order.

    ``sets`` are sorted arrays of ranks, all different, and none is empty.
    """

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u4").tobytes())
        self.order = np.array(order, np.int64)
        rows = [sets[k] for k in order]
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.flat = np.concatenate(rows)
        self.at = np.cumsum(self.sizes) - self.sizes
        common = np.zeros(len(rows), np.int64)  # with the set before
        for k in range(1, len(rows)):
            a, b = rows[k - 1], rows[k]
            m = min(len(a), len(b))
            apart = np.flatnonzero(a[:m] != b[:m])
            common[k] = apart[0] if len(apart) else m
        low, high, end, first, count, children = [], [], [], [], [], []
        todo = [(0, len(rows))]
        low.append(0)
        high.append(len(rows))
        while todo:
            following = []
            for lo, hi in todo:
                if hi - lo == 1:
                    end.append(int(self.sizes[lo]))
                    first.append(0)
                    count.append(0)
                    continue
                depth = int(common[lo + 1 : hi].min())
                cuts = [lo, *(lo + 1 + np.flatnonzero(common[lo + 1 : hi] == depth)).tolist(), hi]
                end.append(depth)
                first.append(len(low))
                count.append(len(cuts) - 1)
                for a, b in zip(cuts, cuts[1:]):
                    low.append(a)
                    high.append(b)
                    following.append((a, b))
            todo = following
        self.low, self.high, self.end, self.first, self.count = (np.array(x, np.int64) for x in (low, high, end, first, count))
        self.least = np.array([self.sizes[a:b].min() for a, b in zip(low, high)], np.int64)
        self.most = np.array([self.sizes[a:b].max() for a, b in zip(low, high)], np.int64)


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places ``start[k] .. start[k] + length[k]`` of all k in a row."""
    total = int(length.sum())
    shift = np.repeat(start - (np.cumsum(length) - length), length)
    return np.arange(total) + shift


def links_of(
    sets: list[np.ndarray], labels: list[int], percent: int = PERCENT, queries: list[bool] | None = None, members: list[bool] | None = None
) -> list[tuple[int, int]]:
    """Links (places of two sets) that join what is similar and has different labels, a forest of them.

    Each set of ``queries`` walks down the tree of ``members``; both are all sets unless given.
    """
    everything = [True] * len(sets)
    queries, members = queries or everything, members or everything
    lengths = np.array([len(s) for s in sets])
    values, ids, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, often))] = np.arange(len(values))
    placed = np.sort(np.repeat(np.arange(len(sets)), lengths) * len(values) + rank[ids]) % len(values)
    ranked = np.split(placed, np.cumsum(lengths)[:-1])

    inside = [k for k in range(len(sets)) if members[k]]
    tree = PrefixTree([ranked[k] for k in inside])
    inside = np.array(inside)[tree.order]
    label = np.array(labels, np.int64)
    found: list[tuple[int, int]] = []
    has = np.zeros(len(values), np.int64)

    def changes() -> tuple[np.ndarray, np.ndarray]:
        own = label[inside]
        return own, np.concatenate(([0], np.cumsum(own[1:] != own[:-1])))

    own, change = changes()
    for k in range(len(sets)):
        if not queries[k]:
            continue
        q, n = ranked[k], int(lengths[k])
        has[q] = 1
        todo = [(np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            node, depth, overlap = todo.pop()
            lo, hi = tree.low[node], tree.high[node]
            open_ = ~((change[hi - 1] == change[lo]) & (own[lo] == label[k]))
            node, depth, overlap = node[open_], depth[open_], overlap[open_]
            if not len(node):
                continue
            lo = tree.low[node]
            to = np.minimum(tree.end[node], depth + STEP)
            length = to - depth
            hits = np.concatenate(([0], np.cumsum(has[tree.flat[_spans(tree.at[lo] + depth, length)]])))
            ends = np.cumsum(length)
            overlap = overlap + hits[ends] - hits[ends - length]
            # how many of the query's n-grams are passed, and how many members can still be shared
            last = np.where(to > 0, tree.flat[np.maximum(tree.at[lo] + to - 1, 0)], -1)
            rest = n - np.searchsorted(q, last, "right")
            size = np.clip(rest + to, tree.least[node], tree.most[node])
            can = overlap + np.minimum(rest, size - to)
            stay = can * (100 + percent) >= percent * (n + size)
            node, to, overlap = node[stay], to[stay], overlap[stay]
            over = to == tree.end[node]
            alone = tree.count[node] == 0
            for x in np.flatnonzero(over & alone).tolist():  # the bound at a set's end is its exact overlap
                other = int(inside[tree.low[node[x]]])
                if label[other] != label[k]:
                    found.append((k, other))
                    label[label == label[other]] = label[k]
                    own, change = changes()
            inner = over & ~alone
            going = ~over
            count = tree.count[node[inner]]
            node = np.concatenate((node[going], _spans(tree.first[node[inner]], count)))
            depth = np.concatenate((to[going], np.repeat(to[inner], count)))
            overlap = np.concatenate((overlap[going], np.repeat(overlap[inner], count)))
            # the most promising nodes are looked at first, as what they link closes others
            best = np.argsort(overlap - depth, kind="stable")
            for low in range(0, len(best), FRONT):
                part = best[low : low + FRONT]
                todo.append((node[part], depth[part], overlap[part]))
        has[q] = 0
    return found


def _join_blocks(percent: int):
    """Links within each (region, block) of a group of them."""

    def join(group: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for _, part in group.groupby(["region", "block", "part"], sort=False):
            part = part.sort_values("role").drop_duplicates(["node", "role"])  # members, then queries
            nodes = part["node"].tolist()
            role = part["role"].tolist()
            if len(nodes) < 2 or set(role) in ({1}, {2}):  # nobody to ask, or to be asked
                continue
            pairs = links_of(
                [np.frombuffer(x, np.uint64) for x in part["ngrams"]],
                part["label"].tolist(),
                percent,
                queries=[r != 1 for r in role],
                members=[r != 2 for r in role],
            )
            a += [nodes[x] for x, _ in pairs]
            b += [nodes[y] for _, y in pairs]
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return join


# --- regions and components -------------------------------------------------------------------


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    key = F.xxhash64(F.col(id_col).cast("long"), F.xxhash64(text_col))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("who"), F.col(text_col).alias("text"))


def _ngrams_of(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, ngrams) of the representatives in ``wanted`` (node, who), at most once a task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # rows equal in id and text give the same set: a task gives one
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            batch = batch.filter(pa.array([not (x in seen or seen.add(x)) for x in nodes], pa.bool_()))
            texts = pc.fill_null(batch.column("text"), "")
            for low, high in slices(texts, 1 << 20):
                sets = shingle_sets(texts.slice(low, high - low), width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(low, high - low), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "ngrams"],
                )

    rows = _rows(docs, id_col, text_col).select("who", "text").join(wanted, "who").select("node", "text")
    return rows.mapInArrow(returning_memory(cut), "node long, ngrams binary")


def _labelled(members: DataFrame, joined: DataFrame) -> DataFrame:
    return members.join(joined, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")


def ngram_classes(
    docs: DataFrame,
    width: int = WIDTH,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ngrams: int = BLOCK_NGRAMS,
    block_sets: int = BLOCK_SETS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles and component_id, the smallest id reachable by links."""
    spark = docs.sparkSession
    described = _rows(docs, id_col, text_col).mapInArrow(returning_memory(_describe(width, percent)), _SETS)
    sets = stage(described.withColumn("node", F.monotonically_increasing_id()), "sets")
    classes = stage(sets.where("n > 0").groupBy("set_key").agg(F.min("node").alias("node")), "classes")

    # regions: sets that share a key, directly or over others
    keyed = sets.where("n > 0").select("set_key", "node", "keys").mapInArrow(_key_rows, "key long, node long")
    keyed = keyed.repartitionByRange(shuffle_partitions(spark), "key", "node").sortWithinPartitions("key", "node")
    met = stage(keyed.mapInArrow(_sharing, _MET), "met")
    edges = met.where("b is null").select("key", F.col("a").alias("node"))  # two rows a slice
    across = edges.join(edges.groupBy("key").agg(F.min("node").alias("lead")), "key").where("node != lead")
    ties = met.where("b is not null").select("a", "b").unionByName(across.select(F.col("lead").alias("a"), F.col("node").alias("b")))
    # a set may stand in several tasks; its representative takes their places
    stands = sets.where("n > 0").select("set_key", F.col("node").alias("of")).join(classes, "set_key").select("of", "node")
    for side in ("a", "b"):
        ties = ties.join(stands.select(F.col("of").alias(side), F.col("node").alias("rep")), side).drop(side).withColumnRenamed("rep", side)
    region = components(ties)
    region = stage(region.unionByName(region.select(F.col("root").alias("node"), "root").distinct()), "regions")
    members = sets.select("node", "who", "n").join(region.withColumnRenamed("root", "region"), "node")
    sizes = members.groupBy("region").agg(
        F.greatest(F.ceil(F.sum("n") / block_ngrams), F.ceil(F.count(F.lit(1)) / block_sets)).cast("long").alias("blocks")
    )
    members = members.join(sizes, "region").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    members = stage(members, "members")
    ngrams = stage(_ngrams_of(docs, members.select("node", "who"), width, id_col, text_col), "ngrams")

    split = members.where("blocks > 1")
    lowest = Window.partitionBy("region").orderBy(F.xxhash64("node", F.lit(1)), "node")
    leaders = split.withColumn("k", F.row_number().over(lowest)).where(F.col("k") <= LEADERS)
    leaders = leaders.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    first = members.select("region", "block", "node").unionByName(leaders.select("region", "block", "node"))
    first = first.withColumns({"part": F.lit(0).cast("long"), "role": F.lit(0), "label": F.col("node")})

    def joined_by_tree(rows: DataFrame) -> DataFrame:
        """Many small regions share a task; one block is never in two."""
        volume = members.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v")).first().v
        tasks = max(4 * shuffle_partitions(spark), -(-volume // block_ngrams))
        dealt = rows.withColumn("task", F.pmod(F.xxhash64("region", "block", "part"), F.lit(tasks))).join(ngrams, "node")
        return stage(dealt.groupBy("task").applyInPandas(_join_blocks(percent), "a long, b long"), "links")

    links = joined_by_tree(first)
    joined = components(links)

    if not split.isEmpty():
        # members outside the largest component of a region of several blocks meet all its blocks
        now = stage(_labelled(split, joined), "labelled")
        counts = now.groupBy("region", "label").agg(F.count(F.lit(1)).alias("size"))
        main = counts.groupBy("region").agg(F.max_by("label", F.struct("size", "label")).alias("main"))
        strays = now.join(main, "region").where("label != main").drop("main")
        parts = strays.groupBy("region").agg(
            F.greatest(F.ceil(F.sum("n") / block_ngrams), F.ceil(F.count(F.lit(1)) / block_sets)).cast("long").alias("parts")
        )
        upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
        asked = (
            strays.join(parts, "region")
            .withColumns({"part": F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts")), "role": F.lit(2)})
            .withColumn("block", upto("blocks"))
        )
        held = now.join(parts, "region").withColumn("role", F.lit(1)).withColumn("part", upto("parts"))
        names = ["region", "block", "part", "role", "node", "label"]
        more = joined_by_tree(asked.select(*names).unionByName(held.select(*names)))
        joined = components(links.unionByName(more))

    placed = _labelled(classes, joined)
    least = sets.where("n > 0").groupBy("set_key").agg(F.min("doc_id").alias("least"))
    named = placed.join(least, "set_key")
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.select("set_key", "label").join(smallest, "label").select("set_key", "component_id")
    out = sets.where("n > 0").join(named, "set_key").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    alone = sets.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    for table in (met, region, ngrams):
        discard(table)
    return out.unionByName(alone)
