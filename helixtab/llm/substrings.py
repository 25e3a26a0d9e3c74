"""Removal of long byte strings that occur more than once.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.  Texts are
UTF-8 bytes; matches never cross documents; strings are judged on the input.

Only some suffixes need sorting.  Each window of ``length`` bytes has an anchor, the position of the
least hash among its ``GRAM``-byte strings, which depends on the window's bytes alone; so equal windows have
equal anchors at equal places, and one anchor serves a run of neighbouring windows.  Anchors whose
gram occurs once in the corpus are dropped.  The others meet, with the bytes around them that their
windows cover, in groups of equal grams.  Within a group the suffixes from the anchors on and, reversed, the
bytes before them are put in order by deep-shallow sorting; taking the adjacent suffixes by falling common
prefix, and in each class so joined the nearest in the order of the bytes before, gives for every
anchor all the bytes that belong to a string of ``length`` that stands elsewhere too.

A group of more than ``GROUP`` members is divided before any task holds it.  Equal surroundings count as one
member; then a radix step deals members into classes that agree in more bytes around the anchor.  Two anchors with
a string in common agree in ``a`` bytes before them and in ``length - a`` from them on, so classes for ranges
of ``a`` lose no pair; classes still too large are divided by narrower ranges, down to those in which
members share a whole string and nothing is left to sort.  Equal texts are worked on once: a text that two
documents have goes as a whole if it has ``length`` bytes.

Defined results: a null text counts as empty and keeps its empty rest; texts shorter than ``length`` stay
whole; rows equal in id and text are two documents; null ids are like others; an empty table gives an
empty table; other columns aren't read.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, mix64, shuffle_partitions, stage, text_or_empty
from .deepshallow import common_prefix, order

LENGTH = 400
GRAM = 96
GROUP = 4096
SEGMENT = 2 << 20
_BITS = 22  # positions within a segment, overlaps included

_CODES = mix64(np.arange(1, 257, dtype=np.uint64))
_ODD = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)


# --- anchors ----------------------------------------------------------------------------------


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position on, put together from powers of two."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        part, size, factor = _CODES[data], 1, _ODD
        out, done = None, 0
        while True:
            if gram & size:
                if out is None:
                    out = part[: len(part)]
                else:
                    keep = min(len(out) - size, len(part))
                    out = part[:keep] * (factor * _ODD) + out[size : size + keep]
                done += size
            if done == gram:
                break
            part = part[:-size] * factor + part[size:]
            factor = factor * factor * _ODD
            size *= 2
        return mix64(out[:n])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Anchors of all windows of texts laid end to end: ``ends`` has for each byte its text's end.

    (position, bytes before it, bytes from it on, gram hash) of the bytes that its windows cover.
    """
    empty = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    if len(data) < length:
        return empty
    hashes = _gram_hashes(data, gram)
    low = np.uint64((1 << _BITS) - 1)
    marked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_least(marked, length - gram + 1)
    start = np.arange(len(least))
    start = start[ends[: len(least)] - start >= length]
    if not len(start):
        return empty
    at = (least[start] & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 0) | (np.diff(start) != 1))))
    last = np.append(first[1:], len(at)) - 1
    p = at[first]
    return p, p - start[first], start[last] + length - p, hashes[p]


def _segments(sizes: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text, byte from, byte to): runs of whole texts, or parts of a long one whose
    windows don't repeat."""
    first, total = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if total and total + size > SEGMENT:
            yield first, k, 0, total
            first, total = k, 0
        if size > SEGMENT:
            for low in range(0, size - length + 1, SEGMENT):
                yield k, k + 1, low, min(size, low + SEGMENT + length - 1)
            first, total = k + 1, 0
        else:
            total += size
    if total:
        yield first, len(sizes), 0, total


_ANCHOR = "d1 long, d2 long, key long, p long, before int, after int"
_ANCHOR_ARROW = pa.schema(
    [("d1", pa.int64()), ("d2", pa.int64()), ("key", pa.int64()), ("p", pa.int64()), ("before", pa.int32()), ("after", pa.int32())]
)


def _own_repeats(data: np.ndarray, text: np.ndarray, p, before, after, key):
    """Anchors whose whole stretch stands twice in one text: the first stays, and all their bytes go.

    Without this a text of one repeated byte would have an anchor at every position.
    """
    by = np.lexsort((p, key, text))
    twin = np.zeros(len(p), bool)
    near = (key[by][1:] == key[by][:-1]) & (text[by][1:] == text[by][:-1])
    twin[by[1:][near]] = True
    twin[by[:-1][near]] = True
    stay = np.ones(len(p), bool)
    spans: list[tuple[int, int, int]] = []
    seen: dict[tuple, int] = {}
    gone: set[int] = set()
    raw = data.tobytes()
    for k in np.flatnonzero(twin).tolist():
        low, high = int(p[k] - before[k]), int(p[k] + after[k])
        name = (int(text[k]), int(before[k]), xxhash.xxh3_128_digest(raw[low:high]))
        if name in seen:
            stay[k] = False
            gone.update((k, seen[name]))
        else:
            seen[name] = k
    for k in sorted(gone, key=lambda k: (int(text[k]), int(p[k] - before[k]))):
        low, high = int(p[k] - before[k]), int(p[k] + after[k])
        if spans and spans[-1][0] == text[k] and low <= spans[-1][2]:
            spans[-1] = (spans[-1][0], spans[-1][1], max(spans[-1][2], high))
        else:
            spans.append((int(text[k]), low, high))
    return stay, spans


def _find_anchors(length: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            if offsets[0] == offsets[-1]:
                continue
            whole = np.frombuffer(texts.buffers()[2], np.uint8)
            d1 = batch.column("d1").to_numpy(zero_copy_only=False)
            d2 = batch.column("d2").to_numpy(zero_copy_only=False)
            for first, last, low, high in _segments(np.diff(offsets), length):
                base = int(offsets[first]) + low
                data = whole[base : int(offsets[first]) + high]
                heads = np.maximum(offsets[first:last] - base, 0)
                tails = np.minimum(offsets[first + 1 : last + 1] - base, len(data))
                ends = np.repeat(tails, tails - heads)
                p, before, after, key = anchors(data, ends, length, gram)
                if not len(p):
                    continue
                text = np.searchsorted(tails, p, side="right")
                stay, spans = _own_repeats(data, text, p, before, after, key)
                # places count from the start of the text
                shift = low - heads if last - first == 1 else -heads
                cols = [x[stay] for x in (text, key.view(np.int64), p + shift[text], before, after)]
                own = np.array(spans, np.int64).reshape(-1, 3)
                sizes = own[:, 2] - own[:, 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((d1[first + cols[0]], d1[first + own[:, 0]])), pa.int64()),
                        pa.array(np.concatenate((d2[first + cols[0]], d2[first + own[:, 0]])), pa.int64()),
                        # a span that goes for certain has no key
                        pa.array(np.concatenate((cols[1], sizes * 0)), pa.int64(), mask=np.arange(len(cols[1]) + len(own)) >= len(cols[1])),
                        pa.array(np.concatenate((cols[2], own[:, 1] + shift[own[:, 0]])), pa.int64()),
                        pa.array(np.concatenate((cols[3], sizes * 0)).astype(np.int32), pa.int32()),
                        pa.array(np.concatenate((cols[4], sizes)).astype(np.int32), pa.int32()),
                    ],
                    schema=_ANCHOR_ARROW,
                )

    return find


# --- groups of equal grams --------------------------------------------------------------------


def covered(left: list[bytes], right: list[bytes], length: int = LENGTH, gram: int = 0) -> list[tuple[int, int]]:
    """For each anchor of a group, how many bytes before it and from it on belong to a string of
    ``length`` that stands at another anchor too; (0, 0) if none does.

    ``left`` has the bytes before the anchors in reverse.
    """
    n = len(right)
    best = [(0, 0)] * n

    def note(x: int, y: int, far: int) -> None:
        near = common_prefix(left[x], left[y])
        if near + far >= length:
            for z in (x, y):
                best[z] = (max(best[z][0], near), max(best[z][1], far))

    if n == 2:
        note(0, 1, common_prefix(right[0], right[1]))
        return best
    by_right = order(right, gram)
    rank = [0] * n
    by_left = order(left)
    for k, x in enumerate(by_left):
        rank[x] = k
    shared = [common_prefix(right[x], right[y]) for x, y in zip(by_right, by_right[1:])]
    owner = list(range(n))
    ranks: list[list[int]] = [[rank[x]] for x in by_right]  # sorted, of each class of adjacent suffixes

    def find(k: int) -> int:
        while owner[k] != k:
            owner[k] = owner[owner[k]]
            k = owner[k]
        return k

    for k in sorted(range(n - 1), key=lambda k: -shared[k]):
        a, b = find(k), find(k + 1)
        if len(ranks[a]) < len(ranks[b]):
            a, b = b, a
        into = ranks[a]
        for r in ranks[b]:
            i = bisect.bisect(into, r)
            if i:
                note(by_left[r], by_left[into[i - 1]], shared[k])
            if i < len(into):
                note(by_left[r], by_left[into[i]], shared[k])
            into.insert(i, r)
        owner[b], ranks[b] = a, []
    return best


_SPAN = "d1 long, d2 long, low long, high long"


def _spans(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["d1", "d2", "low", "high"])


def _match(length: int, gram: int):
    """Spans of the groups of a task; its rows are sorted by group."""

    def solve(group: dict[tuple[int, int, int], tuple[bytes, bytes]]) -> list[tuple[int, int, int, int]]:
        if len(group) < 2:
            return []
        found = covered([x[0] for x in group.values()], [x[1] for x in group.values()], length, gram)
        return [(d1, d2, p - a, p + b) for (d1, d2, p), (a, b) in zip(group, found) if b]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, out = None, {}, []
        for batch in batches:
            for name, d1, d2, p, left, right in zip(*(batch.column(c).to_pylist() for c in ("key", "d1", "d2", "p", "left", "right"))):
                if name != key:
                    out += solve(group)
                    key, group = name, {}
                group[d1, d2, p] = (left, right)
            if len(out) > 10_000:
                yield _spans(out)
                out = []
        yield _spans(out + solve(group))

    return match


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around the surviving anchors of each text; those before an anchor in reverse."""
    names = ("key", "hot", "d1", "d2", "p", "left", "right")
    for batch in batches:
        out: dict[str, list] = {n: [] for n in names}
        size = 0
        texts = batch.column("text").cast(pa.large_binary())
        for text, d1, d2, places in zip(texts, batch.column("d1").to_pylist(), batch.column("d2").to_pylist(), batch.column("places")):
            text = text.as_py()
            merged: dict[tuple[int, int], list] = {}
            for x in places.as_py():  # a long text's parts may each have a share of an anchor's windows
                own = merged.setdefault((x["p"], x["key"]), [0, 0, False])
                own[:] = max(own[0], x["before"]), max(own[1], x["after"]), own[2] or x["hot"]
            for (p, key), (before, after, hot) in merged.items():
                row = (key, hot, d1, d2, p, text[p - before : p][::-1], text[p : p + after])
                size += before + after
                for n, v in zip(names, row):
                    out[n].append(v)
            if size > 4 << 20:
                yield pa.RecordBatch.from_pydict(out, _CONTEXT_ARROW)
                out, size = {n: [] for n in names}, 0
        if out["key"]:
            yield pa.RecordBatch.from_pydict(out, _CONTEXT_ARROW)


_CONTEXT = "key long, hot boolean, d1 long, d2 long, p long, left binary, right binary"
_CONTEXT_ARROW = pa.schema(
    [("key", pa.int64()), ("hot", pa.bool_()), ("d1", pa.int64()), ("d2", pa.int64()), ("p", pa.int64()), ("left", pa.binary()), ("right", pa.binary())]
)


def _narrower(classes: DataFrame, width: int, step: int, length: int) -> DataFrame:
    """Members of classes for ``width`` counts of shared bytes before the anchor, from ``low`` on, dealt into
    classes for ``step`` counts each."""
    edge = F.least(F.col("low") + width, F.lit(length + 1))
    dealt = classes.withColumn("low", F.explode(F.sequence(F.col("low"), edge - 1, F.lit(step))))
    # who shares at most `last` bytes before the anchor needs the rest of the string from it on
    last = F.least(F.col("low") + step, F.lit(length + 1)) - 1
    dealt = dealt.withColumn("rest", F.greatest(length - last, F.lit(0)))
    dealt = dealt.where((F.octet_length("left") >= F.col("low")) & (F.octet_length("right") >= F.col("rest")))
    shared = [F.col("gram"), F.col("low"), F.expr("substring(left, 1, low)"), F.expr("substring(right, 1, rest)")]
    return dealt.withColumns({"key": F.xxhash64(*shared), "check": F.xxhash64(F.lit(7), *shared)}).drop("rest")


def _divided(contexts: DataFrame, length: int, gram: int, group: int) -> DataFrame:
    """Spans of the groups of more than ``group`` members, none of which is gathered whole."""
    parts = shuffle_partitions(contexts.sparkSession)
    same = ["key", "left", "right"]
    named = contexts.withColumns({"h1": F.xxhash64(*same), "h2": F.xxhash64(F.lit(7), *same)})
    # equal surroundings are put together before the shuffle
    members = stage(
        named.groupBy("h1", "h2").agg(
            F.count(F.lit(1)).alias("n"), F.first("key").alias("gram"), F.first("left").alias("left"), F.first("right").alias("right")
        ),
        "members",
    )
    used = [members]
    classes = members.select("h1", "h2", "gram", "left", "right", F.col("gram").alias("key"), F.lit(0).alias("low"))
    whole = F.col("n") > 1
    found = members.where(whole).select("h1", "h2", F.octet_length("left").alias("near"), F.octet_length("right").alias("far"))
    # each width is a multiple of the next, so no member meets itself in a class
    width, step = length + 1, 4 ** max(0, int(math.log((length + 1) / 4, 4)))
    while True:
        sizes = classes.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        large = sizes.where(F.col("size") > group).select("key")
        small = classes.join(large, "key", "left_anti").select("key", F.col("h1").alias("d1"), F.col("h2").alias("d2"), F.lit(0).alias("p"), "left", "right")
        matched = small.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_match(length, gram), _SPAN)
        found = found.unionByName(
            matched.select(F.col("d1").alias("h1"), F.col("d2").alias("h2"), (-F.col("low")).cast("int").alias("near"), F.col("high").cast("int").alias("far"))
        )
        if large.isEmpty():
            break
        classes = stage(_narrower(classes.join(large, "key", "left_semi"), width, step, length), "classes")
        used.append(classes)
        width, step = step, max(1, step // 4)
        if width == 1:  # members of a class share the string that starts ``low`` bytes before the anchor
            twice = classes.groupBy("key", "check").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key", "check")
            found = found.unionByName(
                classes.join(twice, ["key", "check"]).select("h1", "h2", F.col("low").alias("near"), (length - F.col("low")).alias("far"))
            )
            break
    # one row per member: the strings of an anchor all cover it, so they are one run
    reach = found.groupBy("h1", "h2").agg(F.max("near").alias("near"), F.max("far").alias("far"))
    spans = stage(
        named.select("h1", "h2", "d1", "d2", "p")
        .join(reach, ["h1", "h2"])
        .select("d1", "d2", (F.col("p") - F.col("near")).alias("low"), (F.col("p") + F.col("far")).alias("high")),
        "divided",
    )
    for table in used:
        discard(table)
    return spans


# --- the job ----------------------------------------------------------------------------------


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("d1"),
        F.xxhash64(F.lit(7), text).alias("d2"),
        text.alias("text"),
    )


def repeated_spans(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    group: int = GROUP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): for every row doc_id, d1, d2 (128 bits of its text), n_bytes, sha256, copies of the text,
    and whether it ``speaks`` for the text; for texts with repeats in other texts or twice inside, the spans (low, high) that go, which may overlap."""
    keyed = _keyed(docs, id_col, text_col)
    ids = stage(
        keyed.select("doc_id", "d1", "d2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256")), "ids"
    )
    texts = ids.groupBy("d1", "d2").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id")).alias("first")
    )
    rows = ids.join(texts, ["d1", "d2"]).select(*ids.columns, "copies", F.col("doc_id").eqNullSafe(F.col("first.doc_id")).alias("speaks"))

    found = stage(keyed.select("d1", "d2", "text").mapInArrow(_find_anchors(length, gram), _ANCHOR), "anchors")
    tag = F.xxhash64("d1", "d2", "p")
    # a gram is hot by the anchors of all documents; copies of a text make one member later on
    again = (
        found.where("key is not null")
        .groupBy("key")
        .agg(F.min(tag).alias("x"), F.max(tag).alias("y"), (F.count(F.lit(1)) > group).alias("hot"))
        .where("x != y")
        .select("key", "hot")
    )
    # copies of a text have the same anchors: one set for each text
    alive = stage(found.join(again, "key").select("d1", "d2", "key", "hot", "p", "before", "after").distinct(), "alive")
    places = alive.groupBy("d1", "d2").agg(F.collect_list(F.struct("key", "p", "before", "after", "hot")).alias("places"))
    places = places.join(texts.select("d1", "d2", "first.doc_id"), ["d1", "d2"]).select(
        F.xxhash64("d1", "d2", "doc_id").alias("who"), "places"
    )
    speakers = keyed.select(F.xxhash64("d1", "d2", "doc_id").alias("who"), "d1", "d2", "text")
    contexts = stage(
        speakers.join(places, "who").select("d1", "d2", "text", "places").mapInArrow(_cut_contexts, _CONTEXT), "contexts"
    )
    parts = shuffle_partitions(docs.sparkSession)
    matched = (
        contexts.where("not hot").repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_match(length, gram), _SPAN)
    )
    spans = matched.unionByName(
        found.where("key is null").select("d1", "d2", F.col("p").alias("low"), (F.col("p") + F.col("after")).alias("high"))
    )
    hot = contexts.where("hot")
    if not hot.isEmpty():
        spans = spans.unionByName(_divided(hot, length, gram, group))
    spans = stage(spans.distinct(), "spans")
    for table in (contexts, found, alive):
        discard(table)
    return rows, spans


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


_LEFT = "d1 long, d2 long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut_spans(with_bytes: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for k in range(batch.num_rows):
                text = texts[k].as_py()
                spans = merge_spans([(x["low"], x["high"]) for x in batch.column("spans")[k].as_py()])
                kept, at = [], 0
                for low, high in spans:
                    kept.append(text[at:low])
                    at = high
                rest = b"".join([*kept, text[at:]])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("d1").slice(k, 1),
                        batch.column("d2").slice(k, 1),
                        pa.array([sum(b - a for a, b in spans)], pa.int64()),
                        pa.array([len(spans)], pa.int64()),
                        pa.array([hashlib.sha256(rest).hexdigest()]),
                        pa.array([rest if with_bytes else None], pa.binary()),
                    ],
                    names=["d1", "d2", "n_removed", "n_spans", "kept_sha256", "kept"],
                )

    return cut


def drop_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    group: int = GROUP,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_bytes: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256, and if asked for ``kept``, what is left of texts that lose a part but not all."""
    rows, spans = repeated_spans(docs, length, gram, group, id_col, text_col)
    # a text that several documents have goes whole if it is long enough; no need to look at its spans
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    cut = spans.groupBy("d1", "d2").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    # the row that speaks for a text that loses a part
    part = rows.where(F.col("speaks") & ~whole).join(cut, ["d1", "d2"]).select(F.xxhash64("d1", "d2", "doc_id").alias("who"), "spans")
    speakers = _keyed(docs, id_col, text_col).select(F.xxhash64("d1", "d2", "doc_id").alias("who"), "d1", "d2", "text")
    left = speakers.join(part, "who").select("d1", "d2", "text", "spans").mapInArrow(_cut_spans(with_bytes), _LEFT)
    return rows.join(left, ["d1", "d2"], "left").select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        *(["kept"] if with_bytes else []),
    )
