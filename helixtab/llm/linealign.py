"""Line de-duplication by pairwise alignment.

Documents that overlap are found through the runs of adjacent lines they share: a text meets, for each of
its shortest runs that are long enough to be deleted, the earliest text with that run.  Such runs cover every block
that is long enough, so no repeated block lies beside all of a text's partners, and a run of any
frequency gives at most one partner to a text.  Each pair is aligned by patience diff over line hashes;
common blocks of the alignment that are long enough are deleted from the later text: ``least_lines`` lines
of ``least_bytes`` in all, or ``lone_bytes`` in however few lines, so that a paragraph of one line counts.  What two texts share in
another order isn't all aligned.  Identical
texts are one text for this: every later copy is deleted whole, and the rest is aligned once.

"Later" is by (smallest id of the text, digest); lines are parts between line feeds, compared without
surrounding white space; blank lines alone are never followed but may lie within a block.

Defined results: a null text has no lines and stays null; an empty text keeps its one empty line;
of rows equal in id and text one stays and the others are copies; null ids come after all others; an empty table gives an empty table; other columns aren't read.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stage

LEAST_LINES = 2
LEAST_BYTES = 40
#: Bytes of a block that counts with fewer lines; a line of more than 50 words has at least so many.
LONE_BYTES = 100
LINES = "hashes array<long>, sizes array<int>, widths array<int>"
LEFT = "kept_text string, n_lines int, n_removed int"


# --- patience diff ----------------------------------------------------------------------------


def _patience(a: list[int], b: list[int], low_a: int, high_a: int, low_b: int, high_b: int) -> list[tuple[int, int]]:
    """Pairs of lines that stand once in either range, longest increasing run of them."""
    once_a = {x for x, n in Counter(a[low_a:high_a]).items() if n == 1}
    once_b = {x for x, n in Counter(b[low_b:high_b]).items() if n == 1} & once_a
    place = {a[i]: i for i in range(low_a, high_a) if a[i] in once_b}
    tails: list[int] = []
    chain: list[tuple[int, int, int]] = []
    last: list[int] = []
    for j in range(low_b, high_b):
        if b[j] in once_b:
            i = place[b[j]]
            k = bisect.bisect_left(tails, i)
            chain.append((i, j, last[k - 1] if k else -1))
            if k == len(tails):
                tails.append(i)
                last.append(len(chain) - 1)
            else:
                tails[k] = i
                last[k] = len(chain) - 1
    out = []
    at = last[-1] if last else -1
    while at >= 0:
        i, j, at = chain[at]
        out.append((i, j))
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Common blocks (start in a, start in b, lines) of two lists of line hashes, in order."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        low_a, high_a, low_b, high_b = todo.pop()
        while low_a < high_a and low_b < high_b and a[low_a] == b[low_b]:
            pairs.append((low_a, low_b))
            low_a, low_b = low_a + 1, low_b + 1
        while low_a < high_a and low_b < high_b and a[high_a - 1] == b[high_b - 1]:
            high_a, high_b = high_a - 1, high_b - 1
            pairs.append((high_a, high_b))
        if low_a == high_a or low_b == high_b:
            continue
        for i, j in (found := _patience(a, b, low_a, high_a, low_b, high_b)):
            todo.append((low_a, i, low_b, j))
            pairs.append((i, j))
            low_a, low_b = i + 1, j + 1
        if found:
            todo.append((low_a, high_a, low_b, high_b))
    blocks: list[list[int]] = []
    for i, j in sorted(pairs):
        if blocks and blocks[-1][0] + blocks[-1][2] == i and blocks[-1][1] + blocks[-1][2] == j:
            blocks[-1][2] += 1
        else:
            blocks.append([i, j, 1])
    return [tuple(x) for x in blocks]


# --- the job ----------------------------------------------------------------------------------


def split_lines(text: str) -> list[str]:
    return text.split("\n")


def line_hash(line: str) -> int:
    """Signed 64-bit hash of a line without surrounding white space; 0 only for blank lines."""
    line = line.strip()
    return (xxhash.xxh64_intdigest(line.encode()) | 1) - (1 << 63) if line else 0


def _lines(texts: pd.Series) -> pd.DataFrame:
    hashes, sizes, widths = [], [], []
    for text in texts:
        lines = split_lines(text) if text is not None else []
        hashes.append([line_hash(x) for x in lines])
        sizes.append([len(x.encode()) for x in lines])
        widths.append([len(x.strip().encode()) for x in lines])
    return pd.DataFrame({"hashes": hashes, "sizes": sizes, "widths": widths})


def long_enough(lines: int, size: int, least_lines: int, least_bytes: int, lone_bytes: int) -> bool:
    return (lines >= least_lines and size >= least_bytes) or size >= lone_bytes


def runs(widths: list[int], least_lines: int, least_bytes: int, lone_bytes: int = LONE_BYTES) -> set[tuple[int, int]]:
    """(start, end) of the shortest runs of lines that are long enough, from each start and to each end.

    Widths are bytes without surrounding white space, so equal lines have the same runs in all texts.
    Any block that is long enough is the union of such runs.  Runs of ``least_lines`` lines that reach
    ``least_bytes`` by white space at most are among them too, unless they are blank.
    """
    n = len(widths)
    upto = [0, *accumulate(widths)]

    def enough(i: int, j: int) -> bool:
        size = upto[j] - upto[i]
        return size > 0 and long_enough(j - i, size, least_lines, least_bytes, lone_bytes)

    out = set()
    j = 0
    for i in range(n):
        while j <= n and not (j > i and enough(i, j)):
            j += 1
        if j > n:
            break
        out.add((i, j))
    i = 0
    for j in range(1, n + 1):
        if enough(i, j):
            while i + 1 < j and enough(i + 1, j):
                i += 1
            out.add((i, j))
    for i in range(n - least_lines + 1):
        j = i + least_lines
        if upto[j] > upto[i] and not enough(i, j):
            out.add((i, j))
    return out


def _run_keys(least_lines: int, least_bytes: int, lone_bytes: int):
    def keys(hashes: pd.Series, widths: pd.Series) -> pd.Series:
        out = []
        for h, w in zip(hashes, widths):
            h = np.asarray(h, np.int64)
            spans = runs([int(x) for x in w], least_lines, least_bytes, lone_bytes)
            out.append(list({xxhash.xxh64_intdigest(h[i:j].tobytes()) - (1 << 63) for i, j in spans}))
        return pd.Series(out, dtype=object)

    return F.pandas_udf(keys, "array<long>")


def _blocks(least_lines: int, least_bytes: int, lone_bytes: int):
    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out: dict[str, list] = {"digest": [], "first": [], "lines": []}
            for digest, early, late, sizes in zip(part["digest"], part["early"], part["hashes"], part["sizes"]):
                for _, start, n in align(list(early), list(late)):
                    if long_enough(n, int(np.sum(sizes[start : start + n])), least_lines, least_bytes, lone_bytes):
                        out["digest"].append(digest)
                        out["first"].append(start)
                        out["lines"].append(n)
            yield pd.DataFrame(out)

    return find


def _key(digest: Column, ident: Column) -> Column:
    return F.concat(digest, F.coalesce(F.unhex(F.lpad(F.hex(ident), 16, "0")), F.lit(b"")))


def aligned_lines(
    docs: DataFrame,
    least_lines: int = LEAST_LINES,
    least_bytes: int = LEAST_BYTES,
    lone_bytes: int = LONE_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per pair of id and text: ``key``, ``n_rows`` of the pair, whether it is a ``copy`` of an
    earlier id's text, and ``gone``, the numbers of the lines that alignment deletes."""
    text = F.col(text_col)
    base = stage(
        docs.where(text.isNotNull())
        .select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"), F.pandas_udf(_lines, LINES)(text).alias("x"))
        .select("doc_id", "digest", "x.*"),
        "lines",
    )
    # the earliest id stands for a text; equal rows are one pair of id and text
    age = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")
    pairs = base.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n_rows"))
    first = pairs.groupBy("digest").agg(F.min(age).alias("age"))
    texts = stage(
        base.withColumn("key", _key(F.col("digest"), F.col("doc_id")))
        .join(first.select(_key(F.col("digest"), F.col("age.doc_id")).alias("key"), "age"), "key")
        .dropDuplicates(["key"])
        .select("digest", "age", "hashes", "sizes", "widths"),
        "distinct",
    )
    keys = _run_keys(least_lines, least_bytes, lone_bytes)(F.col("hashes"), F.col("widths"))
    lines = stage(texts.select("age", F.explode(keys).alias("run")), "runs")
    # a run leads to its earliest text
    shared = lines.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("age").alias("leader")).where("n > 1")
    partners = (
        lines.join(shared.drop("n"), "run")
        .where(F.col("leader.digest") != F.col("age.digest"))
        .select(F.col("age.digest").alias("digest"), F.col("leader.digest").alias("partner"))
        .distinct()
    )
    early = texts.select(F.col("digest").alias("partner"), F.col("hashes").alias("early"))
    found = (
        partners.join(early, "partner")
        .join(texts.select("digest", "hashes", "sizes"), "digest")
        .select("digest", "early", "hashes", "sizes")
        .mapInPandas(_blocks(least_lines, least_bytes, lone_bytes), "digest binary, first int, lines int")
    )
    numbers = F.flatten(F.collect_list(F.sequence("first", F.col("first") + F.col("lines") - 1)))
    gone = found.groupBy("digest").agg(F.array_sort(F.array_distinct(numbers)).alias("gone"))
    plan = (
        pairs.join(first, "digest")
        .join(gone, "digest", "left")
        .select(
            _key(F.col("digest"), F.col("doc_id")).alias("key"),
            "n_rows",
            (~F.col("doc_id").eqNullSafe(F.col("age.doc_id"))).alias("copy"),
            "gone",
        )
    )
    plan = stage(plan, "alignment")
    for table in (base, texts, lines):
        discard(table)
    return plan


def _without(texts: pd.Series, copies: pd.Series, gone: pd.Series) -> pd.DataFrame:
    out: dict[str, list] = {"kept_text": [], "n_lines": [], "n_removed": []}
    for text, copy, drop in zip(texts, copies, gone):
        lines = split_lines(text) if text is not None else []
        left = set(range(len(lines))) if copy else set() if drop is None else set(drop)
        out["kept_text"].append(None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in left))
        out["n_lines"].append(len(lines))
        out["n_removed"].append(len(left))
    return pd.DataFrame(out)


def drop_aligned_lines(
    docs: DataFrame,
    least_lines: int = LEAST_LINES,
    least_bytes: int = LEAST_BYTES,
    lone_bytes: int = LONE_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, copy, n_lines, n_removed, kept_text (what is left of the text)."""
    plan = aligned_lines(docs, least_lines, least_bytes, lone_bytes, id_col, text_col)
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        _key(F.unhex(F.sha2(F.col(text_col), 256)), F.col(id_col).cast("long")).alias("key"),
    )
    joined = own.join(plan, "key", "left")
    # of rows equal in id and text, one is the text and the others are copies
    once = joined.where("n_rows = 1 or n_rows is null or copy").drop("n_rows")
    number = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    again = joined.where("n_rows > 1 and not copy").withColumn("copy", number > 1).drop("n_rows")
    rows = once.unionByName(again).withColumn("copy", F.coalesce("copy", F.lit(False)))
    return rows.withColumn("x", F.pandas_udf(_without, LEFT)("text", "copy", "gone")).select("doc_id", "copy", "x.n_lines", "x.n_removed", "x.kept_text")
