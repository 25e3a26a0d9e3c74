"""The n-gram join, the Merkle manifest and the hard negatives against brute force."""

import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from cases import nothing, ugly, ugly_rows  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from helixtab.llm import hardneg, manifest, ngramjoin  # noqa: E402
from helixtab.llm.common import new_folder  # noqa: E402
from helixtab.llm.queries import QUERIES  # noqa: E402


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def grams(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def similar(a, b, percent):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def classes_by_hand(rows, width, percent):
    """Counter of (id, set size, smallest id reachable)."""
    sets = [grams(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if similar(sets[a], sets[b], percent):
                parent[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min((x for x in (least.get(top(k)), i) if x is not None), default=None)
    return Counter((i, len(s), least[top(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def families(seed, count=8, members=25):
    """Texts of many lengths with copies changed in a few places, some just below and some just above the limit."""
    own = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for f in range(count):
        base = own.choices(words, k=own.choice([3, 9, 10, 11, 20, 40, 75, 150, 300]))
        for _ in range(members):
            text = list(base)
            for _ in range(own.randint(0, max(1, len(base) // 25))):
                place = own.randrange(len(text))
                how = own.randrange(3)
                if how == 0:
                    text[place] = own.choice(words)
                elif how == 1:
                    text.insert(place, own.choice(words))
                elif len(text) > 1:
                    del text[place]
            rows.append((len(rows), " ".join(text)))
    return rows


# --- n-gram join ------------------------------------------------------------------------------


def joined(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return Counter(tuple(r) for r in ngramjoin.ngram_classes(docs, **options).collect())


@pytest.mark.parametrize("percent", [90, 80])
def test_ngram_join(spark, percent):
    rows = families(percent)
    want = classes_by_hand(rows, 3, percent)
    assert len({c for _, _, c in want}) < len(rows)
    assert joined(spark, rows, percent=percent) == want


def test_ngram_join_of_split_regions(spark):
    """Regions cut into many blocks give the same classes."""
    rows = families(5, count=3, members=60)
    assert joined(spark, rows, block_sets=7, block_ngrams=400) == classes_by_hand(rows, 3, 90)


def test_ngram_join_on_ugly_rows(spark):
    got = Counter(tuple(r) for r in ngramjoin.ngram_classes(ugly(spark)).collect())
    assert got == classes_by_hand([(i, t) for i, t, *_ in ugly_rows()], 3, 90)
    assert ngramjoin.ngram_classes(nothing(spark)).count() == 0


@pytest.mark.parametrize("percent", [80, 90, 95])
def test_similar_sets_share_a_key(percent):
    own = np.random.default_rng(percent)
    for n in [1, 2, 5, 9, 10, 11, 19, 20, 47, 48, 60, 200, 1000, 5000]:
        for _ in range(20):
            a = own.choice(1 << 62, n, replace=False).astype(np.uint64)
            out = int(own.integers(0, n // 5 + 1))
            b = np.concatenate((a[out:], own.choice(1 << 62, int(own.integers(0, n // 5 + 1)), replace=False).astype(np.uint64)))
            both = n - out
            if 0 < both and 100 * both >= percent * (n + len(b) - both) and not (len(b) == n == both):
                assert set(ngramjoin.keys_of(np.sort(a), percent)) & set(ngramjoin.keys_of(np.sort(b), percent))


def test_nodes_that_share_a_key():
    """Whatever the batches, each key's nodes hang together, over the edges of the slice too."""
    own = random.Random(8)
    rows = sorted((own.choice([1, 2, 3, 50, 51, 52, 53]), k) for k in range(90))
    for cuts in ([], [0, 1, 2, 30, 31], [10, 20, 40, 60, 89], list(range(90))):
        batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 90])]
        batches = [pa.RecordBatch.from_pydict({"key": [k for k, _ in b], "node": [n for _, n in b]}, pa.schema([("key", pa.int64()), ("node", pa.int64())])) for b in batches]
        out = [r for b in ngramjoin._sharing(iter(batches)) for r in b.to_pylist()]
        first = {k: min(n for j, n in rows if j == k) for k, _ in rows}
        assert sorted((r["a"], r["b"]) for r in out if r["b"] is not None) == sorted((first[k], n) for k, n in rows if n != first[k])
        assert [(r["key"], r["a"]) for r in out if r["b"] is None] == [(rows[0][0], rows[0][1]), (rows[-1][0], first[rows[-1][0]])]


def test_tree_finds_all_links():
    own = random.Random(3)
    for percent in (60, 80, 90):
        for _ in range(15):
            base = [own.sample(range(60), own.randint(1, 40)) for _ in range(4)]
            sets = {tuple(sorted(set(own.choice(base)) ^ set(own.sample(range(70), own.randint(0, 4))))) for _ in range(40)}
            sets = [s for s in sets if s]
            arrays = [np.array(s, np.uint64) for s in sets]
            parent = list(range(len(sets)))

            def top(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for a, b in ngramjoin.links_of(arrays, list(range(len(sets))), percent):
                assert similar(set(sets[a]), set(sets[b]), percent)
                parent[top(a)] = top(b)
            for a in range(len(sets)):
                for b in range(a):
                    if similar(set(sets[a]), set(sets[b]), percent):
                        assert top(a) == top(b)


def test_ngram_query(spark):
    """The registered query on the smallest table."""
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op11_prefix_tree_join"](spark, folder).collect())
    assert got == classes_by_hand(rows, 3, 90)


# --- manifest ---------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(*values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_by_hand(row):
    """Levels from the leaves up."""
    levels = [list(row)]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha(*now[k : k + 3]) for k in range(0, len(now), 3)])
    return levels


def proof_by_hand(levels, at):
    out = []
    for row in levels[:-1]:
        low = at - at % 3
        out.append((row[low:at], row[at + 1 : low + 3]))
        at //= 3
    return out


def manifest_by_hand(rows):
    """(doc_id, leaf, subroot, root, proof, folded root) of (doc_id, source, lang, n_chars, text)."""
    leaves = defaultdict(list)
    for row in rows:
        doc, source, lang, n_chars, text = row
        leaf = leaf_by_hand(*row)
        other = leaf
        if doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0:
            other = leaf_by_hand(doc, source, lang, n_chars, None if text is None else text.replace("\n", ""))
        leaves[source].append((doc, leaf, other))
    sources = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        leaves[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree_by_hand([leaf for _, leaf, _ in leaves[s]])
    upper = tree_by_hand([trees[s][-1][0] for s in sources])
    out = Counter()
    for k, s in enumerate(sources):
        for at, (doc, leaf, other) in enumerate(leaves[s]):
            proof = proof_by_hand(trees[s], at) + proof_by_hand(upper, k)
            folded = other
            for left, right in proof:
                folded = sha(*left, folded, *right)
            out[doc, leaf, trees[s][-1][0], upper[-1][0], sha(*[x for left, right in proof for x in left + right]), folded] += 1
    return out


def manifest_rows(spark, rows, levels=2):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, grp string, pos int, digest string")
    when = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    out = manifest.manifest(docs.repartition(3), tampered=manifest.newlines_removed(), when=when, levels=levels)
    return out.withColumn("proof", manifest.proof_digest())


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest(spark, levels):
    """One source with most rows, one with a single row, null fields, repeated rows, columns with names used inside."""
    own = random.Random(1)
    rows = []
    for k in range(140):
        source = own.choice(["big", "big", "big", "é", "e", None, "z" * 3])
        text = own.choice([None, "", "one\ntwo", f"text {k}\n\n{k}", "no line feed", "中文\n"])
        rows.append((own.choice([k, k, k, 7, None, 1 << 60]), source, own.choice(["en", None]), own.choice([k, None, -3]), text))
    rows += [rows[3]] * 5 + [(900, "single", None, None, None)]
    got = manifest_rows(spark, [(*r, "x", 1, "y") for r in rows], levels).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded_root) for r in got) == manifest_by_hand(rows)
    for r in got:
        assert (r.tampered_leaf is None) == (r.copied is None)
        if r.copied is not None:
            assert len(r.copied) == len(r.left) and r.copied[-1] == r.folded_root
        else:
            assert r.folded_root == r.root


def test_manifest_of_one_and_of_nothing(spark):
    (r,) = manifest_rows(spark, [(4, None, None, None, "a\nb", "x", 1, "y")]).collect()
    assert r.leaf == r.subroot == r.root and r.proof == sha()
    assert manifest.manifest(nothing(spark)).count() == 0


def test_versions_share_what_they_do_not_change():
    block = manifest.Block([str(k) for k in range(20)], manifest.depth_of(20))
    before = block.top

    def nodes(node):
        yield node
        for child in node[1]:
            yield from nodes(child)

    old = {id(n) for n in nodes(before)}
    copies = block.version(13, "changed")
    fresh = [n for n in nodes(copies[-1]) if id(n) not in old]
    assert len(fresh) == block.levels + 1 == len(copies)
    assert block.top is before
    leaves = [str(k) for k in range(20)]
    leaves[13] = "changed"
    assert copies[-1][0] == manifest.Block(leaves, block.levels).top[0]


# --- hard negatives ---------------------------------------------------------------------------


def negatives_by_hand(rows, every):
    usable = []
    size = Counter(len(v) for _, v, _ in rows if v is not None).most_common(1)[0][0]
    for i, v, label in rows:
        if i is None or v is None or label is None or len(v) != size or any(x is None or not np.isfinite(x) for x in v):
            continue
        usable.append((i, [int(np.floor(256 * x)) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = Counter()
    for k, (i, v, label) in enumerate(usable):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for h, (j, w, m) in enumerate(usable) if h != k)
        for s, j, m in [x for x in scored if x[2] == label][:5]:
            inside = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s]
            for rank, (t, h, _) in enumerate(inside[:5]):
                out[i, j, rank + 1, h, -s, -t] += 1
    return out


def vectors(spark, rows):
    wide = [(*r, "x", 1.0, 3) for r in rows]
    return spark.createDataFrame(wide, "vec_id long, embedding array<double>, label int, row string, score double, home int").repartition(3)


def mined(spark, rows, **options):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return Counter(tuple(r) for r in hardneg.hard_negatives(vectors(spark, rows), label=moved, **options).collect())


@pytest.mark.parametrize("options", [{}, {"block_rows": 17, "block_anchors": 3, "references": 4}])
def test_hard_negatives(spark, options):
    own = np.random.default_rng(4)
    centres = own.standard_normal((5, 12))
    rows = []
    for k in range(260):
        v = centres[own.integers(5)] + own.standard_normal(12) * own.choice([0.05, 0.3, 2])
        rows.append((int(k), (np.round(v, 1) if k % 3 else v).tolist(), 1 if k % 3 == 0 else int(own.integers(10))))
    rows += rows[20:30] + [(None, rows[0][1], 1), (300, None, 1), (301, rows[0][1], None), (302, [float("nan")] * 12, 1)]
    rows += [(310, [None, *rows[0][1][1:]], 1), (320, [0.0] * 12, 2), (330, [1.0], 1), (340, [], 1), (350, [-1e-17] * 12, 1)]
    want = negatives_by_hand(rows, 10)
    assert len(want) > 200
    assert mined(spark, rows, every=10, **options) == want


def test_hard_negatives_of_large_components(spark):
    own = np.random.default_rng(5)
    rows = [(k, (own.standard_normal(6) * 10.0 ** own.integers(0, 7)).tolist(), k % 3) for k in range(80)]
    assert mined(spark, rows, every=5) == negatives_by_hand(rows, 5)
    huge = [(k, [10.0**200 * (1 + k), 1.0], k % 2) for k in range(12)]
    assert all(n[4] == 2**63 - 1 for n in mined(spark, huge, every=2))


def test_hard_negatives_of_nothing(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(0, [1.0], 1)], every=1)


def test_bounds_hold():
    own = np.random.default_rng(6)
    for spread in (0.001, 0.3, 5):
        x = np.rint((own.standard_normal(9) + own.standard_normal((400, 9)) * spread) * 256)
        x[5] = 0
        references = hardneg.fit_references(x[:100], 8)
        angles, lengths = hardneg.angles_to(x, references), hardneg.lengths_of(x)
        for k in range(0, 400, 5):
            low, high = hardneg.score_bounds(angles[k], lengths[k], angles, lengths)
            scores = hardneg.integer_scores(x[k], x)
            assert (low <= scores).all() and (scores <= high).all()


def test_negatives_query_folder(spark):
    """An embeddings table without rows."""
    folder = new_folder(spark, "tables")
    vectors(spark, []).select("vec_id", "embedding", "label").write.parquet(f"{folder}/embeddings.parquet")
    assert QUERIES["op13_angular_hard_negatives"](spark, folder).count() == 0
