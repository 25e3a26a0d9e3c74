"""Each operator against brute force, on awkward rows and on an empty table."""

import hashlib
import os
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

from helixtab.llm import ann, deepshallow, exactdup, linealign, mixing, neardup, packing  # noqa: E402
from helixtab.llm import sharding, substrings, token_store, tokens, toxicity  # noqa: E402
from helixtab.llm.common import new_folder  # noqa: E402
from helixtab.llm.tokens import encoder  # noqa: E402

TABLES = "/root/testdata/sf0.001"


def whole_ids(text, end):
    tokenizer = encoder(None).tokenizer
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def order_key(row):
    return tuple((x is not None, x) for x in row)


def test_scores_of_extreme_vectors():
    own = np.random.default_rng(2)
    x = own.standard_normal((300, 8))
    want = ann.exact_scores(x[0], x)
    size = np.where(np.arange(300) % 3 == 0, 1e200, np.where(np.arange(300) % 3 == 1, 1e-200, 1.0))[:, None]
    with np.errstate(all="raise", under="ignore"):
        got = ann.exact_scores(x[0] * 1e-200, x * size)
        assert np.allclose(got, want, rtol=0, atol=1e-14)
        assert np.allclose(ann._unit(x * size), ann._unit(x), rtol=0, atol=1e-14)


# --- tokens -----------------------------------------------------------------------------------


@pytest.mark.parametrize("most_kept", [0, 3, 1000])
def test_ids_with_few_kept_pieces(monkeypatch, most_kept):
    monkeypatch.setattr(tokens, "MOST_KEPT", most_kept)
    own = tokens.Encoder(tokens.vocabulary_path())
    texts = ["", "one two three", "two,three  four\n", "naïve Größe one", "x" * 100 + " one two", "one two three"]
    want = [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(3):
        for part in (texts[:2], texts[2:], texts):
            ids, bounds = own.encode(pa.array(part))
            got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
            assert got == [want[texts.index(t)] for t in part]
        assert len(own.kept) <= max(most_kept, 30)


def test_ids_of_texts_with_added_tokens():
    """Those of the vocabulary file as it is, also where a text holds one of its added tokens."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.vocabulary_path())
    texts = ["one<|endoftext|>two", "no such token", "", "<|endoftext|>", "a <|endoftext|> b, c<|endoftext|>", "<|endoftext", "|> end"]
    own = tokens.Encoder(tokens.vocabulary_path())
    for _ in range(2):
        for part in (texts, texts[3:5], texts[1:3], texts[3:4]):
            ids, bounds = own.encode(pa.array(part))
            assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in part]
    assert own.encode(pa.array(texts[:1]))[0].tolist() == [505, 50256, 11545]


def test_store(spark):
    path = new_folder(spark, "store")
    token_store.write_store(ugly(spark), path, shard_ids=500)
    got = token_store.scan_store(spark, path).orderBy("start").collect()
    want = Counter((i, zlib.crc32(np.array(whole_ids(t, 2), "<u4"))) for i, t, *_ in ugly_rows())
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == want
    place = 0
    for r in got:
        assert r.start == place
        place += r.n_tokens
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    keys = spark.createDataFrame([(12,), (9,), (15,), (777,), (None,)], "doc_id long")
    found = token_store.lookup(spark, path, keys).collect()
    assert Counter(r.doc_id for r in found) == {12: 2, 9: 1, 15: 2}
    for r in found:
        assert zlib.crc32(r.ids) == r.ids_crc32


def test_store_of_nothing(spark):
    path = new_folder(spark, "store")
    token_store.write_store(nothing(spark), path)
    assert token_store.scan_store(spark, path).count() == 0
    assert token_store.lookup(spark, path, spark.createDataFrame([(1,)], "doc_id long")).count() == 0


def test_perfect_hash():
    keys = np.random.default_rng(1).choice(1 << 62, 5000, replace=False).astype(np.uint64)
    seeds, slots = token_store.build_index(keys)
    assert sorted(slots) == list(range(5000))
    prints = np.zeros(5000, np.uint32)
    prints[slots] = token_store._fingerprint(keys)
    assert (token_store.find(keys, seeds, prints) == slots).all()
    assert (token_store.find(keys + np.uint64(1), seeds, prints) < 0).mean() > 0.99


def test_packing(spark):
    rows = packing.place_pieces(packing.cut_pieces(ugly(spark), capacity=64), capacity=64).collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(i for i, *_ in ugly_rows())
    bins = defaultdict(list)
    for r in rows:
        assert 1 <= r.length <= 64 and (r.piece == 0 or r.length == 64)
        assert zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4")) == r.ids_crc32
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= 64
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // 64) + 1
    assert sum(r.n_ids for r in packing.sequences(spark.createDataFrame(rows)).collect()) == total
    assert packing.place_pieces(packing.cut_pieces(nothing(spark))).count() == 0


def test_plan_uses_each_piece_once():
    plan = packing.plan_bins({3: 10, 5: 7, 8: 4, 1: 2}, 10)
    used = Counter()
    for times, content in plan:
        assert sum(k * n for k, n in content.items()) <= 10
        for k, n in content.items():
            used[k] += times * n
    assert used == {3: 10, 5: 7, 8: 4, 1: 2}
    assert packing._fullest(6, Counter({6: 1, 3: 2, 2: 2}), 10) == Counter({6: 1, 2: 2})


# --- duplicates -------------------------------------------------------------------------------


@pytest.mark.parametrize("largest", [True, False])
def test_copies(spark, largest):
    rows = exactdup.copy_classes(ugly(spark), keep_largest=largest).collect()
    groups = defaultdict(list)
    for i, t, *_ in ugly_rows():
        groups[hashlib.sha256(lowered(t).encode()).hexdigest()].append(i)
    assert len(rows) == len(ugly_rows())
    for r in rows:
        known = [x for x in groups[r.text_sha256] if x is not None]
        best = (max if largest else min)(known) if known else None
        assert (r.keep_id, r.group_size) == (best, len(groups[r.text_sha256]))
    assert sum(r.kept for r in rows) == len(groups)
    kept = exactdup.drop_copies(ugly(spark), keep_largest=largest)
    assert kept.columns == ugly(spark).columns and kept.count() == len(groups)
    assert exactdup.copy_classes(nothing(spark)).count() == 0


def test_near(spark):
    rows = neardup.near_classes(ugly(spark), width=4).collect()
    assert len(rows) == len(ugly_rows())
    sets = []
    for i, t, *_ in ugly_rows():
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", lowered(t)) if x]
        sets.append((i, {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()))
    owner = list(range(len(sets)))

    def find(x):
        while owner[x] != x:
            x = owner[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                owner[find(a)] = find(b)
    least = {}
    for k, (i, s) in enumerate(sets):
        root = find(k)
        least[root] = min([v for v in (least.get(root), i) if v is not None], default=None)
    want = Counter((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == want
    kept = neardup.drop_near_copies(ugly(spark), width=4)
    roots = {find(k) for k, (_, s) in enumerate(sets) if s}
    assert kept.count() == len(roots) + sum(not s for _, s in sets)
    assert neardup.near_classes(nothing(spark)).count() == 0


def test_near_family(spark):
    """A large family of differently changed copies, its members linked in many ways or not at all."""
    random = np.random.default_rng(4)
    base = [f"b{k}" for k in range(150)]
    docs = []
    for i in range(400):
        words = list(base)
        for k in random.choice(150, random.integers(1, 8), replace=False):
            words[k] += f"v{random.integers(1000)}"
        docs.append((i, " ".join(words)))
    rows = neardup.near_classes(spark.createDataFrame(docs, "doc_id long, text string"), width=4).collect()
    sets = [{tuple(t.split()[k : k + 4]) for k in range(147)} for _, t in docs]
    owner = list(range(400))
    for a in range(400):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = a, b
                while owner[x] != x:
                    x = owner[x]
                while owner[y] != y:
                    y = owner[y]
                owner[max(x, y)] = min(x, y)
    want = {}
    for a in range(400):
        x = a
        while owner[x] != x:
            x = owner[x]
        want[a] = x
    assert {r.doc_id: r.component_id for r in rows} == want


def brute_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[: len(t)]
        rest = np.frombuffer(t, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize("group", [4096, 2])
def test_repeats(spark, group):
    random = np.random.default_rng(group)
    pool = ["".join(random.choice(list("abé \0"), random.integers(5, 50))) for _ in range(10)]
    texts = ["".join(random.choice(pool, random.integers(0, 7))) for _ in range(40)]
    texts += ["q" * 300, "pq" * 100, "", texts[0], None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = substrings.drop_repeats(docs, length=40, gram=10, group=group).orderBy("doc_id").collect()
    want = brute_repeats([(t or "").encode() for t in texts], 40)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == want


@pytest.mark.parametrize("group", [4096, 25, 3])
def test_repeats_in_large_groups(spark, group):
    """Near copies of one passage: equal surroundings are one member, and classes get narrower until they fit."""
    random = np.random.default_rng(5)
    base = [f"w{x}" for x in random.integers(0, 10**6, 60)]
    texts = []
    for k in range(150):
        words = list(base)
        words[int(random.integers(0, 60))] = f"x{k}"  # no two copies are equal, no anchor lies in all of them
        texts.append(" ".join(words[: int(random.integers(20, 61))]))
    texts += ["z" * 500, " ".join(base), " ".join(base[5:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = substrings.drop_repeats(docs, length=50, gram=12, group=group).orderBy("doc_id").collect()
    want = brute_repeats([t.encode() for t in texts], 50)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == want


def test_repeats_in_ugly_rows(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SEGMENT", 4096)
    rows = substrings.drop_repeats(ugly(spark), length=60, gram=20, with_bytes=True).collect()
    want = brute_repeats([(t or "").encode() for _, t, *_ in ugly_rows()], 60)
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == Counter(want)
    assert substrings.drop_repeats(nothing(spark)).count() == 0


def test_deep_shallow():
    random = np.random.default_rng(2)
    for _ in range(60):
        base = bytes(random.choice(list(b"ab\0"), 200))
        strings = [base[: random.integers(0, 200)] + bytes(random.choice(list(b"ab\0"), 9)) for _ in range(20)]
        found = deepshallow.order(strings, 0, 16)
        assert [strings[k] for k in found] == sorted(strings) and sorted(found) == list(range(20))


def test_alignment():
    a = [1, 2, 3, 4, 5, 6, 7]
    assert linealign.align(a, a) == [(0, 0, 7)]
    assert linealign.align([9, 1, 2, 3, 8], [1, 2, 3, 7]) == [(1, 0, 3)]
    assert linealign.align([1, 2], []) == []
    assert linealign.align([1, 5, 5, 2, 3], [1, 2, 5, 3]) == [(0, 0, 1), (3, 1, 1), (4, 3, 1)]


def test_lines(spark):
    block = "\n".join(f"a line that is shared, number {k}" for k in range(4))
    docs = [(1, "first own\n" + block + "\nend one"), (2, "second own\n" + block + "\nend two"), (3, "alone"), (4, "alone"), (4, "alone"), (5, None), (6, "")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    rows = linealign.drop_aligned_lines(table).collect()
    got = Counter((r.doc_id, r["copy"], r.n_lines, r.n_removed, r.kept_text) for r in rows)
    assert got == Counter(
        [
            (1, False, 6, 0, docs[0][1]),
            (2, False, 6, 4, "second own\nend two"),
            (3, False, 1, 0, "alone"),
            (4, True, 1, 1, ""),
            (4, True, 1, 1, ""),
            (5, False, 0, 0, None),
            (6, False, 1, 0, ""),
        ]
    )
    twice = linealign.drop_aligned_lines(spark.createDataFrame([(4, "alone")] * 3, "doc_id long, text string"))
    assert sorted(r["copy"] for r in twice.collect()) == [False, True, True]
    assert linealign.drop_aligned_lines(ugly(spark)).count() == len(ugly_rows())
    assert linealign.drop_aligned_lines(nothing(spark)).count() == 0


def left_lines(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.kept_text for r in linealign.drop_aligned_lines(table).orderBy("doc_id").collect()]


def test_lines_of_many_earlier_texts(spark):
    """A text that repeats passages of a dozen others, and blocks whose parts stand in still earlier texts."""
    passages = ["\n".join(f"passage {p} has its own line, number {k}" for k in range(10)) for p in range(12)]
    whole = "\n".join(f"{p}\nan own line after passage {k}" for k, p in enumerate(passages))
    got = left_lines(spark, [*passages, whole])
    assert got == [*passages, "\n".join(f"an own line after passage {k}" for k in range(12))]
    lines = [f"a line of the block with number {k}" for k in range(4)]
    alone = [f"text {k}\n{x}\nthe end of {k}" for k, x in enumerate(lines)]
    got = left_lines(spark, [*alone, "b\n" + "\n".join(lines) + "\nb end", "c\n" + "\n".join(lines) + "\nc end"])
    assert got == [*alone, "b\n" + "\n".join(lines) + "\nb end", "c\nc end"]
    # two lines of this block are too short to be deleted, the whole is not
    short = [f"fifteen bytes {k}" for k in range(4)]
    parts = [f"text {k}\n{short[k]}\n{short[k + 1]}\nthe end of {k}" for k in range(3)]
    got = left_lines(spark, [*parts, "b\n" + "\n".join(short) + "\nb end", "c\n" + "\n".join(short) + "\nc end"])
    assert got == [*parts, "b\n" + "\n".join(short) + "\nb end", "c\nc end"]


def test_lines_that_stand_alone(spark):
    """A passage of over 50 words in one line goes, in whichever texts it stands; a short line stays."""
    words = " ".join(f"w{k}" for k in range(51))
    least = " ".join("abcdefghijklmnopqrstuvwxyz"[k % 26] for k in range(51))
    texts = [f"first {k}\n{x}\nlast {k}" for k, x in enumerate((words, least, words, least, "just a short line of six", "just a short line of six"))]
    got = left_lines(spark, [*texts, f"both\n{words}\nbetween\n{least}\nends"])
    assert got == [*texts[:2], "first 2\nlast 2", "first 3\nlast 3", *texts[4:], "both\nbetween\nends"]


def test_runs_cover_each_block():
    random = np.random.default_rng(5)
    for _ in range(300):
        widths = random.choice([0, 3, 15, 30, 60, 120], random.integers(1, 12)).tolist()
        least = int(random.integers(1, 4))

        def enough(i, j):
            return (j - i >= least and sum(widths[i:j]) >= 40) or sum(widths[i:j]) >= 100

        spans = linealign.runs(widths, least, 40)
        for i in range(len(widths)):
            for j in range(i + 1, len(widths) + 1):
                if enough(i, j):
                    inside = [s for s in spans if i <= s[0] and s[1] <= j and enough(*s)]
                    assert {x for a, b in inside for x in range(a, b)} == set(range(i, j))


# --- choice and layout ------------------------------------------------------------------------


def test_mix_meets_shortage_among_siblings_first(spark):
    sizes = {("d", "a", "s1"): 100, ("d", "a", "s2"): 1000, ("d", "b", "s3"): 1000, ("e", "a", "s4"): 2000}
    leaves = spark.createDataFrame([(*k, v) for k, v in sizes.items()], "__n_domain string, __n_lang string, __n_source string, __supply long")
    weights = {x: {None: 1} for x in mixing.TREE}
    got = {r["__n_source"]: int(r["__budget"]) for r in mixing.leaf_budgets(leaves, weights=weights, budget_percent=50, max_epochs=1).collect()}
    # 2050 in all, 1025 to a domain, 512 to a language: s1 is short, its sibling s2 has the rest
    assert got == {"s1": 100, "s2": 412, "s3": 512, "s4": 1025}


def test_mix_on_ugly_rows(spark):
    """Columns named like results, or like what the mixing works with, come out as they were."""
    own = {"N_tokens": 7, "copies_": 5, "__tokens": 3, "__range": 2, "in0": 1, "a.b`c": 4}
    docs = mixing.with_domain(ugly(spark)).withColumns({n: F.lit(v) for n, v in own.items()})
    mixed = mixing.mix(docs, mixing.token_estimate(F.col("text")))
    renamed = {"copies": "copies__", "N_tokens": "N_tokens_"}
    assert mixed.columns == [*(renamed.get(c, c) for c in docs.columns), "n_tokens", "copies"]
    rows = mixed.collect()
    assert {(r["copies__"], *(r[renamed.get(n, n)] for n in own)) for r in rows} == {(9, *own.values())}
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(r[:2] for r in ugly_rows())
    assert len(rows) == len(ugly_rows())
    total = sum(r.n_tokens for r in rows)
    assert sum(r.n_tokens * r.copies for r in rows) <= total * 0.8
    assert all(0 <= r.copies <= 3 for r in rows)
    assert mixing.mix(mixing.with_domain(nothing(spark)), F.lit(1)).count() == 0


def test_shards(spark):
    rows = sharding.shard_documents(ugly(spark), new_folder(spark, "map"), shards=3, slots=64).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in ugly_rows())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert sharding.shard_documents(nothing(spark), new_folder(spark, "map")).count() == 0


def test_slot_map_edits(spark):
    sizes = np.random.default_rng(0).integers(1, 1000, 512).tolist()
    owner = sharding.deal(sizes, 8)
    loads = sharding._loads(owner, sizes, 8)
    assert max(loads) - min(loads) <= 1000
    more = sharding.grow(owner, sizes, 8)
    assert all(b in (a, 8) for a, b in zip(owner, more))
    loads = sharding._loads(more, sizes, 9)
    assert max(loads) < 1.05 * sum(sizes) / 9 + 1000
    sizes[:20] = [5000] * 20
    again = sharding.rebalance(owner, sizes, 8)
    assert max(sharding._loads(again, sizes, 8)) <= max(sharding._loads(owner, sizes, 8))
    path = new_folder(spark, "map")
    sharding.write_map(spark, path, 0, owner)
    sharding.write_map(spark, path, 1, again)
    assert [r.shard for r in sharding.read_map(spark, path).orderBy("vslot").collect()] == again
    assert [r.shard for r in sharding.read_map(spark, path, 0).orderBy("vslot").collect()] == owner


def test_vectors(spark):
    random = np.random.default_rng(6)
    vectors = random.standard_normal((600, 16)).astype(np.float32)
    vectors[100:180] = vectors[50]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(600, None), (650, [0.0] * 16), (700, [1.0, None] + [0.0] * 14), (750, [float("nan")] * 16), (None, [1.0] * 16), (800, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in ann.nearest(table, block_rows=50).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    v = vectors.astype(float)
    assert sorted(got) == list(range(0, 600, 50))
    hit = 0
    for q, found in got.items():
        score = ann.exact_scores(v[q], v)
        score[q] = -2
        best = np.lexsort((np.arange(600), -score))[:5]
        assert len(found) == 5 and all(s == score[i] for i, s in found)
        hit += len(set(best) & {i for i, _ in found})
    assert hit >= 0.9 * 5 * len(got)
    assert got[50] == [(i, got[50][0][1]) for i in range(100, 105)]
    assert ann.nearest(table.where("vec_id = 0")).count() == 0
    assert ann.nearest(table.where("vec_id < 3")).count() == 2
    assert ann.nearest(table.limit(0)).count() == 0


def test_toxicity(spark):
    random = np.random.default_rng(8)
    words = [f"word{chr(97 + k)}" for k in range(26)]
    docs, labels = [], []
    for i in range(600):
        text = random.choice(words, 30).tolist()
        bad, junk = i % 5 == 0, i % 7 == 0
        text += ["nastyabc"] * bad + ["$$$"] * junk
        docs.append((i, " ".join(text)))
        labels.append((i, int(not junk), int(bad)))
    docs += [(1000, None), (1001, "")]
    labels += [(1000, None, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = toxicity.fit_chain(table, marks.where("doc_id < 300"), toxicity.label_categories(), sample_rows=250)
    assert [link.category for link in chain] == ["low_quality", "toxic"]
    # the later model has a weight for the earlier category's probability
    assert len(chain[1].weights) == len(chain[1].features) + 2
    rows = toxicity.score(table, chain).where("doc_id between 300 and 599").collect()
    assert np.mean([(r.scores.toxic >= 0.5) == (r.doc_id % 5 == 0) for r in rows]) > 0.98
    assert toxicity.drop_toxic(ugly(spark), marks.limit(0)).count() == len(ugly_rows())
    assert toxicity.drop_toxic(nothing(spark), marks).count() == 0
    assert toxicity.score(table, chain).where("doc_id >= 1000").count() == 2
