"""The n-gram Jaccard join against a comparison of all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from saleslens.llm import chosen_path as cp


def shingles(text):
    words = (text or "").lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """Sorted (doc_id, class_id, n_links, text_links, text_class)."""
    sets = [shingles(t) for _, t in rows]
    first = {}
    for (doc, _), s in zip(rows, sets):
        first[s] = min(first.get(s, doc), doc)
    docs, inverted = Counter(sets), defaultdict(set)
    for s in docs:
        for x in s:
            inverted[x].add(s)
    links, parent = defaultdict(set), {s: s for s in docs}

    def root(s):
        while parent[s] != s:
            s = parent[s]
        return s

    for s in docs:
        common = Counter(o for x in s for o in inverted[x] if o != s)
        for o, k in common.items():
            if 5 * k >= 4 * (len(s) + len(o) - k):
                links[s].add(o)
                parent[root(s)] = root(o)
    least = {}
    for s in docs:
        least[root(s)] = min(least.get(root(s), first[s]), first[s])
    out = []
    for (doc, _), s in zip(rows, sets):
        if s:
            out.append((doc, least[root(s)], sum(docs[o] for o in links[s]) + docs[s] - 1, len(links[s]), first[s]))
        else:
            out.append((doc, doc, 0, 0, doc))
    return sorted(out)


def found(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, cid int, comp int")
    return sorted(tuple(r) for r in cp.jaccard_classes(docs).collect())


def near_copies(rng, n, words=60, vocabulary=5000, changes=2):
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(changes + 1)):
            own[rng.choice((0, 1, words - 1, words - 2))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_all_links_are_found(spark):
    rng = random.Random(3)
    texts = [None, "", " \n", "one", "one", "ONE", "a b c d", "a b c d e", "a b c d e f", "same words " * 3000, "same words " * 3001]
    for n in (2, 3, 5, 40, 150):  # the last is larger than a small bucket
        texts += near_copies(rng, n)
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(150)]
    texts += [texts[20]] * 70
    for words in (8, 15, 200, 900):
        for _ in range(6):
            texts += near_copies(rng, 3, words, changes=4)
    rows = list(enumerate(texts)) + [(7, "a b c d e"), (7, "a b c d e"), (12, texts[30])]
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_blocks_of_a_large_group(spark, monkeypatch):
    """Blocks of about 16 sets: tight, loose and mixed groups, with copies, and a set that is equally far from all."""
    monkeypatch.setattr(cp, "BLOCK_BYTES", 16 * 1024)
    monkeypatch.setattr(cp, "BLOCK_SETS", 16)
    rng = random.Random(5)
    texts = near_copies(rng, 120, changes=4) + near_copies(rng, 150, words=400, changes=3) + near_copies(rng, 60, words=30, changes=2)
    base = [f"m{i}" for i in range(120)]
    for k in range(160):  # ever further from the first
        texts.append(" ".join(base[k % 40:] + [f"e{i}" for i in range(k % 40)]))
    texts += [texts[3]] * 20 + [texts[130]] * 5
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_large_buckets_leave_with_their_center(spark, monkeypatch):
    """Small buckets of 8: several groups, a passage that many share, and levels until no large bucket is left."""
    monkeypatch.setattr(cp, "SMALL", 8)
    monkeypatch.setattr(cp, "DRAWN", 6)
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(50))
    texts = [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.choice((10, 30, 60)))) for _ in range(200)]
    for n in (40, 60, 90):
        texts += near_copies(rng, n, words=80, changes=5)
    rows = list(enumerate(texts))
    assert found(spark, rows) == brute(rows)


def test_null_ids_within_groups(spark):
    """A NULL id changes nothing but the names: one among exact copies, alone among near ones, and a group without ids."""
    rng = random.Random(8)
    one, two, three = near_copies(rng, 6), near_copies(rng, 4), near_copies(rng, 3)
    texts = one + [one[0]] * 5 + two + three + [three[0]]
    rows = list(enumerate(texts))
    nameless = {7, 11, *range(15, 19)}  # a copy of one[0]; two[0], whose text no other row needs to have; all of three
    want = brute(rows)
    assert {c for d, c, *_ in want} == {0, 11, 15} and all(n for _, _, n, *_ in want)
    smallest = {11: min(d for d, c, *_ in want if c == 11 and d not in nameless), 15: None}
    docs = spark.createDataFrame([(None if d in nameless else d, t) for d, t in rows], "doc_id long, text string")
    got = Counter(tuple(r)[:4] for r in cp.jaccard_classes(docs).collect())
    assert got == Counter((None if d in nameless else d, smallest.get(c, c), n, m) for d, c, n, m, _ in want)


def test_empty_table(spark):
    assert found(spark, [(1, "a")])[:0] == found(spark, [(1, "a")])[1:]
    assert cp.jaccard_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whole_table(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(path).collect()]
    got = sorted(tuple(r) for r in cp.op5_chosen_path(spark, "/root/testdata/sf0.01").collect())
    assert got == brute(rows)


def test_helpers():
    texts = ["a b c d e f g", "b c d e f g h", "", "x y"]
    sets = cp.shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == [3, 3, 0, 1]
    assert cp.shared([sets[0], sets[1]], [sets[1], sets[3], sets[0]]).tolist() == [[2, 0, 3], [3, 0, 2]]
    assert cp.shared([], [sets[0]]).shape == (0, 1) and cp.shared([sets[0]], [sets[2]]).tolist() == [[0]]
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 900).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 100).astype(np.uint64)])
    assert abs((cp.sketch(a) == cp.sketch(b)).mean() - 0.8) < 0.15
    packed = [cp.signature(cp.sketch(x)).tobytes() for x in (a, b)]
    two = cp.symbols(pa.array(packed, pa.binary()))
    assert len(packed[0]) == cp.WIDTH // 4 and two.max() == 3 and (two[0] == two[1]).mean() >= cp.CANDIDATE
    assert (two[0] == two[1])[cp.sketch(a) == cp.sketch(b)].all()
    assert 1 - (1 - cp.survival()) ** cp.runs_for(0.9999) >= 0.9999


def test_recall_holds_at_every_depth():
    for depth in (1, 2, 3, 6, 20, 1000):
        assert 1 - (1 - cp.survival(depth)) ** cp.runs_for(cp.RECALL) >= cp.RECALL


def test_components_of_any_graph(spark):
    rng = random.Random(12)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(1000 + i, 999) for i in range(200)] + [(1000 + i, 998) for i in range(0, 200, 3)]
    edges += [(2000 + i, 2001 + i) for i in range(100)] + [(7, 7), (5000, 5001), (5001, 5000), (998, -4)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    want = {n: root(n) for e in edges for n in e if e[0] != e[1]}
    got = {r.node: r.comp for r in cp.components(spark.createDataFrame(edges, cp.EDGES)).collect()}
    assert got == want
