"""Exact dedup: the index against plain dictionaries, the filter by itself, odd documents."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from saleslens.llm import cuckoo_dedup as cd


def normal(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(normal(text).encode()).digest()


def brute(rows):
    """Sorted (doc_id, keep_id, group_size, digest) and the number of rows kept."""
    groups = defaultdict(list)
    for doc, text in rows:
        groups[sha(text)].append(doc)
    keep = {d: max((i for i in ids if i is not None), default=None) for d, ids in groups.items()}
    return sorted(((doc, keep[sha(t)], len(groups[sha(t)]), sha(t)) for doc, t in rows), key=str), len(groups)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2, 3) for d, t in rows], "doc_id long, text string, digest string, n int, row int, shard int")


def found(out):
    rows = out.collect()
    kept = defaultdict(list)
    for r in rows:
        if r.kept:
            kept[bytes(r.digest)].append(r.doc_id)
    assert all(len(k) == 1 for k in kept.values())
    assert all(kept[bytes(r.digest)][0] == r.keep_id for r in rows)
    return sorted(((r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in rows), key=str), len(kept)


def test_odd_documents(spark):
    rows = [(1, None), (2, ""), (3, "A"), (4, "a"), (5, "Ä"), (6, "ä"), (7, "a "), (8, "\x00"), (9, "word " * 300_000), (10, "WORD " * 300_000)]
    rows += [(None, "no id"), (None, "no id"), (None, "NO ID"), (None, "some id"), (20, "Some id"), (21, "same"), (21, "same"), (21, "SAME")]
    rows += [(100 + i, "hot") for i in range(500)] + [(-5, "hot"), (-(2**63), "least"), (None, "least")]
    random.Random(1).shuffle(rows)
    assert found(cd.exact_dedup(frame(spark, rows))) == brute(rows)
    assert cd.exact_dedup(frame(spark, [])).collect() == []


def test_many_shards_with_many_resizes(spark, monkeypatch):
    monkeypatch.setattr(cd, "SHARD_KEYS", 64)
    monkeypatch.setattr(cd, "CHUNK", 16)
    rng = random.Random(2)
    rows = [(i, f"text {rng.randrange(900)}") for i in range(1500)]
    assert found(cd.exact_dedup(frame(spark, rows).repartition(7))) == brute(rows)


@pytest.fixture(scope="module")
def grown(spark):
    """An index after two additions and a removal, and the rows that are live."""
    rng = random.Random(4)
    first = [(i, f"t{rng.randrange(400)}") for i in range(700)] + [(None, "t1"), (None, "lone")]
    second = [(1000 + i, f"T{rng.randrange(600)}") for i in range(700)] + [(i, "again") for i in range(5)]
    gone = set(rng.sample(range(700), 300)) | set(range(1000, 1200)) | {99_999}
    old = cd.SHARD_KEYS
    cd.SHARD_KEYS = 256
    try:
        index = cd.add(cd.empty_index(spark), cd.digests(frame(spark, first)))
        small = index.bits
        index = cd.add(index, cd.digests(frame(spark, second), batch=1))
        assert index.bits > small  # the filters of the first shards were built again from stored keys
        left = cd.remove(index, spark.createDataFrame([(i,) for i in gone] + [(None,)], "doc_id long"))
    finally:
        cd.SHARD_KEYS = old
    return index, first + second, left, [r for r in first + second if r[0] is None or r[0] not in gone]


def test_additions_and_removals(grown):
    before, all_rows, after, live = grown
    for index, rows in ((before, all_rows), (after, live)):
        assert found(cd.exact_groups(index.members, index)) == brute(rows)
        want = {d: (k, n) for _, k, n, d in brute(rows)[0]}
        assert {bytes(r.digest): (r.doc_id, r.n) for r in index.entries.collect()} == want


def test_filters_hold_exactly_the_live_digests(grown):
    for index in grown[::2]:
        per_shard = defaultdict(int)
        for r in index.state.where("kind = 1").collect():
            per_shard[r.shard] += 1
        filters = {r.shard: cd.CuckooFilter.from_bytes(r.slots) for r in index.state.where("kind = 0").collect()}
        assert {s: int((f.slots > 0).sum()) for s, f in filters.items() if (f.slots > 0).any()} == dict(per_shard)


def test_lookup(spark, grown):
    _, _, index, live = grown
    want = {d: (k, n) for _, k, n, d in brute(live)[0]}
    asked = [(i, f"T{i}") for i in range(800)] + [(5000, "LONE"), (5001, None), (5002, "t1")]
    got = cd.lookup(index, cd.digests(frame(spark, asked), batch=2)).collect()
    assert sorted((r.doc_id, r.known_id, r.known_n) for r in got) == sorted((d, *want[sha(t)]) for d, t in asked if sha(t) in want)


def test_removing_all_and_adding_again(spark):
    rows = [(i, f"t{i % 30}") for i in range(90)]
    index = cd.add(cd.empty_index(spark), cd.digests(frame(spark, rows)))
    index = cd.remove(index, spark.range(90).withColumnRenamed("id", "doc_id"))
    assert index.entries.count() == 0 and cd.lookup(index, cd.digests(frame(spark, rows))).count() == 0
    index = cd.add(index, cd.digests(frame(spark, rows), batch=1))
    assert found(cd.exact_groups(index.members, index)) == brute(rows)


def test_filter_against_a_multiset():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    f = cd.CuckooFilter(1024)
    assert f.insert(keys) and f.contains(keys).all() and (f.slots > 0).sum() == 3000
    others = rng.integers(0, 2**64, 100_000, dtype=np.uint64)
    assert f.contains(others).mean() < 0.001  # hits of other keys are verified against the content
    f.delete(keys[:1500])
    assert f.contains(keys[1500:]).all() and (f.slots > 0).sum() == 1500 and f.contains(keys[:1500]).mean() < 0.01
    f.delete(keys[1500:])
    assert not f.slots.any()
    with pytest.raises(ValueError):
        f.delete(keys[:1])


def test_equal_fingerprints_are_stored_and_deleted_one_by_one():
    f = cd.CuckooFilter(64)
    same = np.full(6, 0x1234_0000_0000_0007, np.uint64)  # 8 places
    assert f.insert(same) and (f.slots > 0).sum() == 6
    f.delete(same[:5])
    assert f.contains(same[:1]).all() and (f.slots > 0).sum() == 1
    assert not cd.CuckooFilter(64).insert(np.repeat(same, 2))  # overflow


def test_overflow_resizes_from_stored_keys():
    rng = random.Random(7)
    shard, want = cd.Shard(), {}
    for turn in range(20):
        names = {hashlib.sha256(str(rng.randrange(3000)).encode()).digest(): (1, turn, turn) for _ in range(300)}
        shard.add(names)
        for d, v in names.items():
            want[d] = cd.merged(want[d], v) if d in want else v
    assert shard.entries == want and shard.resizes >= 3 and shard.hits > 0
    assert (shard.filter.slots > 0).sum() == len(want) and shard.filter.contains(cd.keys_of(list(want))).all()


def test_a_false_hit_is_told_from_content():
    a, b = (bytes(8) + (0x55 << 56 | 9).to_bytes(8, "big") + bytes([i]) * 16 for i in (1, 2))  # same key, other digest
    shard = cd.Shard()
    shard.add({a: (1, 1, 1)})
    shard.add({b: (1, 2, 2)})
    assert shard.false_hits == 1 and set(shard.entries) == {a, b}
    shard.put({a: (0, None, None)})
    assert set(shard.entries) == {b} and shard.filter.contains(cd.keys_of([b])).all()
