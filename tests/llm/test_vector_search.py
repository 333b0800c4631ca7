"""Vector searches against brute force."""

import math
import random

import numpy as np
import pytest

from saleslens.llm import ball_tree, dim_scan, vectors

INF = float("inf")


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, cell string, score double")


def odd_rows():
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[40][1]) for i in range(300, 380)]  # one common vector
    rows += [(400, [1e3] * 8), (401, [0.0] * 8), (402, None), (403, [None] + [1.0] * 7), (404, [math.nan] * 8), (405, [INF] * 8),
             (407, []), (None, [1.0] * 8), (20, rows[20][1]), (-40, rows[3][1])]
    rows += [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(500, 640)] + [(700, [2.0]), (60, [1.0, 1.0])]  # other lengths
    random.Random(1).shuffle(rows)
    return rows


def brute(rows, k, every, number, zero):
    fine = [(i, [number(x) for x in v]) for i, v in rows if i is not None and v
            and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))]
    queries = {}
    for i, v in fine:
        if i % every == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q and len(w) == len(v))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def run_op8(spark, rows, **more):
    own = vectors.usable(table(spark, rows), zero=False).cache()
    out = vectors.by_length(own, vectors.queries_of(own, 20), lambda v, q: dim_scan.search(v, q, **more))
    return sorted(tuple(r) for r in out.collect())


def run_op9(spark, rows, **more):
    own = ball_tree.whole_numbers(vectors.usable(table(spark, rows), zero=True)).cache()
    out = vectors.by_length(own, vectors.queries_of(own, 50), lambda v, q: ball_tree.search(v, q, **more))
    return sorted(tuple(r) for r in out.collect())


def test_exact_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(ball_tree, "LEAF_ROWS", 8)
    monkeypatch.setattr(ball_tree, "SHARD_ROWS", 50)
    rows = odd_rows()
    want = brute(rows, 5, 50, lambda x: math.floor(256 * float(np.float32(x))), True)
    assert run_op9(spark, rows, per_cell=40) == want
    assert run_op9(spark, rows) == want


def test_exact_beyond_doubles(spark):
    rows = [(i, [float(np.float32(1e6 + i * 3)), -1e6, 7.0, 1.0, 0.0, 2.0, 3.0, float(i)]) for i in range(60)]
    assert run_op9(spark, rows) == brute(rows, 5, 50, lambda x: math.floor(256 * float(np.float32(x))), True)


def test_scores_beyond_long_count_as_the_nearest_long(spark):
    rows = [(i, [1e18 * (1 + i % 3), float(i)]) for i in range(20)] + [(50, [3e38, 0.0]), (51, [-3e38, 0.0]), (52, [1.0, 2.0])]
    got = run_op9(spark, rows)
    exact = brute(rows, 40, 50, lambda x: math.floor(256 * float(np.float32(x))), True)
    clipped = sorted((q, -max(-2**63, min(2**63 - 1, s)), i) for q, _, i, s in exact)
    want = [(q, r, i, -s) for q0 in (0, 50) for r, (q, s, i) in enumerate([c for c in clipped if c[0] == q0][:5], 1)]
    assert got == want and got[0][3] == 2**63 - 1


def test_many_queries_in_one_batch(spark, monkeypatch):
    """Queries are dealt in parts: no batch of rows for units is larger than its bound."""
    import pyarrow as pa
    n, d = 10_000, 64
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array(list(np.ones((n, d), np.float32)), pa.list_(pa.float32())), pa.array(np.zeros(n))], names=["vec_id", "v", "floor"])
    row, cell = np.repeat(np.arange(n), 20), np.tile(np.arange(20), n)
    parts = list(vectors.dealt(batch, *vectors.with_blocks(row, cell, np.full(len(row), 2))))
    assert max(p.nbytes for p in parts) < 2 * vectors.DEAL_BYTES and sum(p.num_rows for p in parts) == n * 40
    (first,) = vectors.dealt(batch, *vectors.with_blocks(np.array([3, 5]), np.array([7, 9]), np.array([2, 3])))
    assert list(zip(first.column("vec_id").to_pylist(), first.column("cell").to_pylist(), first.column("block").to_pylist())) == [
        (3, 7, 0), (3, 7, 1), (5, 9, 0), (5, 9, 1), (5, 9, 2)]


def test_units_grow_with_the_table():
    assert vectors.unit_rows(10_000, 64, 1024) == 1024
    assert vectors.unit_rows(10**8, 64, 1024) == math.ceil(10**8 / vectors.UNITS)
    assert vectors.unit_rows(10**12, 64, 1024) * 64 * 8 <= vectors.UNIT_BYTES


@pytest.mark.parametrize("per_cell", [40, 10_000])
def test_approximate_search(spark, monkeypatch, per_cell):
    monkeypatch.setattr(dim_scan, "UNIT_ROWS", 60)
    rows = odd_rows()
    want = brute(rows, 20, 20, lambda x: float(np.float32(x)), False)
    got = run_op8(spark, rows, per_cell=per_cell)
    assert len(got) == len(want)
    found = {(q, i) for q, _, i, _ in got}
    assert len(found & {(q, i) for q, _, i, _ in want}) / len(want) > 0.9
    score = {(q, i): s for q, _, i, s in brute(rows, 10**6, 20, lambda x: float(np.float32(x)), False)}
    assert all(abs(score[q, i] - s) < 1e-9 * max(1, abs(s)) for q, _, i, s in got)
    for q in {q for q, *_ in got}:
        own = [(r, -s, i) for p, r, i, s in got if p == q]
        length = len([w for w in want if w[0] == q])
        assert sorted(own) == sorted(own, key=lambda x: x[1:]) and [r for r, *_ in sorted(own)] == list(range(1, length + 1))


def test_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (7, [0.0, 1.0])]
    assert [(q, r, i) for q, r, i, _ in run_op8(spark, rows)] == [(0, 1, 20), (0, 2, 7), (20, 1, 0), (20, 2, 7)]
    assert run_op8(spark, rows[:1]) == [] and run_op8(spark, []) == [] and run_op9(spark, []) == []


def test_candidates_are_abandoned_early():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20, 64))[np.arange(1000) % 20] + 0.3 * rng.normal(size=(1000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    own = dim_scan.ScannedList(np.arange(1000), x, 1.0)
    q = x[:10] + 0.3 * rng.normal(size=(10, 64)) / 8
    row, at = own.search(np.full(10, -1), q, 5)
    want = np.argsort(-(q @ x.T), axis=1)[:, :5]
    assert len({(a, b) for a, b in zip(row, at)} & {(i, j) for i in range(10) for j in want[i]}) >= 48
    assert own.scanned < 0.6 * 10 * 1000 * 65


def test_a_tree_prunes():
    rng = np.random.default_rng(3)
    x = np.floor(np.concatenate([rng.normal(size=(500, 6)) + c for c in (0, 40, -40, 80)]) * 256)
    tree = ball_tree.BallTree(np.arange(len(x)), x)
    top = tree.search(-1, x[700], -math.inf, 5)
    want = sorted(((int(s), -i) for i, s in enumerate(x @ x[700])), reverse=True)[:5]
    assert sorted(((s, -i) for s, i in top), reverse=True) == want
    assert tree.visited < sum(1 for c in tree.children if not c) / 2


def test_recall_on_the_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    data = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").toPandas()
    x, ids = np.array(data.embedding.tolist(), np.float64), data.vec_id.to_numpy()
    got = {(r.query_id, r.vec_id) for r in dim_scan.op8_dim_scan(spark, folder).collect()}
    want = set()
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -INF
        want |= {(ids[i], ids[j]) for j in np.argsort(-s, kind="stable")[:20]}
    recall = len(got & want) / len(want)
    print("recall", recall)
    assert len(got) == len(want) and recall >= 0.9
