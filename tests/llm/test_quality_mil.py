"""The quality classifier: gradients, accuracy on held-out documents, odd inputs."""

import math

import numpy as np
import pyarrow as pa
import pytest

from saleslens.llm import quality_mil as qm


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(1)
    x, bags, y = rng.normal(size=(30, qm.N_FEATURES)), np.array([5, 1, 10, 14]), np.array([1, 0, 0, 1.0])
    model = qm.Model().fit(x.astype(np.float32), bags, y.astype(np.float32))
    model.p = {k: v.astype(np.float64) * 0.3 for k, v in model.p.items()}
    starts = np.cumsum(bags) - bags

    def loss():
        p = model._forward(x, starts, bags)[-1]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grad = model._gradient(x, bags, y)
    for k, v in model.p.items():
        at = tuple(0 for _ in v.shape)
        keep = v[at]
        v[at] = keep + 1e-4
        up = loss()
        v[at] = keep - 1e-4
        down = loss()
        v[at] = keep
        assert abs((up - down) / 2e-4 - grad[k][at]) < 1e-5, k


def test_passages_of_each_text():
    texts = ["", None, "a", "w " * 64, "w " * 65, " \n\t", "é|! " * 200, "x" * 300000]
    features, bags = qm.passages(pa.array(texts))
    assert bags.tolist() == [1, 1, 1, 1, 2, 1, 4, 1] and features.shape == (12, qm.N_FEATURES)
    alone = [qm.passages(pa.array([t], pa.string()))[0] for t in texts]
    # What stands beside a text in its batch makes no difference.
    assert np.array_equal(features, np.concatenate(alone))
    assert [len(p) for p in qm.text_parts(pa.array(texts), limit=100)] == [3, 1, 1, 1, 1, 1]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    out = qm.op2_quality(spark, folder).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id").join(out)
    held = labels[labels.held_out]
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.7)).all()
    accuracy = (held.predicted == held.quality).mean()
    good = held[held.quality == 1].predicted.mean()
    bad = 1 - held[held.quality == 0].predicted.mean()
    print(accuracy, good, bad)
    assert accuracy > 0.97 and good > 0.97 and bad > 0.9


def test_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, 0.5), (2, "", 1.0), (3, "text " * 300, 0.1), (3, "text", 0.2), (None, "x", 0.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, text string")
    one = spark.createDataFrame([(1, 1, "z"), (3, 1, "z"), (2, None, "z"), (None, 0, "z")], "doc_id long, quality int, text string")
    assert qm.fit_quality(docs, none).prior == 0.5
    assert qm.fit_quality(docs, one).prior > 0.5
    both = spark.createDataFrame([(i, i % 2, "z") for i in (1, 2, 3, 3)], "doc_id long, quality int, text string")
    kept = docs.select(qm.scorer(qm.fit_quality(docs, both))("text").alias("s")).collect()
    assert len(kept) == 5 and all(0 <= r.s <= 1 for r in kept)
    assert docs.limit(0).select(qm.scorer(qm.Model())("text").alias("s")).count() == 0


def test_fit_sees_all_passages(spark, monkeypatch):
    texts = {i: " ".join(f"w{i}x{j}" for j in range(64 * (1 + 11 * i))) for i in range(9)}  # 1 to 89 passages
    seen = {}

    def fit(self, features, bags, labels):
        seen.update(features=features, bags=bags)
        return self

    monkeypatch.setattr(qm.Model, "fit", fit)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int")
    taught = [r.doc_id for r in labels.where(~qm.held_out(labels.doc_id)).collect()]
    qm.fit_quality(docs, labels)
    want = qm.passages(pa.array([texts[i] for i in taught]))
    assert want[1].max() > 32 and sorted(seen["bags"]) == sorted(want[1])
    assert sorted(map(bytes, seen["features"])) == sorted(map(bytes, want[0]))


def brute_features(text):
    """One list of features per passage, by plain counting."""
    def kind(b):
        c = chr(b)
        return (3 if b >= 128 else 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if c.isdigit() else 4 if c in ".," else
                5 if c in "!?" else 6 if c == "|" else 7)

    words = [w for w in (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if w]
    out = []
    for i in range(0, max(1, len(words)), qm.PASSAGE_WORDS):
        own = words[i:i + qm.PASSAGE_WORDS]
        kinds = [kind(b) for b in "".join(own).encode()]
        n, w = max(1, len(kinds)), max(1, len(own))
        pairs = list(zip(kinds[:1] + kinds, kinds))
        row = [kinds.count(k) / n for k in range(8)] + [pairs.count((a, b)) / n for a in range(8) for b in range(8)]
        sizes = [len(x.encode()) for x in own]
        row += [sum(a == b for a, b in zip(own, own[1:])) / w, len(set(own)) / w, sizes.count(1) / w, sum(sizes) / w / 10, len(own) / qm.PASSAGE_WORDS]
        out.append(row)
    return out


def brute_score(model, text):
    """Encode, weigh and add up the passages one by one."""
    p = {k: v.tolist() for k, v in model.p.items()}

    def times(x, m):
        return [sum(a * row[j] for a, row in zip(x, m)) for j in range(len(m[0]))]

    hidden, weights = [], []
    for row in brute_features(text):
        x = [(v - m) / s for v, m, s in zip(row, model.mean.tolist(), model.spread.tolist())]
        h = [math.tanh(a + b) for a, b in zip(times(x, p["w"]), p["b"])]
        gate = [math.tanh(a) / (1 + math.exp(-b)) for a, b in zip(times(h, p["v"]), times(h, p["u"]))]
        hidden.append(h)
        weights.append(math.exp(sum(a * b for a, b in zip(gate, p["a"]))))
    z = [sum(w * h[j] for w, h in zip(weights, hidden)) / sum(weights) for j in range(qm.HIDDEN)]
    return 1 / (1 + math.exp(-(sum(a * b for a, b in zip(z, p["c"])) + p["d"][0])))


def test_scores_passage_by_passage(spark):
    """The registered query against plain Python on every document of a table."""
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = qm.fit_quality(docs, labels)
    assert model.p is not None
    got = {r.doc_id: r.score for r in qm.op2_quality(spark, folder).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        assert got[i] == pytest.approx(brute_score(model, text), abs=2e-4), i
    odd = ["", None, " \n ", "a", "é|!? " * 100, "word " * 70 + "\tX9\r" * 70]
    scored = model.score(*qm.passages(pa.array(odd, pa.string())))
    assert scored.tolist() == pytest.approx([brute_score(model, t) for t in odd], abs=2e-4)


def test_the_fit_is_bounded(spark, monkeypatch):
    """Repeated ids bring one text each, and documents beyond the bound of passages stay away."""
    seen = {}

    def fit(self, features, bags, labels):
        seen.update(bags=sorted(bags.tolist()), labels=sorted(labels.tolist()))
        return self

    monkeypatch.setattr(qm.Model, "fit", fit)
    ids = list(range(40))
    docs = spark.createDataFrame([(i, "w " * 64 * (1 + i % 3)) for i in ids for _ in range(5)] + [(0, "v " * 64 * 50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    taught = [r.doc_id for r in labels.where(~qm.held_out(labels.doc_id)).collect()]
    qm.fit_quality(docs, labels)
    assert len(seen["bags"]) == len(taught)  # not five times as many
    qm.fit_quality(docs, labels, sample_passages=30)
    assert 10 < sum(seen["bags"]) <= 30 and max(seen["bags"]) <= 3
    qm.fit_quality(docs, labels, sample_docs=4)
    assert len(seen["bags"]) <= 4
