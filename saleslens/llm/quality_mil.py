"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Every passage is
encoded from its surface (byte classes, pairs of byte classes, repetition and
length of words) by a learned layer; gated attention weights, learned from the
labels of documents alone, add the encodings up, and a logistic unit scores the sum.

The model is fitted on at most ``SAMPLE_DOCS`` labelled documents (the smallest
hashes of their ids), with all passages of each, until these make up
``SAMPLE_PASSAGES``; a document that alone has more than an eighth of that is not used for
the fit.  Both bounds are parameters and do not grow with the input.  Scoring reads
whole texts, all passages, in one pass without a shuffle; the model is a few kilobytes.

Defined results: NULL and empty texts are a bag of one empty passage; documents
without a label are only scored; where rows repeat a labelled id the smallest text
(NULL first) is learned, and every row is scored; labels that are NULL are not used;
repeated labels count each; with labels of one class, or none, every score is the
smoothed share of label 1 (0.5 without any); a score may tie with another; other
columns of the tables, whatever their names, are ignored or pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import hash_key, materialize, read

PASSAGE_WORDS = 64
#: The fit: documents and passages at most (of 308 bytes each).
SAMPLE_DOCS, SAMPLE_PASSAGES, SEED = 4096, 400_000, 5
HIDDEN, GATE, EPOCHS, BATCH, RATE = 32, 16, 14, 128, 0.01
THRESHOLD = 0.7
CHUNK_BYTES = 4 << 20
N_CLASS = 8
N_FEATURES = N_CLASS + N_CLASS * N_CLASS + 5


def _byte_classes() -> np.ndarray:
    """Letters, capitals, digits, non-ASCII, sentence marks, shouting marks, bars, other."""
    kinds = np.full(256, 7, np.uint8)
    kinds[128:] = 3
    for kind, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")):
        kinds[[ord(c) for c in chars]] = kind
    for kind, chars in ((4, ".,"), (5, "!?"), (6, "|")):
        kinds[[ord(c) for c in chars]] = kind
    return kinds


BYTE_CLASS = _byte_classes()


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages in a row, number of passages of each text, at least 1)."""
    spaced = pc.cast(pc.fill_null(texts, ""), pa.large_string())
    for white in "\n\t\r":
        spaced = pc.replace_substring(spaced, white, " ")
    lists = pc.split_pattern(spaced, " ")
    words = lists.flatten()
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)
    full = sizes > 0
    words, doc, sizes = words.filter(pa.array(full)), doc[full], sizes[full]
    per_doc = np.bincount(doc, minlength=len(texts))
    bags = np.maximum(1, -(-per_doc // PASSAGE_WORDS))
    first_bag, first_word = np.cumsum(bags) - bags, np.cumsum(per_doc) - per_doc
    at = first_bag[doc] + (np.arange(len(doc)) - first_word[doc]) // PASSAGE_WORDS  # the passage of each word
    total = int(bags.sum())
    out = np.zeros((total, N_FEATURES), np.float32)
    if not len(doc):
        return out, bags
    buffers = words.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[words.offset:words.offset + len(words) + 1]
    kinds = BYTE_CLASS[np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]]
    byte_at = np.repeat(at, sizes)
    count = np.maximum(1, np.bincount(byte_at, minlength=total))[:, None]
    out[:, :N_CLASS] = np.bincount(byte_at * N_CLASS + kinds, minlength=total * N_CLASS).reshape(total, -1) / count
    before = np.concatenate([kinds[:1], kinds[:-1]])
    edge = np.flatnonzero(byte_at[1:] != byte_at[:-1]) + 1
    before[edge] = kinds[edge]  # a passage's first byte has none before it
    pairs = before * N_CLASS + kinds
    n2 = N_CLASS * N_CLASS
    out[:, N_CLASS:N_CLASS + n2] = np.bincount(byte_at * n2 + pairs, minlength=total * n2).reshape(total, -1) / count
    codes = pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n_words = np.maximum(1, np.bincount(at, minlength=total))
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (at[1:] == at[:-1])
    distinct = np.unique(at * (codes.max() + 1) + codes) // (codes.max() + 1)
    short = sizes == 1
    for k, values in enumerate((
            np.bincount(at, same, total) / n_words, np.bincount(distinct, minlength=total) / n_words,
            np.bincount(at, short, total) / n_words, np.bincount(at, sizes, total) / n_words / 10, np.bincount(at, minlength=total) / PASSAGE_WORDS)):
        out[:, N_CLASS + n2 + k] = values
    return out, bags


class Model:
    """Encoder, gated attention and logistic unit over bags of passages."""

    def __init__(self, prior: float = 0.5):
        self.prior, self.p = prior, None

    def _forward(self, x: np.ndarray, starts: np.ndarray, bags: np.ndarray):
        p = self.p
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        s = (t * g) @ p["a"]
        s = np.exp(s - np.repeat(np.maximum.reduceat(s, starts), bags))
        a = s / np.repeat(np.add.reduceat(s, starts), bags)
        z = np.add.reduceat(a[:, None] * h, starts)
        return h, t, g, a, z, 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))

    def score(self, features: np.ndarray, bags: np.ndarray) -> np.ndarray:
        if self.p is None:
            return np.full(len(bags), self.prior)
        x = (features - self.mean) / self.spread
        return self._forward(x, np.cumsum(bags) - bags, bags)[-1].astype(np.float64)

    def fit(self, features: np.ndarray, bags: np.ndarray, labels: np.ndarray) -> Model:
        """Minibatch training with Adam; the order of the batches is fixed by the seed."""
        rng = np.random.default_rng(SEED)
        self.mean, self.spread = features.mean(0), features.std(0) + 1e-2
        x = (features - self.mean) / self.spread
        d = x.shape[1]
        shapes = {"w": (d, HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE), "a": (GATE,), "c": (HIDDEN,), "d": (1,)}
        self.p = {k: (rng.normal(size=s) / np.sqrt(s[0]) if k not in "bd" else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}
        m, v, step = {k: 0.0 for k in shapes}, {k: 0.0 for k in shapes}, 0
        ends = np.cumsum(bags)
        for epoch in range(EPOCHS):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), BATCH):
                own = order[i:i + BATCH]
                rows = np.concatenate([np.arange(ends[j] - bags[j], ends[j]) for j in own])
                step += 1
                for k, grad in self._gradient(x[rows], bags[own], labels[own]).items():
                    grad = grad + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad * grad
                    rate = RATE * (1 - epoch / EPOCHS)
                    self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradient(self, x, bags, labels):
        p, starts = self.p, np.cumsum(bags) - bags
        h, t, g, a, z, y = self._forward(x, starts, bags)
        dl = ((y - labels) / len(bags)).astype(np.float32)
        dz = np.repeat(dl[:, None] * p["c"], bags, axis=0)
        da = (dz * h).sum(1)
        ds = a * (da - np.repeat(np.add.reduceat(a * da, starts), bags))
        dt, dg = ds[:, None] * p["a"] * g * (1 - t * t), ds[:, None] * p["a"] * t * g * (1 - g)
        dh = a[:, None] * dz + dt @ p["v"].T + dg @ p["u"].T
        dx = dh * (1 - h * h)
        return {"w": x.T @ dx, "b": dx.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ ds, "c": z.T @ dl, "d": dl.sum(keepdims=True)}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def text_parts(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Slices of about ``limit`` bytes, at least one text each."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + limit, "right")))
        yield texts.slice(at, end - at)
        at = end


def fit_quality(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_passages: int = SAMPLE_PASSAGES) -> Model:
    """A model of ``labels.quality`` from documents that are not held out."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    known = usable.select("doc_id", F.col("quality").cast("int").alias("quality"), hash_key(F.lit(SEED), F.col("doc_id")).alias("key"))
    # The sample has a fixed bound, so it may be broadcast.
    sample = known.orderBy("key", "doc_id").limit(sample_docs)
    ids = sample.select(F.col("doc_id").alias("_id"), "key").distinct()

    def encode(batches):
        for batch in batches:
            at = 0
            for part in text_parts(batch.column(0)):
                features, bags = passages(part)
                ends = np.cumsum(bags)
                fits = bags <= sample_passages // 8
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(at, len(bags)), pa.array(bags, pa.int32()),
                     pa.array([features[end - n:end].tobytes() if ok else None for n, end, ok in zip(bags.tolist(), ends.tolist(), fits)], pa.binary())],
                    names=["id", "n", "x"])
                at += len(bags)

    # Rows that repeat an id meet as one text per task; NULL counts as smaller than any text.
    texts = (
        docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
        .groupBy("doc_id").agg(F.min(F.struct("text")).alias("t")).select("t.text", "doc_id"))
    encoded = materialize(texts.mapInArrow(encode, "id bigint, n int, x binary").where("x is not null"), "bags")
    bags = encoded.join(F.broadcast(sample), F.col("id") == F.col("doc_id")).select("key", "id", "quality", "n", "x")
    # At most sample_docs rows, so this window has a fixed bound.
    upto = F.sum("n").over(W.orderBy("key", "id", "quality").rowsBetween(W.unboundedPreceding, 0))
    rows = bags.withColumn("upto", upto).where(F.col("upto") <= sample_passages).toArrow()
    if not len(rows):
        return Model()
    # Rows come in the order of the tasks; sorted, the fit is the same in every run.
    rows = sorted(zip(*(rows.column(c).to_pylist() for c in ("quality", "n", "x"))))
    y = np.array([r[0] for r in rows], np.float32)
    if y.min() == y.max():
        return Model(float((y.sum() + 1) / (len(y) + 2)))
    x = np.frombuffer(b"".join(r[2] for r in rows), np.float32).reshape(-1, N_FEATURES)
    return Model().fit(x, np.array([r[1] for r in rows]), y)


def scorer(model: Model):
    """A column function: the score of a text."""

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            scores = [model.score(*passages(part)) for part in text_parts(texts)]
            yield pa.array(np.concatenate(scores) if scores else [], pa.float64())

    return score


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    score = scorer(fit_quality(docs, read(spark, sf_dir, "labels")))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    score = scorer(fit_quality(docs, read(spark, sf_dir, "labels")))
    own = docs.select(F.struct(*docs.columns).alias("own"), score("text").alias("score"))
    return own.where(F.col("score") >= THRESHOLD).select("own.*")
