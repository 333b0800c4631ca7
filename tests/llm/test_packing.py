"""Packing: ids against the tokenizer on whole texts, and the rules of a packing."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from saleslens.llm import packing

TEXTS = [
    "", None, "a", "Don't  stop\n\nme 123", "x<|endoftext|>y <|startoftext|>", "é é   b\x1cc \x85", "ΑΣ σς İI", "ab" * 9000,
    "word " * 20000, "Word.. WORD,x !'s <|ENDOFTEXT|> <|endoftext|>", "\t \r\n", "日本語 テキスト 12", "%%% ''s 're", " lead", "trail ",
]


def whole(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids + [2]


def test_word_by_word_is_the_tokenizer():
    tok = Tokenizer.from_file(packing.public_tokenizer())
    ids, counts = packing.WordTokenizer(packing.public_tokenizer()).encode(pa.array(TEXTS))
    assert ids.tolist() == [i for t in TEXTS for i in whole(tok, t)[:-1]]
    assert counts.tolist() == [len(whole(tok, t)) - 1 for t in TEXTS]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_word_by_word_on_any_text(texts):
    tok = Tokenizer.from_file(packing.public_tokenizer())
    ids, counts = packing.WordTokenizer(packing.public_tokenizer()).encode(pa.array(texts, pa.string()))
    assert ids.tolist() == [i for t in texts for i in whole(tok, t)[:-1]]
    assert counts.tolist() == [len(whole(tok, t)) - 1 for t in texts]


def test_words_are_encoded_once_and_many_at_a_time():
    words = packing.WordTokenizer(packing.public_tokenizer())
    tok, calls = words.encoder, []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return tok.encode_batch_fast(texts, **options)

    words.encoder = Counting()
    texts = [" ".join(f"{a}{b}é{c}" for b in "abcdefghij" for c in "klmnopqrst") for a in "uvwxyz"]
    ids, counts = words.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in whole(tok, t)[:-1]]
    assert len(calls) == sum(calls) == -(-600 // packing.ENCODED)
    words.encode(pa.array(texts))
    assert len(calls) == -(-600 // packing.ENCODED)  # all are remembered
    assert packing.worker_tokenizer(packing.public_tokenizer()) is packing.worker_tokenizer(packing.public_tokenizer())


@pytest.mark.parametrize("text", [packing.MARK, f"a {packing.MARK} b", f"a{packing.MARK}b .{packing.MARK}", f"{packing.MARK}{packing.MARK} c  d"])
def test_the_mark_in_a_text(text):
    tok = Tokenizer.from_file(packing.public_tokenizer())
    ids, _ = packing.WordTokenizer(packing.public_tokenizer()).encode(pa.array([text, "other words"]))
    assert ids.tolist() == whole(tok, text)[:-1] + whole(tok, "other words")[:-1]


def test_forgotten_words_are_encoded_again(monkeypatch):
    monkeypatch.setattr(packing, "MEMORY_WORDS", 5)
    words = packing.WordTokenizer(packing.public_tokenizer())
    tok = words.encoder
    for texts in (["a b c d"], ["e f g a"], ["h i j k l m n o"], ["a b e z"], ["a"]):
        ids, _ = words.encode(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in whole(tok, t)[:-1]]
        assert len(words.known) <= 5


def test_tournament_tree_is_first_fit():
    rng = random.Random(1)
    lengths = np.array([rng.randint(1, 100) for _ in range(300)])
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    free, want = [], {}
    for i in np.argsort(-lengths, kind="stable").tolist():
        b = next((k for k, room in enumerate(free) if room >= lengths[i]), None)
        if b is None:
            free.append(100)
            b = len(free) - 1
        want[i] = (b, 100 - free[b])
        free[b] -= int(lengths[i])
    assert [(int(a), int(b)) for a, b in zip(bins, offsets)] == [want[i] for i in range(300)]


def check(rows, texts):
    tok = Tokenizer.from_file(packing.public_tokenizer())
    seen = sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    want = []
    for doc, text in texts:
        ids = np.array(whole(tok, text), "<u4")
        want += [(doc, s, min(4096, len(ids) - s), zlib.crc32(ids[s:s + 4096].tobytes()), len(ids)) for s in range(0, len(ids), 4096)]
    assert seen == sorted(want)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return by


def test_documents_of_every_kind(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(3, "same", "y", 2)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, length long")
    check(packing.pack_documents(docs).collect(), [(r[0], r[1]) for r in rows])
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_query_packs_tightly(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = packing.op10_packing(spark, folder).collect()
    by = check(rows, docs)
    assert sum(r.length for r in rows) / (4096 * len(by)) > 0.98


def test_other_tokenizers_are_refused():
    """One that keeps white space and case would give wrong ids word by word."""
    import public_tokenizers

    with pytest.raises(ValueError, match="word by word"):
        packing.WordTokenizer(str(public_tokenizers.path("byte_bpe_50k.json")))
