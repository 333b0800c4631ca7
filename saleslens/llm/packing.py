"""Packing documents into sequences: first-fit decreasing in randomised groups.

Every document is tokenised whole, ends with an end id, and is cut into pieces of
at most ``capacity`` ids; a piece of full capacity is a sequence of its own.  The
rest are dealt at random into groups of about ``GROUP_PIECES`` pieces.  A group is
packed by first-fit decreasing: pieces by falling length go to the first bin with
room, found in O(log n) with a tournament tree of the free capacities.

Only lengths and checksums are shuffled, never texts or ids, and a group has a
bounded size whatever the input: the number of groups follows the table.

Defined results: NULL text counts as empty and packs its end id alone; repeated
rows are packed each; an empty table gives no rows; columns beside doc_id and text
are ignored; very long documents are cut every ``capacity`` ids.
"""

from __future__ import annotations

import math
import os
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, read

CAPACITY, END_ID = 4096, 2
GROUP_PIECES = 4096
#: Bytes of text that a task tokenises at once, and words that a worker remembers.
CHUNK_BYTES, MEMORY_WORDS = 4 << 20, 400_000
#: Words that are encoded at once, as one text with a mark between words; encodings are much larger than their ids.
ENCODED = 500
MARK = "\x01"


#: Texts on which a tokenizer that keeps white space or case, or joins letters and marks, differs from its words.
PROBES = ["The cat, it's 42 dogs!\n\tAnd  more: x.y;z|w", " lead and trail ", "ÉTUDE é#1 & co* 50%", "A\r\nB", "word.Word,word"]


class WordTokenizer:
    """Exact ids of a tokenizer that drops white space and case, word by word.

    Such a tokenizer never joins across white space, so a text's ids are those of
    its words in a row; it also ends a run of letters before punctuation.  Each
    distinct word of a chunk is encoded once, and words that were met before are
    remembered up to a bound.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.mark = self._encoder_ids(MARK)
        whole = [self._encoder_ids(t).tolist() for t in PROBES]
        ids, counts = self.encode(pa.array(PROBES))
        if [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] != whole:
            raise ValueError(f"{path} is no tokenizer that works word by word and without case")

    def _encoder_ids(self, text: str) -> np.ndarray:
        return np.array(self.encoder.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word; one call for many words costs far less than a call's share per word."""
        ids = self._encoder_ids(f" {MARK} ".join(words))
        cuts = np.flatnonzero(ids == self.mark[0]) if len(self.mark) == 1 else ()
        if len(cuts) != len(words) - 1:  # a word has the mark's id in it, or there is none
            return [self._encoder_ids(w).tobytes() for w in words]
        raw, ends = ids.tobytes(), (4 * cuts).tolist()
        return [raw[i:j] for i, j in zip([0, *(e + 4 for e in ends)], [*ends, len(raw)])]

    def _ids_of(self, words: list[str]) -> list[bytes]:
        parts = list(map(self.known.get, words))
        new = [i for i, p in enumerate(parts) if p is None]
        older = self.older.get
        missing = []
        for i in new:
            parts[i] = older(words[i])
            if parts[i] is None:
                missing.append(i)
        for at in range(0, len(missing), ENCODED):
            some = missing[at:at + ENCODED]
            for i, p in zip(some, self._encode_words([words[i] for i in some])):
                parts[i] = p
        if len(self.known) + len(new) > MEMORY_WORDS:
            # The words of the last chunks stay; those that nobody asked for since the last turn go.
            self.older, self.known = self.known, {}
        self.known.update((words[i], parts[i]) for i in new[:MEMORY_WORDS])
        return parts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        spaced = pc.cast(pc.fill_null(texts, ""), pa.large_string())
        for white in "\n\t\r":
            spaced = pc.replace_substring(spaced, white, " ")
        # Fewer distinct words; not where the text may spell a special token, which has case and punctuation.
        if not pc.any(pc.match_substring(spaced, "<|")).as_py():
            spaced = pc.replace_substring_regex(pc.ascii_lower(spaced), r"([a-z])([.,;:!?|&$%#*])", r"\1 \2")
        lists = pc.split_pattern(spaced, " ")
        coded = pc.dictionary_encode(lists.flatten())
        parts = self._ids_of(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        pool = np.frombuffer(b"".join(parts), "<u4")
        starts = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy(zero_copy_only=False)
        each = sizes[codes]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        # Position in the pool: the word's start plus the place inside the word.
        ids = pool[np.repeat(starts[codes] - (ends - each), each) + np.arange(total)]
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], ends])[np.cumsum(counts)] if len(counts) else np.empty(0, np.int64)
        return ids, np.diff(upto, prepend=0)


@lru_cache(maxsize=1)
def worker_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this Python worker: what one task has met is known to the next."""
    return WordTokenizer(path)


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES):
    """Slices of a batch with about ``limit`` bytes of text, at least one row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > limit:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += int(n)
    if at < len(sizes):
        yield batch.slice(at)


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: where it starts in its document, its length and the checksum of its ids."""

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work; threads would only add memory
        words = worker_tokenizer(tokenizer)
        for batch in batches:
            for part in text_chunks(batch, "text"):
                ids, counts = words.encode(part.column("text"))
                rows, at = [], 0
                for doc, n in zip(part.column("doc_id").to_pylist(), counts.tolist()):
                    own = np.append(ids[at:at + n], np.array([end_id], "<u4")).astype("<u4")
                    at += n
                    rows += [
                        (doc, s, min(capacity, n + 1 - s), zlib.crc32(own[s:s + capacity]), n + 1)
                        for s in range(0, n + 1, capacity)]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=PIECES_NAMES)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


PIECES_NAMES = [c.split()[0] for c in PIECES.split(", ")]


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece; at most one bin per piece is opened."""
    n = len(lengths)
    width = 1 << max(0, (n - 1).bit_length())
    tree = [capacity] * (2 * width)  # a node holds the largest free capacity below it
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < width:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[i], offsets[i] = node - width, capacity - tree[node]
        tree[node] -= need
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (written, with length) with sequence_id and offset; ids of sequences are unique."""
    rest = pieces.where(F.col("length") < capacity)
    groups = max(1, math.ceil(rest.count() / group_pieces))
    names = [f.name for f in pieces.schema]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id bigint, offset bigint"

    def fill(own: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = first_fit_decreasing(own["length"].to_numpy(), capacity)
        out = own[names].copy()
        out["sequence_id"] = (own["_group"].to_numpy() << 32) + bins
        out["offset"] = offsets
        return out

    # The row's number in the written table, hashed: equal rows go to different groups too.
    group = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    packed = rest.withColumn("_group", group).groupBy("_group").applyInPandas(fill, schema)
    full = pieces.where(F.col("length") == capacity).select(
        *names, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return packed.unionByName(full)


def public_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    return pack(materialize(cut_pieces(docs, tokenizer or public_tokenizer()), "pieces"))


def op10_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)
