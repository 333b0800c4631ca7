"""Filter interaction audit by min-plus removal ranks.

Every document has a mask: the set of filters that it fails.  An order of the
filters is a permutation; its inverse gives the position of each filter.  With 0
for a failed filter and infinity for a passed one, the min-plus product of the
mask matrix and the position matrix,

    rank[mask, order] = min over filters (mask[f] + position[order, f]),

is the step at which the order removes a document with that mask (infinity:
never).  Masks are counted per part first, with the labels as weights, so the
product has 2**filters rows whatever the table, and each part's counts are
scattered to (order, step) by that rank: what a step removes, what it finds removed
already (redundant), what stays.

How it scales: texts are read once, by Arrow batches in their own tasks, and leave
as a mask and a digest.  Two shuffles of such rows follow: by digest (equal texts)
and by doc_id (labels); equal digests are first counted map-side, so a text that a
third of all rows share is one row per task, and only texts that occur more than once
meet their rows again, those with a large share of the rows by broadcast.  Parts are counted map-side; one row per part is expanded.

Defined results: NULL text counts as empty (and fails the filter on few words); a
NULL source and an empty one are one part; a NULL doc_id is neither smaller nor
larger than another, so such a row is never a repetition and makes none; rows that
repeat an id are counted each and do not make each other repetitions; a document is
good (toxic) if any of its labels says 1, NULL labels and labels of unknown ids
say nothing; very long texts are read whole; an empty table gives no rows; columns
beside doc_id, text and source (and quality and toxic of the labels) are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import left_join_hot, materialize, read
from .quality_mil import text_parts

LETTERS = "ABCDE"
MIN_WORDS, DISTINCT_PCT, CAPITALS_PCT = 200, 50, 2
MARKS = "#$%&*|"

_BYTES = np.zeros((2, 256), bool)
_BYTES[0, ord("A"):ord("Z") + 1] = True
_BYTES[1, [ord(c) for c in MARKS]] = True


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags each text has; ``offsets`` are the bounds of the texts."""
    upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def text_failures(texts: pa.Array) -> np.ndarray:
    """The bits of the filters A to D that each text fails."""
    texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
    lists = pc.ascii_split_whitespace(texts)
    words, n = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), n)
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves an empty word
    owner = owner[full]
    coded = pc.dictionary_encode(words.filter(pa.array(full)))
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words_n = np.bincount(owner, minlength=len(texts))
    size = max(1, len(coded.dictionary))
    distinct = np.bincount(np.unique(owner * size + codes) // size, minlength=len(texts))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    capitals, marks = (per_text(kind[data], offsets - offsets[0]) for kind in _BYTES)
    points = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    failed = (words_n < MIN_WORDS, 100 * distinct < DISTINCT_PCT * words_n, 100 * capitals > CAPITALS_PCT * points, marks > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(failed))


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest), written: the bits of A to D and the SHA-256 of the text."""

    def run(batches):
        for batch in batches:
            at = 0
            for part in text_parts(batch.column(2)):
                own = batch.slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays([
                    own.column(0), own.column(1), pa.array(text_failures(part), pa.int32()),
                    pa.array([hashlib.sha256((t or "").encode()).digest() for t in part.to_pylist()], pa.binary())], names=["doc_id", "part", "mask", "digest"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), "text")
    return materialize(rows.mapInArrow(run, "doc_id bigint, part string, mask int, digest binary"), "failures")


def with_repetitions(rows: DataFrame) -> DataFrame:
    """``rows`` (written) with the bit of filter E where a smaller doc_id has the same text."""
    repeated = materialize(rows.groupBy("digest").agg(
        F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"), F.count(F.lit(1)).alias("_n")).where("_first < _last").drop("_last"), "repeated")
    joined = left_join_hot(rows, repeated, "digest", "_n")
    bit = F.when(F.col("doc_id") > F.col("_first"), 1 << LETTERS.index("E")).otherwise(0)
    return joined.select("doc_id", "part", F.col("mask").bitwiseOR(bit).alias("mask"))


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those of them with either label."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    joined = rows.join(known, F.col("doc_id") == F.col("_id"), "left")
    return joined.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def removal_ranks(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """(orders, rank): all permutations, and the step (from 0; ``filters``: never) at which each removes each mask."""
    orders = np.array(list(permutations(range(filters))))
    positions = np.argsort(orders, axis=1)  # the inverse permutations
    masks = np.where((np.arange(1 << filters)[:, None] >> np.arange(filters)) & 1, 0, filters)
    rank = (masks[:, None, :] + positions[None, :, :]).min(axis=2)
    return orders, np.minimum(rank, filters)


FIELDS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


class Audit:
    """The matrices that turn a part's counts by mask into its counts by (order, step)."""

    def __init__(self, letters: str):
        k = len(letters)
        orders, rank = removal_ranks(k)
        step = np.arange(k)
        fails = ((np.arange(1 << k)[:, None] >> np.arange(k)) & 1).astype(bool)[:, orders]  # mask, order, step: fails the step's filter
        flat = (1 << k, -1)
        self.names = ["".join(letters[f] for f in o) for o in orders]
        self.filter = orders.ravel()
        self.removed = (rank[:, :, None] == step).reshape(flat).astype(np.int64)
        self.kept = (rank[:, :, None] > step).reshape(flat).astype(np.int64)
        self.redundant = (fails & (rank[:, :, None] < step)).reshape(flat).astype(np.int64)
        self.k = k

    def rows(self, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Columns by (order, step) from counts (mask; documents, good, toxic)."""
        n, good, toxic = counts.T
        removed = n @ self.removed
        return dict(zip(FIELDS, (
            n @ self.kept, removed, n @ self.redundant, n[1 << self.filter], good @ self.removed, toxic @ self.removed,
            np.bincount(self.filter, removed.astype(np.float64), self.k).astype(np.int64)[self.filter]
            if removed.sum() < 2**52 else np.array([removed[self.filter == f].sum() for f in range(self.k)])[self.filter])))


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order and step from (part, mask, n, good, toxic)."""
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("own"))  # at most one per mask

    def run(batches):
        matrices = Audit(letters)
        size = len(matrices.filter)
        for batch in batches:
            for part, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                table = np.zeros((1 << len(letters), 3), np.int64)
                for m in own:
                    table[m["mask"]] = m["n"], m["good"], m["toxic"]
                columns = matrices.rows(table)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * size), pa.array(np.repeat(matrices.names, matrices.k).tolist()),
                    pa.array(np.tile(np.arange(1, matrices.k + 1, dtype=np.int32), len(matrices.names))),
                    *[pa.array(columns[c], pa.int64()) for c in FIELDS]], names=["part", "filter_order", "step", *FIELDS])

    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in FIELDS))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(mask_counts(with_repetitions(failures(docs)), labels))


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM texts),
checked AS (
  SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > first, false) AS e
  FROM words),
known AS (SELECT doc_id, coalesce(max(quality) FILTER (quality = 1), 0) AS good, coalesce(max(toxic) FILTER (toxic = 1), 0) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, list_filter([CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END, CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END],
                           lambda x: x IS NOT NULL) AS f, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM checked LEFT JOIN known USING (doc_id)),
masks AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, f),
orders AS (
  SELECT '' AS o
  UNION ALL
  SELECT o || x FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) t(x) WHERE NOT contains(o, x)),
steps AS (SELECT o AS filter_order, CAST(s AS INTEGER) AS step, o[s] AS filter FROM orders, range(1, 6) r(s) WHERE length(o) = 5),
ranked AS (
  SELECT m.*, o AS filter_order, coalesce(list_min(list_transform(f, lambda x: strpos(o, x))), 6) AS removed_at
  FROM masks m, orders WHERE length(o) = 5),
counted AS (
  SELECT part, filter_order, step, filter,
         coalesce(sum(n) FILTER (removed_at > step), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (removed_at = step), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (removed_at < step AND list_contains(f, filter)), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (f = [filter]), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (removed_at = step), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (removed_at = step), 0)::BIGINT AS toxic_lost
  FROM ranked JOIN steps USING (filter_order) GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley
FROM counted
"""
