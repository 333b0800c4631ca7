"""Exact dedup with a cuckoo-filter index of live digests.

The index has one filter per shard of the digest space and, beside the filters, the
stored keys: one entry per live digest with its number of rows and the row that
stays.  Adding rows asks the filter first.  A miss is certainly new.  A hit is
verified against the stored entries, since other digests may share a fingerprint.
Removing rows counts the touched digests again; those without rows leave the
entries and the filter.  A filter that overflows is built again, twice as large,
from the stored keys of its shard.

How it scales: texts are hashed where they are read, and only digests travel; map
tasks fold equal digests of a batch, so copies that are a third of all rows reach
their shard as one row per batch.  Shards hold about ``SHARD_KEYS`` rows and are
split (their filters rebuilt) as the index grows, so a task's memory is bounded.
An addition or removal writes the next version of filters and entries to the
shared folder; the version before stays readable, so lost executors only repeat
tasks.

Defined results: NULL text counts as empty; only A-Z are lower-cased, so empty
texts are equal to each other and texts that differ in other case are not; the row
with the largest doc_id stays, any id goes before none, and of rows that repeat an
id and a text one stays; very long texts are hashed whole; an empty table gives no
rows; columns beside doc_id and text, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .chosen_path import grouped, mix
from .common import left_join_hot, materialize, read

SHARD_KEYS, SLOTS, FIRST_BUCKETS, MAX_TURNS = 8192, 4, 64, 300
CHUNK = 2048  # changes that a shard looks up at once
CAPITALS, SMALLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
U = np.uint64


def normal_digest(text: Column) -> Column:
    """SHA-256, as 32 bytes, of the text in UTF-8 with A-Z lower-cased."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALLS), 256))


def digests(docs: DataFrame, batch: int = 0) -> DataFrame:
    """(doc_id, digest, row), written; rows of different ``batch`` numbers never share a ``row``."""
    return materialize(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), normal_digest(F.col("text")).alias("digest"),
        (F.monotonically_increasing_id() + F.lit(batch << 56)).alias("row")), "digests")


# -- the filter of one shard --------------------------------------------------


class CuckooFilter:
    """Buckets of ``SLOTS`` 16-bit fingerprints; a key may lie in either of two buckets.

    The second bucket follows from the first and the fingerprint, so keys can move
    and be deleted without the filter knowing them.  Work goes in whole arrays:
    keys that compete for a bucket are ranked, and those without a free slot evict.
    """

    def __init__(self, buckets: int = FIRST_BUCKETS):
        self.slots = np.zeros((buckets, SLOTS), np.uint16)

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        out = cls(0)
        out.slots = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return out

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, first bucket) of 64-bit keys; a fingerprint is never 0."""
        prints = np.maximum(keys >> U(48), U(1)).astype(np.uint16)
        return prints, (keys & U(len(self.slots) - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        return at ^ (mix(prints.astype(U)) & U(len(self.slots) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, at = self._places(keys)
        own = prints[:, None]
        return ((self.slots[at] == own) | (self.slots[self._other(prints, at)] == own)).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """False if the filter has overflowed; it must then be built again from its keys."""
        prints, at = self._places(keys)
        draw = np.random.default_rng(len(keys))
        for turn in range(MAX_TURNS):
            done = self._take(prints, at, np.zeros(len(prints), np.uint16), prints)
            prints, at = prints[~done], at[~done]
            if not len(prints):
                return True
            if turn == 0:
                at = self._other(prints, at)
                continue
            # One key a bucket takes a slot; the key that lay there goes to its other bucket.
            bucket, first = np.unique(at, return_index=True)
            slot = draw.integers(0, SLOTS, len(bucket))
            evicted = self.slots[bucket, slot]
            self.slots[bucket, slot] = prints[first]
            prints[first], at[first] = evicted, self._other(evicted, bucket)
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Take out one fingerprint for each key; all must have been inserted."""
        prints, at = self._places(keys)
        done = self._take(prints, at, prints, np.zeros(len(prints), np.uint16))
        prints, at = prints[~done], self._other(prints[~done], at[~done])
        if not self._take(prints, at, prints, np.zeros(len(prints), np.uint16)).all():
            raise ValueError("a key that is not in the filter cannot be deleted")

    def _take(self, prints: np.ndarray, at: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Turn a slot with ``old`` in bucket ``at`` into ``new``, one slot for each key; False where none was left."""
        order = np.lexsort((old, at))
        where, wanted = at[order], old[order]
        edge = np.ones(len(order), bool)
        edge[1:] = (where[1:] != where[:-1]) | (wanted[1:] != wanted[:-1])
        start = np.maximum.accumulate(np.where(edge, np.arange(len(order)), 0))
        nth = np.arange(len(order)) - start + 1
        upto = (self.slots[where] == wanted[:, None]).cumsum(axis=1)
        fits = upto[:, -1] >= nth if len(order) else np.zeros(0, bool)
        slot = (upto == nth[:, None]).argmax(axis=1) if len(order) else np.zeros(0, np.int64)
        self.slots[where[fits], slot[fits]] = new[order][fits]
        done = np.zeros(len(order), bool)
        done[order] = fits
        return done


def keys_of(digests_: list[bytes]) -> np.ndarray:
    """Bytes 8 to 16 of each digest as a number; the first bytes deal the shards."""
    return np.frombuffer(b"".join(digests_), ">u8").reshape(-1, 4)[:, 1].astype(U)


class Shard:
    """The filter and the stored entries (digest: rows, doc_id, row) of one shard."""

    def __init__(self):
        self.filter, self.entries = CuckooFilter(), {}
        self.hits = self.false_hits = self.resizes = 0

    def store(self, changes: dict[bytes, tuple]) -> None:
        """Put in entries of digests that are not live."""
        self.entries.update(changes)
        if changes and not self.filter.insert(keys_of(list(changes))):
            self.resize()

    def resize(self) -> None:
        buckets = len(self.filter.slots)
        while True:
            buckets *= 2
            self.resizes += 1
            self.filter = CuckooFilter(buckets)
            if self.filter.insert(keys_of(list(self.entries))):
                return

    def add(self, changes: dict[bytes, tuple]) -> None:
        """Add rows of digests: new ones are stored, live ones keep the larger row."""
        names = list(changes)
        hit = self.filter.contains(keys_of(names))
        new = {}
        for d, maybe in zip(names, hit.tolist()):
            live = self.entries.get(d) if maybe else None  # a miss needs no look at the content
            if live is None:
                self.false_hits += maybe
                new[d] = changes[d]
            else:
                self.entries[d] = merged(live, changes[d])
        self.hits += int(hit.sum())
        self.store(new)

    def put(self, changes: dict[bytes, tuple]) -> None:
        """Replace entries of live digests; no rows: the digest goes."""
        dead = [d for d, (n, _, _) in changes.items() if not n]
        self.entries.update(changes)
        for d in dead:
            del self.entries[d]
        if dead:
            self.filter.delete(keys_of(dead))


def merged(a: tuple, b: tuple) -> tuple:
    """Rows added up, and the larger (doc_id, row); no doc_id is the smallest."""
    last = max((a[1] is not None, a[1] or 0, a[2]), (b[1] is not None, b[1] or 0, b[2]))
    return a[0] + b[0], last[1] if last[0] else None, last[2]


# -- the index over all shards ------------------------------------------------

FILTER, ENTRY, ADDED, COUNTED = 0, 1, 2, 3
FIELDS = ["shard", "kind", "digest", "n", "doc_id", "row", "slots"]
SCHEMA = "shard int, kind int, digest binary, n bigint, doc_id bigint, row bigint, slots binary"
ARROW = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("digest", pa.binary()), ("n", pa.int64()), ("doc_id", pa.int64()),
                   ("row", pa.int64()), ("slots", pa.binary())])


class CuckooIndex(NamedTuple):
    """``members``: every live row (doc_id, digest, row); ``state``: filters and entries by shard; 2**bits shards."""

    members: DataFrame
    state: DataFrame
    bits: int

    @property
    def entries(self) -> DataFrame:
        """(digest, n, doc_id, row) of every live digest: its rows, and the id and row that stay."""
        return self.state.where(F.col("kind") == ENTRY).select("digest", "n", "doc_id", "row")


def empty_index(spark: SparkSession) -> CuckooIndex:
    return CuckooIndex(
        spark.createDataFrame([], "doc_id bigint, digest binary, row bigint"), spark.createDataFrame([], SCHEMA), 0)


def shard_numbers(digest: pa.Array, bits: int) -> pa.Array:
    """The first bits of each digest."""
    if not len(digest):
        return pa.array([], pa.int32())
    first = np.frombuffer(b"".join(digest.to_pylist()), ">u4").reshape(-1, 8)[:, 0]
    return pa.array((first.astype(np.int64) >> (32 - bits)).astype(np.int32))


def folded(rows: DataFrame, bits: int, kind: int) -> DataFrame:
    """Changes by shard: equal digests of an Arrow batch are one row already."""

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            order = pc.sort_indices(t, [("doc_id", "ascending"), ("row", "ascending")], null_placement="at_start")
            last = pc.ScalarAggregateOptions(skip_nulls=False, min_count=0)
            g = t.take(order).group_by("digest", use_threads=False).aggregate([("n", "sum"), ("doc_id", "last", last), ("row", "last", last)])
            digest = g.column("digest").combine_chunks()
            yield pa.RecordBatch.from_arrays([
                shard_numbers(digest, bits), pa.array(np.full(len(digest), kind, np.int32)), digest, g.column("n_sum").combine_chunks(),
                g.column("doc_id_last").combine_chunks(), g.column("row_last").combine_chunks(), pa.nulls(len(digest), pa.binary())], schema=ARROW)

    return rows.select("digest", "n", "doc_id", "row").mapInArrow(run, SCHEMA)


def shards(batches):
    """(number, shard as stored, its changes) from rows that are sorted by shard and kind."""
    for own in grouped(batches, "shard"):
        shard = Shard()
        kinds = own.column("kind").to_numpy()
        for slots in own.filter(pa.array(kinds == FILTER)).column("slots").to_pylist():
            shard.filter = CuckooFilter.from_bytes(slots)
        stored = columns(own.filter(pa.array(kinds == ENTRY)))
        if FILTER in kinds:
            shard.entries = stored
        else:
            shard.store(stored)  # dealt to other shards: the filter is built from the stored keys
        yield own.column("shard")[0].as_py(), shard, own.filter(pa.array(kinds > ENTRY))


def columns(rows: pa.Table) -> dict[bytes, tuple]:
    values = zip(*(rows.column(c).to_pylist() for c in ("n", "doc_id", "row")))
    out = {}
    for d, v in zip(rows.column("digest").to_pylist(), values):
        out[d] = merged(out[d], v) if d in out else v
    return out


def next_state(index: CuckooIndex, changes: DataFrame, bits: int) -> DataFrame:
    """Filters and entries, written, after changes; every shard is read and written by one task."""

    def run(batches):
        for number, shard, changed in shards(batches):
            counted = pc.equal(changed.column("kind"), COUNTED)
            shard.put(columns(changed.filter(counted)))
            added = changed.filter(pc.invert(counted))
            for i in range(0, added.num_rows, CHUNK):
                shard.add(columns(added.slice(i, CHUNK)))
            n = len(shard.entries)
            values = list(zip(*shard.entries.values())) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * (n + 1), pa.int32()), pa.array([FILTER] + [ENTRY] * n, pa.int32()),
                 pa.array([None, *shard.entries], pa.binary()),
                 *[pa.array([None, *v], pa.int64()) for v in values], pa.array([shard.filter.to_bytes()] + [None] * n, pa.binary())], schema=ARROW)

    state = index.state
    if bits != index.bits:
        state = folded(index.entries, bits, ENTRY)
    rows = state.unionByName(changes)
    return materialize(rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(run, SCHEMA), "cuckoo-index")


def add(index: CuckooIndex, rows: DataFrame) -> CuckooIndex:
    """The index with further rows (``digests``)."""
    total = index.members.count() + rows.count()
    bits = max(index.bits, math.ceil(math.log2(max(1, total / SHARD_KEYS))))
    state = next_state(index, folded(rows.withColumn("n", F.lit(1).cast("bigint")), bits, ADDED), bits)
    return CuckooIndex(index.members.unionByName(rows), state, bits)


def remove(index: CuckooIndex, ids: DataFrame) -> CuckooIndex:
    """The index without the rows of these doc_ids; unknown ids change nothing."""
    gone = ids.select(F.col("doc_id").cast("bigint").alias("_id")).where("_id is not null").distinct()
    match = F.col("doc_id") == F.col("_id")
    left = materialize(index.members.join(gone, match, "left_anti"), "members")
    touched = materialize(index.members.join(gone, match, "left_semi").select("digest").distinct(), "touched")
    counts = left.join(touched, "digest", "left_semi").groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("last"))  # NULL sorts first
    changes = touched.join(counts, "digest", "left").select(
        "digest", F.coalesce("n", F.lit(0)).alias("n"), F.col("last.doc_id").alias("doc_id"), F.col("last.row").alias("row"))
    return CuckooIndex(left, next_state(index, folded(changes, index.bits, COUNTED), index.bits), index.bits)


def lookup(index: CuckooIndex, rows: DataFrame) -> DataFrame:
    """``rows`` (with digest) that the index knows, with ``known_n`` and ``known_id``.

    The filters answer for most new digests; only hits meet the stored entries.
    """
    asked = folded(rows.select("digest").withColumns({
        "n": F.lit(1).cast("bigint"), "doc_id": F.lit(None).cast("bigint"), "row": F.lit(0).cast("bigint")}), index.bits, ADDED)

    def run(batches):
        for own in grouped(batches, "shard"):
            kinds = own.column("kind").to_numpy()
            slots = own.filter(pa.array(kinds == FILTER)).column("slots").to_pylist()
            names = own.filter(pa.array(kinds == ADDED)).column("digest").unique()
            if slots and len(names):
                hit = CuckooFilter.from_bytes(slots[0]).contains(keys_of(names.to_pylist()))
                yield pa.RecordBatch.from_arrays([names.filter(pa.array(hit)).cast(pa.binary())], names=["digest"])

    filters = index.state.where(F.col("kind") == FILTER)
    hits = filters.unionByName(asked).repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "digest binary")
    verified = index.entries.join(hits, "digest", "left_semi").select(
        F.col("digest").alias("_d"), F.col("n").alias("known_n"), F.col("doc_id").alias("known_id"))
    return rows.join(verified, F.col("digest") == F.col("_d")).drop("_d")


# -- the whole table ----------------------------------------------------------


def exact_groups(rows: DataFrame, index: CuckooIndex) -> DataFrame:
    """One row per row of the index: doc_id, keep_id, group_size, kept, digest.

    Digests of one row need no look at the index; the others meet one entry each, those
    with a large share of all rows by broadcast.
    """
    groups = index.entries.where("n > 1").select(
        "digest", F.col("n").alias("_n"), F.col("doc_id").alias("_keep"), F.col("row").alias("_keep_row"))
    joined = left_join_hot(rows.select("doc_id", "digest", "row"), groups, "digest", "_n")
    alone = F.col("_n").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_n", F.lit(1).cast("bigint")).alias("group_size"), F.coalesce(F.col("row") == F.col("_keep_row"), F.lit(True)).alias("kept"), "digest")


def exact_dedup(docs: DataFrame) -> DataFrame:
    rows = digests(docs)
    return exact_groups(rows, add(empty_index(docs.sparkSession), rows))


def op11_cuckoo_dedup(spark, sf_dir: str) -> DataFrame:
    out = exact_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP11_SQL = f"""
WITH normal AS (SELECT doc_id, translate(coalesce(text, ''), '{CAPITALS}', '{SMALLS}') AS t FROM documents),
ranked AS (
  SELECT doc_id, t, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
         row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept
  FROM normal WINDOW w AS (PARTITION BY t))
SELECT doc_id, keep_id, group_size, kept, sha256(t) AS text_sha256 FROM ranked
"""
