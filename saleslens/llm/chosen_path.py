"""N-gram Jaccard join by chosen paths.

Documents are sets of five-word shingles, embedded as ``WIDTH`` min-hash values.
A run splits the sets along randomly chosen tokens: a set goes into the bucket of
a path and a token if a hash of both is small, which similar sets agree on.
Buckets of up to ``SMALL`` sets are compared by brute force on 2-bit signatures of
the min-hash values.  A larger bucket has a center, the commonest symbol of each
place over some of its sets.  Sets near the center leave with it: by the triangle
inequality whatever is similar to one of them is not far from the center and joins
their group.  The rest is compared, if few, or split again, until no large bucket is
left.  Runs repeat until a similar pair is missed with less than 1 - ``RECALL``, in
buckets of any depth.

What the runs find are candidates; sets that candidates connect form groups, and
links within a group are exact.  Small groups are compared as a whole.  In a large
group Jaccard distances to one pivot decide most pairs: two distances that add
up to 0.2 are a link, two that differ by more than 0.2 are none.  The group is cut
into blocks by that distance, only blocks whose distances leave pairs undecided meet,
and only there tokens are sent and compared.

Equal sets are collapsed before all this: a set that a third of all documents
share is one row.  Within a group of g different texts, all about as far from
each other as from the pivot, g**2 / 2 pairs stay undecided; they are compared in
blocks of up to ``BLOCK_BYTES``, so a set travels once per such block, g / 1024 times
at least.  Tables of a level are deleted when the next one is written.

Defined results: words are lower-cased runs between white space; a text of 1 to 4
words is one shingle; NULL and wordless texts have no shingles, link to nothing
and are classes of their own; rows that repeat a document are counted each; an
empty table gives no rows; columns beside doc_id and text are ignored.  A NULL
doc_id is a document like others: it links and is counted, but it names a class or
an equal set only where none of its documents has an id, and that name is NULL.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, materialize, read
from .quality_mil import text_parts

WORDS, NUMERATOR, DENOMINATOR = 5, 4, 5  # shingle length; similarity of 4/5 or more
#: With two branches on average, sets that share less than half of their tokens part sooner or later, and those that
#: share more are in the core of their center.
WIDTH, BRANCH, RECALL = 128, 2.0, 0.9999
#: Buckets of up to so many sets are compared as a whole.
SMALL = 1024
#: Shares of equal 2-bit symbols.  Sets of similarity 0.8 share 0.85 of them (0.8 and a quarter of the rest); four
#: standard deviations below is a candidate.  What is a candidate to a set in the core of a center shares
#: at least NEAR with the center, since unequal shares add up like distances.
CANDIDATE, CORE = 0.724, 0.775
NEAR = CORE + CANDIDATE - 1
#: Sets that are drawn, about, for the center of a bucket.
DRAWN = 48
#: A block of a large group: bytes of tokens, where a set counts for 1/1024 of a block at least.
BLOCK_BYTES, BLOCK_SETS = 4 << 20, 1024
#: Distances to a pivot are rounded up to millionths; LIMIT is the distance of similarity 0.8.
UNIT, LIMIT = 1_000_000, 200_000

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_RNG = np.random.default_rng(11)
FACTORS = (_RNG.integers(0, 2**31, WIDTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1))
OFFSETS = _RNG.integers(0, 2**32, WIDTH, dtype=np.uint32)
SLOTS = mix(np.arange(1, WIDTH + 1, dtype=np.uint64)) & U(0xFFFFFFFF00000000)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    spaced = pc.utf8_lower(pc.cast(pc.fill_null(texts, ""), pa.large_string()))
    lists = pc.utf8_split_whitespace(spaced)
    words = lists.flatten()
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    words, doc = words.filter(pa.array(full)), doc[full]
    coded = pc.dictionary_encode(words)
    known = coded.dictionary.to_pandas().to_numpy(object)
    h = (pd.util.hash_array(known, categorize=False) if len(known) else np.empty(0, U))[coded.indices.to_numpy(zero_copy_only=False)]
    ends = np.cumsum(np.bincount(doc, minlength=len(texts)))
    with np.errstate(over="ignore"):
        rolled = h[:len(h) - WORDS + 1].copy() if len(h) >= WORDS else np.empty(0, U)
        for k in range(1, WORDS):
            rolled = rolled * U(0x9E3779B97F4A7C15) + h[k:len(h) - WORDS + 1 + k]
    rolled = mix(rolled)
    out, start = [], 0
    for end in ends.tolist():
        n = end - start
        if n >= WORDS:
            out.append(np.unique(rolled[start:end - WORDS + 1]))
        elif n:
            one = U(n)
            for w in h[start:end]:
                one = mix(np.array([one ^ w]))[0]
            out.append(np.array([one]))
        else:
            out.append(np.empty(0, U))
        start = end
    return out


def sketch(own: np.ndarray) -> np.ndarray:
    """``WIDTH`` min-hash values of a set that is not empty."""
    low, best = own.astype(np.uint32), None
    for i in range(0, len(low), 4096):
        part = (low[i:i + 4096, None] * FACTORS + OFFSETS).min(axis=0)
        best = part if best is None else np.minimum(best, part)
    return best


def signature(sketches: np.ndarray) -> np.ndarray:
    """2 bits of each min-hash value, mixed, four to a byte."""
    with np.errstate(over="ignore"):
        two = ((sketches * np.uint32(0x9E3779B1)) >> np.uint32(30)).astype(np.uint8).reshape(-1, WIDTH // 4, 4)
    return (two << np.array([0, 2, 4, 6], np.uint8)).sum(axis=2, dtype=np.uint8)


def symbols(column: pa.Array) -> np.ndarray:
    """The 2-bit symbols of a column of signatures, one row each."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH // 4, 1)
    return ((raw >> np.array([0, 2, 4, 6], np.uint8)) & 3).reshape(-1, WIDTH)


def set_id(own: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = mix(own + U(len(own))).sum(dtype=U)
    return int(np.array([mix(np.array([total]))[0]], U).view(np.int64)[0])


def embedded(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, cid, n, sketch, sig): the set of each document by its 64-bit id, its size, min-hash values and signature."""

    def run(batches):
        for batch in batches:
            at = 0
            for part in text_parts(batch.column(2)):
                sets = shingle_sets(part)
                sketches = [sketch(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(sets)),
                    batch.column(1).slice(at, len(sets)).cast(pa.int64()),
                    pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([s if s is None else s.tobytes() for s in sketches], pa.binary()),
                    pa.array([s if s is None else signature(s).tobytes() for s in sketches], pa.binary())],
                    names=["_row", "doc_id", "cid", "n", "sketch", "sig"])
                at += len(sets)

    row = docs.schema["_row"].dataType.simpleString()
    return docs.select("_row", "doc_id", "text").mapInArrow(run, f"_row {row}, doc_id bigint, cid bigint, n int, sketch binary, sig binary")


def survival(depth: int = 100) -> float:
    """Chance that a pair of exactly the wanted similarity is still together after ``depth`` splits; it falls to a limit above 0."""
    s = 1.0
    for _ in range(depth):
        s = 1 - math.exp(-BRANCH * NUMERATOR / DENOMINATOR * s)
    return s


def runs_for(recall: float) -> int:
    """Runs after which a pair of the wanted similarity is found with that chance, in buckets of any depth."""
    return math.ceil(math.log(1 - recall) / math.log(1 - survival()))


def chosen(paths: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, new path) for the tokens that each row's path chooses."""
    tokens = sketches.astype(np.uint64) ^ SLOTS
    h = mix(tokens ^ paths[:, None])
    row, slot = np.nonzero(h < U(int(BRANCH / WIDTH * 2**64)))
    return row, mix(h[row, slot] ^ U(0x5851F42D4C957F2D)).view(np.int64)


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, WIDTH)


def first_paths(classes: DataFrame, runs: int) -> DataFrame:
    seeds = mix(np.arange(1, runs + 1, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                sketches, cids = matrix(part.column(1)), part.column(0).to_numpy()
                for seed in seeds:
                    row, path = chosen(np.full(len(cids), seed), sketches)
                    yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(cids[row])], names=["path", "cid"])

    return classes.select("cid", "sketch").mapInArrow(run, "path bigint, cid bigint")


EDGES = "a bigint, b bigint"


def stars(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row the smallest id in its component of a symmetric boolean matrix."""
    label = ids.copy()
    while True:
        near = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, near)
        if (new == label).all():
            return label
        label = new


def grouped(batches, *keys: str):
    """Batches sorted by keys, as one table per key."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        change = np.zeros(max(0, table.num_rows - 1), bool)
        for key in keys:
            values = table.column(key).to_numpy()
            change |= values[1:] != values[:-1]
        at = 0
        for cut in (np.flatnonzero(change) + 1).tolist():
            yield table.slice(at, cut - at).combine_chunks()
            at = cut
        rest = table.slice(at)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def alike(s: np.ndarray) -> np.ndarray:
    """For all pairs of rows the places with equal symbols."""
    if len(s) <= 8:
        return (s[:, None, :] == s[None, :, :]).sum(axis=2)
    each = (s[:, :, None] == np.arange(4, dtype=np.uint8)).reshape(len(s), -1).astype(np.float32)
    return each @ each.T


def compare_small(buckets: DataFrame, sigs: DataFrame) -> DataFrame:
    """Candidate edges of small buckets (path, cid), as stars; ``sigs``: cid, n, sig."""
    # Runs often find the same bucket: it is compared once.
    members = (
        buckets.groupBy("path").agg(F.sort_array(F.collect_list("cid")).alias("cids")).select("cids").distinct()
        .select(F.xxhash64("cids").alias("bucket"), F.explode("cids").alias("cid")).join(sigs, "cid"))

    def run(batches):
        a, b = [], []
        for own in grouped(batches, "bucket"):
            ids, n = own.column("cid").to_numpy(), own.column("n").to_numpy().astype(np.int64)
            near = alike(symbols(own.column("sig"))) >= CANDIDATE * WIDTH
            near &= np.minimum(n[:, None], n) * DENOMINATOR >= np.maximum(n[:, None], n) * NUMERATOR
            root = stars(near, ids)
            a += ids[root != ids].tolist()
            b += root[root != ids].tolist()
            if len(a) > 10000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return members.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, EDGES)


def centers(rows: DataFrame, key: str) -> DataFrame:
    """(key, center): the commonest symbol of each place over about DRAWN rows of the key; rows: key, cid, sig, m (rows of the key)."""
    drawn = rows.where(F.pmod(F.xxhash64("cid", key), F.col("m")) < DRAWN).groupBy(key).agg(F.collect_list("sig").alias("sigs"))

    def run(batches):
        for batch in batches:
            out = []
            for sigs in batch.column(1).to_pylist():
                s = symbols(pa.array(sigs, pa.binary()))
                best = np.stack([(s == v).sum(axis=0) for v in range(4)]).argmax(axis=0).astype(np.uint8).reshape(-1, 4)
                out.append((best << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=[key, "center"])

    return drawn.mapInArrow(run, f"{key} bigint, center binary")


def near_center(rows: DataFrame, key: str) -> DataFrame:
    """(key, cid, share) of rows (key, cid, sig, center): the share of symbols like the center's; 0 without one."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                known = part.column(3).fill_null(bytes(WIDTH // 4))
                share = (symbols(part.column(2)) == symbols(known)).mean(axis=1)
                share[part.column(3).is_null().to_numpy(zero_copy_only=False)] = 0
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(share)], names=[key, "cid", "share"])

    return rows.select(key, "cid", "sig", "center").mapInArrow(run, f"{key} bigint, cid bigint, share double")


def split(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(path, cid) of the next level from those of this one; each set's min-hash values travel once."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                lists = part.column(1)
                owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                row, path = chosen(lists.flatten().to_numpy().view(np.uint64), matrix(part.column(2))[owner])
                yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(part.column(0).to_numpy()[owner[row]])], names=["path", "cid"])

    paths = rows.groupBy("cid").agg(F.collect_list("path").alias("paths"))  # a few dozen for each set
    return paths.join(classes.select("cid", "sketch"), "cid").select("cid", "paths", "sketch").mapInArrow(run, "path bigint, cid bigint")


def candidates(classes: DataFrame, recall: float = RECALL) -> DataFrame:
    """(node, comp): groups of sets that the chosen-path runs connect as candidates; some nodes are centers."""
    scratch = Scratch(classes.sparkSession)
    sigs = classes.select("cid", "n", "sig")
    rows, edges = scratch.keep(first_paths(classes, runs_for(recall)), "paths"), []
    while True:
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        met = scratch.keep(rows.join(sizes, "path"), "met")
        scratch.drop(rows)
        edges.append(scratch.keep(compare_small(met.where(F.col("m") <= SMALL), sigs), "edges"))
        large = met.where(F.col("m") > SMALL)
        if large.isEmpty():
            break
        owned = scratch.keep(large.join(sigs.select("cid", "sig"), "cid"), "large")
        scratch.drop(met)
        judged = scratch.keep(near_center(owned.join(centers(owned, "path"), "path", "left"), "path"), "judged")
        scratch.drop(owned)
        core = F.col("share") >= CORE
        counts = scratch.keep(judged.groupBy("path").agg(
            F.count_if(core).alias("cores"), F.count_if(~core).alias("rest")), "counts")
        # A star around the center, which is a node by itself; without a core nothing has left.
        kin = judged.where(F.col("share") >= NEAR).join(counts.where("cores > 0"), "path")
        edges.append(scratch.keep(kin.select(F.col("cid").alias("a"), F.xxhash64("path", F.lit("center")).alias("b")), "edges"))
        rest = scratch.keep(judged.where(~core).join(counts.where("rest > 1"), "path").select("path", "cid", "rest"), "rest")
        scratch.drop(judged, counts)
        # What is few now is compared on the next level.
        few = rest.where(F.col("rest") <= SMALL).select("path", "cid")
        rows = scratch.keep(split(rest.where(F.col("rest") > SMALL), classes).unionByName(few), "paths")
        scratch.drop(rest)
    groups = components(reduce(DataFrame.unionByName, edges))
    scratch.drop(*edges)
    return groups


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node of each connected component of undirected edges (a, b).

    A node is the ``a`` of few edges.  These shrink first: ``a`` keeps the edge to its
    smallest neighbour, and its other neighbours are tied to that one, which for the
    centers and roots that very many nodes share are always the same few ties.
    Labels then spread to neighbours as minima, which are pre-aggregated, and jump along
    labels, so the rounds grow with the logarithm of the longest path.
    """
    some = edges.where("a <> b")
    if some.isEmpty():
        return edges.sparkSession.createDataFrame([], "node bigint, comp bigint")
    scratch = Scratch(edges.sparkSession)
    tied = some.withColumn("least", F.min("b").over(W.partitionBy("a")))
    others = tied.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    both = tied.groupBy("a").agg(F.min("b").alias("b")).unionByName(others)
    both = scratch.keep(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "both-ways")
    labels = scratch.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("comp")), "labels")
    while True:
        known = labels.select("node", "comp")
        near = (
            both.join(known.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        new = known.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = known.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        new = scratch.keep(new.join(jump, "comp").select("node", "old", F.least("comp", "far").alias("comp")), "labels")
        scratch.drop(labels)
        labels = new
        if new.where("old <> comp").isEmpty():
            scratch.drop(both)
            return new.select("node", "comp")


LINKS = "cid bigint, root bigint, texts bigint, docs bigint"


def exact_links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Per set and place where links were found: their number, and a set they connect it to.

    ``members``: cid, row, comp, docs (documents with that set), n, sig; written.
    """
    weight = F.col("n") * 8 + BLOCK_BYTES // BLOCK_SETS
    totals = materialize(members.groupBy("comp").agg(F.sum(weight).alias("total"), F.count(F.lit(1)).alias("m")).where("m > 1"), "totals")
    sized = members.join(totals, "comp").withColumn("weight", weight)
    small = full_sets(docs, sized.where(F.col("total") <= BLOCK_BYTES)).select(
        "comp", F.lit(0).alias("first"), F.lit(0).alias("second"), F.lit(False).alias("other"), "cid", "docs", F.lit(LIMIT).alias("q"), "tokens")
    large = sized.where(F.col("total") > BLOCK_BYTES)
    if large.isEmpty():
        return materialize(compare_blocks(small), "links")
    scratch = Scratch(docs.sparkSession)
    own = scratch.keep(large, "large-groups")
    sets = scratch.keep(full_sets(docs, own), "large-sets")
    places = scratch.keep(blocks(from_pivot(own, sets).join(own.select("cid", "comp", "docs", "weight"), "cid")), "places")
    units = places.join(block_pairs(places), ["comp", "block"]).join(sets.select("cid", "tokens"), "cid").select(
        "comp", "first", "second", "other", "cid", "docs", "q", "tokens")
    links = materialize(compare_blocks(small.unionByName(units)).unionByName(decided_links(places)), "links")
    scratch.drop(own, sets, places)
    return links


def from_pivot(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(cid, q, pivot): the distance of each set to its group's pivot, the set that is most like the group's center."""
    central = members.join(centers(members, "comp"), "comp", "left")
    pivots = near_center(central, "comp").groupBy("comp").agg(F.max(F.struct("share", "cid")).alias("p")).select("comp", F.col("p.cid").alias("pivot"))
    tokens = sets.select(F.col("cid").alias("pivot"), F.col("tokens").alias("_pivot")).join(pivots, "pivot")

    def run(batches):
        for batch in batches:
            q = []
            for own, pivot in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(own, np.uint64), np.frombuffer(pivot, np.uint64)
                both = int(np.isin(a, b, assume_unique=True).sum())
                union = len(a) + len(b) - both
                q.append(-(-UNIT * (union - both) // union))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(q, pa.int32()), batch.column(1)], names=["cid", "q", "pivot"])

    return sets.join(tokens, "comp").select("cid", "pivot", "tokens", "_pivot").mapInArrow(run, "cid bigint, q int, pivot bigint")


def blocks(sets: DataFrame) -> DataFrame:
    """``sets`` (cid, q, pivot, comp, docs, weight) with ``block``: groups are cut by distance, and where many are equally far by a hash."""
    by_distance = sets.groupBy("comp", "q").agg(F.sum("weight").alias("_w"))
    before = W.partitionBy("comp").orderBy("q").rowsBetween(W.unboundedPreceding, -1)  # at most a row per millionth
    starts = by_distance.withColumn("_start", F.coalesce(F.sum("_w").over(before), F.lit(0)))
    at = F.col("_start") + F.pmod(F.xxhash64("cid"), F.lit(1 << 20)) / (1 << 20) * F.col("_w")
    return sets.join(starts, ["comp", "q"]).withColumn("block", F.floor(at / BLOCK_BYTES).cast("int")).drop("_w", "_start")


def block_pairs(places: DataFrame) -> DataFrame:
    """(comp, block, first, second, other): for every pair of blocks that must meet a row for each of them."""
    spans = materialize(places.groupBy("comp", "block").agg(F.min("q").alias("low"), F.max("q").alias("high")), "spans")
    far = spans.select("comp", F.col("block").alias("second"), F.col("low").alias("low_2"), F.col("high").alias("high_2"))
    pairs = spans.withColumnRenamed("block", "first").join(far, "comp").where(
        (F.col("first") <= F.col("second")) & (F.col("low_2") - F.col("high") <= LIMIT + 1) & (F.col("high") + F.col("high_2") > LIMIT))
    sides = F.when(F.col("first") == F.col("second"), F.array(F.col("first"))).otherwise(F.array("first", "second"))
    return pairs.select("comp", "first", "second", F.explode(sides).alias("block")).withColumn("other", F.col("block") != F.col("first"))


def decided_links(places: DataFrame) -> DataFrame:
    """Links of sets whose distances to the pivot add up to at most LIMIT, counted without meeting."""
    counts = places.groupBy("comp", "q").agg(F.count(F.lit(1)).alias("texts"), F.sum("docs").alias("docs"))
    none = F.lit(0).cast("bigint")
    asked = counts.where(F.col("q") <= LIMIT).select("comp", (F.lit(LIMIT) - F.col("q")).alias("at"), F.lit(1).alias("ask"), none.alias("texts"), none.alias("docs"))
    line = counts.select("comp", F.col("q").alias("at"), F.lit(0).alias("ask"), "texts", "docs").unionByName(asked)
    upto = W.partitionBy("comp").orderBy("at", "ask").rowsBetween(W.unboundedPreceding, 0)
    sums = line.select("comp", (F.lit(LIMIT) - F.col("at")).alias("q"), "ask", F.sum("texts").over(upto).alias("texts"), F.sum("docs").over(upto).alias("all_docs")).where("ask = 1").drop("ask")
    self_too = (2 * F.col("q") <= LIMIT).cast("bigint")  # a set is no link of its own
    return places.join(sums, ["comp", "q"]).select(
        "cid", F.col("pivot").alias("root"), (F.col("texts") - self_too).alias("texts"), (F.col("all_docs") - self_too * F.col("docs")).alias("docs"))


def compare_blocks(units: DataFrame) -> DataFrame:
    """LINKS of undecided pairs within units (comp, first, second); ``other`` marks the second block."""
    keys = ["comp", "first", "second"]

    def run(batches):
        for unit in grouped(batches, *keys):
            other = unit.column("other").to_numpy(zero_copy_only=False)
            sides = [unit.filter(pa.array(~other)), unit.filter(pa.array(other))]
            if unit.column("first")[0] == unit.column("second")[0]:
                sides[1] = sides[0]
            (ids, docs, q, own), (ids_2, docs_2, q_2, own_2) = (
                (t.column("cid").to_numpy(), t.column("docs").to_numpy(), t.column("q").to_numpy().astype(np.int64),
                 [np.frombuffer(x, np.uint64) for x in t.column("tokens").to_pylist()]) for t in sides)
            n, n_2 = (np.array([len(t) for t in s], np.int64) for s in (own, own_2))
            same = sides[0] is sides[1]
            linked = shared(own, own_2) * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (n[:, None] + n_2)
            linked &= q[:, None] + q_2 > LIMIT  # the others are decided
            if same:
                np.fill_diagonal(linked, False)
                found = [(ids, stars(linked, ids), linked.sum(axis=1), linked @ docs)]
            else:
                # Each set with a link goes to the smallest set of the other block that it is linked to.
                most = np.iinfo(np.int64).max
                found = [(ids, np.where(linked, ids_2, most).min(axis=1, initial=most), linked.sum(axis=1), linked @ docs_2),
                         (ids_2, np.where(linked, ids[:, None], most).min(axis=0, initial=most), linked.sum(axis=0), docs @ linked)]
            for columns in found:
                has = columns[2] > 0
                yield pa.RecordBatch.from_arrays([pa.array(x[has], pa.int64()) for x in columns], names=["cid", "root", "texts", "docs"])

    return units.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, LINKS)


def shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all of ``b``."""
    out = np.zeros((len(a), len(b)), np.int64)
    (tokens, owner), (tokens_2, owner_2) = (
        (np.concatenate(s) if s else np.empty(0, U), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (a, b))
    both = np.intersect1d(tokens, tokens_2)  # tokens of one side alone cannot be shared
    step = 4096
    for i in range(0, len(both), step):
        part = both[i:i + step]
        sides = []
        for t, o, m in ((tokens, owner, len(a)), (tokens_2, owner_2, len(b))):
            at = np.searchsorted(part, t)
            hit = (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == t)
            side = np.zeros((m, len(part)), np.float32)
            side[o[hit], at[hit]] = 1
            sides.append(side)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    return out


#: Hash buckets of wanted rows, which bound a broadcast: texts in other buckets are not shuffled.
ROW_BUCKETS = 1 << 20


def full_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(cid, comp, docs, tokens) of sets (cid, row, comp, docs), read again from the text of one row each."""

    def run(batches):
        for batch in batches:
            at = 0
            for part in text_parts(batch.column(0)):
                sets = shingle_sets(part)
                own = batch.slice(at, len(sets))
                at += len(sets)
                yield pa.RecordBatch.from_arrays(
                    [own.column(c) for c in ("cid", "comp", "docs")] + [pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["cid", "comp", "docs", "tokens"])

    def bucket(row):
        return F.pmod(F.xxhash64(row), F.lit(ROW_BUCKETS))

    wanted = members.select(bucket("row").cast("int").alias("_bucket")).distinct()
    texts = docs.select("_row", "text").join(F.broadcast(wanted), bucket("_row").cast("int") == F.col("_bucket"), "left_semi")
    rows = texts.join(members.select("cid", "row", "comp", "docs"), F.col("_row") == F.col("row")).select("text", "cid", "comp", "docs")
    return rows.mapInArrow(run, "cid bigint, comp bigint, docs bigint, tokens binary")


def with_row(docs: DataFrame) -> DataFrame:
    """``docs``, written, with ``_row``: a key of each row that is the same whenever the table is read."""
    return materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")


def jaccard_classes(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, text_links, text_class.

    ``class_id`` is the smallest doc_id among all documents that links connect it
    to, ``n_links`` the number of other documents that are similar to it (equal
    sets included), ``text_links`` the number of similar different sets and
    ``text_class`` the smallest doc_id of an equal set.
    """
    return row_classes(with_row(docs.select("doc_id", "text")), recall).drop("_row", "_kept")


def row_classes(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """``jaccard_classes`` of documents that have a ``_row``, with that and ``_kept``.

    ``_kept`` is the row that stands for the class: the smallest with the smallest
    id.  A row without shingles stands for itself.
    """
    scratch = Scratch(docs.sparkSession)
    all_docs = scratch.keep(embedded(docs), "embedded")
    ids = materialize(all_docs.select("_row", "doc_id", "cid"), "ids")
    classes = scratch.keep(
        all_docs.where("n > 0").groupBy("cid", "n").agg(
            F.count(F.lit(1)).alias("docs"),
            # NULL sorts first in a struct; an id goes before none.
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row", "sketch", "sig")).alias("s"))
        .select("cid", "n", "docs", F.col("s.doc_id").alias("rep"), F.col("s._row").alias("row"), "s.sketch", "s.sig"), "classes")
    scratch.drop(all_docs)
    groups = candidates(classes, recall)
    members = scratch.keep(classes.join(groups, F.col("cid") == F.col("node")).select("cid", "row", "comp", "docs", "n", "sig"), "members")
    found = exact_links(docs, members)
    final = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy(F.col("cid").alias("_l")).agg(F.sum("texts").alias("texts"), F.sum("docs").alias("more"))
    known = classes.select("cid", "rep", "row", "docs").join(final.withColumnRenamed("node", "_n"), F.col("cid") == F.col("_n"), "left").join(
        links, F.col("cid") == F.col("_l"), "left").withColumn("comp", F.coalesce("comp", "cid"))
    known = materialize(known.select("cid", "rep", "row", "docs", "comp", "texts", "more"), "known")
    scratch.drop(classes, members)
    first = known.groupBy("comp").agg(F.min(F.struct(F.col("rep").isNull().alias("no_id"), "rep", "row")).alias("f"))
    info = known.join(first.select("comp", F.col("f.rep").alias("class_id"), F.col("f.row").alias("kept")), "comp").select(
        F.col("cid").alias("_c"), "class_id", "kept", F.col("rep").alias("text_class"),
        (F.coalesce("more", F.lit(0)) + F.col("docs") - 1).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("text_links"))
    return ids.join(info, F.col("cid") == F.col("_c"), "left").select(
        "_row", "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("text_links", F.lit(0)).alias("text_links"), F.coalesce("text_class", "doc_id").alias("text_class"),
        F.coalesce("kept", "_row").alias("_kept"))


def op5_chosen_path(spark, sf_dir: str) -> DataFrame:
    # The place of a row in its file is a key that needs no copy of the table.
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    return row_classes(read(spark, sf_dir, "documents").select("doc_id", "text", place.alias("_row"))).drop("_row", "_kept")


def dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class, of those with the smallest id; rows without shingles stay."""
    rows = materialize(docs.select(F.struct(*docs.columns).alias("_own"), F.monotonically_increasing_id().alias("_row")), "rows")
    gone = row_classes(rows.select("_row", "_own.doc_id", "_own.text")).where("_row <> _kept").select(F.col("_row").alias("_gone"))
    return rows.join(gone, F.col("_row") == F.col("_gone"), "left_anti").select("_own.*")
