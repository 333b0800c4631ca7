"""Approximate nearest neighbours by adaptive dimension scans.

Vectors are dealt to cells (inverted lists).  A query probes the cells that
promise the largest inner products; how many, follows from a search within the
bounded sample that the cells are fitted on, so that ``RECALL`` of the nearest lie
in probed cells.  (Vectors without any structure need most of the cells.)  Inside a list the vectors are rotated at
random and scanned in blocks of columns: from the partial distance over some
dimensions a hypothesis test decides whether the whole distance can still be
among the k best, and abandons the candidate if not.  Candidates that stay to the
end are scored exactly on the original vectors.

Largest inner product becomes smallest distance by one more dimension that fills
every vector up to the largest norm.

Cells are probed in three rounds, best first: one, a few, the rest.  The kth score
found so far goes with the query into the next round: it is the first limit of the
tests, and no candidate below it leaves a task.

Cells grow in number with the root of the rows.  A crowded cell is cut into blocks of
``UNIT_ROWS`` rows, more in large tables; each is scanned by itself and gives at most k
rows per query.  Queries are answered as they stream by.  Where vectors have no structure,
so that a fixed share of all cells must be probed, the work grows with queries times
rows, and only the abandoned dimensions are saved.

Defined results: vectors take part that are not NULL, empty or zero and have a
vec_id and finite components only; vectors of different lengths never meet, each
length is searched by itself; rows that repeat a vec_id are candidates each, but one
query (the smallest vector), and never answer their own id; ties go to the smaller
vec_id; very large components may overflow to an infinite score, which then ranks
first; a table with fewer candidates than k returns all of them; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, read
from .vectors import (
    DEAL_QUERIES, best, block_of, by_length, by_unit, cell_stats, dealt, fit_cells, in_cells, nearest, queries_of, rows_of, unit_rows, usable,
    with_blocks)

K, EVERY = 20, 20
ROWS_PER_CELL, UNIT_ROWS, RECALL, ASKED = 512, 1024, 0.95, 512
#: Dimensions per step, rows per step, and how sure (in sigmas) an abandoned candidate is out.
STEP, CHUNK, SIGMAS = 16, 256, 2.1
QUERY_CHUNK = 128


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(29).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


class ScannedList:
    """Rotated, filled-up vectors of one list, in the order of their ids."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, largest: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.largest = ids[order], x[order], largest
        self.turn = rotation(x.shape[1] + 1)
        fill = np.sqrt(np.maximum(0, largest**2 - (self.x**2).sum(axis=1)))
        self.r = np.column_stack([self.x, fill]) @ self.turn
        self.scanned = 0  # dimensions looked at, for tests

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray | None = None):
        """(query row, member row) of the k nearest members of every query, if they reach its ``floor`` of the inner product."""
        n, d = self.r.shape
        rq = np.column_stack([q, np.zeros(len(q))]) @ self.turn
        start = np.full(len(q), np.inf)
        if floor is not None:
            scale = (q**2).sum(axis=1) + self.largest**2
            start = scale - 2 * floor + 1e-9 * scale
        kept_d = np.full((len(q), k), np.inf)
        kept_i = np.full((len(q), k), -1)
        for a in range(0, n, CHUNK):
            part = self.r[a:a + CHUNK]
            limit = np.minimum(start, kept_d[:, -1])
            steps = [*range(STEP, d, STEP), d]
            first = steps[0]
            sums = np.maximum(0, (rq[:, :first] ** 2).sum(axis=1)[:, None] + (part[:, :first] ** 2).sum(axis=1)
                              - 2 * rq[:, :first] @ part[:, :first].T)
            sums[self.ids[None, a:a + CHUNK] == query_ids[:, None]] = np.inf
            self.scanned += sums.size * first
            row, col = np.nonzero(self._open(sums, first, d, limit[:, None]) & (sums < np.inf))
            partial = sums[row, col]
            for s, e in zip(steps[:-1], steps[1:]):
                partial = partial + ((rq[row, s:e] - part[col, s:e]) ** 2).sum(axis=1)
                self.scanned += len(row) * (e - s)
                stay = self._open(partial, e, d, limit[row])
                row, col, partial = row[stay], col[stay], partial[stay]
            full = np.full((len(q), len(part)), np.inf)
            full[row, col] = partial
            both_d = np.concatenate([kept_d, full], axis=1)
            both_i = np.concatenate([kept_i, np.broadcast_to(np.arange(a, a + len(part)), full.shape)], axis=1)
            order = np.argsort(both_d, axis=1, kind="stable")[:, :k]
            kept_d, kept_i = np.take_along_axis(both_d, order, 1), np.take_along_axis(both_i, order, 1)
        row, slot = np.nonzero(kept_d < np.inf)
        return row, kept_i[row, slot]

    @staticmethod
    def _open(partial, seen: int, d: int, limit):
        """Not rejected: the distance scaled up from ``seen`` dimensions isn't clearly above the limit."""
        slack = 1.0 if seen == d else (1 + SIGMAS / math.sqrt(seen)) ** 2
        return partial * (d / seen) <= limit * slack * (1 + 1e-12)


def probes_for(recall: float, k: int, sample: np.ndarray, own: np.ndarray, promise) -> int:
    """Cells to probe so that they hold the wanted share of the k nearest in the sample; ``own`` are its rows' cells."""
    q = sample[:ASKED]
    order = promise(q)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), 1)
    scores = q @ sample.T
    np.fill_diagonal(scores, -np.inf)
    top = np.argsort(-scores, axis=1, kind="stable")[:, :min(k, max(1, len(sample) - 1))]
    needed = np.sort(np.take_along_axis(place, own[top], 1).ravel())
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]) + 1


def search(vectors: DataFrame, queries: DataFrame, k: int = K, recall: float = RECALL, per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """query_id, rank, vec_id, score for usable ``vectors`` (vec_id, v) of one length and the (vec_id, v) of ``queries``."""
    n = vectors.count()
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    centres, sample = fit_cells(vectors, n, per_cell)
    placed = in_cells(vectors, centres)
    stats = cell_stats(placed)
    unit = unit_rows(n, centres.shape[1], UNIT_ROWS)
    blocks = {c: math.ceil(s[0] / unit) for c, s in stats.items()}
    largest = max(s[3] for s in stats.values())
    cells = np.array(sorted(stats))
    sizes = np.array([stats[c][0] for c in cells])
    spread = np.array([math.sqrt(max(0.0, stats[c][2]) / centres.shape[1]) for c in cells])
    kind = placed.schema["v"].dataType.simpleString()

    def promise(q: np.ndarray) -> np.ndarray:
        """Cells by falling promise of large inner products."""
        mean = q @ centres[cells].T
        return np.argsort(-mean - 2 * np.sqrt((q**2).sum(axis=1))[:, None] * spread, axis=1, kind="stable")

    probes = probes_for(recall, k, sample, np.searchsorted(cells, nearest(sample, centres)), promise)

    many = np.array([blocks[c] for c in cells])

    def probe(batches, since: int, until: int):
        for whole in batches:
            for i in range(0, whole.num_rows, DEAL_QUERIES):
                batch = whole.slice(i, DEAL_QUERIES)
                order = promise(rows_of(batch.column(1)))
                # More cells where the usual number holds fewer candidates than are asked for.
                enough = np.maximum(probes, (np.cumsum(sizes[order], axis=1) < k + 1).sum(axis=1) + 1)
                place = np.arange(order.shape[1])
                row, at = np.nonzero((place >= since) & (place < np.minimum(until, enough)[:, None]))
                own = order[row, at]
                yield from dealt(batch, *with_blocks(row, cells[own], many[own]))

    members = materialize(placed.select(
        "vec_id", "v", "cell", block_of(F.col("vec_id"), blocks).alias("block"), F.lit(0).alias("kind"), F.lit(None).cast("double").alias("floor")),
        "lists")

    def build(table):
        return ScannedList(table.column("vec_id").to_numpy(), rows_of(table.column("v")), largest)

    def answer(own, table):
        for i in range(0, table.num_rows, QUERY_CHUNK):
            part = table.slice(i, QUERY_CHUNK)
            ids, q = part.column("vec_id").to_numpy(), rows_of(part.column("v"))
            row, at = own.search(ids, q, k, part.column("floor").to_numpy())
            score = np.einsum("ij,ij->i", q[row], own.x[at])
            yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(own.ids[at]), pa.array(score)], names=["query_id", "vec_id", "score"])

    parts = min(max(1, sum(blocks.values())), MAX_PARTS)
    found, since = None, 0
    for until in (*(t for t in FIRST_ROUNDS if t < len(cells)), len(cells)):
        floors = queries.select("vec_id", "v", F.lit(float("-inf")).alias("floor"))
        if found is not None:
            # The kth score of queries that have k candidates already.
            least = found.where(F.col("rank") == k).select(F.col("query_id").alias("_q"), F.col("score").alias("_least"))
            floors = queries.select("vec_id", "v").join(least, F.col("vec_id") == F.col("_q"), "left").select(
                "vec_id", "v", F.coalesce("_least", F.lit(float("-inf"))).alias("floor"))
        asked = floors.mapInArrow(
            lambda b, since=since, until=until: probe(b, since, until), f"vec_id bigint, v {kind}, cell int, block int, floor double")
        rows = members.unionByName(asked.withColumn("kind", F.lit(1)))
        sorted_ = rows.repartition(parts, "cell", "block").sortWithinPartitions("cell", "block", "kind")
        more = sorted_.mapInArrow(lambda b: by_unit(b, build, answer), "query_id bigint, vec_id bigint, score double")
        merged = more if found is None else found.drop("rank").unionByName(more)
        found = materialize(best(merged, k), "nearest")
        since = until
    return found


#: Cells that a query has probed after the first rounds; the last round probes the rest.
FIRST_ROUNDS = (1, 8)
#: Tasks of the scan at most; a task scans several units one after the other.
MAX_PARTS = 20000


def op8_dim_scan(spark, sf_dir: str) -> DataFrame:
    vectors = materialize(usable(read(spark, sf_dir, "embeddings"), zero=False), "vectors")
    return by_length(vectors, materialize(queries_of(vectors, EVERY), "queries"), search)
