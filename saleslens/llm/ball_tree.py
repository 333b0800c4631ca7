"""Exact top-k inner products by branch and bound over ball trees.

Vectors become whole numbers, floor(256 * x).  They are dealt to cells, and cells
to shards of about ``SHARD_ROWS`` rows; each shard holds a ball tree.  A query
visits the nodes of a tree in the order of their upper bound, query . centre +
|query| * radius, and stops where that falls below its current kth score.

The kth score is shared: a query first searches one shard of its most promising
cell, then the shards of the few cells with the largest bounds, then those of the
rest.  Each round starts with the kth score of the rounds before: only shards of
cells whose own bound reaches it are visited, and pruning starts with it at once.
The bounds of all cells, at most ``MAX_CELLS``, are a table of fixed size.

Defined results: vectors take part that are not NULL or empty and have a vec_id and
components that are finite, also 256 times as large; zero vectors take part; vectors of
different lengths never meet, each length is searched by itself; rows that repeat a
vec_id are candidates each, but one query (the smallest vector), and never answer
their own id; ties go to the smaller vec_id; scores are exact (beyond 2**53 they are
added up as Python integers), and one beyond the range of long counts and ranks as the
nearest long; a table with fewer candidates than k returns all of them; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, read
from .vectors import (
    DEAL_QUERIES, best, block_of, by_length, by_unit, cell_stats, dealt, fit_cells, in_cells, queries_of, rows_of, unit_rows, usable,
    with_blocks)

K, EVERY, SCALE = 5, 50, 256
ROWS_PER_CELL, SHARD_ROWS, LEAF_ROWS = 1024, 2048, 64
#: Relative rounding that a bound may have.
SLACK = 1e-9
EXACT = float(2**53)
LONGEST = 2**63 - 1


class BallTree:
    """Balls around halves of halves; a node is split across its two most distant rows."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.rows, self.children, centres, radii = [], [], [], []
        waiting = [np.arange(len(ids))]
        while waiting:
            own = waiting.pop(0)
            part = self.x[own]
            centre = part.mean(axis=0)
            gap = ((part - centre) ** 2).sum(axis=1)
            centres.append(centre)
            radii.append(math.sqrt(gap.max()))
            kids = ()
            if len(own) > LEAF_ROWS:
                far = part[gap.argmax()]
                other = part[((part - far) ** 2).sum(axis=1).argmax()]
                along = np.argsort(part @ (far - other), kind="stable")
                half = len(own) // 2
                kids = (len(self.rows) + len(waiting) + 1, len(self.rows) + len(waiting) + 2)
                waiting += [np.sort(own[along[:half]]), np.sort(own[along[half:]])]
            self.rows.append(own)
            self.children.append(kids)
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.large = float(np.abs(self.x).max(initial=0))
        self.visited = 0

    def search(self, query_id: int, q: np.ndarray, floor: float, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best members with a score of at least ``floor``."""
        bound = self.centres @ q + np.sqrt(q @ q) * self.radii
        bound = (bound + np.abs(bound) * SLACK + SLACK).tolist()
        exact = self.large * float(np.abs(q).max(initial=0)) * len(q) < EXACT
        top: list[tuple[int, int]] = []  # (score, -id), the worst first
        heap = [(-bound[0], 0)]
        while heap:
            most, node = heapq.heappop(heap)
            if -most < floor or (len(top) == k and -most < top[0][0]):
                break
            kids = self.children[node]
            if kids:
                for c in kids:
                    heapq.heappush(heap, (-min(bound[c], -most), c))
                continue
            self.visited += 1
            own = self.rows[node]
            if exact:
                scores = self.x[own] @ q
                least = max(floor, top[0][0] if len(top) == k else -math.inf)
                near = np.flatnonzero(scores >= least)
                found = zip(scores[near].astype(np.int64).tolist(), self.ids[own[near]].tolist())
            else:
                whole = [int(v) for v in q]
                found = [
                    (min(LONGEST, max(-LONGEST - 1, sum(int(a) * b for a, b in zip(row, whole)))), i)
                    for row, i in zip(self.x[own], self.ids[own].tolist())]
            for score, i in found:
                if i != query_id and score >= floor:
                    if len(top) < k:
                        heapq.heappush(top, (score, -i))
                    elif (score, -i) > top[0]:
                        heapq.heapreplace(top, (score, -i))
        return [(s, -i) for s, i in top]


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """floor(256 * x) as doubles; vectors for which that is not finite take no part."""

    def whole(x):
        y = x.cast("double") * SCALE
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole

    out = vectors.select("vec_id", F.transform("v", whole).alias("v"))
    return out.where(F.forall("v", lambda y: F.abs(y) != float("inf")))


def search(vectors: DataFrame, queries: DataFrame, k: int = K, per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """query_id, rank, vec_id, score for whole-number ``vectors`` (vec_id, v) of one length and ``queries``."""
    n = vectors.count()
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    centres, _ = fit_cells(vectors, n, per_cell)
    placed = in_cells(vectors, centres)
    stats = cell_stats(placed)
    unit = unit_rows(n, centres.shape[1], SHARD_ROWS)
    blocks = {c: math.ceil(s[0] / unit) for c, s in stats.items()}
    cells = np.array(sorted(stats))
    radii = np.array([stats[c][1] for c in cells])
    members = materialize(placed.select(
        "vec_id", "v", "cell", block_of(F.col("vec_id"), blocks).alias("block"), F.lit(0).alias("kind"), F.lit(None).cast("double").alias("floor")),
        "shards")
    layout = "vec_id bigint, v array<double>, cell int, block int, floor double"

    many = np.array([blocks[c] for c in cells])

    def visits(batches, since: int, until: int):
        """Rows (query, shard) of cells by falling bound, from ``since`` to ``until``; with until 0 the home shard only."""
        for whole in batches:
            for i in range(0, whole.num_rows, DEAL_QUERIES):
                batch = whole.slice(i, DEAL_QUERIES)
                ids, q = batch.column("vec_id").to_numpy(), rows_of(batch.column("v"))
                mean = q @ centres[cells].T
                bound = mean + np.sqrt((q**2).sum(axis=1))[:, None] * radii
                home = np.argmax(mean, axis=1)
                home_block = (ids // EVERY) % many[home]
                if not until:
                    yield from dealt(batch, np.arange(len(q)), cells[home], home_block)
                    continue
                order = np.argsort(-bound, axis=1, kind="stable")[:, since:until]
                row, own = np.repeat(np.arange(len(q)), order.shape[1]), order.ravel()
                most = bound[row, own]
                reached = most + np.abs(most) * SLACK + SLACK >= batch.column("floor").to_numpy()[row]
                row, cell, block = with_blocks(row[reached], cells[own[reached]], many[own[reached]])
                new = (cell != cells[home][row]) | (block != home_block[row])
                yield from dealt(batch, row[new], cell[new], block[new])

    def build(table):
        return BallTree(table.column("vec_id").to_numpy(), rows_of(table.column("v")))

    def answer(tree, table):
        out = []
        for i, q, floor in zip(table.column("vec_id").to_pylist(), rows_of(table.column("v")), table.column("floor").to_pylist()):
            out += [(i, m, s) for s, m in tree.search(i, q, floor, k)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))], names=["query_id", "vec_id", "score"])

    def searched(asked: DataFrame) -> DataFrame:
        rows = members.unionByName(asked.withColumn("kind", F.lit(1)))
        dealt = rows.repartition(min(MAX_PARTS, max(1, sum(blocks.values()))), "cell", "block").sortWithinPartitions("cell", "block", "kind")
        return dealt.mapInArrow(lambda b: by_unit(b, build, answer), "query_id bigint, vec_id bigint, score bigint")

    floors, found, since = queries.select("vec_id", "v", F.lit(float("-inf")).alias("floor")), None, 0
    for until in (0, *(t for t in FIRST_ROUNDS if t < len(cells)), len(cells)):
        more = searched(floors.mapInArrow(lambda b, since=since, until=until: visits(b, since, until), layout))
        found = materialize(best(more if found is None else found.drop("rank").unionByName(more), k), "found")
        least = found.where(F.col("rank") == k).select(F.col("query_id").alias("_q"), F.col("score").cast("double").alias("_least"))
        # As a double the score may have been rounded up.
        floors = queries.join(least, F.col("vec_id") == F.col("_q"), "left").select(
            "vec_id", "v", F.coalesce(F.col("_least") - F.abs("_least") * 2.0**-52, F.lit(float("-inf"))).alias("floor"))
        since = until
    return found


#: Cells by falling bound that a query may have visited after the first rounds; the last round visits the rest.
FIRST_ROUNDS = (8,)
#: Tasks of a search at most; a task searches several shards one after the other.
MAX_PARTS = 20000


def op9_ball_tree(spark, sf_dir: str) -> DataFrame:
    vectors = materialize(whole_numbers(usable(read(spark, sf_dir, "embeddings"), zero=True)), "vectors")
    return by_length(vectors, materialize(queries_of(vectors, EVERY), "queries"), search)


OP9_SQL = """
WITH fine AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM fine),
pairs AS (
  SELECT q.vec_id AS query_id, w.vec_id, list_dot_product(q.v, w.v)::BIGINT AS score
  FROM (SELECT vec_id, min(v) AS v FROM whole WHERE vec_id % 50 = 0 GROUP BY vec_id) q JOIN whole w ON q.vec_id <> w.vec_id AND len(q.v) = len(w.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
