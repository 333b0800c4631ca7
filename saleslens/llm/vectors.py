"""Vectors in cells: what the two vector searches share."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_key, materialize

#: The cells are fitted on at most so many vectors, and bytes of them (the smallest hashes of their ids).  Their number
#: follows the rows, then the root of the rows; there are at most MAX_CELLS.
SAMPLE, SAMPLE_BYTES, MAX_CELLS, ROUNDS, SEED = 16384, 64 << 20, 2048, 8, 13
#: A unit of work (a cell or a block of one) grows with the table up to so many bytes of vectors.
UNITS, UNIT_BYTES = 2048, 64 << 20
#: Queries that are dealt to units at once, and bytes of query rows per batch.
DEAL_QUERIES, DEAL_BYTES = 256, 8 << 20


def usable(vectors: DataFrame, zero: bool) -> DataFrame:
    """(vec_id, v): vectors with a key and of finite components only; zero vectors if ``zero``."""
    v = F.col("embedding")
    fine = v.isNotNull() & (F.size(v) > 0) & F.col("vec_id").isNotNull() & F.forall(
        v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    if not zero:
        fine = fine & F.exists(v, lambda x: x != 0)
    return vectors.where(fine).select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))


def queries_of(vectors: DataFrame, every: int) -> DataFrame:
    """The vectors whose id ``every`` divides; of rows that repeat an id the smallest vector."""
    return vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))


def by_length(vectors: DataFrame, queries: DataFrame, search: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """``search`` for each length of the queries' vectors by itself: an inner product needs equal lengths.

    The lengths come to the driver; each is a search of its own, and tables have few.
    """
    size = F.size("v")
    lengths = sorted(r["n"] for r in queries.select(size.alias("n")).distinct().collect())
    if len(lengths) < 2:
        return search(vectors.where(size == lengths[0]) if lengths else vectors.limit(0), queries)
    return reduce(DataFrame.unionByName, [search(vectors.where(size == n), queries.where(size == n)) for n in lengths])


def rows_of(column) -> np.ndarray:
    """A list column as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def fit_cells(vectors: DataFrame, n: int, per_cell: int) -> tuple[np.ndarray, np.ndarray]:
    """Centres by k-means on the bounded sample, and the sample."""
    size = vectors.select(F.size("v").alias("d")).first()["d"]
    limit = min(SAMPLE, max(1, SAMPLE_BYTES // (8 * size)))
    # Rows that repeat an id and its vector count as often.
    sample = vectors.select("vec_id", "v", hash_key(F.lit(SEED), F.col("vec_id")).alias("_k")).orderBy("_k", "vec_id", "v").limit(limit)
    x = rows_of(sample.select("v").toArrow().column("v"))
    k = min(MAX_CELLS, max(1, math.ceil(n / per_cell)), math.ceil(math.sqrt(n)), len(x))
    rng = np.random.default_rng(SEED)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        own = nearest(x, centres)
        count = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return centres, x


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * (x @ centres.T), axis=1)


def in_cells(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """(vec_id, v, cell, norm, apart): written; ``apart`` is the distance to the cell's centre."""
    kind = vectors.schema["v"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = rows_of(batch.column(1))
            own = nearest(x, centres) if len(x) else np.empty(0, np.int64)
            apart = np.sqrt(((x - centres[own]) ** 2).sum(axis=1)) if len(x) else np.empty(0)
            norm = np.sqrt((x**2).sum(axis=1)) if len(x) else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(own, pa.int32()), pa.array(norm), pa.array(apart)],
                names=["vec_id", "v", "cell", "norm", "apart"])

    return materialize(vectors.mapInArrow(run, f"vec_id bigint, v {kind}, cell int, norm double, apart double"), "cells")


def cell_stats(placed: DataFrame) -> dict[int, tuple[int, float, float, float]]:
    """Rows, radius, mean squared distance and largest norm by cell; at most ``MAX_CELLS`` rows come to the driver."""
    return {r[0]: tuple(r[1:]) for r in placed.groupBy("cell").agg(
        F.count(F.lit(1)), F.max("apart"), F.avg(F.col("apart") ** 2), F.max("norm")).collect()}


def unit_rows(n: int, d: int, least: int) -> int:
    """Rows of a unit: ``least``, or more in large tables, so that a query meets fewer units, up to UNIT_BYTES."""
    return max(least, min(math.ceil(n / UNITS), UNIT_BYTES // (8 * d)))


def with_blocks(row: np.ndarray, cell: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, block): each pair repeated for all ``many`` blocks of its cell."""
    row, cell = np.repeat(row, many), np.repeat(cell, many)
    return row, cell, np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)


def dealt(batch: pa.RecordBatch, row: np.ndarray, cell: np.ndarray, block: np.ndarray):
    """Batches (vec_id, v, cell, block, floor) of the queries ``row``, of bounded size."""
    width = batch.column(1).type.value_type.bit_width // 8 * max(1, len(batch.column(1)[0]) if batch.num_rows else 1)
    step = max(1, DEAL_BYTES // width)
    for i in range(0, len(row), step):
        take = pa.array(row[i:i + step])
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(take), batch.column("v").take(take), pa.array(cell[i:i + step], pa.int32()),
             pa.array(block[i:i + step], pa.int32()), batch.column("floor").take(take)], names=["vec_id", "v", "cell", "block", "floor"])


def block_of(vec_id: Column, blocks: dict[int, int]) -> Column:
    """A random block of the row's cell, so that a crowded cell is many units of work."""
    many = F.element_at(F.create_map(*[F.lit(x) for kv in (blocks or {0: 1}).items() for x in kv]), F.col("cell"))
    return F.pmod(F.xxhash64(vec_id), many).cast("int")


def by_unit(batches, build: Callable, answer: Callable):
    """Streams rows sorted by (cell, block, kind): members (0) are gathered, queries (1) answered as they come.

    ``build(table)`` makes what ``answer(built, table)`` searches; a unit without members is skipped.
    """
    key, members, built = None, [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        cols = [table.column(c).to_numpy() for c in ("cell", "block", "kind")]
        change = np.zeros(len(cols[0]), bool)
        if len(change):
            change[0] = True
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        edges = [*np.flatnonzero(change).tolist(), len(change)]
        for a, b in zip(edges[:-1], edges[1:]):
            own = (int(cols[0][a]), int(cols[1][a]))
            if own != key:
                key, members, built = own, [], None
            part = table.slice(a, b - a)
            if cols[2][a] == 0:
                members.append(part)
            elif members or built is not None:
                if built is None:
                    built, members = build(pa.concat_tables(members)), []
                yield from answer(built, part)


def best(found: DataFrame, k: int) -> DataFrame:
    """Each query's k highest scores, ties to the smaller vec_id."""
    from pyspark.sql import Window as W

    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
