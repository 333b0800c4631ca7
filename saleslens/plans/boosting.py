"""Boosted trees over a panel: patience, the loss of every round, contributions.

Trees grow by sums over blocks of rows, for any number of fits in the same jobs.
A tree is a node table, a few arrays, and from there every pass over rows is one
Arrow pass: the score, the holdout loss after each round, and each feature's share
in a prediction.  Models of Spark ML are read into the same form.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import materialize, scratch_folder


@dataclass
class Tree:
    """Nodes of one tree: rows with ``x[feature] <= threshold`` go left; a leaf has left -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray  # the training weight that came by

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while True:
            inner = self.left[at] >= 0
            if not inner.any():
                return self.value[at]
            rows, nodes = np.flatnonzero(inner), at[inner]
            low = x[rows, self.feature[nodes]] <= self.threshold[nodes]  # unknown goes right
            at[rows] = np.where(low, self.left[nodes], self.right[nodes])

    def leaves(self) -> Iterator[tuple[float, dict[int, tuple[float, float, float]]]]:
        """(value, {feature: (low, high, share)}) of each leaf.

        A row passes the feature's splits if ``low < x <= high``; ``share`` of the
        training weight did at these splits.
        """
        todo = [(0, {})]
        while todo:
            node, path = todo.pop()
            if self.left[node] < 0:
                yield float(self.value[node]), path
                continue
            j, cut = int(self.feature[node]), float(self.threshold[node])
            low, high, share = path.get(j, (-math.inf, math.inf, 1.0))
            for child, bounds in ((self.left[node], (low, min(high, cut))), (self.right[node], (max(low, cut), high))):
                todo.append((int(child), {**path, j: (*bounds, share * self.cover[child] / self.cover[node])}))


class Ensemble:
    """Weighted trees over named features."""

    def __init__(self, features: list[str], trees: list[Tree], weights: np.ndarray):
        self.features, self.trees, self.weights = features, trees, weights

    def cut(self, rounds: int) -> Ensemble:
        return Ensemble(self.features, self.trees[:rounds], self.weights[:rounds])

    def score(self, x: np.ndarray) -> np.ndarray:
        return sum((w * t.score(x) for w, t in zip(self.weights, self.trees)), np.zeros(len(x)))

    def staged(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The score after each round."""
        total = np.zeros(len(x))
        for w, t in zip(self.weights, self.trees):
            total = total + w * t.score(x)
            yield total

    def contributions(self, x: np.ndarray) -> tuple[np.ndarray, float]:
        """(Shapley values by row and feature, base): they add up to the score minus the base.

        The value of a set of features is the expected score of a tree walk that
        follows these features of the row and splits by training weight at others.
        In a leaf this is a product over the features of its path, so the average
        over all orders of features follows from the coefficients of a product of
        linear terms, one per feature.
        """
        out, base = np.zeros((len(x), len(self.features))), 0.0
        for weight, tree in zip(self.weights, self.trees):
            for value, path in tree.leaves():
                own = list(path)
                shares = np.array([path[j][2] for j in own])
                base += weight * value * shares.prod()
                d = len(own)
                if not d or not weight * value:
                    continue
                passed = np.empty((d, len(x)))
                for k, j in enumerate(own):
                    low, high, _ = path[j]
                    # Unknown goes right: it passes where no upper bound is set.
                    v = np.where(np.isnan(x[:, j]), np.inf, x[:, j])
                    passed[k] = (v > low) & (v <= high)
                for k, j in enumerate(own):
                    terms = np.ones((1, len(x)))  # by the number of known features among the others
                    for o in range(d):
                        if o != k:
                            more = np.zeros((len(terms) + 1, len(x)))
                            more[:-1] += terms * shares[o]
                            more[1:] += terms * passed[o]
                            terms = more
                    orders = np.array([math.factorial(s) * math.factorial(d - 1 - s) / math.factorial(d) for s in range(d)])
                    out[:, j] += weight * value * (passed[k] - shares[k]) * (orders @ terms)
        return out, base


def ensemble_of(model, features: list[str], spark) -> Ensemble:
    """The node table of a fitted Spark ML model, read from its saved form."""
    path = scratch_folder(spark, "trees")
    model.write().save(path)
    # Bounded by rounds and depth, whatever the rows.
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), "nodeData.id", "nodeData.prediction", "nodeData.impurityStats", "nodeData.leftChild", "nodeData.rightChild",
        "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold").orderBy("tree", "id").toPandas()
    trees = []
    for _, t in nodes.groupby("tree", sort=True):
        inner = t["leftChild"].to_numpy() >= 0
        cuts = [float(c[0]) if i else 0.0 for c, i in zip(t["leftCategoriesOrThreshold"], inner)]
        trees.append(Tree(
            np.where(inner, t["featureIndex"].to_numpy(), 0), np.array(cuts), t["leftChild"].to_numpy(), t["rightChild"].to_numpy(),
            t["prediction"].to_numpy(), np.array([s[0] for s in t["impurityStats"]])))
    return Ensemble(features, trees, np.array(model.treeWeights))


@dataclass
class TreeModel:
    """Boosted trees with the columns they read, and the holdout loss of every round that was fitted."""

    ensemble: Ensemble
    losses: list[float]

    @property
    def features(self) -> list[str]:
        return self.ensemble.features

    def predict(self, df: DataFrame, name: str) -> DataFrame:
        ensemble = self.ensemble

        @F.pandas_udf("double")
        def score(x: pd.DataFrame) -> pd.Series:
            return pd.Series(ensemble.score(x.to_numpy(dtype=float)))

        return df.withColumn(name, score(F.struct(*[F.col(c).cast("double").alias(c) for c in self.features])))

    def contributions(self, df: DataFrame) -> DataFrame:
        """(prediction, base, parts) per row: ``parts`` has the contribution of each feature, in their order."""
        ensemble = self.ensemble

        def run(batches):
            for batch in batches:
                x = batch.to_pandas().to_numpy(dtype=float)
                parts, base = ensemble.contributions(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ensemble.score(x)), pa.array(np.full(len(x), base)), pa.array(list(parts), pa.list_(pa.float64()))],
                    names=["prediction", "base", "parts"])

        columns = df.select(*[F.col(c).cast("double").alias(c) for c in self.features])
        return columns.mapInArrow(run, "prediction double, base double, parts array<double>")

    def importance(self, sample: DataFrame, top: int = 10) -> DataFrame:
        """(rank, feature, importance): the mean absolute contribution over ``sample``, largest first."""
        parts = self.contributions(sample).select(F.posexplode("parts").alias("at", "part"))
        names = F.array(*[F.lit(c) for c in self.features])
        mean = parts.groupBy("at").agg(F.avg(F.abs("part")).alias("importance")).select(F.get(names, F.col("at")).alias("feature"), "importance")
        best = mean.orderBy(F.desc("importance"), "feature").limit(top)
        ranked = best.agg(F.sort_array(F.collect_list(F.struct((-F.col("importance")).alias("minus"), "feature"))).alias("own"))
        return ranked.select(F.posexplode("own").alias("at", "o")).select(
            (F.col("at") + 1).alias("rank"), F.col("o.feature").alias("feature"), (-F.col("o.minus")).alias("importance"))


def predict_by(df: DataFrame, fit: str, models: dict[int, TreeModel], name: str) -> DataFrame:
    """``TreeModel.predict`` with the model of each row's ``fit``, in one pass for all of them."""
    ensembles = {f: model.ensemble for f, model in models.items()}
    features = next(iter(ensembles.values())).features

    @F.pandas_udf("double")
    def score(fits: pd.Series, x: pd.DataFrame) -> pd.Series:
        rows, own = x.to_numpy(dtype=float), fits.to_numpy()
        out = np.empty(len(rows))
        for f in np.unique(own):
            out[own == f] = ensembles[int(f)].score(rows[own == f])
        return pd.Series(out)

    return df.withColumn(name, score(F.col(fit).cast("int"), F.struct(*[F.col(c).cast("double").alias(c) for c in features])))


def hashed_sample(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """``n`` rows that the seed picks by a hash of their keys; the same ones in every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(n)


def round_losses(ensemble: Ensemble, rows: DataFrame, target: str, weight: str | None) -> list[float]:
    """Mean squared error after each round, by one pass over the rows; empty without rows."""

    def run(batches):
        for batch in batches:
            t = batch.to_pandas()
            y, w = t["_target"].to_numpy(float), t["_weight"].to_numpy(float)
            x = t[ensemble.features].to_numpy(dtype=float)
            sums = [float((w * (y - p) ** 2).sum()) for p in ensemble.staged(x)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(sums)), pa.int32()), pa.array(sums, pa.float64()), pa.array([float(w.sum())] * len(sums))], names=["round", "error", "weight"])

    own = rows.select(
        *[F.col(c).cast("double").alias(c) for c in ensemble.features], F.col(target).cast("double").alias("_target"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_weight"))
    by_round = own.mapInArrow(run, "round int, error double, weight double").groupBy("round").agg(
        F.try_divide(F.sum("error"), F.sum("weight")).alias("loss")).orderBy("round").collect()  # one row per round
    return [r["loss"] for r in by_round if r["loss"] is not None]


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """(rounds to keep, whether training may stop): the best round before ``patience`` rounds bring nothing better."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


#: Rows of a block, which is one record of one task: there are more blocks, not larger ones, as the rows grow.
BLOCK_ROWS = 50_000
#: A feature is cut into so many bins at most, by distinct values if they are that few, else by weight.
BINS = 32
#: Points in the summary of a feature's values: exact for so many distinct values, else ranks are off by 1 / 4096 a merge.
SUMMARY = 4096
#: The scores' lineage is cut after so many rounds.
CHECKPOINT_ROUNDS = 10


@dataclass
class Block:
    """Rows of one fit; ``x`` has values first, then the numbers of their bins."""

    fit: int
    x: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    held: np.ndarray
    score: np.ndarray


@dataclass
class Growth:
    """A tree that grows level by level: the children of node i are 2 i + 1 and 2 i + 2; feature -1: no split."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @staticmethod
    def root(depth: int) -> Growth:
        n = 2 ** (depth + 1) - 1
        return Growth(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n), np.zeros(n))

    def split(self, node: int, found: Split) -> list[int]:
        """The new children; a row goes left if its bin is not above that of the split."""
        if not node:
            self.value[0], self.cover[0] = found.mean, found.weight
        if found.feature < 0:
            return []
        children = [2 * node + 1, 2 * node + 2]
        self.feature[node], self.bin[node] = found.feature, found.bin
        self.value[children], self.cover[children] = found.means, found.weights
        return children

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row has come to."""
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while len(rows):
            rows = rows[self.feature[at[rows]] >= 0]
            nodes = at[rows]
            at[rows] = 2 * nodes + 1 + (bins[rows, self.feature[nodes]] > self.bin[nodes])
        return at

    def tree(self, cuts: list[np.ndarray]) -> Tree:
        inner = self.feature >= 0
        left = np.where(inner, 2 * np.arange(len(inner)) + 1, -1)
        threshold = np.array([cuts[f][b] if i else 0.0 for f, b, i in zip(self.feature, self.bin, inner)])
        return Tree(np.where(inner, self.feature, 0), threshold, left, np.where(inner, left + 1, -1), self.value, self.cover)


@dataclass
class Split:
    """The best split of a node (feature -1: none), and the weight and mean of the node and of both sides."""

    weight: float
    mean: float
    feature: int = -1
    bin: int = 0
    weights: tuple[float, float] = (0.0, 0.0)
    means: tuple[float, float] = (0.0, 0.0)


def best_split(sums: np.ndarray) -> Split:
    """The split that lowers the variance most, from (weight, weighted label) by feature and bin; ties: the first."""
    weight, label = sums
    out = Split(float(weight[0].sum()), float(label[0].sum() / weight[0].sum()))
    # Both sides are added up from their own end, so that an empty one is exactly 0.
    low_w, low = weight.cumsum(axis=1)[:, :-1], label.cumsum(axis=1)[:, :-1]
    high_w, high = weight[:, ::-1].cumsum(axis=1)[:, -2::-1], label[:, ::-1].cumsum(axis=1)[:, -2::-1]
    valid = (low_w > 0) & (high_w > 0)
    low_m, high_m = (np.divide(a, b, out=np.zeros_like(a), where=valid) for a, b in ((low, low_w), (high, high_w)))
    gain = np.where(valid, low_w * high_w * (low_m - high_m) ** 2, -1.0)
    best = np.unravel_index(gain.argmax(), gain.shape)
    if gain[best] > 0 and abs(low_m[best] - high_m[best]) > 1e-12 * (abs(low_m[best]) + abs(high_m[best])):
        out.feature, out.bin = int(best[0]), int(best[1])
        out.weights = float(low_w[best]), float(high_w[best])
        out.means = float(low_m[best]), float(high_m[best])
    return out


def summary(value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, their weights); of more than ``SUMMARY`` values, steps of equal weight become one each."""
    distinct, at = np.unique(value, return_inverse=True)
    total = np.bincount(at, weight, len(distinct))
    if len(distinct) > SUMMARY:
        step = np.minimum((total.cumsum() * SUMMARY / total.sum()).astype(np.int64), SUMMARY - 1)
        last = np.flatnonzero(np.append(step[1:] != step[:-1], True))
        distinct, total = distinct[last], np.diff(total.cumsum()[last], prepend=0.0)
    return distinct, total


def cut_points(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Bounds between bins, as the library finds them: midway between values, at steps of about equal weight."""
    middle = values[:-1] + (values[1:] - values[:-1]) / 2
    middle = np.where((middle >= values[:-1]) & (middle < values[1:]), middle, values[:-1])
    if len(middle) < BINS:
        return middle
    step, below, keep = weights.sum() / BINS, weights.cumsum(), []
    goal = step
    for i in range(1, len(values)):
        if abs(below[i - 1] - goal) < abs(below[i] - goal):
            keep.append(i - 1)
            goal += step
    return middle[keep]


def blocks_of(rows: DataFrame, n_features: int):
    """(RDD of ``Block``, number of blocks by fit): every partition has rows of one fit, about ``BLOCK_ROWS`` at most.

    The rows have the columns _fit, features, _y, _weight, _eval.
    """
    wrong = F.isnan("_y") | (F.abs("_y") == math.inf) | F.coalesce(~F.col("_weight").between(0, sys.float_info.max), F.lit(True))
    sizes = rows.groupBy("_fit").agg(  # one row per fit
        F.count("*").alias("n"), F.count_if(wrong).alias("wrong"), F.sum(F.when(~F.col("_eval"), F.col("_weight"))).alias("weight")).collect()
    for r in sizes:
        if r["wrong"] or not r["weight"]:
            raise ValueError(f"{r['wrong']} rows with an impossible label or weight, weight of the training rows {r['weight']}")
    shares = {r["_fit"]: math.ceil(r["n"] / BLOCK_ROWS) for r in sorted(sizes, key=lambda r: r["_fit"])}
    if not shares:
        return rows.sparkSession.sparkContext.emptyRDD(), {}
    first = dict(zip(shares, np.cumsum([0, *shares.values()]).tolist()))
    share, start = (F.create_map(*[F.lit(v) for kv in d.items() for v in kv])[F.col("_fit")] for d in (shares, first))
    dealt = rows.repartitionById(sum(shares.values()), (start + F.pmod(F.monotonically_increasing_id(), share)).cast("int"))

    def pack(batches):
        own = [b for b in batches if b.num_rows]  # a block's rows
        if own:
            cols = [c.to_numpy() for c in pa.Table.from_batches(own).columns]
            y, weight, held = cols[n_features + 1:]
            block = Block(int(cols[0][0]), np.column_stack(cols[1:n_features + 1]), y, weight, held.astype(bool), np.zeros(len(y)))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], names=["block"])

    return dealt.mapInArrow(pack, "block binary").rdd.map(lambda r: pickle.loads(r["block"])), shares


def bin_bounds(blocks, n_features: int) -> dict[int, list[np.ndarray]]:
    """The bounds of the bins by fit and feature, from the training rows; unknown values are in the last bin."""

    def summaries(block: Block):
        for j in range(n_features):
            own = ~block.held & ~np.isnan(block.x[:, j])
            yield (block.fit, j), summary(block.x[own, j], block.weight[own])

    merged = blocks.flatMap(summaries).reduceByKey(lambda a, b: summary(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])))
    # At most BINS numbers per fit and feature, whatever the rows.
    found = dict(merged.mapValues(lambda s: cut_points(*s)).collect())
    return {fit: [found[fit, j] for j in range(n_features)] for fit in {fit for fit, _ in found}}


def level_sums(block: Block, tree: Growth, nodes: list[int], first: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(node, (weight, weighted label) by feature and bin) of the training rows in ``nodes``."""
    n = block.x.shape[1]
    number = np.full(len(tree.feature), -1)
    number[nodes] = np.arange(len(nodes))
    at = number[tree.place(block.x)]
    rows = np.flatnonzero((at >= 0) & ~block.held)
    label, weight = block.label[rows], block.weight[rows]
    if not first:
        label = 2 * (label - block.score[rows])  # the negative gradient of the squared error
    cell = ((at[rows, None] * n + np.arange(n)) * BINS + block.x[rows]).ravel()
    shape = len(nodes), n, BINS
    sums = np.stack([np.bincount(cell, np.repeat(v, n), math.prod(shape)).reshape(shape) for v in (weight, weight * label)], axis=1)
    for k in np.flatnonzero(np.bincount(at[rows], minlength=len(nodes))):
        yield nodes[k], sums[k]


def scored(block: Block, tree: Growth, weight: float) -> Block:
    return replace(block, score=block.score + weight * tree.value[tree.place(block.x)])


def held_error(block: Block) -> np.ndarray:
    """(weighted squared error, weight) of the holdout rows."""
    weight = block.weight[block.held]
    return np.array([(weight * (block.label - block.score)[block.held] ** 2).sum(), weight.sum()])


def grow_alone(block: Block, rounds: int, depth: int, step: float, patience: int) -> tuple[int, list[Growth], list[float]]:
    """(fit, trees, holdout losses) of a fit that is one block: its sums have nothing to meet."""
    grown, losses = [], []
    for r in range(rounds):
        tree, nodes = Growth.root(depth), [0]
        for _ in range(depth):
            found = {node: best_split(sums) for node, sums in level_sums(block, tree, nodes, not r)} if nodes else {}
            nodes = [c for node in nodes for c in tree.split(node, found[node])]
        grown.append(tree)
        block = scored(block, tree, step if r else 1.0)
        error, total = held_error(block)
        if total:
            losses.append(float(error / total))
            if best_round(losses, patience)[1]:
                break
    return block.fit, grown, losses


def grow_spread(blocks, fits: set[int], rounds: int, depth: int, step: float, patience: int) -> list[tuple[int, list[Growth], list[float]]]:
    """``grow_alone`` for fits of several blocks, side by side: one job per level, in which sums meet by fit and node.

    Only the best split of each node comes back.  The first job of a round also
    gives the holdout errors after the round before.
    """
    sc = blocks.context
    grown, losses = {f: [] for f in fits}, {f: [] for f in fits}
    state, before = blocks, None

    def job(level: int, trees: dict[int, Growth], nodes: dict[int, list[int]], first: bool) -> dict:
        def sums(block: Block):
            if block.fit in nodes:
                for node, own in level_sums(block, trees[block.fit], nodes[block.fit], first):
                    yield (block.fit, node), own
            if not level and not first:
                yield (block.fit, -1), held_error(block)

        tasks = min(sc.defaultParallelism, math.ceil(sum(len(own) for own in nodes.values()) / 16) or 1)
        met = state.flatMap(sums).reduceByKey(np.add, tasks)
        return dict(met.map(lambda kv: (kv[0], best_split(kv[1]) if kv[0][1] >= 0 else kv[1])).collect())

    for r in range(rounds + 1):
        state.persist(StorageLevel.MEMORY_AND_DISK)
        if r % CHECKPOINT_ROUNDS == 0:
            state.checkpoint()
        trees = {f: Growth.root(depth) for f in fits}
        nodes = {f: [0] for f in fits} if r < rounds else {}
        found = job(0, trees, nodes, not r)
        if before is not None:
            before.unpersist()
        for f in sorted(fits):
            error, total = found.get((f, -1), (0.0, 0.0))
            if total:
                losses[f].append(float(error / total))
                if best_round(losses[f], patience)[1]:
                    fits = fits - {f}
        if r == rounds or not fits:
            break
        trees, nodes = {f: trees[f] for f in fits}, {f: nodes[f] for f in fits}
        for level in range(depth):
            if level and nodes:
                found = job(level, trees, nodes, not r)
            nodes = {f: [c for node in own for c in trees[f].split(node, found[f, node])] for f, own in nodes.items()}
            nodes = {f: own for f, own in nodes.items() if own}
        for f, tree in trees.items():
            grown[f].append(tree)
        # Blocks of fits that have ended go.
        state, before = state.flatMap(lambda b, trees=trees, w=step if r else 1.0: [scored(b, trees[b.fit], w)] if b.fit in trees else []), state
    state.unpersist()
    return [(f, grown[f], losses[f]) for f in grown]


def fit_trees_by(
    df: DataFrame, fit: str, features: list[str], target: str, is_eval: Column | None = None, weight: str | None = None,
    rounds: int = 20, depth: int = 4, step: float = 0.1, patience: int = 50,
) -> dict[int, TreeModel]:
    """``fit_trees`` for each value of the integer column ``fit``, all of them side by side.

    Rows are dealt to blocks by fit.  A fit of one block grows in its task; those of
    more grow together, one job per level.  Trees are those of Spark ML's
    ``GBTRegressor``, which would take some six jobs per round of each fit by itself
    and cannot go on with a fit; the bounds of the bins come from all rows.
    """
    n = len(features)
    flag = F.coalesce(is_eval if is_eval is not None else F.lit(False), F.lit(False)).alias("_eval")
    rows = materialize(df.where(F.col(target).isNotNull()).select(
        F.col(fit).cast("int").alias("_fit"), *[F.col(c).cast("double").alias(f"_x{j}") for j, c in enumerate(features)],
        F.col(target).cast("double").alias("_y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_weight"), flag), "tree-input")
    spark = rows.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_folder(spark, "tree-scores"))
    raw, shares = blocks_of(rows, n)
    raw.persist(StorageLevel.MEMORY_AND_DISK)
    cuts = bin_bounds(raw, n)

    def binned(block: Block) -> Block:
        # One bin more than bounds; unknown values come last.
        return replace(block, x=np.column_stack([np.searchsorted(c, block.x[:, j], "left") for j, c in enumerate(cuts[block.fit])]).astype(np.uint8))

    alone = {f for f, share in shares.items() if share == 1}
    options = {"rounds": rounds, "depth": depth, "step": step, "patience": patience}
    # Bounded by rounds and depth, whatever the rows.
    fitted = raw.filter(lambda b: b.fit in alone).map(lambda b: grow_alone(binned(b), **options)).collect()
    if len(alone) < len(shares):
        fitted += grow_spread(raw.filter(lambda b: b.fit not in alone).map(binned), set(shares) - alone, **options)
    raw.unpersist()
    weights = np.where(np.arange(rounds) == 0, 1.0, step)
    models = {}
    for f, grown, losses in fitted:
        ensemble = Ensemble(features, [tree.tree(cuts[f]) for tree in grown], weights[:len(grown)])
        models[f] = TreeModel(ensemble.cut(best_round(losses, patience)[0]) if losses else ensemble, losses)
    return models


def fit_trees(
    df: DataFrame, features: list[str], target: str, is_eval: Column | None = None, weight: str | None = None,
    rounds: int = 20, depth: int = 4, step: float = 0.1, patience: int = 50,
) -> TreeModel:
    """Gradient boosted trees; with ``is_eval`` rows, those rounds stay that lead to their smallest error.

    Training ends when ``patience`` rounds in a row bring nothing better.
    """
    models = fit_trees_by(df.withColumn("_one", F.lit(0)), "_one", features, target, is_eval, weight, rounds, depth, step, patience)
    if not models:
        raise ValueError(f"no rows with {target} to fit trees on")
    return models[0]
