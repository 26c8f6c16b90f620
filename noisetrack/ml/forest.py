"""A random forest of deep trees, all folds in one shuffle.

MLlib adds up dense histograms of all nodes of a level, in every partition; at depth 14 these are far larger than the rows.
Here rows are binned once, and rows of equal bins (a vector) and fold are alike to every tree.  Where its rows are, how often a
tree draws them and the levels drawn are added up for each vector and fold; these sums go to ``groups`` tasks, which grow some
of the trees each, for every left-out fold, and send back one sum of predictions a vector.  Rows go through one shuffle and no
task holds more than some ``ROWS_A_TASK`` of them; a growing task holds some 30 bytes a vector and fold, and the sums of one tree.  Trees
never leave their task.  What is drawn for a tree depends on the row's id, the tree and nothing else, so results do not depend
on where rows are.  Tables beyond ``MOST_ROWS``, whose vectors could be as many, are MLlib's (see ``regression``), which gathers nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noisetrack.ml.boosting import bytes_of, cut_points, runs, vectors, with_bins
from noisetrack.session import materialised

MOST_ROWS, ROWS_A_TASK = 10_000_000, 200_000


@dataclass(frozen=True)
class Forest:
    """trees of variance splits on ``bins`` quantiles; least: drawn rows of a leaf; of: the share of features that a node looks
    at; groups: tasks that grow the trees."""

    trees: int
    depth: int
    least: int = 1
    of: float = 1 / 3
    bins: int = 32
    seed: int = 42
    groups: int = 50

    def mllib(self, target: str) -> RandomForestRegressor:
        return RandomForestRegressor(numTrees=self.trees, maxDepth=self.depth, minInstancesPerNode=self.least, featureSubsetStrategy=str(self.of), maxBins=self.bins, seed=self.seed, featuresCol="features", labelCol=target)


@dataclass
class Tree:
    """Nodes level by level: the right child is ``child`` + 1; a leaf is its own left child and sends all rows there."""

    feature: np.ndarray
    bin: np.ndarray
    child: np.ndarray
    value: np.ndarray
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            node = self.child[node] + (x[rows, self.feature[node]] > self.bin[node])
        return self.value[node]


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


def times_drawn(uid: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a row is in a tree's bootstrap sample: a Poisson number of mean 1, from a hash of the row and the tree."""
    with np.errstate(over="ignore"):
        h = uid.astype(np.uint64) ^ ((np.uint64(tree + 1) + (np.uint64(seed) << np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
    return np.searchsorted(_POISSON, (h >> np.uint64(11)).astype(float) * 2.0**-53, "right").astype(float)


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, spec: Forest, rng: np.random.Generator) -> Tree:
    """x: bins; w: how often each row counts."""
    return grow_sums(x, w, w * y, spec, rng)


def grow_sums(x: np.ndarray, w: np.ndarray, wy: np.ndarray, spec: Forest, rng: np.random.Generator) -> Tree:
    """x: vectors of bins; w: how often rows of a vector are drawn, all in all; wy: the sum of the levels drawn."""
    some = min(x.shape[1], max(1, math.ceil(spec.of * x.shape[1] - 1e-9)))
    rows = np.flatnonzero(w)
    w = w[rows]
    mean = wy[rows].sum() / max(1.0, w.sum())
    wy = wy[rows] - w * mean
    slot, count, first, levels = np.zeros(len(rows), np.int64), 1, 0, []
    for level in range(spec.depth + 1):
        n, g = np.bincount(slot, w, count), np.bincount(slot, wy, count)
        feature, cut, child = np.zeros(count, np.int64), np.full(count, 255, np.int64), first + np.arange(count)
        levels.append((feature, cut, child, mean + np.divide(g, n, out=np.zeros(count), where=n > 0)))
        opened = np.flatnonzero(n >= 2 * spec.least) if level < spec.depth else ()
        if not len(opened):
            break
        place = np.full(count, -1)
        place[opened] = np.arange(len(opened))
        slot = place[slot]
        kept = slot >= 0
        rows, w, wy, slot, n, g = rows[kept], w[kept], wy[kept], slot[kept], n[opened], g[opened]
        looked = np.argsort(rng.random((len(opened), x.shape[1])), axis=1)[:, :some]
        best, f, b, at = np.full(len(opened), -np.inf), np.zeros(len(opened), np.int64), np.zeros(len(opened), np.int64), np.arange(len(opened))
        for j in range(some):
            key = slot * spec.bins + x[rows, looked[slot, j]]
            left = np.bincount(key, w, len(opened) * spec.bins).reshape(-1, spec.bins).cumsum(axis=1)[:, :-1]
            left_g = np.bincount(key, wy, len(opened) * spec.bins).reshape(-1, spec.bins).cumsum(axis=1)[:, :-1]
            right = n[:, None] - left
            worth = np.where((left >= spec.least) & (right >= spec.least), left_g**2 / np.maximum(left, 1) + (g[:, None] - left_g) ** 2 / np.maximum(right, 1), -np.inf)
            top = worth.argmax(axis=1)
            better = worth[at, top] > best
            best, f, b = np.where(better, worth[at, top], best), np.where(better, looked[:, j], f), np.where(better, top, b)
        split = best - g**2 / n > 1e-9
        if not split.any():
            break
        below = np.where(split, 2 * (np.cumsum(split) - 1), -1)
        parents = opened[split]
        feature[parents], cut[parents], child[parents] = f[split], b[split], first + count + below[split]
        right = x[rows, f[slot]] > b[slot]
        kept = split[slot]
        rows, w, wy, slot = rows[kept], w[kept], wy[kept], (below[slot] + right)[kept]
        first, count = first + count, 2 * int(split.sum())
    return Tree(*map(np.concatenate, zip(*levels, strict=True)), len(levels) - 1)


def draw_sums(part: int, batches: Iterator[pa.RecordBatch], spec: Forest, width: int, groups: int) -> Iterator[pa.RecordBatch]:
    """For each group of trees the vectors and folds of a part (as tree -1), then for each of its trees how often and with what
    sum of levels their rows are drawn.  batches: b, fold, y and uid in order of b and fold."""
    x, at, (fold, y, uid) = vectors(batches, width, "fold", "y", "uid")
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (fold[1:] != fold[:-1])])
    x, folds = x[at[new]], fold[new].astype(np.int16)
    entry = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(at)]))
    learned = fold >= 0
    record = lambda group, tree, *columns: pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([tree], pa.int32()), pa.array([part], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)], ["group", "tree", "part", "first", "second"])
    for group in range(groups):
        yield record(group, -1, x, folds)
    for tree in range(spec.trees):
        w = np.where(learned, times_drawn(uid, tree, spec.seed), 0.0)
        yield record(tree % groups, tree, np.bincount(entry, w, len(new)).astype(np.int32), np.bincount(entry, w * y, len(new)))


def some_trees(batches: Iterator[pa.RecordBatch], spec: Forest, width: int, folds: int, whole: bool) -> pa.RecordBatch:
    """Sums of a group's predictions: a row a vector, with a column for each fold (zero where the vector has no row in it) and one
    for the fit on all rows.  batches: ``draw_sums`` in order of tree and part."""
    joined = lambda records, name, kind: np.frombuffer(b"".join(bytes_of(r[name]).tobytes() for r in records), kind)
    for tree, records in runs(batches, "tree"):
        records = list(records)
        if tree < 0:
            known, at = np.unique(joined(records, "first", np.dtype((np.void, width))), return_inverse=True)
            x = known.view(np.uint8).reshape(len(known), width)
            fold = joined(records, "second", np.int16)
            order = np.lexsort((fold, at))  # sums do not depend on where parts were
            at, fold = at[order], fold[order]
            asked = [np.unique(at[fold == k]) for k in range(folds)]
            out = np.zeros((folds + 1, len(known)))
            continue
        w, wy = joined(records, "first", np.int32)[order], joined(records, "second", float)[order]
        for k, own in enumerate(asked):
            if len(own):
                others = fold != k
                sums = (np.bincount(at, np.where(others, c, 0.0), len(known)) for c in (w, wy))
                out[k, own] += grow_sums(x, *sums, spec, np.random.default_rng([spec.seed, tree, k])).predict(x[own])
        if whole:
            sums = (np.bincount(at, c, len(known)) for c in (w, wy))
            out[folds] += grow_sums(x, *sums, spec, np.random.default_rng([spec.seed, tree, folds])).predict(x)
    return pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in known], pa.binary()), *(pa.array(o) for o in out)], ["b", *(f"by_{k}" for k in range(folds + 1))])


def predictions(rows: DataFrame, spec: Forest, folds: int, key: str, whole: bool = False) -> DataFrame:
    """``key``, ``out_of_fold`` (by the fit that has not seen the row's fold) and, with ``whole``, ``by_all`` (by the fit on all rows).

    rows: key, x (array of double), y, fold (0 .. folds - 1; -1: never learned from, without ``out_of_fold``), uid."""
    cuts = cut_points(rows.where("fold >= 0"), spec.bins)
    width, groups = len(cuts), min(spec.groups, spec.trees)
    ready = materialised(with_bins(rows, cuts, key, "y", "fold", "uid"), "binned")
    size, heaviest = ready.groupBy("b").agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n")).first()
    parts, salts = -(-(size or 1) // ROWS_A_TASK), -(-(heaviest or 1) // ROWS_A_TASK)  # a vector with very many rows is dealt to several parts

    def draws(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in runs(it, "part"):
            yield from draw_sums(part, own, spec, width, groups)

    def trees(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in runs(it, "group"):
            yield some_trees(own, spec, width, folds, whole)

    dealt = ready.select("b", "y", "fold", "uid", F.pmod(F.xxhash64("b", F.pmod("uid", F.lit(salts))), F.lit(parts)).cast("int").alias("part"))
    drawn = dealt.repartitionById(parts, "part").sortWithinPartitions("part", "b", "fold", "uid").mapInArrow(draws, "group int, tree int, part int, first binary, second binary")
    sums = [f"by_{k}" for k in range(folds + 1)]
    grown = drawn.repartitionById(groups, "group").sortWithinPartitions("group", "tree", "part").mapInArrow(trees, ", ".join(["b binary", *(f"{c} double" for c in sums)]))
    found = grown.groupBy("b").agg(*[(F.sum(c) / spec.trees).alias(c) for c in sums])
    own = F.element_at(F.array(*sums[:-1]), F.greatest(F.col("fold"), F.lit(0)) + 1)
    return ready.select(key, "fold", "b").join(found, "b").select(key, own.alias("out_of_fold"), *([F.col(sums[-1]).alias("by_all")] if whole else ()))
