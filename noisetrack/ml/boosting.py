"""Gradient boosting on histograms, all folds and all candidates in the same jobs.

Features are binned once, and rows of equal bins (a vector) are alike to every tree, so sums over rows are sums over vectors
of their number and levels.  Up to ``MOST_ROWS`` rows each fit (candidate and left-out fold) is a task that runs all its rounds: rows
come in order of their vectors, a task holds the vectors with two numbers each and, where rounds look at a share of the rows,
16 bytes a row to draw them.

Beyond, no task may hold them: a job handles one level of the trees that are growing.  Each task adds up, for each fit,
open node, feature and bin, the residuals and the number of its rows, and only these sums, whose size
depends on the parameters and not on the rows, come back.  The driver picks the splits.  So the number of jobs is that of
the levels of the longest candidate, not the sum over all fits.

A task then needs the residuals of its rows.  Its Python worker keeps them and brings them up to date by the trees that it has not
seen; a worker that has not seen the partition replays all trees from its rows, which gives the same numbers.  Rows are
deserialised blocks that Spark holds in memory or on disk and reads again where they are lost; trees are broadcast some
rounds at a time.  Nothing but time is lost with an executor.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial, reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noisetrack.session import materialised

ROUNDS_A_BROADCAST, FANIN, WORKER_PARTITIONS = 10, 16, 8
MOST_ROWS, ROWS_AT_ONCE, PACKED = 10_000_000, 65_536, 1_024


@dataclass(frozen=True)
class Boosting:
    """Squared loss from the mean on.  least: rows of a leaf; share: of the rows that a round looks at; l2: added to the
    number of rows of a leaf."""

    rounds: int
    depth: int
    step: float
    least: int = 1
    share: float = 1.0
    l2: float = 0.0


@dataclass
class Tree:
    """A round's trees, one a fit: feature and bin of inner nodes in level order (a row goes right if its bin is greater),
    and the values of the leaves.  A node that isn't split sends all rows left."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray | None = None

    def descend(self, x: np.ndarray, fit: int, node: np.ndarray, levels: int) -> np.ndarray:
        rows = np.arange(len(x))
        for _ in range(levels):
            node = 2 * node + 1 + (x[rows, self.feature[fit, node]] > self.bin[fit, node])
        return node


@dataclass
class Model:
    """Of one candidate: its start and trees by fit, the last fit being that of all rows."""

    start: np.ndarray
    trees: list[Tree] = field(default_factory=list)
    depth: int = 0

    def predict(self, x: np.ndarray, fit: np.ndarray) -> np.ndarray:
        """x: bins; fit: the fit that each row is predicted by."""
        out = self.start[fit]
        for k in np.unique(fit):
            own = np.flatnonzero(fit == k)
            for t in self.trees:
                out[own] += t.value[k][t.descend(x[own], k, np.zeros(len(own), np.int64), self.depth) - (2**self.depth - 1)]
        return out


def drawn(uid: np.ndarray, round_: int, share: float) -> np.ndarray:
    """Whether a round looks at a row: a hash of the row and the round."""
    if share >= 1:
        return np.ones(len(uid), bool)
    with np.errstate(over="ignore"):
        h = uid.astype(np.uint64) ^ (np.uint64(round_ + 1) * np.uint64(0x9E3779B97F4A7C15))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h >> np.uint64(11)).astype(float) * 2.0**-53 < share


def cut_points(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """At most ``bins`` - 1 thresholds for each entry of the array column ``x``: quantiles with a rank error of a
    ten-thousandth, in one pass."""
    width = len(rows.select("x").first()["x"])
    at = [k / bins for k in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col("x")[k], at, 10_000).alias(f"q{k}") for k in range(width)]).first()
    return [np.unique(np.array(found[f"q{k}"] or [], float)) for k in range(width)]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], axis=1).astype(np.uint8) if len(x) else np.zeros((0, len(cuts)), np.uint8)


def with_bins(rows: DataFrame, cuts: list[np.ndarray], *keep: str) -> DataFrame:
    """The ``keep`` columns and ``b``, the bins of ``x``, a byte each."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = binned(batch["x"].flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(cuts)), cuts)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array([r.tobytes() for r in x], pa.binary())], [*keep, "b"])

    kinds = dict(rows.dtypes)
    return rows.select(*keep, "x").mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "b binary"]))


def bytes_of(column: pa.Array) -> np.ndarray:
    """The bytes of all values of a binary column, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8)


def runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Batches in order of a column, by its values."""

    def parts() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            values = batch[column].to_numpy()
            edges = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else [0]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield int(values[a]), batch.slice(a, b - a)

    for value, own in groupby(parts(), lambda p: p[0]):
        yield value, (part for _, part in own)


def vectors(batches: Iterator[pa.RecordBatch], width: int, *columns: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of rows in order of ``b``: the vectors that differ, the number of each row's, and columns."""
    x, at, rest, last, n = [], [], [[] for _ in columns], None, 0
    for batch in batches:
        b = bytes_of(batch["b"]).reshape(batch.num_rows, width)
        before = np.vstack([b[:1] if last is None else last, b[:-1]])
        new = (b != before).any(axis=1)
        new[0] |= last is None
        x.append(b[new])
        at.append((n - 1 + np.cumsum(new)).astype(np.int32))
        n, last = n + int(new.sum()), b[-1:].copy()
        for c, values in zip(columns, rest, strict=True):
            values.append(batch[c].to_numpy())
    return np.concatenate(x), np.concatenate(at), [np.concatenate(v) for v in rest]


class Packed:
    """Vectors with several features in one number, so that a histogram goes over fewer of them: the cells of a number are added
    up to the bins of each feature."""

    def __init__(self, x: np.ndarray, bins: int) -> None:
        self.width, self.bins, self.packs = x.shape[1], bins, []
        used = [np.unique(x[:, f], return_inverse=True) for f in range(self.width)]
        left = sorted(range(self.width), key=lambda f: len(used[f][0]))
        while left:
            some, cells = [], 1
            for f in left:
                if not some or cells * len(used[f][0]) <= PACKED:
                    some, cells = [*some, f], cells * len(used[f][0])
            left = [f for f in left if f not in some]
            code = np.zeros(len(x), np.int32)
            for f in some:
                code = code * len(used[f][0]) + used[f][1].astype(np.int32)
            self.packs.append((some, [used[f][0] for f in some], code))

    def histograms(self, slot: np.ndarray, g: np.ndarray, n: np.ndarray, n_slots: int) -> np.ndarray:
        """(2, slots, features, bins): sums of ``g`` and ``n``; vectors whose slot is negative are left out."""
        out = np.zeros((2, n_slots, self.width, self.bins))
        own = np.flatnonzero(slot >= 0)
        every = len(own) == len(slot)
        slot, weights = (slot, (g, n)) if every else (slot[own], (g[own], n[own]))
        for some, values, code in self.packs:
            sizes = [len(v) for v in values]
            cells = int(np.prod(sizes))
            key = slot * cells + (code if every else code[own])
            for k, weight in enumerate(weights):
                found = np.bincount(key, weight, n_slots * cells).reshape(n_slots, *sizes)
                for j, f in enumerate(some):
                    out[k][:, f, values[j]] = found.sum(axis=tuple(a + 1 for a in range(len(some)) if a != j))
        return out


@dataclass
class Block:
    x: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    uid: np.ndarray


class Running:
    """What a worker knows of one partition: by candidate the predictions of each fit, the rounds that they hold, and the
    nodes of the rows in the growing trees."""

    def __init__(self, block: Block, starts: list[np.ndarray]) -> None:
        self.block = block
        self.predicted = [np.repeat(s[:, None], len(block.y), axis=1) for s in starts]
        self.done = [0] * len(starts)
        self.node = [np.zeros((len(s), len(block.y)), np.int64) for s in starts]
        self.level = [0] * len(starts)

    def add(self, spec: int, tree: Tree, depth: int) -> None:
        """A finished round."""
        for k in range(len(self.node[spec])):
            node = tree.descend(self.block.x, k, self.node[spec][k], depth - self.level[spec])
            self.predicted[spec][k] += tree.value[k][node - (2**depth - 1)]
        self.node[spec][:] = 0
        self.level[spec] = 0
        self.done[spec] += 1

    def go_down(self, spec: int, tree: Tree, level: int) -> None:
        for k in range(len(self.node[spec])):
            self.node[spec][k] = tree.descend(self.block.x, k, self.node[spec][k], level - self.level[spec])
        self.level[spec] = level


_HELD: OrderedDict[tuple[str, int], Running] = OrderedDict()


def histograms(running: Running, spec: int, round_: int, share: float, level: int, slot: np.ndarray, bins: int) -> np.ndarray:
    """(2, slots, features, bins): sums of residuals and rows.  slot: by fit and node of the level, the place of an open node
    in the result, or -1."""
    b = running.block
    n_slots, width = int(slot.max()) + 1, b.x.shape[1]
    out = np.zeros((2, n_slots * width * bins))
    use = drawn(b.uid, round_, share)
    columns = np.arange(width)[None, :] * bins + b.x
    for k in range(len(slot)):
        at = slot[k][running.node[spec][k] - (2**level - 1)]
        rows = np.flatnonzero(use & (b.fold != k) & (at >= 0))
        if len(rows):
            key = (at[rows, None] * (width * bins) + columns[rows]).ravel()
            out[0] += np.bincount(key, np.repeat(b.y[rows] - running.predicted[spec][k][rows], width), out.shape[1])
            out[1] += np.bincount(key, minlength=out.shape[1])
    return out.reshape(2, n_slots, width, bins)


def best_splits(hist: np.ndarray, spec: Boosting) -> tuple[np.ndarray, ...]:
    """For each slot: whether it is split, feature, bin, and residuals and rows on the left and in all."""
    g, n = hist
    total_g, total_n = g[:, 0].sum(axis=1), n[:, 0].sum(axis=1)
    left_g, left_n = g.cumsum(axis=2)[:, :, :-1], n.cumsum(axis=2)[:, :, :-1]
    right_g, right_n = total_g[:, None, None] - left_g, total_n[:, None, None] - left_n
    worth = left_g**2 / np.maximum(left_n + spec.l2, 1e-12) + right_g**2 / np.maximum(right_n + spec.l2, 1e-12)
    worth = np.where((left_n >= spec.least) & (right_n >= spec.least) & (left_n > 0) & (right_n > 0), worth, -1.0)
    flat = worth.reshape(len(worth), -1)
    at = flat.argmax(axis=1)
    rows = np.arange(len(flat))
    gain = flat[rows, at] - total_g**2 / np.maximum(total_n + spec.l2, 1e-12)
    feature, bin_ = np.divmod(at, worth.shape[2])
    return gain > 1e-9 * (1 + total_g**2), feature, bin_, left_g[rows, feature, bin_], left_n[rows, feature, bin_], total_g, total_n


class Growing:
    """The driver's side of one candidate: the tree that grows, level by level."""

    def __init__(self, spec: Boosting, start: np.ndarray, bins: int) -> None:
        self.spec, self.model, self.fits, self.bins = spec, Model(start, [], spec.depth), len(start), bins
        self.begin()

    def begin(self) -> None:
        inner, d = 2**self.spec.depth - 1, self.fits
        self.tree = Tree(np.zeros((d, inner), np.int16), np.full((d, inner), self.bins, np.int16))
        self.level = 0
        self.slot = np.arange(d)[:, None]
        self.open = np.ones((d, 1), bool)
        self.sums = np.zeros((2, d, 1))

    @property
    def over(self) -> bool:
        return len(self.model.trees) >= self.spec.rounds

    def take(self, hist: np.ndarray | None) -> None:
        """The sums of the open nodes of this level."""
        first, count = 2**self.level - 1, 2**self.level
        g, n = self.sums
        left_g, left_n = g.copy(), n.copy()
        split = np.zeros((self.fits, count), bool)
        if hist is not None:
            found, feature, bin_, lg, ln, tg, tn = best_splits(hist, self.spec)
            fit, node = np.nonzero(self.open)
            s = self.slot[fit, node]
            if self.level == 0:
                g[fit, node], n[fit, node] = tg[s], tn[s]
                left_g, left_n = g.copy(), n.copy()
            fit, node, s = fit[found[s]], node[found[s]], s[found[s]]
            split[fit, node] = True
            self.tree.feature[fit, first + node], self.tree.bin[fit, first + node] = feature[s], bin_[s]
            left_g[fit, node], left_n[fit, node] = lg[s], ln[s]
        # A node that isn't split goes on as its own left child.
        below = lambda left, all_: np.stack([left, np.where(split, all_ - left, 0.0)], axis=2).reshape(self.fits, 2 * count)
        self.sums = np.stack([below(left_g, g), below(left_n, n)])
        self.level += 1
        if self.level == self.spec.depth:
            g, n = self.sums
            self.tree.value = self.spec.step * np.divide(g, n + self.spec.l2, out=np.zeros_like(g), where=n > 0)
            self.model.trees.append(self.tree)
            self.begin()
            return
        self.open = np.repeat(split, 2, axis=1) & (self.sums[1] >= max(2, 2 * self.spec.least))
        self.slot = np.where(self.open, np.cumsum(self.open).reshape(self.open.shape) - 1, -1)


def whole_fit(batches: Iterator[pa.RecordBatch], spec: Boosting, start: float, width: int, bins: int) -> list[Tree]:
    """All rounds of one fit.  batches: b, n, y and uid in order of b; n rows of equal bins are drawn together."""
    x, at, (n, y, uid) = vectors(batches, width, "n", "y", "uid")
    packed, growing = Packed(x, bins), Growing(spec, np.array([start]), bins)
    predicted = np.full(len(x), start)

    def sums(round_: int) -> tuple[np.ndarray, np.ndarray]:
        rows, levels = np.zeros(len(x)), np.zeros(len(x))
        for a in range(0, len(at), ROWS_AT_ONCE):
            part = slice(a, a + ROWS_AT_ONCE)
            first = at[a]
            own, use = at[part] - first, drawn(uid[part], round_, spec.share)
            there = slice(first, first + own[-1] + 1)
            rows[there] += np.bincount(own, np.where(use, n[part], 0))
            levels[there] += np.bincount(own, np.where(use, y[part], 0.0))
        return rows, levels

    rows, levels = sums(0)
    for round_ in range(spec.rounds):
        if round_ and spec.share < 1:
            rows, levels = sums(round_)
        residual, node = levels - rows * predicted, np.zeros(len(x), np.int64)
        while True:
            tree, level = growing.tree, growing.level
            slot = growing.slot[0][node - (2**level - 1)]
            growing.take(packed.histograms(slot, residual, rows, int(growing.slot.max()) + 1) if growing.open.any() else None)
            node = tree.descend(x, 0, node, 1)
            if not growing.level:
                break
        predicted += tree.value[0][node - (2**spec.depth - 1)]
    return growing.model.trees


def whole_fits(rows: DataFrame, cuts: list[np.ndarray], specs: list[Boosting], start: np.ndarray, bins: int) -> list[Model]:
    """``fit_folds`` with each fit in a task of its own."""
    fits, width = len(start), len(cuts)
    ready = materialised(with_bins(rows, cuts, "y", "fold", "uid"), "binned")
    alike = ready.groupBy("b", "fold").agg(F.sum("y").alias("y"), F.min("uid").alias("uid"), F.count("*").alias("n"))
    dealt = lambda df, tasks: df.select("b", "n", "y", "uid", F.explode(F.filter(F.array(*[F.lit(t) for t in tasks]), lambda t: t % fits != F.col("fold"))).alias("task"))
    of = lambda which: [s * fits + k for s, spec in enumerate(specs) if which(spec) for k in range(fits)]
    sent = reduce(DataFrame.unionByName, [dealt(df, tasks) for df, tasks in ((alike, of(lambda s: s.share >= 1)), (ready.withColumn("n", F.lit(1).cast("long")), of(lambda s: s.share < 1))) if tasks])

    def fit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task, own in runs(it, "task"):
            trees = whole_fit(own, specs[task // fits], start[task % fits], width, bins)
            parts = [np.concatenate(x).astype(kind).tobytes() for x, kind in (([t.feature for t in trees], np.int16), ([t.bin for t in trees], np.int16), ([t.value for t in trees], float))]
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), *(pa.array([p], pa.binary()) for p in parts)], ["task", "feature", "bin", "value"])

    ordered = sent.repartitionById(len(specs) * fits, "task").sortWithinPartitions("task", "b", "uid")
    found = {r["task"]: r for r in ordered.mapInArrow(fit, "task int, feature binary, bin binary, value binary").collect()}  # trees: their size depends on the parameters
    models = []
    for s, spec in enumerate(specs):
        inner, leaves = 2**spec.depth - 1, 2**spec.depth

        def of_fits(name: str, kind: type, size: int, none: float, s: int = s, spec: Boosting = spec) -> np.ndarray:
            one = lambda k: np.frombuffer(found[k][name], kind).reshape(spec.rounds, size) if k in found else np.full((spec.rounds, size), none, kind)
            return np.stack([one(s * fits + k) for k in range(fits)], axis=1)

        trees = zip(of_fits("feature", np.int16, inner, 0), of_fits("bin", np.int16, inner, bins), of_fits("value", float, leaves, 0.0), strict=True)
        models.append(Model(start.copy(), [Tree(*t) for t in trees], spec.depth))
    return models


def fit_folds(rows: DataFrame, specs: list[Boosting], folds: int, bins: int = 32, rows_a_task: int = 50_000) -> tuple[list[Model], list[np.ndarray]]:
    """A model for each candidate, with ``folds`` fits that leave a fold out and one of all rows; and the cut points.

    rows: x (array of double), y, fold (0 .. folds - 1), uid (long; equal ids are drawn alike)."""
    cuts = cut_points(rows, bins)
    size = rows.count()
    sums = {r["fold"]: (r["s"], r["n"]) for r in rows.groupBy("fold").agg(F.sum("y").alias("s"), F.count("*").alias("n")).collect()}  # a row a fold
    total, n = sum(s for s, _ in sums.values()), sum(c for _, c in sums.values())
    without = lambda k: (total - sums.get(k, (0, 0))[0]) / max(1, n - sums.get(k, (0, 0))[1])
    start = np.array([without(k) for k in range(folds)] + [total / max(1, n)])
    if size <= MOST_ROWS:
        return whole_fits(rows, cuts, specs, start, bins), cuts
    growing = [Growing(s, start.copy(), bins) for s in specs]

    def block(part: Iterator) -> Iterator[Block]:
        got = list(part)  # ``rows_a_task`` rows
        x = np.array([r["x"] for r in got], float).reshape(len(got), len(cuts))
        yield Block(binned(x, cuts), np.array([r["y"] for r in got], float), np.array([r["fold"] for r in got], np.int64), np.array([r["uid"] for r in got], np.int64))

    context = rows.sparkSession.sparkContext
    parts = max(1, -(-size // rows_a_task))
    blocks = rows.select("x", "y", "fold", "uid").repartition(parts).rdd.mapPartitions(block).persist(StorageLevel.MEMORY_AND_DISK)
    run, sent = uuid.uuid4().hex, [[] for _ in specs]

    def running(index: int, own: Block, at: list[tuple[int, int, int]], chunks: list[list], recent: list[list[Tree]]) -> Running:
        """This worker's state of a partition with all finished rounds added; at: candidate, finished rounds and level."""
        held = _HELD.get((run, index))
        if held is None or any(held.done[s] > r or held.done[s] == r and held.level[s] > level for s, r, level in at):
            held = _HELD[run, index] = Running(own, [start] * len(specs))
            while len(_HELD) > WORKER_PARTITIONS:
                _HELD.popitem(last=False)
        for s, rounds, _ in at:
            while held.done[s] < rounds:
                chunk, k = divmod(held.done[s], ROUNDS_A_BROADCAST)
                held.add(s, (chunks[s][chunk].value if chunk < len(chunks[s]) else recent[s])[k], specs[s].depth)
        return held

    def one_level(index: int, part: Iterator[Block], todo: tuple, chunks: list[list], recent: list[list[Tree]]) -> Iterator[list[np.ndarray]]:
        (own,) = part  # read in any case: a worker that leaves input unread is not used again
        held = running(index, own, [x[:3] for x in todo], chunks, recent)
        out = []
        for s, rounds, level, tree, slot in todo:
            held.go_down(s, tree, level)
            out.append(histograms(held, s, rounds, specs[s].share, level, slot, bins))
        yield out

    try:
        while not all(g.over for g in growing):
            for g, out in zip(growing, sent, strict=True):
                while len(g.model.trees) >= (len(out) + 1) * ROUNDS_A_BROADCAST:
                    out.append(context.broadcast(g.model.trees[len(out) * ROUNDS_A_BROADCAST :][:ROUNDS_A_BROADCAST]))
            chunks, recent = [list(x) for x in sent], [g.model.trees[len(x) * ROUNDS_A_BROADCAST :] for x, g in zip(sent, growing, strict=True)]
            todo = tuple((s, len(g.model.trees), g.level, g.tree, g.slot) for s, g in enumerate(growing) if not g.over and g.open.any())
            found: dict[int, np.ndarray] = {}
            if todo:
                got = blocks.mapPartitionsWithIndex(partial(one_level, todo=todo, chunks=chunks, recent=recent))
                add = lambda a, b: [x + y for x, y in zip(a, b, strict=True)]
                sums_ = got.treeReduce(add, 2) if parts > FANIN else reduce(add, got.collect())  # of fixed size
                found = {t[0]: h for t, h in zip(todo, sums_, strict=True)}
            for s, g in enumerate(growing):
                if not g.over:
                    g.take(found.get(s))
    finally:
        blocks.unpersist()
        for x in sent:
            for chunk in x:
                chunk.unpersist()
    return [g.model for g in growing], cuts


def predict(rows: DataFrame, model: Model, cuts: list[np.ndarray], keep: tuple[str, ...], fit: str) -> DataFrame:
    """The ``keep`` columns and ``prediction`` by the fit whose number is in the column ``fit``.  The model is broadcast: its
    size depends on the parameters."""
    sent = rows.sparkSession.sparkContext.broadcast((model, cuts))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, edges = sent.value
        for batch in it:
            x = np.array(batch.column(batch.schema.get_field_index("x")).to_pylist(), float).reshape(batch.num_rows, len(edges))
            which = batch.column(batch.schema.get_field_index(fit)).to_numpy(zero_copy_only=False).astype(np.int64)
            values = own.predict(binned(x, edges), which) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(values, pa.float64())], [*keep, "prediction"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "prediction double"]))


def as_rows(df: DataFrame, key: str, target: str, fold: str) -> DataFrame:
    """The columns that ``fit_folds`` reads, beside ``key`` and ``target``, from a vector column ``features``."""
    return df.select(key, target, vector_to_array("features").alias("x"), F.col(target).cast("double").alias("y"), F.col(fold).cast("int").alias("fold"), F.xxhash64(key).alias("uid"))
