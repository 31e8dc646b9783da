"""Classification trees grown on counted cells, one tree per task, by the rules of Spark ML's forest.

Spark ML grows a forest level by level with a job per level, and its driver handles every node. Cells are few enough to be
held by a task, so a task grows a whole tree here: best Gini gain of all bin borders of the node's drawn features, the first
of equals, no split without a gain, no more levels than asked for, leaves of one prediction put together. Given the same
weights and all features the tree is Spark's.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# the functions below travel with the tasks, so that executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: An impurity below this is none (Spark's ``Utils.EPSILON``); sums that a task holds at once per temporary.
EPSILON, SUMS = 2.0**-52, 1 << 21
#: Bytes of a packed cell beside its bins; what all cells may take, as every task and the driver hold them.
CELL_BYTES, PACKED_BYTES = 24, 48 << 20
#: Trees that a task of the search grows; cells whose votes are added together.
TREES_PER_TASK, CELLS_PER_PART = 25, 20_000


@dataclass
class Cells:
    """Cells in the order of their columns: bins by feature, label, weight, rows ``n`` and held-out weight ``held``."""

    values: list[np.ndarray]
    bins: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    n: np.ndarray
    held: np.ndarray | None
    classes: int

    def drawn(self, seed: int, tree: int) -> tuple[np.random.Generator, np.ndarray]:
        """A tree's random numbers and how often bootstrapping draws rows of each cell, which depend on ``seed`` and ``tree`` only.

        Each row is drawn a Poisson(1) number of times, the ``n`` rows of a cell thus Poisson(n) times.
        """
        rng = np.random.default_rng([seed, tree])
        return rng, rng.poisson(self.n)


@dataclass
class Tree:
    """Nodes, parents before children. ``feature`` is -1 at leaves; a row goes right if its bin is above ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    stats: np.ndarray
    count: np.ndarray
    leaf_of: np.ndarray


def fits(cells: int, features: int) -> bool:
    return cells * (features + CELL_BYTES) <= PACKED_BYTES


def packed(cells: DataFrame, values: Sequence[Sequence[float]], classes: int) -> Cells:
    """All cells in the driver's memory: ``label``, ``weight``, ``x``, ``n`` and, if there, ``held``. Check ``fits`` before."""
    own = [np.asarray(v, dtype=float) for v in values]
    names = ["label", "weight", *[F.col("x")[i].alias(f"x{i}") for i in range(len(own))], "n", *(c for c in cells.columns if c == "held")]
    table = cells.select(*names).toArrow()
    bins = np.array([np.searchsorted(v, table.column(f"x{i}").to_numpy()) for i, v in enumerate(own)], dtype=np.uint8)
    label, weight, n = (table.column(c).to_numpy() for c in ("label", "weight", "n"))
    held = table.column("held").to_numpy() if "held" in table.column_names else None
    order = np.lexsort((weight, label, *bins))
    return Cells(
        own, np.ascontiguousarray(bins[:, order]), label[order].astype(np.int32), weight[order], n[order],
        held[order] if held is not None else None, classes,
    )


def impurity(stats: np.ndarray) -> np.ndarray:
    """Gini impurity over the last axis."""
    total = stats.sum(axis=-1)
    found = np.ones(total.shape)
    for c in range(stats.shape[-1]):
        share = stats[..., c] / total
        found -= share * share
    return found


def best_cuts(sums: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each node the gain, place and left sums of its best cut. ``sums`` are by node, bin and class, ``before`` impurities."""
    left = sums.cumsum(axis=1)
    total, left = left[:, -1:, :], left[:, :-1, :]
    right = total - left
    filled = sums.sum(axis=2) > 0
    first, last = filled.argmax(axis=1), filled.shape[1] - 1 - filled[:, ::-1].argmax(axis=1)
    at = np.arange(left.shape[1])
    low, high = left.sum(axis=2), right.sum(axis=2)
    gain = before[:, None] - low / (low + high) * impurity(left) - high / (low + high) * impurity(right)
    gain[(at < first[:, None]) | (at >= last[:, None])] = -np.inf
    place, rows = gain.argmax(axis=1), np.arange(len(gain))
    return gain[rows, place], place, left[rows, place], right[rows, place]


def grow(cells: Cells, draws: np.ndarray, depth: int, per_split: int, rng: np.random.Generator | None) -> Tree:
    """One tree on cells of which rows are drawn ``draws`` times. Cells without draws are led to their leaves, too."""
    features, k = len(cells.bins), cells.classes
    sizes = [len(v) for v in cells.values]
    weights = draws * cells.weights
    node = np.zeros(len(draws), dtype=np.int64)
    stats = [np.bincount(cells.labels, weights, k)[None, :]]
    feature, cut, left, gain = ([np.full(1, v)] for v in (-1, 0, -1, -1.0))
    live, slot, ids = np.arange(len(draws)), np.zeros(len(draws), dtype=np.int64), np.zeros(1, dtype=np.int64)
    levels, made = [(0, 1)], 1
    with np.errstate(divide="ignore", invalid="ignore"):
        if depth == 0 or not stats[0].sum() > 0 or impurity(stats[0])[0] < EPSILON:
            ids = ids[:0]
        while len(ids):
            low = levels[-1][0]
            own = stats[-1][ids - low]
            before = impurity(own)
            best = np.full(len(ids), -np.inf)
            which, where = np.full(len(ids), -1), np.zeros(len(ids), dtype=np.int64)
            lefts, rights = np.zeros((len(ids), k)), np.zeros((len(ids), k))
            chosen = np.ones((len(ids), features), dtype=bool)
            if per_split < features:
                chosen[:] = False
                np.put_along_axis(chosen, rng.random(chosen.shape).argpartition(per_split, axis=1)[:, :per_split], True, axis=1)
            label, weight = cells.labels[live], weights[live]
            for f in range(features):
                with_f, size = np.flatnonzero(chosen[:, f]), sizes[f]
                if size < 2:
                    continue
                place = np.full(len(ids), -1)
                place[with_f] = np.arange(len(with_f))
                at = place[slot]
                step = max(1, SUMS // (size * k))
                for start in range(0, len(with_f), step):
                    some = with_f[start : start + step]
                    mine = np.flatnonzero((at >= start) & (at < start + step))
                    key = ((at[mine] - start) * size + cells.bins[f, live[mine]]) * k + label[mine]
                    sums = np.bincount(key, weight[mine], len(some) * size * k).reshape(len(some), size, k)
                    found = best_cuts(sums, before[some])
                    better = found[0] > best[some]
                    to = some[better]
                    best[to], which[to], where[to], lefts[to], rights[to] = found[0][better], f, *(x[better] for x in found[1:])
            split = best > 0
            parents = ids[split]
            feature[-1][parents - low], cut[-1][parents - low], gain[-1][parents - low] = which[split], where[split], best[split]
            children = made + 2 * np.arange(len(parents))
            left[-1][parents - low] = children
            if not len(parents):
                break
            levels.append((made, made + 2 * len(parents)))
            made += 2 * len(parents)
            stats.append(np.stack([lefts[split], rights[split]], axis=1).reshape(-1, k))
            for known, v in ((feature, -1), (cut, 0), (left, -1), (gain, -1.0)):
                known.append(np.full(2 * len(parents), v))
            to = np.full(len(ids), -1)
            to[split] = children
            going = np.flatnonzero(split[slot])
            live, slot = live[going], slot[going]
            node[live] = to[slot] + (cells.bins[which[slot], live] > where[slot])
            pure = impurity(stats[-1]) < EPSILON
            ids = levels[-1][0] + np.flatnonzero(~pure) if len(levels) <= depth else children[:0]
            place = np.full(2 * len(parents), -1)
            place[ids - levels[-1][0]] = np.arange(len(ids))
            slot = place[node[live] - levels[-1][0]]
            live, slot = live[slot >= 0], slot[slot >= 0]
    return _pruned(*(np.concatenate(x) for x in (feature, cut, left, gain, stats)), levels, node, draws)


def _pruned(feature, cut, left, gain, stats, levels, node, draws) -> Tree:
    """The tree without leaves that predict the same as their sibling, its nodes numbered anew."""
    says = stats.argmax(axis=1)
    count = np.bincount(node, draws, len(feature)).astype(np.int64)
    for low, high in reversed(levels):
        inner = low + np.flatnonzero(left[low:high] >= 0)
        count[inner] = count[left[inner]] + count[left[inner] + 1]
        inner = low + np.flatnonzero(feature[low:high] >= 0)
        a = left[inner]
        alike = inner[(feature[a] < 0) & (feature[a + 1] < 0) & (says[a] == says[a + 1])]
        feature[alike], cut[alike], gain[alike] = -1, 0, -1.0
    owner, kept = np.arange(len(feature)), np.ones(len(feature), dtype=bool)
    for low, high in levels:
        parents = low + np.flatnonzero(left[low:high] >= 0)
        for child in (left[parents], left[parents] + 1):
            gone = (feature[parents] < 0) | ~kept[parents]
            owner[child[gone]], kept[child[gone]] = owner[parents[gone]], False
    number = np.cumsum(kept) - 1
    to = np.where(feature >= 0, number[left], -1)
    return Tree(feature[kept], cut[kept], to[kept], gain[kept], stats[kept], count[kept], number[owner[node]])


NODES = (
    "treeID int, id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
    "leftChild int, rightChild int, feature int, threshold double"
)


def grown_nodes(spark: SparkSession, cells: Cells, trees: int, depth: int, per_split: int, seed: int, classes: int) -> DataFrame:
    """The nodes of ``trees`` trees as rows, ``classes`` sums each. Each task grows trees of its own."""
    sent = spark.sparkContext.broadcast(tuple(vars(cells).values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Cells(*sent.value)
        borders = [(v[:-1] + v[1:]) / 2 for v in own.values]
        for batch in batches:
            for number in batch.column(0).to_pylist():
                rng, draws = own.drawn(seed, number)
                tree = grow(own, draws, depth, per_split, rng)
                size, inner = len(tree.feature), tree.feature >= 0
                stats = np.zeros((size, classes))
                stats[:, : own.classes] = tree.stats
                at = np.zeros(size)
                for f, cuts in enumerate(borders):
                    at[tree.feature == f] = cuts[tree.cut[tree.feature == f]]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * classes), pa.array(stats.ravel()))
                columns = [
                    np.full(size, number, dtype=np.int32), np.arange(size, dtype=np.int32), stats.argmax(axis=1).astype(float), impurity(stats),
                    lists, tree.count, tree.gain, tree.left.astype(np.int32), np.where(inner, tree.left + 1, -1).astype(np.int32),
                    tree.feature.astype(np.int32), at,
                ]
                names = [c.split()[0] for c in NODES.split(", ")]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    tasks = min(trees, 4 * spark.sparkContext.defaultParallelism)
    return spark.range(0, trees, 1, tasks).mapInArrow(run, NODES)


def held_out_votes(
    spark: SparkSession, cells: Cells, jobs: Sequence[tuple[int, int]], sizes: Sequence[int], seed: int
) -> DataFrame:
    """Confusion cells of held-out rows: ``job``, ``trees``, ``label``, ``prediction`` and their weight ``n``.

    ``jobs`` are pairs of depth and features per split. Of each a forest of the largest of the ascending ``sizes`` is
    grown, a block of trees per task; blocks end at the sizes. A tree depends on its number, not on how many there are, so that the
    first trees are the forest a fit of so many gives. Every tree votes with the shares of its leaf's classes, of classes
    with equal votes the first wins, as in Spark ML.
    """
    sent = spark.sparkContext.broadcast(tuple(vars(cells).values()))
    judged = np.flatnonzero(cells.held > 0)
    ends = sorted({*sizes, *range(TREES_PER_TASK, sizes[-1], TREES_PER_TASK)})
    blocks = [(j, low, high) for j in range(len(jobs)) for low, high in zip([0, *ends], ends)]
    blocks.sort(key=lambda b: -jobs[b[0]][0])  # deep trees take longest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Cells(*sent.value)
        at = np.flatnonzero(own.held > 0)
        for batch in batches:
            for b in batch.column(0).to_pylist():
                job, low, high = blocks[b]
                depth, per_split = jobs[job]
                votes = np.zeros((len(at), own.classes))
                for number in range(low, high):
                    rng, draws = own.drawn(seed, number)
                    tree = grow(own, draws, depth, per_split, rng)
                    total = tree.stats.sum(axis=1, keepdims=True)
                    votes += np.divide(tree.stats, total, out=np.zeros_like(tree.stats), where=total != 0)[tree.leaf_of[at]]
                for part, start in enumerate(range(0, len(at), CELLS_PER_PART)):
                    numbers = [pa.array([i], pa.int32()) for i in (job, part, high)]
                    some = pa.array([votes[start : start + CELLS_PER_PART].tobytes()], pa.binary())
                    yield pa.RecordBatch.from_arrays([*numbers, some], ["job", "part", "high", "votes"])

    def judge(table: pa.Table) -> pa.Table:
        own, rows = Cells(*sent.value), sorted(table.to_pylist(), key=lambda r: r["high"])
        job, start = rows[0]["job"], rows[0]["part"] * CELLS_PER_PART
        at = np.flatnonzero(own.held > 0)[start : start + CELLS_PER_PART]
        votes, found = np.zeros((len(at), own.classes)), []
        for row in rows:
            votes += np.frombuffer(row["votes"]).reshape(votes.shape)
            if row["high"] in sizes:
                key = own.labels[at] * own.classes + votes.argmax(axis=1)
                total = np.bincount(key, own.held[at], own.classes**2)
                found += [(job, row["high"], i // own.classes, i % own.classes, total[i]) for i in np.flatnonzero(total)]
        columns = zip(*found) if found else [[]] * 5
        types = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], ["job", "trees", "label", "prediction", "n"])

    if not len(judged):
        return spark.createDataFrame([], "job int, trees int, label double, prediction double, n double")
    votes = spark.range(0, len(blocks), 1, len(blocks)).mapInArrow(run, "job int, part int, high int, votes binary")
    cut = votes.groupBy("job", "part").applyInArrow(judge, "job int, trees int, label double, prediction double, n double")
    return cut.groupBy("job", "trees", "label", "prediction").agg(F.sum("n").alias("n"))
