"""Second-order boosted trees for a 0/1 label, fitted on Spark by histograms.

Features are cut into bins once; features of few bins are counted together, in one cell for each combination of
their bins. A tree grows a level at a time: every task adds up the gradients and hessians of its rows by node and
cell, the sums of all tasks are folded, and the driver, which sees nothing but these sums, picks the splits. Of two
children only the lighter one is added up; the other's sums are what their parent has more. Gradients are whole
multiples of 2^-24, so all sums are exact and a model does not depend on how the rows are dealt out. Margins are kept
beside the cells: each round adds the last tree's values to the rows held from the round before, and every ``KEEP``
rounds they are written to the checkpoint folder; what a lost executor held is built again from there.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.session import ensure_checkpoint_dir

SAMPLE = 100_000  # rows that the bin edges are taken from; all rows where there are no more
KEEP = 25  # rounds between two checkpoints of the margins
BLOCK = 1_000_000  # rows of one block; a table of no more is fitted by one task, with the same result,
ALONE = 12_000_000  # if it has no more cells: up to there one task counts a level sooner than a job for it takes
_ONE = float(1 << 24)  # one, in the unit of gradient sums
_FEW = 64  # partitions whose sums the driver folds by itself
CELLS = 256  # cells of features that are counted together, at most
PART = 1_000_000  # rows of one partition, about; fewer where there are cores for more partitions


@dataclass(frozen=True)
class Settings:
    rounds: int = 300
    depth: int = 4
    rate: float = 0.05
    rows: float = 0.9  # share of the rows a tree sees
    columns: float = 0.9  # share of the columns a tree may split on
    bins: int = 256
    ridge: float = 1.0
    least: float = 1.0  # hessian sum of a node's child
    seed: int = 42


@dataclass
class Trees:
    """Complete binary trees: row t holds tree t, node i has children 2i + 1 and 2i + 2; right if larger."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes)
    value: np.ndarray  # (trees, leaves)
    base: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row; a missing value is smaller than any other."""
        x = np.where(np.isnan(x), -np.inf, x)
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(len(value).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    def score(self, features: str) -> Column:
        """The probability as a column, from an array column of the features the trees were fitted on."""
        trees = self

        @F.pandas_udf("double")
        def probability(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype="float64")
            return pd.Series(trees.probability(np.stack(rows.to_list()).astype(np.float64)))

        return probability(F.col(features))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per tree, and one that holds the base."""
        rows = [(i, *(a.tolist() for a in t), self.base) for i, t in enumerate(zip(self.feature, self.threshold, self.value))]
        kept = rows or [(-1, [], [], [], self.base)]
        schema = "tree int, feature array<long>, threshold array<double>, value array<double>, base double"
        spark.createDataFrame(kept, schema).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Trees:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r.tree)
        trees = [r for r in rows if r.tree >= 0]
        return cls(
            np.array([r.feature for r in trees], np.int64),
            np.array([r.threshold for r in trees], np.float64),
            np.array([r.value for r in trees], np.float64),
            rows[0].base,
        )


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per column at most ``bins`` - 1 edges at its quantiles, all values if they are fewer; the largest is none."""
    steps = np.linspace(0, 1, bins + 1)[1:-1]
    edges = []
    for column in x.T:
        values = np.unique(column)
        chosen = values if len(values) <= bins else np.unique(np.quantile(column, steps, method="lower"))
        edges.append(chosen[chosen < values[-1]] if len(values) else chosen)
    return edges


@dataclass
class Block:
    """Some rows: their cell in each group of features, in one numbering for all groups, label, draw key and margin."""

    bins: np.ndarray
    label: np.ndarray
    key: np.ndarray
    margin: np.ndarray


@dataclass
class _Tree:
    """A tree on bins: right if the row's bin of ``feature`` is larger than ``cut``.

    On cells: right if ``right`` holds for the node and the row's cell in the node's ``group``.
    """

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    group: np.ndarray | None = None
    right: np.ndarray | None = None

    def nodes(self, cells: np.ndarray, depth: int) -> np.ndarray:
        node, rows = np.zeros(len(cells), np.int64), np.arange(len(cells))
        for level in range(depth):
            own = cells[rows, self.group[node]] if level else cells[:, self.group[0]]
            node = 2 * node + 1 + self.right[node, own]
        return node


class Layout:
    """Which features are counted together: a group has a cell for each combination of its features' bins.

    ``starts``: numbers of each feature's first bin, and of the end. A feature of many bins is a group by itself.
    """

    def __init__(self, starts: np.ndarray) -> None:
        self.starts, sizes = starts, np.diff(starts).tolist()
        self.groups: list[list[int]] = []
        widths: list[int] = []
        for f in sorted(range(len(sizes)), key=lambda f: sizes[f]):
            if widths and widths[-1] * sizes[f] <= CELLS:
                self.groups[-1].append(f)
                widths[-1] *= sizes[f]
            else:
                self.groups.append([f])
                widths.append(sizes[f])
        self.first = np.cumsum([0, *widths])
        # By feature: its group, and the combinations of the features before and after it there.
        self.place: dict[int, tuple[int, int, int]] = {}
        for g, features in enumerate(self.groups):
            before = 1
            for f in features:
                self.place[f] = (g, before, widths[g] // before // sizes[f])
                before *= sizes[f]

    @property
    def cells(self) -> int:
        return int(self.first[-1])

    def cells_of(self, bins: np.ndarray) -> np.ndarray:
        """(rows, groups) from the (rows, features) bins, each feature's counted from 0."""
        found = np.zeros((len(bins), len(self.groups)), np.int64) + self.first[:-1]
        for f, (g, _, after) in self.place.items():
            found[:, g] += bins[:, f].astype(np.int64) * after
        return found.astype("<u2" if self.cells <= 1 << 16 else "<i4")

    def by_bin(self, sums: np.ndarray) -> np.ndarray:
        """Sums (nodes, bins, 2) from those by cell."""
        found = np.empty((len(sums), int(self.starts[-1]), 2), sums.dtype)
        for f, (g, before, after) in self.place.items():
            own = sums[:, self.first[g] : self.first[g + 1]].reshape(len(sums), before, -1, after, 2)
            found[:, self.starts[f] : self.starts[f + 1]] = own.sum(axis=(1, 3))
        return found

    def tree(self, inner: int) -> _Tree:
        """A tree that splits nowhere."""
        tree = _Tree(np.zeros(inner, np.int64), np.full(inner, self.starts[-1]), np.zeros(inner + 1))
        tree.group, tree.right = np.zeros(inner, np.int64), np.zeros((inner, self.cells), bool)
        return tree

    def split(self, tree: _Tree, node: int, feature: int, cut: int) -> None:
        """Let a node split its rows by a feature's bins."""
        g, before, after = self.place[feature]
        larger = np.arange(self.starts[feature], self.starts[feature + 1]) > cut
        tree.feature[node], tree.cut[node], tree.group[node] = feature, cut, g
        tree.right[node, self.first[g] : self.first[g + 1]] = np.tile(np.repeat(larger, after), before)


def fit(rows: DataFrame, settings: Settings = Settings()) -> Trees:
    """Trees for ``rows`` with columns ``key`` (long), ``label`` (0 or 1) and ``features`` (array of doubles).

    ``key`` decides which rows a tree draws; rows without one are drawn together. Rows without a label are not fitted
    on. With one label only, or no rows, the answer is the share of label 1 (0.5 of nothing) without a tree.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    rows = rows.select(
        F.xxhash64(F.lit(settings.seed), "key").alias("key"),
        F.col("label").cast("double").alias("label"),
        F.col("features").cast("array<double>").alias("features"),
    ).where("label IS NOT NULL")
    counted = rows.agg(F.count("*").alias("n"), F.sum("label").alias("ones"), F.max(F.size("features")).alias("d")).first()
    n, ones, d = counted.n, counted.ones or 0.0, counted.d or 0
    inner, leaves = (1 << settings.depth) - 1, 1 << settings.depth
    share = min(max(ones / n, 1e-6), 1 - 1e-6) if n else 0.5
    base = math.log(share / (1 - share))
    if not d or ones in (0, n):
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)

    edges = bin_edges(_sampled(rows, n), settings.bins)
    # Numbers of each feature's first bin, and of the end.
    starts = np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges])])
    layout = Layout(starts)
    packed = _packed(rows, edges, layout)
    if n <= BLOCK and n * len(layout.groups) <= ALONE:
        # One block needs no exchange of sums: its task grows the same trees by itself.
        one = _blocks(packed.repartition(1), layout, base)
        made = one.mapPartitions(lambda part: _alone(part, layout, settings)).collect()
        return _on_values(made, edges, starts, base)
    # Every level of every tree is a job: as many tasks as the cores and the rows ask for, however the table lies.
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(n / PART))
    return _on_values(_together(_blocks(packed.repartition(parts), layout, base), layout, settings), edges, starts, base)


def _alone(part: Iterator[Block], layout: Layout, settings: Settings) -> Iterator[_Tree]:
    """The trees of a few rows that lie in one partition."""
    parts = list(part)
    bins = np.concatenate([b.bins for b in parts]).T.copy()  # the rows' cells in one group lie together
    label, key, margin = (np.concatenate([getattr(b, c) for b in parts]) for c in ("label", "key", "margin"))
    del parts
    for round_ in range(settings.rounds):
        weights = _weights(label, margin, _drawn(key, round_, settings.rows))
        node = np.zeros(len(label), np.int64)  # in the level that was reached last

        def down(tree: _Tree, level: int) -> None:
            """Move the rows to the children of a level's nodes."""
            inner = node + ((1 << level) - 1)
            right = np.zeros(len(node), bool)
            for g in np.unique(tree.group[(1 << level) - 1 : (2 << level) - 1]):
                own = np.flatnonzero(tree.group[inner] == g) if level else slice(None)
                right[own] = tree.right[inner[own], bins[g][own]]
            node[:] = 2 * node + right

        def sums(tree: _Tree, level: int, skipped: np.ndarray) -> np.ndarray:
            if level:
                down(tree, level - 1)
            rows = np.flatnonzero(~skipped[node]) if skipped.any() else slice(None)
            return _counted(bins, rows, node[rows], [w[rows] for w in weights], 1 << level, layout.cells)

        tree = _grow(sums, layout, round_, settings)
        down(tree, settings.depth - 1)
        margin = margin + tree.value[node]
        yield tree


def _together(blocks: RDD, layout: Layout, settings: Settings) -> list[_Tree]:
    """The trees of blocks in many partitions: a job for each level, margins checkpointed every ``KEEP`` rounds."""
    made: list[_Tree] = []
    held: list[RDD] = []
    cells = layout.cells
    try:
        for round_ in range(settings.rounds):
            last = made[-1:]
            blocks = blocks.map(lambda b, last=last: _moved(b, last, settings.depth))
            blocks.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(blocks)
            if round_ % KEEP == 0:
                blocks.checkpoint()
                blocks.count()

            def sums(tree: _Tree, level: int, skipped: np.ndarray, round_=round_, blocks=blocks) -> np.ndarray:
                def of(part: Iterator[Block]) -> Iterator[np.ndarray]:
                    found = None
                    for b in part:
                        own = histograms(b, [], tree, level, cells, round_, settings, skipped)
                        found = own if found is None else found + own
                    if found is not None:
                        yield found

                return blocks.mapPartitions(of).treeReduce(np.add, 1 if blocks.getNumPartitions() <= _FEW else 2)

            made.append(_grow(sums, layout, round_, settings))
            # The first level's job has moved all rows; those of the round before are needed no more.
            while len(held) > 1:
                held.pop(0).unpersist()
    finally:
        for kept in held:
            kept.unpersist()
    return made


def _sampled(rows: DataFrame, n: int) -> np.ndarray:
    """The features of the rows of low key: all of them, or about ``SAMPLE``."""
    low = F.lit(1.0) if n <= SAMPLE else F.lit(SAMPLE / n)
    # The key is a hash already; its upper bits are as good as a number from 0 to 1.
    unit = F.shiftrightunsigned("key", 11) / F.lit(float(1 << 53))
    table = rows.where(unit < low).select("features").toArrow()
    values = table.column("features").combine_chunks()
    return _matrix(values)


def _matrix(values: pa.ListArray) -> np.ndarray:
    x = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)
    return np.where(np.isnan(x), -np.inf, x)


def _packed(rows: DataFrame, edges: list[np.ndarray], layout: Layout) -> DataFrame:
    """The rows as blocks of cells, one row per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["features"])
            cells = layout.cells_of(np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1))
            for at in range(0, len(cells), BLOCK):
                part = slice(at, at + BLOCK)
                label, key = (batch[c].to_numpy(zero_copy_only=False)[part] for c in ("label", "key"))
                columns = [cells[part], label.astype("<f8"), key.astype("<i8")]
                yield pa.record_batch([pa.array([c.tobytes()]) for c in columns], names=["cells", "label", "key"])

    return rows.mapInArrow(run, "cells binary, label binary, key binary")


def _blocks(packed: DataFrame, layout: Layout, base: float) -> RDD:
    kind, groups = layout.cells_of(np.zeros((0, len(layout.place)))).dtype, len(layout.groups)

    def block(row) -> Block:
        label = np.frombuffer(row.label, "<f8")
        cells = np.frombuffer(row.cells, kind).reshape(len(label), groups)
        return Block(cells, label, np.frombuffer(row.key, "<u8"), np.full(len(label), base))

    return packed.rdd.map(block)


def _moved(block: Block, trees: list[_Tree], depth: int) -> Block:
    """The block with the trees' values added to its margins, one after the other."""
    margin = block.margin
    for tree in trees:
        margin = margin + tree.value[tree.nodes(block.bins, depth) - len(tree.feature)]
    return Block(block.bins, block.label, block.key, margin)


def _drawn(key: np.ndarray, round_: int, share: float) -> np.ndarray:
    """Which rows a round draws: a mixed hash of key and round below the share."""
    with np.errstate(over="ignore"):
        z = key + np.uint64((round_ + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53) < share


def histograms(
    block: Block,
    trees: list[_Tree],
    tree: _Tree,
    level: int,
    cells: int,
    round_: int,
    settings: Settings,
    skipped: np.ndarray | None = None,
) -> np.ndarray:
    """Gradient and hessian sums (nodes of the level, cells, 2) of the rows a round draws, in whole units.

    The sums of ``skipped`` nodes are left at 0.
    """
    block = _moved(block, trees, settings.depth)
    drawn = _drawn(block.key, round_, settings.rows)
    width = 1 << level
    node = tree.nodes(block.bins, level) - (width - 1)
    if skipped is not None and skipped.any():
        drawn &= ~skipped[node]
    rows = np.flatnonzero(drawn)
    weights = _weights(block.label[rows], block.margin[rows])
    return _counted(block.bins.T, rows, node[rows], weights, width, cells)


def _weights(label: np.ndarray, margin: np.ndarray, drawn: np.ndarray | None = None) -> list[np.ndarray]:
    """Gradients and hessians in whole units; 0 for rows that are not drawn."""
    p = 1 / (1 + np.exp(-margin))
    whole = [np.rint(w * _ONE) for w in (p - label, p * (1 - p))]
    return whole if drawn is None else [w * drawn for w in whole]


def _counted(bins: np.ndarray, rows, node: np.ndarray, weights: list[np.ndarray], width: int, cells: int) -> np.ndarray:
    """Sums (nodes, cells, 2) of the rows' weights by node and cell; ``bins`` holds one group of features after the other."""
    found = np.zeros((width, cells, 2), np.int64)
    for own in bins if len(node) else ():
        own = own[rows]
        first, end = int(own.min()), int(own.max()) + 1
        at = node * (end - first) + own - first
        for side, weight in enumerate(weights):
            # Whole numbers below 2^53 add up exactly in doubles.
            sums = np.bincount(at, weight, width * (end - first))
            found[:, first:end, side] += sums.astype(np.int64).reshape(width, -1)
    return found


def _grow(
    sums_of: Callable[[_Tree, int, np.ndarray], np.ndarray], layout: Layout, round_: int, settings: Settings
) -> _Tree:
    """One more tree; ``sums_of`` gives the sums by cell of a level of the tree so far, but for the nodes it skips."""
    inner, starts = (1 << settings.depth) - 1, layout.starts
    tree = layout.tree(inner)
    allowed = np.zeros(int(starts[-1]), bool)
    d = len(starts) - 1
    some = np.random.default_rng([settings.seed, round_]).permutation(d)[: max(1, round(d * settings.columns))]
    for f in some:
        allowed[starts[f] : starts[f + 1] - 1] = True  # nothing is larger than the last bin
    above, skipped = None, np.zeros(1, bool)
    for level in range(settings.depth):
        sums = sums_of(tree, level, skipped)
        if above is not None:
            children = np.arange(len(sums))
            sums[skipped] = (np.repeat(above, 2, axis=0) - sums[children ^ 1])[skipped]
        feature, cut, left, right = best_splits(layout.by_bin(sums) / _ONE, starts, allowed, settings)
        for node, (f, c) in enumerate(zip(feature, cut), (1 << level) - 1):
            layout.split(tree, node, int(f), int(c))
        # The heavier child's sums follow from its parent's.
        above, lighter = sums, left[:, 1] < right[:, 1]
        skipped = np.stack([~lighter, lighter], axis=1).ravel()
    for side, totals in enumerate((left, right)):
        tree.value[side::2] = -settings.rate * totals[:, 0] / (totals[:, 1] + settings.ridge)
    return tree


def best_splits(
    sums: np.ndarray, starts: np.ndarray, allowed: np.ndarray, settings: Settings
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node: feature, cut (a bin number; none exceeds it where nothing is gained), sums to its left and right."""
    upto = np.cumsum(sums, axis=1)
    before = np.concatenate([np.zeros((len(sums), 1, 2)), upto], axis=1)[:, starts[:-1]]
    sizes = np.diff(starts)
    left = upto - np.repeat(before, sizes, axis=1)
    total = upto[:, starts[1] - 1]
    right = total[:, None] - left

    def worth(side: np.ndarray) -> np.ndarray:
        return side[..., 0] ** 2 / (side[..., 1] + settings.ridge)

    gain = worth(left) + worth(right) - worth(total)[:, None]
    enough = (left[..., 1] >= settings.least) & (right[..., 1] >= settings.least) & allowed
    gain = np.where(enough, gain, -np.inf)
    best = gain.argmax(axis=1)
    nodes = np.arange(len(sums))
    split = gain[nodes, best] > 1e-6
    feature = np.where(split, np.searchsorted(starts, best, side="right") - 1, 0)
    cut = np.where(split, best, starts[-1])
    own_left = np.where(split[:, None], left[nodes, best], total)
    return feature, cut, own_left, total - own_left


def _on_values(made: list[_Tree], edges: list[np.ndarray], starts: np.ndarray, base: float) -> Trees:
    """The trees with the features' values as thresholds."""
    values = np.concatenate([np.append(e, np.inf) for e in edges] + [[np.inf]])
    feature, cut, value = (np.array([getattr(t, c) for t in made]) for c in ("feature", "cut", "value"))
    return Trees(feature, values[cut], value, base)
