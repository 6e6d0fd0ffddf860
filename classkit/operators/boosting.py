"""Gradient-boosted trees on histograms of first and second derivatives.

After the published method for scalable tree boosting: features are cut into
bins once; each level of a tree needs, per open node, feature and bin, the sums
of the derivatives of the loss. Tasks sum them over their rows, Spark adds the
partial histograms up and ranks the possible splits with a window per feature,
and the driver receives one row per open node. Of two siblings only the one with
fewer rows is measured; the other's sums are those of their parent, which were
kept, less the measured ones. Trees are grown for all classes at once, so a round
costs one job per level, as long as nodes are large.

A node of few rows (LOCAL_VALUES) is finished inside a task, which gets its rows
and grows the subtree to full depth by the same rule. If the whole table is that
small, its roots are such nodes. Rows with equal bins and label are then one unit,
which counts as often as rows of it are drawn, and ends in a leaf while the tree
grows, so nothing is routed a second time. One task grows the trees of many rounds
in a row, and hands the margins on to the next job; where a round of several
classes is much work (SPREAD_VALUES), each of its trees is grown by a task of its
own. Every way gives the same trees.

Rows are binned into one byte per feature, packed into blocks and written with
their margins to the shared folder. Every few rounds the margins are brought up to date and written
again; in between, tasks add the trees grown since. So no plan grows with the
number of rounds, and a lost executor costs only its tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import RDD, InheritableThread, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from classkit.operators.blocks import block, block_schema, blocks, list_column, matrix
from classkit.runtime import discard, local_table, written

MARGIN_ROUNDS = 10  # rounds between two writes of the margins
DENSE_CELLS = 1 << 21  # above this many cells a task keeps no dense histogram
LOCAL_VALUES = 1 << 25  # numbers that a node's rows take in a task that grows its subtree alone: 256 MB
SPREAD_VALUES = 1 << 24  # rows times features and outputs of a small table, from which each tree of a round has a task
LOCAL_ROUNDS = 100  # rounds of a small table that a task grows in a row
SPREAD_ROUNDS = 5  # rounds between two generations of the margins of a small table whose trees have a task each
LARGE_ROWS = 1 << 11  # rows from which a node is held by itself in a subtree, but not fewer than
LARGE_ROWS_A_FEATURE = 154  # for each feature: its sums then take 40 bytes a row at most
LANES = 4  # sums that are kept of a cell while it is added up
TOGETHER = 1 << 16  # numbers of several features or nodes that are ranked in one go
MARKED_SHARE, MARKED_CELLS = 8, 1 << 22  # cells per row, and in any case, up to which those with rows are marked, else sorted
MERGED_DRAWS = 8  # possible draws of features up to which rows that are equal in the drawn ones are found beforehand
DRAWN_ROWS = 1 << 13  # rows drawn at once
KEPT_SHARE = 0.75  # of rows led through a tree that are not in a leaf: below it the others are left out
MERGED_TREES = 32  # trees of the same features from which rows are scored by the distinct ones
SCORED_ROWS, SCORED_BYTES = 1 << 16, 1 << 25  # rows scored together
SKETCH_ACCURACY = 10_000  # quantile error at most 1 / 10,000; exact for fewer distinct values
SENT_NODES = 2_000_000  # tree nodes broadcast at once, 40 bytes each; larger models score in several passes
STORED_NODES = 200_000  # nodes of a part of a stored model, give or take a round
GAIN_DIGITS = 9  # gains are ranked at this precision, ties by lower feature and bin


@dataclass(frozen=True)
class BoostingSettings:
    rounds: int = 300
    eta: float = 0.1
    max_depth: int = 4
    subsample: float = 0.9
    colsample: float = 0.9
    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    max_bins: int = 256
    seed: int = 42


# The settings of the multiclass and of the binary model.
MULTICLASS = BoostingSettings(rounds=300, eta=0.1, max_depth=4, subsample=0.9, colsample=0.9)
BINARY = BoostingSettings(rounds=15_000, eta=0.05, max_depth=15, subsample=0.5, colsample=0.9)


@dataclass
class Tree:
    """Nodes as columns; a leaf has feature -1. ``x[feature] <= threshold`` goes left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    cut: list[int] = field(default_factory=lambda: [0])  # the threshold as a bin
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, threshold: float, cut: int, gain: float) -> tuple[int, int]:
        children = len(self.feature), len(self.feature) + 1
        self.feature[node], self.threshold[node], self.cut[node], self.gain[node] = feature, threshold, cut, gain
        self.left[node], self.right[node] = children
        for _ in children:
            for name, start in (("feature", -1), ("threshold", 0.0), ("cut", 0), ("left", -1), ("right", -1)):
                getattr(self, name).append(start)
            for name in ("gain", "cover", "value"):
                getattr(self, name).append(0.0)
        return children

    def graft(self, node: int, sub: Tree) -> None:
        """Put a subtree in the place of a leaf."""
        at = len(self.feature) - 1  # where the subtree's node 0 would be
        for name in ("left", "right"):
            moved = [x + at if x > 0 else -1 for x in getattr(sub, name)]
            getattr(self, name)[node] = moved[0]
            getattr(self, name).extend(moved[1:])
        for name in ("feature", "threshold", "cut", "gain", "cover", "value"):
            getattr(self, name)[node] = getattr(sub, name)[0]
            getattr(self, name).extend(getattr(sub, name)[1:])

    def by_level(self) -> Tree:
        """The same tree, its nodes numbered level by level, as arrays."""
        order = [0]
        for node in order:  # grows as it goes
            if self.feature[node] >= 0:
                order += (self.left[node], self.right[node])
        place = np.full(len(self.feature) + 1, -1)
        place[order] = np.arange(len(order))
        names = ("feature", "threshold", "cut", "gain", "cover", "value")
        moved = {n: place[np.array(getattr(self, n))[order]] for n in ("left", "right")}
        return Tree(**{n: np.array(getattr(self, n))[order] for n in names}, **moved)

    def columns(self, by_bin: bool) -> tuple[np.ndarray, ...]:
        bounds = self.cut if by_bin else self.threshold
        return tuple(np.array(c) for c in (self.feature, bounds, self.left, self.right, self.value))


@dataclass
class Boosted:
    """Trees in the order grown: all classes of round 0, then of round 1, .. They are in the list, or in a table of nodes."""

    trees: list[Tree]
    outputs: int  # 1 for two classes
    eta: float
    path: str | None = None  # of the table, see `node_table`; trees that are not written yet are in the list
    written: int = 0  # trees
    parts: int = 0

    def settle(self, spark: SparkSession, beside: _Beside, whole: bool = False) -> None:
        """Move the trees from the list to the table once they are many, or ``whole`` if the model is complete.

        A part is written while the next trees are grown; all are there once the model is complete.
        """
        if self.path and self.trees and (whole or sum(len(t.feature) for t in self.trees) >= STORED_NODES):
            beside.run(_write_part, spark, self.trees, self.written, f"{self.path}/part={self.parts}")
            self.written, self.parts, self.trees = self.written + len(self.trees), self.parts + 1, []
        if whole:
            beside.wait()


class _Beside:
    """One call at a time that runs beside its caller; the next call, or `wait`, raises what it raised."""

    def __init__(self) -> None:
        self.thread: InheritableThread | None = None
        self.error: BaseException | None = None

    def run(self, call: Callable, *given) -> None:
        def kept() -> None:
            try:
                call(*given)
            except BaseException as error:
                self.error = error

        self.wait()
        self.thread = InheritableThread(target=kept)
        self.thread.start()

    def wait(self) -> None:
        if self.thread is not None:
            self.thread.join()
            self.thread = None
        if self.error is not None:
            error, self.error = self.error, None
            raise error


def _write_part(spark: SparkSession, trees: list[Tree], first: int, path: str) -> None:
    spark.createDataFrame(_node_columns(trees, first)).write.parquet(path)


def _leaf(columns: tuple[np.ndarray, ...], rows: np.ndarray) -> np.ndarray:
    """The node every row ends in. Rows that stand column by column in memory are not copied."""
    feature, bound, left, right, _ = columns
    node, at, here = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), np.arange(len(rows))
    values, inner, own = rows.ravel(order="F"), feature >= 0, np.arange(len(feature))
    line = np.where(inner, feature, 0).astype(np.int64) * len(rows)
    children = np.where(inner[:, None], np.column_stack([left, right]), own[:, None]).ravel()  # a leaf leads to itself
    while True:
        going = inner[at]
        n = np.count_nonzero(going)
        if n <= KEPT_SHARE * len(at):  # those that have arrived are no longer led along
            node[here] = at
            going = np.flatnonzero(going)
            at, here = at[going], here[going]
        if not n:
            return node
        at = children[2 * at + (values[line[at] + here] > bound[at])]


def _add_trees(margins: np.ndarray, trees: Sequence[tuple], rows: np.ndarray) -> np.ndarray:
    rows = np.asfortranarray(rows)
    for i, columns in enumerate(trees):
        margins[:, i % margins.shape[1]] += columns[4][_leaf(columns, rows)]
    return margins


@dataclass
class _Coded:
    """Trees whose bounds are places among all bounds of a feature, so that rows between the same bounds are equal."""

    edges: list[np.ndarray]
    trees: list[tuple]
    used: list[tuple]  # the features of each tree
    shared: Counter  # how many trees have them

    @classmethod
    def of(cls, trees: Sequence[tuple]) -> _Coded:
        feature, bound = (np.concatenate([np.empty(0), *(t[i] for t in trees)]) for i in (0, 1))
        edges, code = [], np.zeros(len(feature), np.int64)
        for f in range(int(feature.max(initial=-1)) + 1):
            own = np.flatnonzero(feature == f)
            found, code[own] = np.unique(bound[own], return_inverse=True)
            edges.append(found)
        code = code.astype(np.uint8 if max(map(len, edges), default=0) < 256 else np.int64)
        codes = np.split(code, np.cumsum([len(t[0]) for t in trees])[:-1])
        used = [tuple(np.flatnonzero(np.bincount(t[0] + 1)[1:]).tolist()) for t in trees]
        return cls(edges, [(t[0], c, *t[2:]) for t, c in zip(trees, codes)], used, Counter(used))

    def add(self, margins: np.ndarray, x: np.ndarray) -> np.ndarray:
        """`_add_trees`; rows that are equal in the features of many trees are led through these as one."""
        kind = self.trees[0][1].dtype if self.trees else np.uint8
        lines = np.empty((len(self.edges), len(x)), kind)
        for f, found in enumerate(self.edges):
            lines[f] = np.searchsorted(found, x[:, f], side="left")
        merged = {u: _equal(lines, u) for u, n in self.shared.items() if n >= MERGED_TREES and u}
        for i, (columns, used) in enumerate(zip(self.trees, self.used)):
            some, at = merged.get(used, (lines, None))
            value = columns[4][_leaf(columns, some.T)]
            margins[:, i % margins.shape[1]] += value if at is None else value[at]
        return margins


def _equal(lines: np.ndarray, used: Sequence[int], share: float = 0.75) -> tuple[np.ndarray, np.ndarray | None]:
    """The columns of ``lines`` that differ in the ``used`` lines, and where each column's are; all of them, and None, if
    they are more than that share."""
    order = np.lexsort(lines[list(used)])
    held = lines[:, order]
    begins = np.append(np.ones(min(1, len(order)), bool), (held[list(used), 1:] != held[list(used), :-1]).any(axis=0))
    if begins.sum() > share * len(order):
        return lines, None
    at = np.empty(len(order), np.int32)
    at[order] = np.cumsum(begins) - 1
    return np.ascontiguousarray(held[:, begins]), at


def _probabilities(margins: np.ndarray) -> np.ndarray:
    if margins.shape[1] == 1:
        p = 1.0 / (1.0 + np.exp(-np.clip(margins, -700, 700)))
        return np.hstack([1.0 - p, p])
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _derivatives(margins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the loss, one column per output."""
    p = _probabilities(margins)
    if margins.shape[1] == 1:
        return p[:, 1:] - y[:, None], p[:, 1:] * p[:, :1]
    return p - np.eye(p.shape[1])[y], 2.0 * p * (1.0 - p)


def _drawn(keys: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """A repeatable draw of rows: a mixed hash of key and the tree's number against the share."""
    keys, drawn = keys.astype(np.int64, copy=False).view(np.uint64), np.empty(len(keys), bool)
    start = np.uint64(((tree + 1) * 0x9E3779B97F4A7C15 + seed) % 2**64)
    held, moved = np.empty((2, min(len(keys), DRAWN_ROWS)), np.uint64)
    for begin in range(0, len(keys), DRAWN_ROWS):  # numbers that stay in the processor's cache
        some = keys[begin : begin + DRAWN_ROWS]
        x, shifted = held[: len(some)], moved[: len(some)]
        np.add(some, start, out=x)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            np.right_shift(x, np.uint64(shift), out=shifted)
            x ^= shifted
            x *= np.uint64(factor)
        np.right_shift(x, np.uint64(31), out=shifted)
        x ^= shifted
        x >>= np.uint64(11)
        np.less(x, np.uint64(int(share * 2**53)), out=drawn[begin : begin + len(some)])
    return drawn


def bin_edges(df: DataFrame, features: str, max_bins: int, accuracy: int = SKETCH_ACCURACY) -> list[np.ndarray]:
    """Approximate quantiles per feature, from sketches that combine on the map side; their error is 1 / ``accuracy``."""
    quantiles = [i / max_bins for i in range(1, max_bins)]
    long = df.select(F.posexplode(F.col(features).cast("array<double>")).alias("feature", "x"))
    cuts = F.percentile_approx("x", quantiles, accuracy)
    rows = long.groupBy("feature").agg(cuts.alias("cuts")).orderBy("feature").collect()  # one row per feature
    return [np.unique(np.array(r["cuts"])) for r in rows]


def _binned(df: DataFrame, id_col: str, features: str, label: str, edges: list[np.ndarray], outputs: int) -> DataFrame:
    rows = df.select(
        F.xxhash64(id_col).alias("key"),
        F.col(features).cast("array<double>").alias("features"),
        F.col(label).cast("int").alias("label"),
    )

    def to_bins(batches):
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("features"))
                held = {
                    "key": batch.column("key").to_numpy(zero_copy_only=False),
                    "bins": np.column_stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)]),
                    "label": batch.column("label").to_numpy(zero_copy_only=False),
                    "margin": np.zeros((len(x), outputs)),
                }
                yield block(held, STATE)

    return rows.mapInArrow(to_bins, block_schema(STATE))


# What a block of training rows holds: a bin is one byte, a margin per output.
STATE = {"key": np.int64, "bins": np.uint8, "label": np.int32, "margin": np.float64}


def _state_blocks(batches, pending):
    """Every block with its margins brought up to date."""
    for held in blocks(batches, STATE):
        yield {**held, "margin": _add_trees(held["margin"].copy(), pending, held["bins"])}


def _with_margins(state: DataFrame, pending: list[tuple]) -> DataFrame:
    """The state with the trees grown since added to its margins, written anew."""
    shared = state.sparkSession.sparkContext.broadcast(pending)

    def update(batches):
        for held in _state_blocks(batches, shared.value):
            yield block(held, STATE)

    return written(state.mapInArrow(update, block_schema(STATE)), "margins")


HISTOGRAM = T.StructType(
    [
        *[T.StructField(c, T.IntegerType()) for c in ("tree", "node", "feature", "bin")],
        *[T.StructField(c, T.DoubleType()) for c in ("g", "h", "n")],
    ]
)


def _merged(cells: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of several blocks ([3, cells] each) added by cell."""
    seen, at = np.unique(np.concatenate(cells), return_inverse=True)
    return seen, np.stack([np.bincount(at, w) for w in np.concatenate(sums, axis=1)])


def _open_rows(held, growing, nodes, number: int, seed: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """A block's drawn rows that are in open nodes, and the place of each one's node among ``nodes``."""
    slot_of = np.full(len(growing[0]), -1)
    slot_of[nodes] = np.arange(len(nodes))
    slot = slot_of[_leaf(growing, held["bins"])]
    rows = np.nonzero(_drawn(held["key"][:, 0], number, seed, share) & (slot >= 0))[0]
    return rows, slot[rows]


def _histogram(state: DataFrame, pending, growing, measured, columns, settings: BoostingSettings, round_: int):
    """Partial sums ``(tree, node, feature, bin, g, h, n)`` for the ``measured`` nodes, added up over all blocks of a task."""
    shared = state.sparkSession.sparkContext.broadcast((pending, growing, measured, columns))
    bins_max, seed, subsample = settings.max_bins, settings.seed, settings.subsample

    def emit(tree, nodes, used, cells, sums):
        slot, rest = np.divmod(cells, len(used) * bins_max)
        feature, bin_ = np.divmod(rest, bins_max)
        ids = [np.full(len(cells), tree), np.array(nodes)[slot], np.array(used)[feature], bin_]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(i.astype(np.int32)) for i in ids), *(pa.array(w) for w in sums)], names=HISTOGRAM.names
        )

    def sums(batches):
        pending, growing, measured, columns = shared.value
        dense: dict[int, np.ndarray] = {}
        sparse: dict[int, tuple[list, list]] = {}
        for held in _state_blocks(batches, pending):
            bins = held["bins"]
            g, h = _derivatives(held["margin"], held["label"][:, 0])
            for tree, nodes in measured.items():
                used = columns[tree]
                rows, slot = _open_rows(held, growing[tree], nodes, round_ * held["margin"].shape[1] + tree, seed, subsample)
                cells = (slot[:, None] * len(used) + np.arange(len(used))) * bins_max + bins[np.ix_(rows, used)]
                flat, size = cells.ravel(), len(nodes) * len(used) * bins_max
                weights = [np.repeat(d, len(used)) for d in (g[rows, tree], h[rows, tree], np.ones(len(rows)))]
                if size <= DENSE_CELLS:
                    part = np.stack([np.bincount(flat, w, size) for w in weights])
                    dense[tree] = dense[tree] + part if tree in dense else part
                elif len(flat):
                    found, parts = sparse.setdefault(tree, ([], []))
                    found.append(flat)
                    parts.append(np.stack(weights))
                    if sum(map(len, found)) > DENSE_CELLS:
                        merged = _merged(found, parts)
                        sparse[tree] = ([merged[0]], [merged[1]])
                        if len(merged[0]) > DENSE_CELLS // 2:  # more different cells than a task should hold
                            yield emit(tree, nodes, used, *merged)
                            del sparse[tree]
        for tree, part in dense.items():
            cells = np.nonzero(part[2])[0]
            if len(cells):
                yield emit(tree, measured[tree], columns[tree], cells, part[:, cells])
        for tree, (found, parts) in sparse.items():
            yield emit(tree, measured[tree], columns[tree], *_merged(found, parts))

    return state.mapInArrow(sums, HISTOGRAM)


# Two siblings of the level to come: the measured one, and which of them are open.
SIBLINGS = T.StructType(
    [
        *[T.StructField(c, T.IntegerType()) for c in ("tree", "parent", "node", "sibling")],
        *[T.StructField(c, T.BooleanType()) for c in ("node_open", "sibling_open")],
    ]
)


def _level_cells(partial: DataFrame, above: DataFrame | None, siblings: list[dict]) -> DataFrame:
    """``(tree, parent, feature, node, bin, g, h, n)``: the sums of all open nodes of a level.

    ``partial`` has those of one child of each parent, ``above`` the cells of the level before. Both are brought together
    by parent and feature in one shuffle, which the running sums of the gains then use as well. ``siblings`` has one row
    per split node, which the driver holds as part of the trees. Counts are whole numbers, so cells that are empty after
    the subtraction are known exactly and go. Rows are in order before they are added up, so that sums are the same to the
    last bit in whatever order the tasks' parts arrive.
    """
    place, sums = ["tree", "parent", "feature"], ("g", "h", "n")
    if above is None:
        rows = partial.withColumn("parent", F.col("node")).repartition(*place).sortWithinPartitions(*place, "node", "bin", *sums)
        return rows.groupBy(*place, "node", "bin").agg(*[F.sum(c).alias(c) for c in sums])
    pairs = F.broadcast(local_table(partial.sparkSession, siblings, SIBLINGS))
    none = F.lit(0.0)
    found = partial.join(pairs.select("tree", "node", "parent"), ["tree", "node"]).select(
        *place, "bin", *sums, *[none.alias(f"all_{c}") for c in sums]
    )
    parents = above.select("tree", F.col("node").alias("parent"), "feature", "bin", *[none.alias(c) for c in sums], *[F.col(c).alias(f"all_{c}") for c in sums])
    kept = parents.join(pairs.select("tree", "parent"), ["tree", "parent"], "left_semi")
    every = (*sums, *(f"all_{c}" for c in sums))
    both = found.unionByName(kept).repartition(*place).sortWithinPartitions(*place, "bin", *every).groupBy(*place, "bin")
    both = both.agg(*[F.sum(c).alias(c) for c in every]).join(pairs, ["tree", "parent"])
    own = F.struct("node", F.col("node_open").alias("open"), *sums)
    rest = [(F.col(f"all_{c}") - F.col(c)).alias(c) for c in sums]
    other = F.struct(F.col("sibling").alias("node"), F.col("sibling_open").alias("open"), *rest)
    cells = both.select(*place, "bin", F.inline(F.array(own, other)))
    return cells.where("open and n > 0").select(*place, "node", "bin", *sums)


def split_gains(histogram: DataFrame, settings: BoostingSettings = MULTICLASS) -> DataFrame:
    """Gain of every split "bin <= b" of ``(tree, node, feature, bin, g, h)`` sums.

    Both the sums per bin and the running sums need rows of one tree, node and
    feature together, so one shuffle of the partial histograms serves both.
    """
    place = ["tree", "node", "feature"]
    sums = [F.sum(c).alias(c) for c in ("g", "h", *("n",) * ("n" in histogram.columns))]
    return _cell_gains(histogram.repartition(*place).groupBy(*place, "bin").agg(*sums), place, settings)


def _cell_gains(cells: DataFrame, place: list[str], settings: BoostingSettings) -> DataFrame:
    counted = "n" in cells.columns
    upto = Window.partitionBy(*place).orderBy("bin")
    whole = Window.partitionBy(*place)
    running = cells.select(
        "tree",
        "node",
        "feature",
        "bin",
        F.sum("g").over(upto).alias("g_left"),
        F.sum("h").over(upto).alias("h_left"),
        F.sum("g").over(whole).alias("g_all"),
        F.sum("h").over(whole).alias("h_all"),
        *[F.sum("n").over(w).alias(name) for w, name in ((upto, "n_left"), (whole, "n_all")) if counted],
    )

    def score(g, h):
        return g * g / (h + settings.reg_lambda)

    left, right = score(F.col("g_left"), F.col("h_left")), score(
        F.col("g_all") - F.col("g_left"), F.col("h_all") - F.col("h_left")
    )
    gain = 0.5 * (left + right - score(F.col("g_all"), F.col("h_all"))) - settings.gamma
    heavy = F.least(F.col("h_left"), F.col("h_all") - F.col("h_left")) >= settings.min_child_weight
    return running.withColumn("gain", F.when(heavy, gain))


def best_splits(gains: DataFrame) -> DataFrame:
    """The best split per open node, and the node's sums even if it has none."""
    order = F.struct(F.round("gain", GAIN_DIGITS), -F.col("feature"), -F.col("bin"))
    counts = [c for c in ("n_left", "n_all") if c in gains.columns]
    best = F.max_by(F.struct("feature", "bin", "gain", "g_left", "h_left", "g_all", "h_all", *counts), order)
    return gains.groupBy("tree", "node").agg(best.alias("b")).select("tree", "node", "b.*")


def fit_boosted(
    train: DataFrame,
    id_col: str,
    features: str = "features",
    label: str = "label",
    n_classes: int = 2,
    settings: BoostingSettings | None = None,
    accuracy: int = SKETCH_ACCURACY,
    edges: list[np.ndarray] | None = None,
    store: str | None = None,
    **changes,
) -> Boosted:
    """Boost ``settings.rounds`` rounds; two classes use one logistic output.

    ``accuracy`` is that of the quantile sketches behind the bins: ranks of bin
    edges are off by at most rows / ``accuracy``. ``edges`` are used instead,
    if given: per feature, the values up to which a bin reaches. With ``store``,
    a new path, finished trees go to a table of nodes there, so what the driver
    holds does not grow with the rounds.
    """
    settings = replace(settings or (BINARY if n_classes == 2 else MULTICLASS), **changes)
    if not 2 <= settings.max_bins <= 256:
        raise ValueError("max_bins must fit one byte")
    outputs = 1 if n_classes == 2 else n_classes
    edges = edges or bin_edges(train, features, settings.max_bins, accuracy)
    state = written(_binned(train, id_col, features, label, edges, outputs), "binned")
    rng = np.random.default_rng(settings.seed)
    used = max(1, int(len(edges) * settings.colsample))
    row_bytes = len(edges) + 24 * outputs + 80  # bins, margins and derivatives, and the numbers of a level
    most = 8 * LOCAL_VALUES // row_bytes  # rows of a node that a task finishes
    model, spark, beside = Boosted([], outputs, settings.eta, store), train.sparkSession, _Beside()

    def drawn_columns() -> list[np.ndarray]:
        return [np.sort(rng.choice(len(edges), used, replace=False)) for _ in range(outputs)]

    n_rows = state.agg(F.sum("rows")).head()[0] or 0
    if n_rows <= most:
        spread = outputs > 1 and n_rows * len(edges) * outputs > SPREAD_VALUES
        (_spread_table if spread else _small_table)(state, model, drawn_columns, edges, settings, beside)
        discard(state)
        model.settle(spark, beside, whole=True)
        return model
    pending: list[tuple] = []
    for round_ in range(settings.rounds):
        trees = [Tree() for _ in range(outputs)]
        columns = drawn_columns()
        measured: dict[int, list[int]] = {t: [0] for t in range(outputs)}
        siblings: list[dict] = []
        levels: list[DataFrame] = []  # kept for the length of a round, found again from the blocks if an executor is lost
        growing = [t.columns(by_bin=True) for t in trees]
        for depth in range(settings.max_depth):
            partial = _histogram(state, pending, growing, measured, columns, settings, round_)
            cells = _level_cells(partial, levels[-1] if levels else None, siblings).persist(StorageLevel.MEMORY_AND_DISK)
            levels.append(cells)
            gains = _cell_gains(cells, ["tree", "parent", "feature", "node"], settings)
            found = best_splits(gains).collect()  # one row per open node
            left = settings.max_depth - depth - 1
            siblings, small = _grow(trees, found, edges, settings, most, last=not left)
            growing = [t.columns(by_bin=True) for t in trees]  # before small nodes are finished: they may be measured for a sibling
            if small:
                _finish(state, pending, trees, small, columns, edges, settings, round_, left)
            if not siblings:
                break
            measured = {}
            for pair in siblings:
                measured.setdefault(pair["tree"], []).append(pair["node"])
        for cells in levels:
            cells.unpersist()
        trees = [t.by_level() for t in trees]
        model.trees += trees
        model.settle(spark, beside)
        pending += [t.columns(by_bin=True) for t in trees]
        if len(pending) >= MARGIN_ROUNDS * outputs and round_ + 1 < settings.rounds:
            before, (state, pending) = state, (_with_margins(state, pending), [])
            discard(before)
    discard(state)
    model.settle(spark, beside, whole=True)
    return model


def _level(cover: np.ndarray, value: np.ndarray) -> dict[str, np.ndarray]:
    """The columns of a level of leaves, thresholds left out."""
    n = len(cover)
    made = {"feature": np.full(n, -1), "cut": np.zeros(n, np.int64), "left": np.full(n, -1), "right": np.full(n, -1)}
    return made | {"gain": np.zeros(n), "cover": cover, "value": value}


@dataclass
class _Rows:
    """Rows of open nodes: a line of bins per drawn feature, those with weight first.

    Rows of a large node that went to a child stay behind, marked, until they are most; ``cells`` has the node's sums.
    """

    columns: list[np.ndarray]
    g: np.ndarray
    h: np.ndarray
    place: np.ndarray  # which rows of the table they are
    here: np.ndarray  # false for those that went
    n: int  # how many are here
    cells: np.ndarray | None = None

    @classmethod
    def of(cls, columns: list[np.ndarray], g: np.ndarray, h: np.ndarray, place: np.ndarray) -> _Rows:
        return cls(columns, g, h, place, np.ones(len(place), bool), len(place))

    @classmethod
    def joined(cls, held: Sequence[_Rows]) -> _Rows:
        def side_by_side(lines):
            return np.concatenate([x[: len(r.g)] for r, x in zip(held, lines)] + [x[len(r.g) :] for r, x in zip(held, lines)])

        columns = [side_by_side(lines) for lines in zip(*(r.columns for r in held))]
        return cls.of(columns, *(np.concatenate([getattr(r, n) for r in held]) for n in "gh"), side_by_side([r.place for r in held]))

    def taken(self, which: np.ndarray) -> _Rows:
        own = which[: np.searchsorted(which, len(self.g))]
        return _Rows.of([c.take(which) for c in self.columns], self.g.take(own), self.h.take(own), self.place.take(which))

    def kept(self) -> _Rows:
        return self if self.n == len(self.here) else self.taken(np.flatnonzero(self.here))

    def places(self) -> np.ndarray:
        return self.place if self.n == len(self.here) else self.place.take(np.flatnonzero(self.here))

    def measured(self, lanes: np.ndarray, size: int) -> np.ndarray:
        """Sums of g and of h, and counts, per feature and bin. Neighbouring rows add to different lanes: additions to one
        cell wait for each other, and rows of few values, or in order, would all add to one."""
        n, cells = len(self.g), LANES * size
        sums = np.empty((3, len(self.columns), cells))
        for i, column in enumerate(self.columns):
            key = column[:n] + lanes[:n]
            sums[:, i] = np.bincount(key, self.g, cells), np.bincount(key, self.h, cells), np.bincount(key, None, cells)
        return sums.reshape(3, -1, LANES, size).sum(axis=2)

    def split(self, column: int, cut: int) -> tuple[_Rows, _Rows, bool]:
        """The smaller child's rows, the larger one's, and whether the smaller is the right one."""
        going = self.columns[column] > cut
        going &= self.here
        right = 2 * int(np.count_nonzero(going)) <= self.n
        if not right:
            going = self.here > going
        which = np.flatnonzero(going)
        self.here ^= going
        self.n -= len(which)
        return self.taken(which), self.kept() if 2 * self.n < len(self.here) else self, right


def _exact_gain(g_left, h_left, g_all, h_all, rest, settings: BoostingSettings) -> np.ndarray:
    shrink = settings.reg_lambda
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g_left * g_left / (h_left + shrink) + (g_all - g_left) ** 2 / (rest + shrink) - g_all * g_all / (h_all + shrink)
    return 0.5 * gain - settings.gamma


def _best_of_cells(cells: np.ndarray, settings: BoostingSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of nodes by their sums [node, (g, h, n), feature, bin]: the best split's feature and bin, and per node its rounded
    gain, 0 if there is none, the sums left of it and in all, the gain itself."""
    (g_left, h_left) = (cells[:, i].cumsum(axis=-1) for i in (0, 1))
    g_all, h_all = g_left[..., -1:], h_left[..., -1:]
    rest = h_all - h_left
    exact = _exact_gain(g_left, h_left, g_all, h_all, rest, settings)
    gain = np.where(np.minimum(h_left, rest) >= settings.min_child_weight, np.round(exact, GAIN_DIGITS), -np.inf)
    tops = gain.max(axis=-1)
    tops[~(tops > 0)] = 0
    node, column = np.arange(len(cells)), tops.argmax(axis=1)  # of equal gains that of the lower feature, then of the lower bin
    top = tops[node, column]
    cut = (gain[node, column] == top[:, None]).argmax(axis=1)
    at = node, column, cut
    return column, cut, np.stack([top, g_left[at], h_left[at], g_all[node, column, 0], h_all[node, column, 0], exact[at]])


def _split_cells(slot, n: int, bins, size: int, g, h, settings: BoostingSettings):
    """Every cell (slot, bin) that has rows and may end a split: slots in order, bins, the sums left of and in all, and h right of it."""
    key = slot * size + bins
    if n * size <= MARKED_SHARE * len(key) + MARKED_CELLS:
        held = np.zeros(n * size, bool)
        held[key] = True
        seen = np.flatnonzero(held)
        number = np.empty(n * size, np.int32)
        number[seen] = np.arange(len(seen))
        at = number.take(key)
    else:
        seen, at = np.unique(key, return_inverse=True)
    of = seen // size
    begins = np.diff(of, prepend=-1) != 0
    first, group = np.flatnonzero(begins), np.cumsum(begins) - 1
    running, whole = [], []  # running sums restart with each slot
    for weight in (g, h):
        cell = np.bincount(at, weight, len(seen))
        upto = np.cumsum(cell)
        running.append(upto - (upto[first] - cell[first])[group])
        whole.append(np.add.reduceat(cell, first))
    rest = whole[1][group] - running[1]
    heavy = np.flatnonzero(np.minimum(running[1], rest) >= settings.min_child_weight)
    group = group[heavy]
    return of[heavy], seen[heavy] % size, running[0][heavy], running[1][heavy], whole[0][group], whole[1][group], rest[heavy]


def _best_of_rows(slot: np.ndarray, n: int, rows: _Rows, size: int, settings: BoostingSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`_best_of_cells` of ``n`` nodes by their rows; ``slot`` says which node a row is in."""
    best, cut_of, column_of = np.zeros((6, n)), np.zeros(n, np.int64), np.zeros(n, np.int64)
    own = len(rows.g)
    width = max(1, TOGETHER // max(1, own))  # features at once
    for begin in range(0, len(rows.columns) if own else 0, width):
        some = [c[:own] for c in rows.columns[begin : begin + width]]
        k = len(some)
        line = (slot[:own] * k + np.arange(k)[:, None]).ravel()  # a slot per node and feature
        cells = _split_cells(line, n * k, np.concatenate(some), size, np.tile(rows.g, k), np.tile(rows.h, k), settings)
        of, cut, *sums = cells
        if not len(of):
            continue
        exact = _exact_gain(*sums, settings)
        gain = np.round(exact, GAIN_DIGITS)
        begins = np.flatnonzero(np.diff(of, prepend=-1))
        tops = np.full(n * k, -np.inf)
        tops[of[begins]] = np.maximum.reduceat(gain, begins)
        tops = tops.reshape(n, k)
        tops[~(tops > best[0][:, None])] = -np.inf  # of equal gains that of the lower feature stays, then that of the lower bin
        better = np.flatnonzero((tops > -np.inf).any(axis=1))
        column = tops[better].argmax(axis=1)
        wanted = np.full((n, k), np.inf)
        wanted[better, column] = tops[better, column]
        hit = np.flatnonzero(gain == wanted.ravel()[of])
        hit = hit[np.flatnonzero(np.diff(of[hit], prepend=-1))]
        best[:, better] = gain[hit], *(c[hit] for c in sums[:4]), exact[hit]
        cut_of[better], column_of[better] = cut[hit], begin + column
    return column_of, cut_of, best


def _subtree(bins: np.ndarray, g: np.ndarray, h: np.ndarray, used: np.ndarray, depth: int, settings: BoostingSettings) -> tuple[Tree, np.ndarray]:
    """The tree that `split_gains` and `best_splits` would grow from a node's rows, without thresholds, and every row's leaf.

    ``bins`` has a line per feature. Rows without weight are only led to their leaves; they stand behind the others. Nodes
    are numbered level by level. A node whose weight is not enough for two children is a leaf, its rows are left behind.

    A node of many rows is held by itself, with its sums per bin. Only the rows of its smaller child are looked up, moved and
    measured; the larger child keeps the arrays, its sums are those of the node less the measured ones, and counts tell
    which of them are none. Nodes of few rows are held together, and measured by all their rows.
    """
    shrink, least, n_rows = settings.reg_lambda, settings.min_child_weight, bins.shape[1]
    total = float(h.sum())
    levels = [_level(np.array([total]), np.array([-settings.eta * float(g.sum()) / (total + shrink)]))]
    weighed = (g != 0) | (h != 0)
    own = np.flatnonzero(weighed)
    place = np.concatenate([own, np.flatnonzero(~weighed)])
    leaf = np.zeros(n_rows, np.int64)
    root = _Rows.of([bins[f].take(place) for f in used], g.take(own), h.take(own), place)
    size = max((int(c.max()) + 1 for c in root.columns if n_rows), default=1)
    lanes = np.resize(size * np.arange(LANES), len(own))
    many = max(LARGE_ROWS, LARGE_ROWS_A_FEATURE * len(used))
    first, places = 0, np.zeros(1, np.int64)  # the level's first node, and which of the level's nodes are open
    large: list[tuple[int, _Rows]] = []  # open nodes of many rows, by their place among the open ones
    few, few_rows, slot = places, root, np.zeros(n_rows, np.int64)  # the other open ones, their rows, and the one each is in
    if n_rows >= many:
        root.cells = root.measured(lanes, size)
        large, few, few_rows, slot = [(0, root)], places[:0], root.taken(places[:0]), slot[:0]
    for left_over in range(depth, 0, -1):
        n = len(places)
        best = np.zeros((6, n))  # per open node the rounded gain, the sums left of the split and in all, the gain itself
        cut_of, column_of = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if len(few):
            column_of[few], cut_of[few], best[:, few] = _best_of_rows(slot, len(few), few_rows, size, settings)
        at_once = max(1, TOGETHER // (len(used) * size))
        for begin in range(0, len(large), at_once):
            some = large[begin : begin + at_once]
            at = [to for to, _ in some]
            column_of[at], cut_of[at], best[:, at] = _best_of_cells(np.stack([rows.cells for _, rows in some]), settings)
        parts = np.flatnonzero(best[0] > 0)
        if not len(parts):
            break
        above, begin = levels[-1], first + len(levels[-1]["feature"])
        children = begin + 2 * np.arange(len(parts))
        _, g_left, h_left, g_all, h_all, exact = best[:, parts]
        made = {"feature": used[column_of[parts]], "cut": cut_of[parts], "left": children, "right": children + 1, "gain": exact}
        for name, values in made.items():
            above[name][places[parts]] = values
        g_of, h_of = (np.column_stack([left, whole - left]).ravel() for left, whole in ((g_left, g_all), (h_left, h_all)))
        with np.errstate(divide="ignore", invalid="ignore"):
            levels.append(_level(h_of, -settings.eta * g_of / (h_of + shrink)))
        goes_to = first + places
        goes_to[parts] = children
        cut_of[best[0] <= 0] = 256  # no bin is over 255
        opened = np.flatnonzero(h_of >= 2 * least * (1 - 1e-9)) if left_over > 1 else np.empty(0, np.int64)
        open_of = np.full(begin + len(h_of), -1)
        open_of[begin + opened] = np.arange(len(opened))

        before, large = large, []
        came: list[tuple[int, _Rows]] = []
        for at, rows in before:
            node, column, cut = int(goes_to[at]), int(column_of[at]), int(cut_of[at])
            if cut > 255:
                leaf[rows.places()] = node
                continue
            if open_of[node] < 0 and open_of[node + 1] < 0:
                rows = rows.kept()
                leaf[rows.place] = node + (rows.columns[column] > cut)
                continue
            cells = rows.cells
            less, more, right = rows.split(column, cut)
            pair = (less, node + right), (more, node + (not right))
            if any(rows.n >= many and open_of[its] >= 0 for rows, its in pair):
                less.cells = less.measured(lanes, size)
                more.cells = np.where(cells[2] > less.cells[2], cells - less.cells, 0)
            for rows, its in pair:
                if open_of[its] < 0:
                    leaf[rows.places()] = its
                else:
                    (large if rows.n >= many else came).append((int(open_of[its]), rows))
        is_few = np.ones(len(opened), bool)
        is_few[[to for to, _ in large]] = False
        slot_of = np.full(len(opened) + 1, -1)  # the last one is that of closed nodes
        next_few = np.flatnonzero(is_few)
        slot_of[next_few] = np.arange(len(next_few))
        if len(slot):
            at = few[slot]
            node = goes_to[at] + (np.concatenate(few_rows.columns)[column_of[at] * len(slot) + np.arange(len(slot))] > cut_of[at])
            slot = slot_of[open_of[node]]
            gone = np.flatnonzero(slot < 0)
            if len(gone):
                leaf[few_rows.place[gone]] = node[gone]
                keep = np.flatnonzero(slot >= 0)
                few_rows, slot = few_rows.taken(keep), slot[keep]
        if came:
            held = [few_rows, *(rows.kept() for _, rows in came)]
            slots = [slot, *(np.full(rows.n, slot_of[to]) for to, rows in came)]
            few_rows = _Rows.joined(held)
            slot = np.concatenate([x[: len(r.g)] for r, x in zip(held, slots)] + [x[len(r.g) :] for r, x in zip(held, slots)])
        first, places, few = begin, opened, next_few
        if not len(places):
            break
    if len(places):  # nothing was split: all open nodes are leaves
        for at, rows in large:
            leaf[rows.places()] = first + places[at]
        leaf[few_rows.place] = first + places[few[slot]]
    return Tree(threshold=None, **{n: np.concatenate([of_level[n] for of_level in levels]) for n in levels[0]}), leaf


# A grown tree as it leaves a task: its columns but for the thresholds.
GROWN_DDL = "struct<feature:array<int>,cut:array<int>,left:array<int>,right:array<int>,gain:array<double>,cover:array<double>,value:array<double>>"
GROWN = pa.struct([(c, pa.list_(pa.int32())) for c in ("feature", "cut", "left", "right")] + [(c, pa.list_(pa.float64())) for c in ("gain", "cover", "value")])


def _sent(tree: Tree) -> dict[str, list]:
    return {f.name: getattr(tree, f.name).tolist() for f in GROWN}


def _received(columns: dict[str, list], edges: list[np.ndarray]) -> Tree:
    """A tree that a task has grown, with its thresholds."""
    return Tree(threshold=_bounds(columns, edges).tolist(), **columns)


def _bounds(columns, edges: list[np.ndarray]) -> np.ndarray:
    feature, cut = (np.asarray(columns[n], np.int64) for n in ("feature", "cut"))
    bounds, inner = np.zeros(len(feature)), np.flatnonzero(feature >= 0)
    for f in np.unique(feature[inner]):
        own = inner[feature[inner] == f]
        bounds[own] = edges[f][cut[own]]
    return bounds


def _finish(state, pending, trees, small, columns, edges, settings: BoostingSettings, round_: int, depth: int) -> None:
    """Grow the subtrees of small nodes, each in the task that gets the node's rows."""
    spark, n_features = state.sparkSession, len(edges)
    shared = spark.sparkContext.broadcast((pending, [t.columns(by_bin=True) for t in trees], small, columns))

    def send(batches):
        pending, growing, small, _ = shared.value
        for held in _state_blocks(batches, pending):
            g, h = _derivatives(held["margin"], held["label"][:, 0])
            for tree, nodes in small.items():
                number = round_ * held["margin"].shape[1] + tree
                rows, slot = _open_rows(held, growing[tree], nodes, number, settings.seed, settings.subsample)
                raw = [held["bins"][r].tobytes() for r in rows.tolist()]
                arrays = [np.full(len(rows), tree, np.int32), np.array(nodes, np.int32)[slot], held["key"][rows, 0]]
                arrays = [*map(pa.array, arrays), pa.array(raw, pa.binary()), pa.array(g[rows, tree]), pa.array(h[rows, tree])]
                yield pa.RecordBatch.from_arrays(arrays, names=["tree", "node", "key", "bins", "g", "h"])

    def grow(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("bins", "ascending"), ("g", "ascending")])
        tree, node = table["tree"][0].as_py(), table["node"][0].as_py()
        bins = np.frombuffer(table["bins"].combine_chunks().buffers()[2], np.uint8)[: table.num_rows * n_features].reshape(-1, n_features)
        grown, _ = _subtree(bins.T, table["g"].to_numpy(), table["h"].to_numpy(), shared.value[3][tree], depth, settings)
        return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int32()), "grown": pa.array([_sent(grown)], GROWN)})

    rows = state.mapInArrow(send, "tree int, node int, key long, bins binary, g double, h double")
    for row in sorted(rows.groupBy("tree", "node").applyInArrow(grow, f"tree int, node int, grown {GROWN_DDL}").collect()):
        sub = _received(row["grown"].asDict(), edges)
        if sub.feature[0] >= 0:  # else the node stays the leaf that it is
            trees[row["tree"]].graft(row["node"], sub)


@dataclass
class _Units:
    """Rows of equal bins and label as one unit: a line of bins per feature, and every unit's rows side by side in ``key``."""

    bins: np.ndarray
    label: np.ndarray
    key: np.ndarray
    ends: np.ndarray  # the place after a unit's last row
    merged: dict[tuple, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # see `merge`

    @classmethod
    def of(cls, rows) -> Iterator[_Units]:
        """One or none, from the rows of a state; the order in which they come does not matter."""
        held = [[np.frombuffer(r[n], t).reshape(r["rows"], -1) for n, t in STATE.items() if n != "margin"] for r in rows]
        if held:
            key, bins, label = (np.concatenate(column) for column in zip(*held))
            order = np.lexsort([key[:, 0], label[:, 0], *bins.T])
            key, bins, label = key[order, 0], bins[order], label[order, 0]
            changes = (bins[1:] != bins[:-1]).any(axis=1) | (label[1:] != label[:-1])
            ends = np.append(np.flatnonzero(changes) + 1, len(key))
            yield cls(np.ascontiguousarray(bins[ends - 1].T), label[ends - 1], key, ends)

    def merge(self, n_used: int) -> _Units:
        """For every draw of ``n_used`` features, if there are few: the bins that differ in these, and where each unit's are.

        A tree cannot tell units apart that are equal in its features. Draws that leave over three quarters are not kept.
        """
        if comb(len(self.bins), n_used) <= MERGED_DRAWS:
            for used in combinations(range(len(self.bins)), n_used):
                bins, at = _equal(self.bins, used)
                if at is not None:
                    self.merged[used] = bins, at
        return self

    def grown(self, g: np.ndarray, h: np.ndarray, number: int, used: np.ndarray, settings: BoostingSettings) -> tuple[Tree, np.ndarray]:
        """The tree of that number, which says what rows are drawn, and every unit's leaf."""
        upto = np.cumsum(_drawn(self.key, number, settings.seed, settings.subsample))
        times = np.diff(upto[self.ends - 1], prepend=0).astype(float)
        g, h = times * g, times * h
        if tuple(used.tolist()) not in self.merged:
            return _subtree(self.bins, g, h, used, settings.max_depth, settings)
        bins, at = self.merged[tuple(used.tolist())]
        tree, leaf = _subtree(bins, *(np.bincount(at, weight, bins.shape[1]) for weight in (g, h)), used, settings.max_depth, settings)
        return tree, leaf[at]


def _small_table(state: DataFrame, model: Boosted, drawn_columns, edges: list[np.ndarray], settings: BoostingSettings, beside: _Beside) -> None:
    """All rounds of a table of few rows: tasks grow LOCAL_ROUNDS rounds one after the other, from the margins that the
    task before has handed on."""
    n_used = max(1, int(len(edges) * settings.colsample))
    whole = state.drop("margin").coalesce(1).rdd.mapPartitions(lambda rows: (units.merge(n_used) for units in _Units.of(rows)))
    whole.persist(StorageLevel.MEMORY_AND_DISK)
    margins: np.ndarray | None = None
    outputs = model.outputs
    for first in range(0, settings.rounds, LOCAL_ROUNDS):
        columns = [drawn_columns() for _ in range(min(LOCAL_ROUNDS, settings.rounds - first))]

        def grow(parts, first=first, columns=columns, given=margins):
            for units in parts:
                at = np.zeros((len(units.label), outputs)) if given is None else given
                made = []
                for n, used in enumerate(columns):
                    g, h = _derivatives(at, units.label)
                    at = at.copy()
                    for t in range(outputs):
                        tree, leaf = units.grown(g[:, t], h[:, t], (first + n) * outputs + t, used[t], settings)
                        at[:, t] += tree.value[leaf]
                        made.append(_grown_columns(tree))
                yield made, at

        for made, margins in state.sparkSession.sparkContext.runJob(whole, grow, [0]):
            model.trees += [Tree(threshold=_bounds(columns, edges), **columns) for columns in made]
            model.settle(state.sparkSession, beside)
    if margins is None:  # no rows, or no rounds
        model.trees += [Tree() for _ in range(settings.rounds * outputs)]
    whole.unpersist()


def _grown_columns(tree: Tree) -> dict[str, np.ndarray]:
    return {n: c for n, c in vars(tree).items() if n != "threshold"}


def _spread_table(state: DataFrame, model: Boosted, drawn_columns, edges: list[np.ndarray], settings: BoostingSettings, beside: _Beside) -> None:
    """A round is a job with a task per output. Each holds the table, which is small, brings the margins up to date with the
    trees grown since they were kept, and grows its output's tree; only trees travel."""
    outputs = model.outputs
    copies = state.drop("margin").rdd.flatMap(lambda row: [(t, row) for t in range(outputs)]).partitionBy(outputs, lambda t: t)

    def begun(rows):
        for units in _Units.of(rows):
            yield units, np.zeros((len(units.label), outputs))

    def with_trees(held: RDD, pending: list[tuple]) -> RDD:
        def added(parts):
            for units, margins in parts:
                yield units, _add_trees(margins.copy(), pending, units.bins.T)

        return held.mapPartitions(added).persist(StorageLevel.MEMORY_AND_DISK)

    held = copies.values().mapPartitions(begun).persist(StorageLevel.MEMORY_AND_DISK)
    before: RDD | None = None
    pending: list[tuple] = []
    for round_ in range(settings.rounds):
        if len(pending) >= SPREAD_ROUNDS * outputs:
            before, held, pending = held, with_trees(held, pending), []

        def grow(at, parts, round_=round_, columns=drawn_columns(), pending=pending):
            for units, margins in parts:
                g, h = _derivatives(_add_trees(margins.copy(), pending, units.bins.T), units.label)
                tree, _ = units.grown(g[:, at], h[:, at], round_ * outputs + at, columns[at], settings)
                yield at, _grown_columns(tree)

        made = sorted(held.mapPartitionsWithIndex(grow).collect(), key=lambda grown: grown[0])
        trees = [Tree(threshold=_bounds(columns, edges), **columns) for _, columns in made]
        model.trees += trees
        model.settle(state.sparkSession, beside)
        pending += [t.columns(by_bin=True) for t in trees]
        if before is not None:  # all tasks have read the generation that it led to
            before.unpersist()
            before = None
    held.unpersist()


def _grow(trees: list[Tree], found, edges, settings: BoostingSettings, most: int, last: bool):
    """Apply the best splits; returns the siblings of which one at least is open next, and the nodes of at most ``most`` rows."""
    siblings: list[dict] = []
    small: dict[int, list[int]] = {}

    def settle(tree: Tree, node: int, g: float, h: float) -> None:
        tree.value[node], tree.cover[node] = -settings.eta * g / (h + settings.reg_lambda), h

    for row in sorted(found, key=lambda r: (r["tree"], r["node"])):
        tree = trees[row["tree"]]
        settle(tree, row["node"], row["g_all"], row["h_all"])
        if row["gain"] is None or round(row["gain"], GAIN_DIGITS) <= 0:
            continue
        threshold = float(edges[row["feature"]][row["bin"]])
        left, right = tree.split(row["node"], row["feature"], threshold, row["bin"], row["gain"])
        settle(tree, left, row["g_left"], row["h_left"])
        settle(tree, right, row["g_all"] - row["g_left"], row["h_all"] - row["h_left"])
        if not last:
            sides = sorted([(row["n_left"], left), (row["n_all"] - row["n_left"], right)])  # the smaller one is measured
            for n, node in sides:
                if n <= most:
                    small.setdefault(row["tree"], []).append(node)
            (n, node), (n_other, other) = sides
            if n_other > most:
                siblings.append(
                    {"tree": row["tree"], "parent": row["node"], "node": node, "sibling": other, "node_open": n > most, "sibling_open": True}
                )
    return siblings, small


NODES = pa.schema(
    [(c, pa.int32()) for c in ("tree_id", "node_id", "feature", "cut", "left", "right")]
    + [(c, pa.float64()) for c in ("threshold", "gain", "cover", "value")]
)


def _node_columns(trees: Sequence[Tree], first: int) -> pa.Table:
    """The nodes of consecutive trees, the first of number ``first``."""
    sizes = [len(t.feature) for t in trees]
    held = {"tree_id": np.repeat(np.arange(first, first + len(trees)), sizes), "node_id": np.concatenate([np.arange(n) for n in sizes])}
    held |= {f.name: np.concatenate([np.asarray(getattr(t, f.name)) for t in trees]) for f in list(NODES)[2:]}
    return pa.table([pa.array(held[f.name], f.type) for f in NODES], schema=NODES)


def node_table(spark: SparkSession, model: Boosted) -> DataFrame:
    """All nodes ``(tree_id, node_id, feature, cut, left, right, threshold, gain, cover, value, part)``; leaves have
    feature -1. A part has whole rounds, about STORED_NODES nodes unless one round has more."""
    if model.path:
        return spark.read.parquet(model.path)
    made, first = [], 0
    for part, trees in enumerate(_parts(model.trees, model.outputs, STORED_NODES)):
        nodes = _node_columns(trees, first)
        made.append(nodes.append_column("part", pa.array(np.full(nodes.num_rows, part, np.int32))))
        first += len(trees)
    return spark.createDataFrame(pa.concat_tables(made))


def stored_trees(spark: SparkSession, path: str, outputs: int, eta: float) -> Boosted:
    """A model whose nodes are in the table at ``path``."""
    row = spark.read.parquet(path).agg(F.max("tree_id"), F.max("part")).first()
    return Boosted([], outputs, eta, path, row[0] + 1, row[1] + 1)


def _parts(trees: Sequence[Tree], outputs: int, most: int) -> list[list[Tree]]:
    """Whole rounds of trees, at most ``most`` nodes together where a round allows it."""
    parts, nodes = [[]], 0
    for at in range(0, len(trees), outputs):
        round_ = trees[at : at + outputs]
        size = sum(len(t.feature) for t in round_)
        if parts[-1] and nodes + size > most:
            parts.append([])
            nodes = 0
        parts[-1] += round_
        nodes += size
    return parts


def _sent_trees(spark: SparkSession, model: Boosted) -> Iterator[list[tuple]]:
    """The columns that scoring needs of whole rounds of trees, one part of the model after the other."""
    if not model.path:
        for trees in _parts(model.trees, model.outputs, SENT_NODES):
            yield [t.columns(by_bin=False) for t in trees]
        return
    nodes = spark.read.parquet(model.path)
    sizes = nodes.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # STORED_NODES nodes a row
    group, held = [], 0
    for i, row in enumerate(sizes):
        group.append(row["part"])
        held += row["n"]
        if i + 1 == len(sizes) or held + sizes[i + 1]["n"] > SENT_NODES:
            table = nodes.where(F.col("part").isin(group)).select("tree_id", "node_id", "feature", "threshold", "left", "right", "value")
            columns = [c.to_numpy() for c in table.toArrow().sort_by([("tree_id", "ascending"), ("node_id", "ascending")]).columns]
            ends = np.flatnonzero(np.diff(columns[0])) + 1
            yield list(zip(*(np.split(c, ends) for c in columns[2:])))
            group, held = [], 0


def _side_by_side(batches) -> Iterator[list[pa.RecordBatch]]:
    """Batches with rows, up to SCORED_ROWS rows or SCORED_BYTES together: more rows have more that are equal."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            if sum(b.num_rows for b in held) >= SCORED_ROWS or sum(b.nbytes for b in held) >= SCORED_BYTES:
                yield held
                held = []
    if held:
        yield held


def predict_boosted(df: DataFrame, model: Boosted, features: str = "features", target: str = "p") -> DataFrame:
    """Add the class probabilities as an array column; a map over the rows.

    The trees are broadcast, those of a large model part by part, each part
    adding to the margins of the one before.
    """
    outputs = model.outputs
    schema = T.StructType([*df.schema.fields, T.StructField(target, T.ArrayType(T.DoubleType()))])

    def add(rows: DataFrame, trees: list[tuple], first: bool, last: bool) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(trees)

        def score(batches):
            trees = _Coded.of(shared.value)
            for held in _side_by_side(batches):
                x = np.concatenate([matrix(batch.column(features)) for batch in held])
                margins = np.zeros((len(x), outputs)) if first else np.concatenate([matrix(batch.column(target)) for batch in held])
                margins = trees.add(margins, x)
                ends = np.cumsum([batch.num_rows for batch in held])[:-1]
                for batch, own in zip(held, np.split(_probabilities(margins) if last else margins, ends)):
                    found = list_column(own)
                    place = batch.num_columns if first else batch.schema.get_field_index(target)
                    kept = batch if first else batch.remove_column(place)
                    yield kept.append_column(target, found)

        return rows.mapInArrow(score, schema)

    first, parts = True, _sent_trees(df.sparkSession, model)
    trees = next(parts)
    while trees is not None:
        following = next(parts, None)
        df = add(df, trees, first, following is None)
        first, trees = False, following
    return df


TREE_NODES = T.StructType(
    [
        *[T.StructField(c, T.IntegerType()) for c in ("tree_id", "node_id", "feature")],
        T.StructField("threshold", T.DoubleType()),
        *[T.StructField(c, T.IntegerType()) for c in ("left", "right")],
        *[T.StructField(c, T.DoubleType()) for c in ("gain", "cover", "prediction")],
    ]
)


def tree_table(spark: SparkSession, model: Boosted, tree_ids: Sequence[int]) -> DataFrame:
    """One row per node of the chosen trees that the model has:
    ``(tree_id, node_id, feature, threshold, left, right, gain, cover, prediction)``."""
    if model.path:
        nodes, inner = spark.read.parquet(model.path).where(F.col("tree_id").isin(list(tree_ids))), F.col("feature") >= 0
        cells = [F.when(inner, F.col(c)).alias(c) for c in ("feature", "threshold", "left", "right", "gain")]
        return nodes.select("tree_id", "node_id", *cells, "cover", F.when(~inner, F.col("value")).alias("prediction"))
    rows = []
    for t in sorted(set(tree_ids) & set(range(len(model.trees)))):
        tree = model.trees[t]
        for n, feature in enumerate(tree.feature):
            inner = feature >= 0
            rows.append(
                {
                    "tree_id": t,
                    "node_id": n,
                    "feature": int(feature) if inner else None,
                    "threshold": float(tree.threshold[n]) if inner else None,
                    "left": int(tree.left[n]) if inner else None,
                    "right": int(tree.right[n]) if inner else None,
                    "gain": float(tree.gain[n]) if inner else None,
                    "cover": float(tree.cover[n]),
                    "prediction": None if inner else float(tree.value[n]),
                }
            )
    return local_table(spark, rows, TREE_NODES)


def chosen_trees(nodes: DataFrame, tree_ids: Sequence[int]) -> DataFrame:
    """Nodes of the chosen trees; an id the model does not have is reported as ``missing``."""
    schema = T.StructType([T.StructField("tree_id", T.IntegerType())])
    asked = local_table(nodes.sparkSession, [{"tree_id": i} for i in tree_ids], schema)
    found = F.broadcast(asked).join(nodes.where(F.col("tree_id").isin(list(tree_ids))), "tree_id", "left")
    return found.withColumn("status", F.when(F.col("node_id").isNull(), "missing").otherwise("found"))
