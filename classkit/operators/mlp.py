"""Multilayer perceptrons trained by data-parallel passes over a Spark table.

Rectified hidden layers, one logistic output for two classes or a softmax for
more, cross-entropy plus an L2 penalty, Adam. Only weights travel: every task
turns its rows into one partial result (a summed gradient), Spark adds the
partials up, and the driver keeps the network.

* :func:`fit_full_batch` takes one Adam step per pass over all rows. Several
  networks, one per held-out fold, are trained by the same passes.
* :func:`fit_epochs` takes one Adam step per batch of rows. Small batches are a
  relay: their order is sequential by nature, so the weights and Adam's state go
  from partition to partition, and a task takes all steps of its batches. With
  ``steps``, large batches are summed by all tasks at once, a job per step.

Rows are packed once into an RDD of numpy blocks, which is kept; a pass is a job
over it, without a query plan of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classkit.functions.scores import DECISION_THRESHOLD, PROBABILITY_EPS
from classkit.operators.blocks import blocks, list_column, matrix, pack
from classkit.operators.columns import clean_vector_shape
from classkit.operators.early_stop import MAX_EPOCHS, EarlyStopping
from classkit.runtime import local_table

# Adam's decay rates and guard, and the stall rule of the full-batch fit.
ADAM_BETA1, ADAM_BETA2, ADAM_EPS = 0.9, 0.999, 1e-8
# Weights of units that no row reaches shrink by a third with each step, to numbers below 1e-308 that take a processor a hundred
# times as long. So now and then what is below VANISHED becomes 0; it is far too little to change a sum.
VANISHED, VANISH_STEPS = 1e-100, 32
STALL_TOLERANCE, STALL_ITERATIONS = 1e-4, 10

BATCH_ROWS = 32  # rows of an Adam step of the relay, on average (fixed value)
FAN_IN = 256  # partial results added up by one task
TASK_VALUES = 1 << 21  # numbers that a task of a training pass should have at least: 16 MB
# Rows and numbers of a relay's partition, which a task reads whole (32 MB): an epoch takes a job for each.
RELAY_ROWS, RELAY_VALUES = 1_000_000, 1 << 22
UNIT_ROWS = 1_000  # validation rows that are measured together
LARGE_ROWS = 100_000  # rows of a partition where all tasks sum a large batch at once
MEASURED_ROWS = 20_000  # validation rows of a partition: these are measured at once, not one after the other


@dataclass
class Network:
    """Weights as matrices [n_in, n_out] and biases, one pair per layer."""

    weights: list[np.ndarray]
    biases: list[np.ndarray]

    @classmethod
    def create(cls, sizes: Sequence[int], seed: int = 42) -> Network:
        """Weights and biases drawn uniformly from +-sqrt(6 / (n_in + n_out))."""
        rng = np.random.default_rng(seed)
        weights, biases = [], []
        for n_in, n_out in zip(sizes, sizes[1:], strict=False):
            bound = np.sqrt(6.0 / (n_in + n_out))
            weights.append(rng.uniform(-bound, bound, (n_in, n_out)))
            biases.append(rng.uniform(-bound, bound, n_out))
        return cls(weights, biases)

    @property
    def arrays(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        return self.weights, self.biases

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for pair in zip(self.weights, self.biases, strict=True) for a in pair])

    def like(self, flat: np.ndarray) -> Network:
        """A network of the same shape from a flat vector."""
        weights, biases, at = [], [], 0
        for w, b in zip(self.weights, self.biases, strict=True):
            weights.append(flat[at : at + w.size].reshape(w.shape))
            biases.append(flat[at + w.size : at + w.size + b.size])
            at += w.size + b.size
        return Network(weights, biases)

    @property
    def penalty(self) -> float:
        return sum(float((w * w).sum()) for w in self.weights)

    def activations(self, x: np.ndarray) -> list[np.ndarray]:
        """Outputs of every layer, the input first and the probabilities last."""
        layers = [x]
        for w, b in zip(self.weights[:-1], self.biases[:-1], strict=True):
            z = layers[-1] @ w
            z += b
            layers.append(np.maximum(z, 0.0, out=z))
        z = layers[-1] @ self.weights[-1]
        z += self.biases[-1]
        if z.shape[1] == 1:
            np.minimum(np.maximum(z, -700.0, out=z), 700.0, out=z)
            np.exp(np.negative(z, out=z), out=z)
            z += 1.0
            layers.append(np.divide(1.0, z, out=z))
        else:
            e = np.exp(z - z.max(axis=1, keepdims=True))
            layers.append(e / e.sum(axis=1, keepdims=True))
        return layers

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """One column per class, also for a single logistic output."""
        p = self.activations(x)[-1]
        return np.hstack([1.0 - p, p]) if p.shape[1] == 1 else p

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        """Summed cross-entropy of the rows and its flat gradient, without the penalty."""
        layers, made = self.activations(x), np.empty(sum(a.size for arrays in self.arrays for a in arrays))
        loss = cross_entropy(layers[-1], y).sum()
        self._backward(layers, y, self.like(made))
        return loss, made

    def _backward(self, layers: list[np.ndarray], y: np.ndarray, made: Network) -> None:
        """The gradient at the activations of rows, written to ``made``, a network of the same shape."""
        target = y[:, None].astype(float) if layers[-1].shape[1] == 1 else np.eye(layers[-1].shape[1])[y]
        delta = layers[-1] - target
        for i in range(len(self.weights) - 1, -1, -1):
            np.matmul(layers[i].T, delta, out=made.weights[i])
            np.add.reduce(delta, axis=0, out=made.biases[i])
            if i:
                positive = layers[i] > 0
                delta = delta @ self.weights[i].T
                delta *= positive

    def step_gradient(self, x: np.ndarray, y: np.ndarray, made: Network) -> None:
        """As `gradient`, into ``made`` and without the loss: an epoch of small batches takes many thousands."""
        self._backward(self.activations(x), y, made)

    def decay(self, alpha: float) -> np.ndarray:
        """Factor of every flat weight in the penalty's gradient: biases are free."""
        pairs = zip(self.weights, self.biases, strict=True)
        return np.concatenate([np.full(a.size, f) for w, b in pairs for a, f in ((w, alpha), (b, 0.0))])


def cross_entropy(p: np.ndarray, y: np.ndarray) -> np.ndarray:
    p_true = np.where(y == 1, p[:, 0], 1.0 - p[:, 0]) if p.shape[1] == 1 else p[np.arange(len(y)), y]
    return -np.log(np.clip(p_true, PROBABILITY_EPS, 1.0 - PROBABILITY_EPS))


class Adam:
    """Steps over one flat vector of weights; ``start`` is changed in place."""

    def __init__(self, start: np.ndarray, rate: float):
        self.flat, self.rate, self.step = start, rate, 0
        self.first, self.second = np.zeros_like(start), np.zeros_like(start)

    def move(self, gradient: np.ndarray) -> None:
        self.step += 1
        room, other = self._room = getattr(self, "_room", None) or (np.empty_like(self.flat), np.empty_like(self.flat))
        np.subtract(gradient, self.first, out=room)
        room *= 1 - ADAM_BETA1
        self.first += room
        np.multiply(gradient, gradient, out=room)
        room -= self.second
        room *= 1 - ADAM_BETA2
        self.second += room
        scale = math.sqrt(1 - ADAM_BETA2**self.step) / (1 - ADAM_BETA1**self.step)
        np.sqrt(self.second, out=other)
        other += ADAM_EPS
        np.multiply(self.first, self.rate * scale, out=room)
        room /= other
        self.flat -= room
        if self.step % VANISH_STEPS == 0:
            for values, least in ((self.flat, VANISHED), (self.first, VANISHED), (self.second, VANISHED * VANISHED)):
                values[np.abs(values) < least] = 0.0

    def __getstate__(self) -> dict:
        return {name: value for name, value in vars(self).items() if name != "_room"}


def _added(partials: list[dict[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """Partial results added by network, in their order."""
    sums: dict[int, np.ndarray] = {}
    for part in partials:
        for net, values in part.items():
            sums[net] = sums[net] + values if net in sums else values
    return sums


def _summed(partials: RDD) -> dict[int, np.ndarray]:
    """Add up the results of tasks, one ``{network: values}`` each.

    Up to FAN_IN tasks the driver adds them; for more, executors first add up
    FAN_IN neighbours at a time, so the driver gets few in either case.
    """
    tasks = partials.getNumPartitions()
    if tasks > FAN_IN:
        groups = -(-tasks // FAN_IN)
        numbered = partials.mapPartitionsWithIndex(lambda at, parts: ((at // FAN_IN, (at, p)) for p in parts))
        gathered = numbered.groupByKey(groups).mapValues(lambda parts: _added([p for _, p in sorted(parts, key=lambda x: x[0])]))
        return _added([p for _, p in sorted(gathered.collect(), key=lambda x: x[0])])
    return _added(partials.collect())


# What a block of training rows holds; ``tag`` is a fold or a batch.
TRAINING = {"features": np.float64, "label": np.int32, "tag": np.int32}


def training_blocks(df: DataFrame, features: str = "features", label: str = "label", tag: Column | None = None) -> DataFrame:
    """Training rows in blocks, in the order of the rows."""
    rows = df.select(
        F.col(features).cast("array<double>").alias("features"),
        F.col(label).cast("int").alias("label"),
        (F.lit(0) if tag is None else tag).cast("int").alias("tag"),
    )
    return pack(rows, TRAINING)


def _unpacked(rows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of `training_blocks` as (features, labels, tags)."""
    for row in rows:
        held = [np.frombuffer(row[name], dtype).reshape(row["rows"], -1) for name, dtype in TRAINING.items()]
        yield held[0], held[1][:, 0], held[2][:, 0]


def training_rows(df: DataFrame, features: str = "features", label: str = "label", tag: Column | None = None) -> RDD:
    """(features, labels, tags) blocks of training rows, for one pass."""
    return training_blocks(df, features, label, tag).rdd.mapPartitions(_unpacked)


def _kept(blocks: DataFrame, rows: int, width: int) -> RDD:
    """Blocks for repeated passes: no more tasks than their size is worth, since a pass costs a start of each."""
    few = blocks.coalesce(max(2, -(-rows * width // TASK_VALUES)))
    return few.rdd.mapPartitions(_unpacked).persist(StorageLevel.MEMORY_AND_DISK)


def _in_units(rows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]]:
    """Rows that are sorted by tag as (features, labels, tags, edges of the tags' rows), no tag in two blocks."""
    held: tuple[np.ndarray, ...] | None = None
    for block in _unpacked(rows):
        held = block if held is None else tuple(np.concatenate(both) for both in zip(held, block, strict=True))
        edges = np.flatnonzero(np.diff(held[2])) + 1
        if len(edges):  # the last tag may go on in the next block
            yield held[0][: edges[-1]], held[1][: edges[-1]], held[2][[0, *edges[:-1]]], [0, *edges.tolist()]
            held = tuple(a[edges[-1] :] for a in held)
    if held is not None and len(held[0]):
        yield held[0], held[1], held[2][:1], [0, len(held[0])]


def _dealt(df: DataFrame, id_col: str, features: str, label: str, rows: int, units: int, seed: int, part_rows: int) -> RDD:
    """Rows dealt to ``units`` batches by their ids, over partitions of about ``part_rows`` rows in the batches' order.

    A partition holds whole batches or, of batches that are larger, a share of one; either is told by number alone.
    Rows of a batch are in the order of ids, features and labels. So the same table gives the same blocks, however it
    was partitioned.
    """
    key = batch_key(F.col(id_col), seed)
    parts, shares = _partitions(rows, units, part_rows)
    unit, share = key % units, F.floor(key / units) % shares
    named = df.select(
        F.col(features).cast("array<double>").alias("features"),
        F.col(label).cast("int").alias("label"),
        unit.cast("int").alias("unit"),
        (F.floor(unit * parts / units) if shares == 1 else unit * shares + share).cast("int").alias("part"),
        F.col(id_col).alias("id"),
    )
    ordered = named.repartitionById(parts * shares, "part").sortWithinPartitions("unit", "id", "features", "label")
    packed = training_blocks(ordered, tag=F.col("unit"))
    return packed.rdd.mapPartitions(_in_units).persist(StorageLevel.MEMORY_AND_DISK)


def _partitions(rows: int, units: int, part_rows: int) -> tuple[int, int]:
    """Partitions for whole batches, and shares of each batch: one of both is 1 or the other all batches."""
    parts = max(1, -(-rows // part_rows))
    return (parts, 1) if parts <= units else (units, -(-parts // units))


def batch_key(id_col: Column, seed: int) -> Column:
    """A number below 2**32 by which rows are dealt to batches: the first digits of ``md5(id | seed)``."""
    return F.conv(F.substring(F.md5(F.concat(id_col.cast("string"), F.lit(f"|{seed}"))), 1, 8), 16, 10).cast("long")


@dataclass
class Fit:
    network: Network
    losses: list[float] = field(default_factory=list)
    scale: tuple[np.ndarray, np.ndarray] | None = None  # mean and divisor applied to the features


def output_units(n_classes: int) -> int:
    return 1 if n_classes == 2 else n_classes


def sum_gradients(rows: RDD, fits: dict[int, Fit], held_out: bool = False) -> dict[int, np.ndarray]:
    """Per network ``[rows, loss, gradient..]`` summed over (features, labels, folds) blocks, in one pass.

    With ``held_out`` a network skips the rows of the fold it is named after.
    """
    shared = rows.context.broadcast({k: (*f.network.arrays, f.scale) for k, f in fits.items()})

    def partials(blocks):
        networks = {k: (Network(w, b), scale) for k, (w, b, scale) in shared.value.items()}
        totals: dict[int, np.ndarray] = {}
        for x, y, fold in blocks:
            for name, (network, scale) in networks.items():
                used = fold != name if held_out else slice(None)
                xs, ys = x[used], y[used]
                if not len(ys):
                    continue
                if scale is not None:
                    xs = (xs - scale[0]) / scale[1]
                loss, gradient = network.gradient(xs, ys)
                part = np.concatenate([[len(ys), loss], gradient])
                totals[name] = totals[name] + part if name in totals else part
        yield totals

    try:
        return _summed(rows.mapPartitions(partials))
    finally:
        shared.unpersist()


def _scales(scalers: DataFrame | None, keys: Sequence[int]) -> dict[int, tuple | None]:
    if scalers is None:
        return dict.fromkeys(keys)
    named = "fold" in scalers.columns
    rows = {r["fold"] if named else 0: r for r in scalers.collect()}
    return {k: (np.array(rows[k]["mean"]), np.array([s or 1.0 for s in rows[k]["std"]])) for k in keys}


def fit_full_batch(
    train: DataFrame,
    features: str = "features",
    label: str = "label",
    n_classes: int = 2,
    hidden: Sequence[int] = (32,),
    alpha: float = 1e-3,
    rate: float = 1e-3,
    max_iter: int = 2000,
    seed: int = 42,
    scalers: DataFrame | None = None,
    folds: Sequence[int] | None = None,
    start: Network | None = None,
) -> dict[int, Fit]:
    """Fit network 0, or one network per held-out fold of ``folds``, from ``start`` or random weights.

    ``losses`` holds the penalised loss of every iteration. A network stops once
    its loss has not improved by the tolerance for more than the stall limit.
    """
    keys = list(folds) if folds is not None else [0]
    n_rows, width = clean_vector_shape(train, features)
    rows = _kept(training_blocks(train, features, label, None if folds is None else F.col("fold")), n_rows, width)
    scales = _scales(scalers, keys)
    start = start or Network.create([width, *hidden, output_units(n_classes)], seed)
    adams = {k: Adam(start.flat, rate) for k in keys}
    fits = {k: Fit(start.like(adams[k].flat), scale=scales[k]) for k in keys}  # views of the moving weights
    decay = start.decay(alpha)
    best, stalled = dict.fromkeys(keys, np.inf), dict.fromkeys(keys, 0)
    active = set(keys)
    try:
        for _ in range(max_iter):
            sums = sum_gradients(rows, {k: fits[k] for k in sorted(active)}, folds is not None)
            for k, total in sums.items():
                n, loss, gradient = total[0], total[1], total[2:]
                penalised = loss / n + 0.5 * alpha * fits[k].network.penalty / n
                if not np.isfinite(penalised):
                    raise FloatingPointError(f"loss is {penalised} in iteration {len(fits[k].losses) + 1}")
                fits[k].losses.append(penalised)
                adams[k].move((gradient + decay * adams[k].flat) / n)
                stalled[k] = stalled[k] + 1 if penalised > best[k] - STALL_TOLERANCE else 0
                best[k] = min(best[k], penalised)
                if stalled[k] > STALL_ITERATIONS:
                    active.discard(k)
            if not active:
                break
    finally:
        rows.unpersist()
    return fits


def _measure(units: RDD, network: Network) -> tuple[float, float]:
    """Mean cross-entropy and accuracy over the units of `_dealt`, added in their order."""
    weights = network.arrays

    def run(blocks):
        held, found = Network(*weights), []
        for x, y, _, edges in blocks:
            for a, b in zip(edges, edges[1:]):
                p = held.activations(x[a:b])[-1]
                predicted = (p[:, 0] >= DECISION_THRESHOLD).astype(int) if p.shape[1] == 1 else p.argmax(axis=1)
                found.append([b - a, cross_entropy(p, y[a:b]).sum(), (predicted == y[a:b]).sum()])
        yield np.array(found).reshape(-1, 3)

    n, loss, hits = (math.fsum(column) for column in np.concatenate(units.mapPartitions(run).collect()).T)
    return loss / n, hits / n


@dataclass
class EpochFit:
    network: Network
    history: list[dict]  # epoch, val_loss, val_acc
    best_epoch: int
    scale: tuple[np.ndarray, np.ndarray] | None = None


def _relay(units: RDD, adam: Adam, shape: Network, decay: np.ndarray) -> Adam:
    """An epoch: every partition's batches in turn, a job per partition that takes Adam's state and hands it on.

    A lost task is run again from the state it was given, which gives the same weights.
    """
    for at in range(units.getNumPartitions()):

        def run(blocks, given=adam):
            network = shape.like(given.flat)  # views of the moving weights
            gradient, room = np.empty_like(given.flat), np.empty_like(given.flat)
            made = shape.like(gradient)
            for x, y, _, edges in blocks:
                for a, b in zip(edges, edges[1:]):
                    network.step_gradient(x[a:b], y[a:b], made)
                    gradient += np.multiply(decay, given.flat, out=room)
                    gradient /= b - a
                    given.move(gradient)
            yield given

        (adam,) = units.context.runJob(units, run, [at])
    return adam


def _large_steps(units: RDD, adam: Adam, shape: Network, decay: np.ndarray, steps: int) -> Adam:
    """An epoch of ``steps`` batches, each summed by the tasks that hold its shares, and by them alone."""
    shares = max(1, units.getNumPartitions() // steps)
    for step in range(steps):
        weights = shape.like(adam.flat).arrays

        def run(blocks, step=step, weights=weights):
            network, total = Network(*weights), 0.0
            for x, y, tags, edges in blocks:
                for tag, a, b in zip(tags, edges, edges[1:]):
                    if tag == step:
                        loss, gradient = network.gradient(x[a:b], y[a:b])
                        total = total + np.concatenate([[b - a, loss], gradient])
            yield total

        held = range(step * shares, (step + 1) * shares) if units.getNumPartitions() >= steps else [step * units.getNumPartitions() // steps]
        total = 0.0
        for first in range(0, len(held), FAN_IN):  # so many results at once on the driver
            total = total + sum(units.context.runJob(units, run, list(held[first : first + FAN_IN])))
        if np.ndim(total):  # a batch of a tiny table may be empty
            adam.move((total[2:] + decay * adam.flat) / total[0])
    return adam


def fit_epochs(
    train: DataFrame,
    valid: DataFrame,
    id_col: str,
    features: str = "features",
    label: str = "label",
    n_classes: int = 2,
    hidden: Sequence[int] = (64, 32, 16),
    alpha: float = 1e-4,
    rate: float = 1e-3,
    steps: int | None = None,
    max_epochs: int = MAX_EPOCHS,
    stopping: EarlyStopping | None = None,
    seed: int = 42,
    batch_rows: int = BATCH_ROWS,
    start: Network | None = None,
) -> EpochFit:
    """Epochs of mini-batch Adam with early stopping on the validation loss.

    Rows are dealt by their ids to batches of ``batch_rows`` rows on average, and
    an epoch takes an Adam step per batch, in their order: a relay of one small
    job per RELAY_VALUES numbers at most, whose tasks hold no more than their partition. Such
    steps follow one another by nature, so an epoch takes as long on a cluster as
    on one machine. With ``steps``, there are as many large batches, and a step
    is a distributed sum of gradients: the way for tables of very many rows.

    The same table gives the same network however it is partitioned. The network
    kept is the one of the best epoch; ``start`` replaces random first weights.
    """
    stopping = stopping or EarlyStopping()
    n_train, width = clean_vector_shape(train, features)
    n_valid, valid_width = clean_vector_shape(valid, features)
    if valid_width != width:
        raise ValueError(f"{features}: the validation vectors have another width than {width}")
    spread = steps or max(1, -(-n_train // batch_rows))
    part_rows = min(RELAY_ROWS, LARGE_ROWS if steps else max(1, RELAY_VALUES // (width + 2)))
    dealt = _dealt(train, id_col, features, label, n_train, spread, seed, part_rows)
    held_out = _dealt(valid, id_col, features, label, n_valid, max(1, -(-n_valid // UNIT_ROWS)), seed, min(RELAY_ROWS, MEASURED_ROWS))
    start = start or Network.create([width, *hidden, output_units(n_classes)], seed)
    adam, decay = Adam(start.flat, rate), start.decay(alpha)
    best, history = start, []
    try:
        for epoch in range(1, max_epochs + 1):
            if steps:
                adam = _large_steps(dealt, adam, start, decay, steps)
            else:
                adam = _relay(dealt, adam, start, decay)
            network = start.like(adam.flat)
            loss, accuracy = _measure(held_out, network)
            if not np.isfinite(loss):
                raise FloatingPointError(f"validation loss is {loss} in epoch {epoch}")
            history.append({"epoch": epoch, "val_loss": loss, "val_acc": accuracy})
            if stopping.improved(epoch, loss):
                best = start.like(adam.flat.copy())
            if stopping.stopped:
                break
    finally:
        dealt.unpersist()
        held_out.unpersist()
    return EpochFit(best, history, stopping.best_step)


def _scored(df: DataFrame, networks: dict, features: str, target: str, fold: str | None) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(networks)

    def score(batches):
        by_fold = {k: (Network(w, b), scale) for k, (w, b, scale) in shared.value.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(features))
            names = batch.column(fold).to_numpy(zero_copy_only=False) if fold else np.zeros(len(x), dtype=int)
            p = None
            for name in np.unique(names):
                network, scale = by_fold[int(name)]
                mine = names == name
                part = network.probabilities(x[mine] if scale is None else (x[mine] - scale[0]) / scale[1])
                if p is None:
                    p = np.empty((len(x), part.shape[1]))
                p[mine] = part
            yield batch.append_column(target, list_column(p))

    schema = T.StructType([*df.schema.fields, T.StructField(target, T.ArrayType(T.DoubleType()))])
    return df.mapInArrow(score, schema)


def predict(df: DataFrame, fit: Fit | EpochFit, features: str = "features", target: str = "p") -> DataFrame:
    """Add the class probabilities as an array column; a map over the rows."""
    return _scored(df, {0: (*fit.network.arrays, fit.scale)}, features, target, None)


def predict_held_out(
    df: DataFrame, fits: dict[int, Fit], features: str = "features", target: str = "p", fold: str = "fold"
) -> DataFrame:
    """Score every row with the network that was fitted without its fold."""
    networks = {k: (*fit.network.arrays, fit.scale) for k, fit in fits.items()}
    return _scored(df, networks, features, target, fold)


def loss_table(spark: SparkSession, fit: Fit) -> DataFrame:
    """``(step, loss)``, one row per iteration."""
    rows = [{"step": i + 1, "loss": float(v)} for i, v in enumerate(fit.losses)]
    return local_table(spark, rows, T.StructType().add("step", "integer").add("loss", "double"))


def history_table(spark: SparkSession, fit: EpochFit) -> DataFrame:
    """``(epoch, val_loss, val_acc)``."""
    schema = T.StructType().add("epoch", "integer").add("val_loss", "double").add("val_acc", "double")
    return local_table(spark, fit.history, schema)


def weight_table(spark: SparkSession, network: Network) -> DataFrame:
    """``(layer, src, dst, weight)``: as many rows as the network has weights."""
    rows = [
        {"layer": layer, "src": i, "dst": j, "weight": float(w[i, j])}
        for layer, w in enumerate(network.weights)
        for i in range(w.shape[0])
        for j in range(w.shape[1])
    ]
    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in ("layer", "src", "dst")]).add("weight", "double")
    return local_table(spark, rows, schema)


def bias_table(spark: SparkSession, network: Network, inputs: bool = False) -> DataFrame:
    """``(layer, node, bias)``; with ``inputs`` also the input nodes, in layer -1 with bias 0."""
    rows = [
        {"layer": layer, "node": j, "bias": float(v)} for layer, b in enumerate(network.biases) for j, v in enumerate(b)
    ]
    if inputs:
        rows = [{"layer": -1, "node": i, "bias": 0.0} for i in range(len(network.weights[0]))] + rows
    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in ("layer", "node")]).add("bias", "double")
    return local_table(spark, rows, schema)
