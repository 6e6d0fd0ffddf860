"""The early-stopping rule, on a history table and step by step in a training loop.

On a table, the rows of a run need not meet in one task. Rows are dealt by ranges of (run, epoch), so a long run is cut
into pieces. What a piece makes of the rule's state can be told without knowing the state it is entered with (see
`_piece`), so all pieces are worked out at once, and the pieces of a run are then chained: a search and a few steps each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

# Longest run, epochs without improvement, smallest improvement.
MAX_EPOCHS = 200
PATIENCE = 20
MIN_DELTA = 1e-3


@dataclass
class EarlyStopping:
    """Keeps the best value seen; an improvement must exceed ``min_delta``."""

    patience: int = PATIENCE
    min_delta: float = MIN_DELTA
    best: float = float("inf")
    best_step: int = 0
    waited: int = 0

    def improved(self, step: int, loss: float) -> bool:
        if loss < self.best - self.min_delta:
            self.best, self.best_step, self.waited = loss, step, 0
            return True
        self.waited += 1
        return False

    @property
    def stopped(self) -> bool:
        return self.waited >= self.patience


def _piece(losses: np.ndarray, patience: int, min_delta: float) -> tuple[np.ndarray, ...]:
    """What consecutive losses of a run make of the rule, for every state that it may enter with.

    Only losses below all earlier ones of the piece can be improvements, because a loss that was read is never below the
    best less ``min_delta``. Of these records the first that is below an entering best less ``min_delta`` is the first
    improvement, and what follows depends on that record alone. So the outcome is told for each record as the first:
    ``(value, place, value and place of the last improvement, place at which the rule stops or -1)``.
    """
    losses = np.where(np.isnan(losses), np.inf, losses)
    lowest = np.minimum.accumulate(np.append(np.inf, losses))
    places = np.flatnonzero(losses < lowest[:-1])
    values, n = losses[places], len(places)
    following = np.searchsorted(-values, -(values - min_delta), side="right")  # the improvement after each record
    until = np.append(places, len(losses))[following]
    stops = until - places > patience
    last = np.where(stops | (following == n), np.arange(n), following)
    while (last[last] != last).any():  # twice as many improvements further each time
        last = last[last]
    return values, places, values[last], places[last], np.where(stops[last], places[last] + patience, -1)


def _edges(columns: list[pa.Array], n: int) -> np.ndarray:
    """Where runs begin among rows sorted by run, and the end."""
    new = np.zeros(max(0, n - 1), bool)
    for column in columns:
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new |= np.diff(codes) != 0
    return np.concatenate([[0], np.flatnonzero(new) + 1, [n]])


def _pieces(keys: int, schema: pa.Schema, patience: int, min_delta: float):
    """mapInArrow over (run.., epoch, loss) sorted by run and epoch: one row per run of the task, see `_summary_schema`."""

    def told(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        epochs = pa.concat_arrays([p.column(keys) for p in parts])
        losses = np.concatenate([p.column(keys + 1).to_numpy(zero_copy_only=False) for p in parts]).astype(float)
        values, places, best, best_at, stop_at = _piece(losses, patience, min_delta)
        stopping = pa.array(np.maximum(stop_at, 0))
        row = [parts[0].column(i).slice(0, 1) for i in range(keys)]
        row += [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([len(losses)], pa.int64())]
        row += [epochs.slice(len(losses) - 1, 1)]
        lists = [epochs.slice(0, patience), pa.array(values), pa.array(places, pa.int64()), pa.array(best)]
        lists += [epochs.take(pa.array(best_at)), pa.array(len(losses) - 1 - best_at, pa.int64())]
        lists += [pa.array(stop_at >= 0), epochs.take(stopping)]
        row += [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(row, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        made: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if held:  # does the run of the batch before go on?
                ends = [pa.concat_arrays([held[-1].column(i).slice(held[-1].num_rows - 1), batch.column(i).slice(0, 1)]) for i in range(keys)]
                if len(_edges(ends, 2)) > 2:
                    made.append(told(held))
                    held = []
            edges = _edges(batch.columns[:keys], batch.num_rows).tolist()
            for start, end in zip(edges, edges[1:]):
                held.append(batch.slice(start, end - start))
                if end < batch.num_rows:
                    made.append(told(held))
                    held = []
            if made:
                yield from pa.Table.from_batches(made).combine_chunks().to_batches()
                made = []
        if held:
            yield told(held)

    return run


def _summary_schema(run: list[T.StructField], epoch: T.DataType) -> T.StructType:
    """A piece: its range, rows and last epoch; its first epochs, at which a rule that waits already may stop; and the
    outcomes of `_piece`, with the rows waited at the end, and the epoch at which the rule stops if it does."""
    plain = [("_range", T.IntegerType()), ("_rows", T.LongType()), ("_end", epoch)]
    lists = [("_first", epoch), ("_value", T.DoubleType()), ("_place", T.LongType()), ("_best", T.DoubleType())]
    lists += [("_best_epoch", epoch), ("_waited", T.LongType()), ("_stops", T.BooleanType()), ("_stop_epoch", epoch)]
    return T.StructType([*run, *[T.StructField(n, t) for n, t in plain], *[T.StructField(n, T.ArrayType(t)) for n, t in lists]])


def _chained(keys: int, schema: pa.Schema, patience: int, min_delta: float):
    """mapInArrow over pieces sorted by run and range: one result per run. Of each piece one outcome is looked up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rule, best, last = None, None, None, None

        def closed() -> list:
            return [*name, best, rule.best if rule.best_step else None, last, rule.stopped]

        for batch in batches:
            done = []
            for i, key in enumerate(zip(*(c.to_pylist() for c in batch.columns[:keys]), strict=True) if keys else [()] * batch.num_rows):
                if rule is None or key != name:
                    if rule is not None:
                        done.append(closed())
                    name, rule, best, last = key, EarlyStopping(patience, min_delta), None, None
                if rule.stopped:
                    continue
                _, rows, end, first, value, place, bests, best_epoch, waited, stops, stop_epoch = (c[i] for c in batch.columns[keys:])
                rows, values = rows.as_py(), value.values.to_numpy()
                at = int(np.searchsorted(-values, -(rule.best - min_delta), side="right"))
                idle = place[at].as_py() if at < len(values) else rows  # rows before the first improvement
                if rule.waited + idle >= patience:
                    last, rule.waited = first[patience - rule.waited - 1].as_py(), patience
                elif at == len(values):
                    last, rule.waited = end.as_py(), rule.waited + rows
                else:
                    best, rule.best, rule.best_step = best_epoch[at].as_py(), bests[at].as_py(), 1
                    stopped = stops[at].as_py()
                    last = (stop_epoch[at] if stopped else end).as_py()
                    rule.waited = patience if stopped else waited[at].as_py()
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if rule is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(closed(), schema, strict=True)], schema=schema)

    return run


def early_stop(
    history: DataFrame,
    run: Sequence[str] = ("run",),
    epoch: str = "epoch",
    loss: str = "val_loss",
    patience: int = PATIENCE,
    min_delta: float = MIN_DELTA,
    max_epochs: int | None = None,
) -> DataFrame:
    """``(run.., best_epoch, best_loss, stop_epoch, stopped_early)`` for every run.

    Histories may be of any length, or end at ``max_epochs``; a long run is worked on by many tasks. A null, NaN or
    infinite loss is no improvement; rows of the same epoch are taken by falling loss, nulls last; a null run is a run.
    """
    if patience < 1 or min_delta < 0:
        raise ValueError("patience must be 1 or more, min_delta not negative")
    run = list(run)
    rows = history.select(*run, F.col(epoch).alias("_epoch"), F.col(loss).cast("double").alias("_loss"))
    order = [F.col("_epoch"), F.desc_nulls_last("_loss")]
    if max_epochs is not None:  # Spark limits the groups ahead of the shuffle
        place = F.row_number().over(Window.partitionBy(*run).orderBy(*order))
        rows = rows.withColumn("_n", place).where(F.col("_n") <= max_epochs).drop("_n")
    kind, names = history.schema[epoch].dataType, rows.schema.fields[: len(run)]
    summary = _summary_schema(names, kind)
    dealt = rows.repartitionByRange(*run, "_epoch").sortWithinPartitions(*run, *order)
    pieces = dealt.mapInArrow(_pieces(len(run), to_arrow_schema(summary), patience, min_delta), summary)
    added = [
        T.StructField("best_epoch", kind),
        T.StructField("best_loss", T.DoubleType()),
        T.StructField("stop_epoch", kind),
        T.StructField("stopped_early", T.BooleanType()),
    ]
    schema = T.StructType([*names, *added])
    met = (pieces.repartition(*run) if run else pieces.coalesce(1)).sortWithinPartitions(*run, "_range")
    return met.mapInArrow(_chained(len(run), to_arrow_schema(schema), patience, min_delta), schema)
