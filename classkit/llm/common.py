"""Small helpers shared by the text operators.

The operators look only at an id and a text column, which they take under names of their own, so further columns of the
table may have any names. Operators that give whole rows back carry them as one struct (`packed`) and unfold it last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from classkit.runtime import written
from classkit.sources import read_table

# Rows that leave a task together: small enough that long texts or token lists don't pile up.
OUT_ROWS = 2_000


# Rows of an Arrow batch of texts: with the default of 10,000, each worker holds tens of megabytes several times over.
BATCH_ROWS = 1_000


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on hands Python at most BATCH_ROWS rows at once."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name, "10000")) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/documents.parquet")


def named(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct."""
    return F.struct(*[named(c) for c in df.columns])


def unpacked(df: DataFrame, row: str, columns: list[str], *more: Column) -> DataFrame:
    """The columns kept in struct ``row``, then ``more``; a name in ``more`` wins over one in ``row``."""
    extra = [name for name in df.select(*more).columns] if more else []
    taken = {name.lower() for name in extra}
    return df.select(*[F.col(row).getField(c).alias(c) for c in columns if c.lower() not in taken], *more)


def _plain_scan(df: DataFrame) -> bool:
    """Whether the rows are those of stored files, chosen and projected at most: no joins, no rows made of others."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.child()
    return plan.getClass().getSimpleName() == "LogicalRelation" and bool(df.inputFiles())


def tagged(docs: DataFrame) -> DataFrame:
    """``row`` (all columns as a struct) and ``tag``, which names a row wherever and however often the rows are read.

    Rows of stored files are named by file and place in it, which hold if executors are lost and the scan is cut anew.
    Other tables, among them joined and exploded ones, are written with a number for each row first.
    """
    row = packed(docs).alias("row")
    if _plain_scan(docs):
        place = F.struct(F.xxhash64("_metadata.file_path").alias("a"), F.col("_metadata.row_index").alias("b"))
        return docs.select(row, place.alias("tag"))
    number = F.struct(F.monotonically_increasing_id().alias("a"), F.lit(0).cast("long").alias("b"))
    return written(docs.select(row, number.alias("tag")), "tagged")


def text_of(text_col: str) -> Column:
    """The text, a null one being empty."""
    return F.coalesce(named(text_col).cast("string"), F.lit(""))


def rebatched(rows: Iterator[tuple], schema: pa.Schema, size: int = OUT_ROWS) -> Iterator[pa.RecordBatch]:
    """Row tuples as Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def per_text(function: Callable[[], Callable[[str], tuple]], types: list[pa.DataType]) -> Callable:
    """A mapInArrow function: replaces the last column (the text) by what ``function()(text)`` returns.

    ``function`` is called once a task; equal neighbours need no special care, each row stands for itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = function()
        for batch in batches:
            for start in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(start, OUT_ROWS)
                made = list(zip(*map(call, part.column(part.num_columns - 1).to_pylist())))
                arrays = [part.column(i) for i in range(part.num_columns - 1)]
                arrays += [pa.array(values, kind) for values, kind in zip(made, types)]
                names = part.schema.names[:-1] + [f"c{i}" for i in range(len(types))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


__all__ = ["OUT_ROWS", "documents", "in_small_batches", "named", "packed", "per_text", "rebatched", "tagged", "text_of", "unpacked", "written"]
