"""Training rows packed into blocks of plain memory.

Training passes over the same rows many times. Moving a row with an array from
Spark to a task's Python side costs more than the arithmetic on it, so rows are
packed once, a few thousand per block, and later passes move whole buffers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column as a matrix, without a Python object per row.

    Null vectors, null or NaN entries and uneven widths are an error that counts them.
    """
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(flat):
        return np.empty((0, 0))
    widths = pc.list_value_length(flat)
    entries = flat.flatten()
    values = np.asarray(entries.to_numpy(zero_copy_only=False), dtype=np.float64)
    missing = int(np.isnan(values).sum())
    if flat.null_count or missing or len(pc.unique(widths)) > 1:
        nulls = entries.null_count
        raise ValueError(
            f"bad vectors among {len(flat)}: {flat.null_count} null, {nulls} null entries, "
            f"{missing - nulls} NaN entries, widths {sorted(pc.unique(widths).drop_null().to_pylist())[:10]}"
        )
    return values.reshape(len(flat), -1)


def list_column(values: np.ndarray) -> pa.Array:
    """A matrix as a list column."""
    offsets = pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))


def block_schema(dtypes: dict[str, type]) -> T.StructType:
    return T.StructType(
        [T.StructField("rows", T.IntegerType()), *[T.StructField(name, T.BinaryType()) for name in dtypes]]
    )


def block(arrays: dict[str, np.ndarray], dtypes: dict[str, type]) -> pa.RecordBatch:
    """One block: the arrays of its rows as raw bytes."""
    rows = len(next(iter(arrays.values())))
    raw = [pa.array([np.ascontiguousarray(arrays[name], dtype=dtype).tobytes()]) for name, dtype in dtypes.items()]
    return pa.RecordBatch.from_arrays([pa.array([rows], pa.int32()), *raw], names=["rows", *dtypes])


def blocks(batches, dtypes: dict[str, type]) -> Iterator[dict[str, np.ndarray]]:
    """Every block as ``name -> [rows, width]`` arrays over the received memory."""
    for batch in batches:
        for i, rows in enumerate(batch.column("rows").to_pylist()):
            yield {
                name: np.frombuffer(batch.column(name)[i].as_buffer(), dtype).reshape(rows, -1)
                for name, dtype in dtypes.items()
            }


def pack(df: DataFrame, dtypes: dict[str, type]) -> DataFrame:
    """Pack the named columns, keeping the order of rows; arrays become matrices."""

    def to_block(batches):
        for batch in batches:
            if batch.num_rows:
                columns = {name: batch.column(name) for name in dtypes}
                arrays = {
                    name: matrix(c) if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False)
                    for name, c in columns.items()
                }
                yield block(arrays, dtypes)

    return df.select(*dtypes).mapInArrow(to_block, block_schema(dtypes))
