"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from classkit.llm.common import packed, unpacked, written

# Partitions share a matrix row beyond this many, so the matrix (shards wide) has a bounded size and can be broadcast.
MAX_BLOCKS = 16_384
# Each shard is put into its final order in slices of about this many rows.
SLICE_ROWS = 1_000_000
MAX_SLICE_BITS = 12


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows, drawn without replacement, are among the ``good`` ones.

    Inverse transform around the mode, over all values whose probability a double can tell from zero; the same rule at
    every size.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    share = good / total
    spread = math.sqrt(draws * share * (1 - share) * (total - draws) / max(1, total - 1))
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    first, last = max(low, int(mode - 40 - 12 * spread)), min(high, int(mode + 40 + 12 * spread))
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(steps)])
    chance = np.cumsum(np.exp(weight - weight.max()))
    return first + int(np.searchsorted(chance, rng.random() * chance[-1], side="right").clip(0, last - first))


def communication_matrix(rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """Row i: how many of partition i's rows go to each shard.

    Row sums are the partitions' rows; column sums are the shards' sizes, at most one apart. It has the distribution
    that a uniform permutation of all rows would give.
    """
    rng = np.random.default_rng(seed)
    total = sum(rows)
    left = [total // shards + (i < total % shards) for i in range(shards)]
    matrix = []
    for n in rows:
        free, line = sum(left), []
        for s in range(shards):
            free -= left[s]
            taken = hypergeometric(rng, left[s], free, n)
            left[s] -= taken
            n -= taken
            line.append(taken)
        matrix.append(line)
    return matrix


def _limits(spark: SparkSession, matrix: dict[int, list[int]]) -> DataFrame:
    """Per block: the local ranks at which the next shard begins; at most MAX_BLOCKS rows."""
    lines = [(block, [int(x) for x in np.cumsum(line)]) for block, line in matrix.items()]
    return F.broadcast(spark.createDataFrame(lines, "block int, limits array<long>"))


def shuffle_into_shards(df: DataFrame, shards: int = 24, seed: int = 42) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (its place in the shard, from 0 without gaps).

    Every order of all rows is as likely as any other, up to the quality of the hash that serves as random numbers;
    shard sizes differ by one row at most. Repeated rows and nulls need no care: a row is told by its place. An input
    column named shard or slot is replaced; an empty table gives an empty result.

    The rows' partitions are counted, a matrix of partition-to-shard counts is drawn (the driver sees counts alone),
    each partition is permuted and cut by its matrix row, rows are exchanged, and each shard is permuted, in slices of
    the random key so that no task holds a whole shard.
    """
    spark, columns = df.sparkSession, df.columns
    tag, block = F.monotonically_increasing_id(), F.spark_partition_id() % MAX_BLOCKS
    rows = written(df.select(packed(df).alias("row"), block.alias("block"), tag.alias("tag")), "partitions")
    counts = {r["block"]: r["count"] for r in rows.groupBy("block").count().orderBy("block").collect()}
    matrix = dict(zip(counts, communication_matrix(list(counts.values()), shards, seed)))
    total = sum(counts.values())

    local = F.expr(f"row_number() over (partition by block order by xxhash64(tag, {seed}, 1), tag) - 1")
    dealt = rows.withColumn("rank", local).join(_limits(spark, matrix), "block")
    bits = min(MAX_SLICE_BITS, max(1, math.ceil(math.log2(max(2, total / shards / SLICE_ROWS)))))
    key = f"xxhash64(tag, {seed}, 2)"
    dealt = dealt.select(
        "row",
        "tag",
        F.expr("size(filter(limits, x -> x <= rank))").alias("shard"),
        F.expr(f"shiftrightunsigned({key}, {64 - bits})").cast("int").alias("slice"),
        F.expr(key).alias("key"),
    )
    dealt = written(dealt, "dealt")
    sizes = dealt.groupBy("shard", "slice").count()
    before = sizes.select("shard", "slice", F.expr("sum(count) over (partition by shard order by slice) - count").alias("before"))
    inside = F.expr("row_number() over (partition by shard, slice order by key, tag) - 1")
    # At most shards * 2^MAX_SLICE_BITS rows.
    placed = dealt.withColumn("inside", inside).join(F.broadcast(before), ["shard", "slice"])
    slot = (F.col("before") + F.col("inside")).cast("long").alias("slot")
    return unpacked(placed, "row", columns, F.col("shard").cast("int").alias("shard"), slot)
