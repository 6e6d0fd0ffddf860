"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classkit.llm.common import written

MAX_ROUNDS = 64


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("big", "small")), F.sum(F.hash("small", "big").cast("long"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of a link table (two long columns), the component being its smallest node.

    Each round hangs every node's larger neighbours on its smallest one, then its smaller neighbours; the table never
    grows beyond twice the links, and the rounds grow with the logarithm of the longest chain. Smallest neighbours come
    from a count-like aggregate that is combined in each task, and a node with very many links is met only in joins
    whose large side can be split. A round's table is written to the shared folder, so a lost executor costs its tasks.
    Nulls in a link drop it; an empty table gives an empty result.
    """
    a, b = (F.col("`" + c + "`") for c in links.columns)
    links = links.where(a != b).select(F.greatest(a, b).alias("big"), F.least(a, b).alias("small")).distinct()
    links = written(links, "links")
    before = _state(links)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        ways = links.select(F.col("big").alias("node"), F.col("small").alias("near"))
        ways = ways.union(links.select("small", "big"))
        least = written(ways.groupBy("node").agg(F.min(F.least("node", "near")).alias("root")), "least")
        hung = written(ways.join(least, "node").where("near > node").select(F.col("near").alias("node"), F.col("root").alias("near")).distinct(), "hung")
        least = written(hung.groupBy("node").agg(F.min("near").alias("root")), "least")
        again = hung.join(least, "node").where("near != root").select(F.col("near").alias("big"), F.col("root").alias("small"))
        links = written(again.union(least.select("node", "root")).distinct(), "links")
        after = _state(links)
        if after == before:
            return links.select(F.col("big").alias("node"), F.col("small").alias("component")).union(
                links.select("small", "small").distinct()
            )
        before = after
    else:
        raise RuntimeError(f"components not settled in {MAX_ROUNDS} rounds")
    return links.select(F.col("big").alias("node"), F.col("small").alias("component"))
