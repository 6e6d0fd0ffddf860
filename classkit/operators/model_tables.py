"""Tables that describe a fitted network: weights, their scales and layer sizes.

A weight table has rows ``(layer, src, dst, weight)``, a bias table
``(layer, node, bias)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classkit.functions import centred_unit, edge_width, edge_width_clipped
from classkit.operators.ranking import exact_percentile
from classkit.runtime import few

# Share of the layer's largest weight, percentile of the robust scale.
WEAK_SHARE = 0.05
ROBUST_PERCENTILE = 0.99

MAX_LAYERS = 100_000


def strong_edges(weights: DataFrame, share: float = WEAK_SHARE, group: str = "layer") -> DataFrame:
    """Drop weights below ``share`` of the largest absolute weight of their layer.

    The maxima are aggregated first (combined on the map side) and joined back,
    so a layer with most of the weights is not gathered in one task.
    """
    largest = weights.groupBy(group).agg(F.max(F.abs("weight")).alias("_largest"))
    kept = weights.join(few(largest, MAX_LAYERS, "layers"), group).where(F.abs("weight") >= share * F.col("_largest"))
    return kept.select(*weights.columns)


def robust_maximum(
    weights: DataFrame, value: str = "weight", by: Sequence[str] = (), q: float = ROBUST_PERCENTILE
) -> DataFrame:
    """``(by.., ceiling)``: the percentile of ``abs(value)``, 1.0 where all are zero."""
    sized = weights.select(*by, F.abs(value).alias("_abs"))
    ceiling = exact_percentile(sized, "_abs", q, by)
    largest = sized.groupBy(*by).agg(F.max("_abs").alias("_largest"))
    if by:
        both = ceiling.join(largest, list(by))
    else:
        both = ceiling.withColumn("_largest", largest.scalar())
    return both.select(*by, F.when(F.col("_largest") == 0, 1.0).otherwise(F.col("percentile")).alias("ceiling"))


def edge_styles(
    weights: DataFrame, widest: float = 4.0, narrowest_clipped: float = 0.2, widest_clipped: float = 3.5
) -> DataFrame:
    """Per edge: width by the largest weight, width by the robust maximum, and
    zero-centred positions on a colour scale that ends at either."""
    robust = robust_maximum(weights).scalar()
    top = weights.agg(F.max(F.abs("weight")).alias("m"))
    largest = top.select(F.when(F.col("m") > 0, F.col("m")).otherwise(1.0)).scalar()
    scaled = weights.withColumn("_robust", robust).withColumn("_largest", largest)
    w = F.col("weight")
    return scaled.select(
        *weights.columns,
        edge_width(w, F.col("_largest"), widest).alias("width"),
        edge_width_clipped(w, F.col("_robust"), narrowest_clipped, widest_clipped).alias("clipped_width"),
        centred_unit(w, F.col("_largest")).alias("colour"),
        centred_unit(w, F.col("_robust")).alias("robust_colour"),
    )


def layer_sizes(weights: DataFrame) -> DataFrame:
    """``(layer, n_in, n_out)`` read off the weight table."""
    return weights.groupBy("layer").agg(
        (F.max("src") + 1).cast("long").alias("n_in"), (F.max("dst") + 1).cast("long").alias("n_out")
    )


def weight_matrix(weights: DataFrame, width: int, names: Sequence[str] | None = None) -> DataFrame:
    """One row per source node, one column ``h1..h{width}`` per target node; ``names`` adds the sources' names."""
    wide = weights.groupBy("src").pivot("dst", list(range(width))).agg(F.first("weight"))
    shown = [] if names is None else [F.get(F.array(*[F.lit(n) for n in names]), F.col("src")).alias("name")]
    return wide.select("src", *shown, *[F.col(f"`{j}`").alias(f"h{j + 1}") for j in range(width)])


def node_name(layer: Column, node: Column, inputs: Sequence[str], outputs: Sequence[str], last: int) -> Column:
    """What a node of a network is called: inputs (layer 0) by their features, those of layer ``last`` by their classes,
    hidden ones ``h<layer>_<node>``, both counted from 1. A node beyond the names has none."""

    def named(names: Sequence[str]) -> Column:
        return F.get(F.array(*[F.lit(n) for n in names]), node)

    hidden = F.concat(F.lit("h"), layer.cast("string"), F.lit("_"), (node + 1).cast("string"))
    return F.when(layer == 0, named(inputs)).when(layer == last, named(outputs)).otherwise(hidden)
