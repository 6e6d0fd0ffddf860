"""A fitted pipeline kept as tables: scaler, network or trees, names of features and classes.

``save_pipeline`` writes them below one path, ``load_pipeline`` reads them back in any later session, and
``apply_pipeline`` scores rows with either, to the last bit alike. Trees stay in their table of nodes: scoring reads
them part by part, and chosen trees are read by their numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classkit import functions as fn
from classkit.functions.scores import DECISION_THRESHOLD
from classkit.operators import boosting, mlp
from classkit.operators.columns import decode_label
from classkit.runtime import MAX_CLASSES, local_table

STEPS = "kind string, outputs int, eta double, features array<string>, mean array<double>, divisor array<double>, threshold double"
CLASSES = "label_idx int, label string"
WEIGHTS = pa.schema([("layer", pa.int32()), ("src", pa.int32()), ("dst", pa.int32()), ("weight", pa.float64())])


@dataclass
class Pipeline:
    """What scoring needs. ``classes`` are the names of class 0, 1, .."""

    model: mlp.Fit | boosting.Boosted
    features: list[str]
    classes: list[str]
    threshold: float = DECISION_THRESHOLD


def with_scaler(fit: mlp.Fit | mlp.EpochFit, scaler: DataFrame) -> mlp.Fit:
    """A network fitted on scaled features, to be used on unscaled ones."""
    row = scaler.select("mean", "std").first()
    return mlp.Fit(fit.network, scale=(np.array(row["mean"]), np.array([s or 1.0 for s in row["std"]])))


def _weights(network: mlp.Network) -> pa.Table:
    """``(layer, src, dst, weight)``; biases have ``src`` -1."""
    parts = []
    for layer, (w, b) in enumerate(zip(network.weights, network.biases)):
        whole = np.vstack([b, w])
        src, dst = (i.ravel() for i in np.indices(whole.shape))
        columns = (np.full(whole.size, layer), src - 1, dst, whole.ravel())
        parts.append(pa.table([pa.array(c, f.type) for c, f in zip(columns, WEIGHTS)], schema=WEIGHTS))
    return pa.concat_tables(parts)


def _network(table: pa.Table) -> mlp.Network:
    layer, src, dst, weight = (c.to_numpy() for c in table.columns)
    weights, biases = [], []
    for number in range(int(layer.max()) + 1):
        mine = layer == number
        whole = np.zeros((src[mine].max() + 2, dst[mine].max() + 1))
        whole[src[mine] + 1, dst[mine]] = weight[mine]
        weights.append(whole[1:])
        biases.append(whole[0])
    return mlp.Network(weights, biases)


def save_pipeline(spark: SparkSession, path: str, pipeline: Pipeline) -> None:
    """Write the pipeline below ``path``, which must not exist yet."""
    model, trees = pipeline.model, isinstance(pipeline.model, boosting.Boosted)
    if len(pipeline.classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    mean, divisor = (None, None) if trees or model.scale is None else (s.tolist() for s in model.scale)
    outputs = model.outputs if trees else model.network.biases[-1].size
    step = ("trees" if trees else "network", outputs, model.eta if trees else None, pipeline.features, mean, divisor, pipeline.threshold)
    if trees:
        boosting.node_table(spark, model).write.partitionBy("part").parquet(f"{path}/nodes")
    else:
        spark.createDataFrame(_weights(model.network)).write.parquet(f"{path}/weights")
    spark.createDataFrame(list(enumerate(pipeline.classes)), CLASSES).write.parquet(f"{path}/classes")
    spark.createDataFrame([step], STEPS).coalesce(1).write.parquet(f"{path}/steps")  # last: what lacks it is not whole


def load_pipeline(spark: SparkSession, path: str) -> Pipeline:
    """A pipeline written by `save_pipeline`. Nodes of trees are not read yet."""
    step = spark.read.schema(STEPS).parquet(f"{path}/steps").first()
    classes = [r["label"] for r in spark.read.schema(CLASSES).parquet(f"{path}/classes").orderBy("label_idx").collect()]
    if step["kind"] == "trees":
        model = boosting.stored_trees(spark, f"{path}/nodes", step["outputs"], step["eta"])
    else:
        weights = spark.read.parquet(f"{path}/weights").select(*WEIGHTS.names).toArrow()
        scale = None if step["mean"] is None else (np.array(step["mean"]), np.array(step["divisor"]))
        model = mlp.Fit(_network(weights), scale=scale)
    return Pipeline(model, list(step["features"]), classes, step["threshold"])


def apply_pipeline(df: DataFrame, pipeline: Pipeline, target: str = "p") -> DataFrame:
    """Add ``target`` (class probabilities), ``prediction`` (class index) and ``class`` (its name).

    With one feature name, that column is an array of all features; else each name is a column of its own.
    """
    one = len(pipeline.features) == 1
    packed = df if one else df.withColumn("_features", F.array(*[F.col(c).cast("double") for c in pipeline.features]))
    column = pipeline.features[0] if one else "_features"
    predict = boosting.predict_boosted if isinstance(pipeline.model, boosting.Boosted) else mlp.predict
    scored = predict(packed, pipeline.model, features=column, target=target)
    two = len(pipeline.classes) == 2
    p = F.col(target)
    found = fn.threshold(fn.positive_probability(p), pipeline.threshold) if two else fn.argmax(p)
    names = local_table(df.sparkSession, [{"label_idx": i, "label": c} for i, c in enumerate(pipeline.classes)], T.StructType.fromDDL(CLASSES))
    named = decode_label(scored.withColumn("prediction", found), "prediction", names, "label", "class")
    return named.select(*df.columns, target, "prediction", "class")
