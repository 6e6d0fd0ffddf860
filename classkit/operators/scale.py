"""Standardisation: mean and population standard deviation, fitted on train rows.

Feature vectors are ``array<double>`` columns. Statistics come from one pass with
a vector aggregate that combines on the map side. Fitted statistics are computed
when the fit function is called: one row, or one row per held-out fold.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classkit.operators.columns import require_clean_vectors
from classkit.runtime import small

MAX_FOLDS = 1_000


def _population(row: Column, n: Column) -> list[Column]:
    """Mean and population variance arrays; the vector aggregate divides by n - 1."""
    variance = F.transform(vector_to_array(row["variance"]), lambda v: v * (n - 1) / n)
    return [vector_to_array(row["mean"]).alias("mean"), variance.alias("variance")]


def _summary(df: DataFrame, features: str, by: list[str]) -> DataFrame:
    metrics = Summarizer.metrics("count", "mean", "variance")
    rows = df.groupBy(*by).agg(metrics.summary(array_to_vector(F.col(features).cast("array<double>"))).alias("s"))
    return rows.select(*by, F.col("s.count").alias("n"), *_population(F.col("s"), F.col("s.count")))


def fit_scaler(train: DataFrame, features: str) -> DataFrame:
    """One row ``(n, mean, std)`` with array columns; unfit vectors are an error that counts them."""
    stats = _summary(train, features, []).select("n", "mean", F.transform("variance", F.sqrt).alias("std"))
    return _checked(stats, 1, "scaler", train, features)


def _checked(stats: DataFrame, limit: int, what: str, rows: DataFrame, features: str) -> DataFrame:
    """The fitted rows; vectors that make the aggregate fail, or its means NaN, are counted in an error."""
    try:
        fitted = small(stats, limit, what)
        clean = not any(math.isnan(m) for r in fitted.select("mean").collect() for m in r["mean"] or [math.nan])
    except Exception:
        require_clean_vectors(rows, features)
        raise
    if not clean:
        require_clean_vectors(rows, features)
    return fitted


def fit_column_scaler(train: DataFrame, columns: list[str]) -> DataFrame:
    """``(feature, mean, std)`` for scalar columns: one aggregation over the table."""
    aggregates = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        aggregates += [F.avg(value).alias(f"mean_{i}"), F.stddev_pop(value).alias(f"std_{i}")]
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(f"mean_{i}").alias("mean"), F.col(f"std_{i}").alias("std"))
        for i, c in enumerate(columns)
    ]
    return train.agg(*aggregates).select(F.inline(F.array(*cells)))


def fit_fold_scalers(df: DataFrame, features: str, fold: str = "fold") -> DataFrame:
    """``(fold, n, mean, std)`` over the rows *outside* each fold, in one job.

    Each fold is summarised once; the k small rows are then merged k times with
    the pairwise formula for means and variances.
    """
    parts = _summary(df, features, [fold])
    folds = F.array_sort(F.collect_set(fold))
    held_out = parts.agg(folds.alias("folds"), F.collect_list(F.struct("*")).alias("parts")).select(
        F.explode("folds").alias("_held"), "parts"
    )
    others = held_out.select("_held", F.inline("parts")).where(F.col("_held") != F.col(fold))
    cells = others.select("_held", "n", F.posexplode(F.arrays_zip("mean", "variance")).alias("pos", "cell"))
    weighted = cells.groupBy("_held", "pos").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("cell.mean")) / F.sum("n")).alias("mean"),
        F.collect_list(F.struct("n", "cell.mean", "cell.variance")).alias("parts"),
    )
    spread = F.aggregate(
        "parts",
        F.lit(0.0),
        lambda acc, p: acc + p["n"] * (p["variance"] + (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean"))),
    )
    merged = weighted.select("_held", "pos", "n", "mean", F.sqrt(spread / F.col("n")).alias("std"))
    ordered = merged.groupBy("_held").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "mean", "std"))).alias("cells")
    )
    stats = ordered.select(
        F.col("_held").alias(fold), "n", F.col("cells.mean").alias("mean"), F.col("cells.std").alias("std")
    )
    return _checked(stats, MAX_FOLDS, "folds", df, features)


def _scaled(features: str, mean: Column, std: Column) -> Column:
    centred = F.zip_with(F.col(features).cast("array<double>"), mean, lambda x, m: x - m)
    return F.zip_with(centred, std, lambda d, s: d / F.when(s == 0, 1.0).otherwise(s))


def apply_scaler(df: DataFrame, scaler: DataFrame, features: str, target: str | None = None) -> DataFrame:
    """``(x - mean) / std`` with stored statistics; a constant column keeps its unit scale.

    The one-row table of statistics is a scalar subquery.
    """
    stats = scaler.select(F.struct("mean", "std")).scalar()
    return (
        df.withColumn("_stats", stats)
        .withColumn(target or features, _scaled(features, F.col("_stats.mean"), F.col("_stats.std")))
        .drop("_stats")
    )


def apply_fold_scaler(df: DataFrame, scalers: DataFrame, features: str, fold: str, target: str | None = None):
    """Scale each row with the statistics named by its ``fold`` column (one row per fold)."""
    joined = df.join(F.broadcast(scalers.select(fold, "mean", "std")), fold)
    return joined.withColumn(target or features, _scaled(features, F.col("mean"), F.col("std"))).drop("mean", "std")
