"""Column selection, label maps and feature checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from classkit.runtime import MAX_CLASSES, bounded, few


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename a column; a name that is not there changes nothing."""
    return df.withColumnRenamed(old, new)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop named columns; unlike ``DataFrame.drop`` a missing name is an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"no such columns: {missing}")
    return df.drop(*names)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns, in table order, without ``exclude``."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def select_features(df: DataFrame, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, every numeric column as double, and the target."""
    features = numeric_columns(df, exclude=[target, *keep])
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features], target)


def cast_target(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn(target, F.col(target).cast("int"))


def map_values(df: DataFrame, source: str, target: str, mapping: Mapping) -> DataFrame:
    """Look a code up in a small fixed map; unknown codes become null."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return df.withColumn(target, F.create_map(*pairs)[F.col(source)])


def label_index(df: DataFrame, label: str) -> DataFrame:
    """One row per class: ``(label, label_idx, n_classes)``, index 0.. in sorted order.

    The windows run over the distinct labels only, of which no more are taken
    than a classification may have.
    """
    classes = df.select(label).where(F.col(label).isNotNull()).distinct().limit(MAX_CLASSES + 1)
    n = F.count(F.lit(1)).over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy(label)) - 1
    # Every column carries the check, so no projection can drop it.
    return classes.select(
        bounded(n, F.col(label), "classes").alias(label),
        bounded(n, place, "classes").alias("label_idx"),
        bounded(n, n, "classes").cast("int").alias("n_classes"),
    )


def with_label_index(df: DataFrame, label: str, target: str = "label_idx") -> DataFrame:
    """Add the class index; a row without a label keeps a null index."""
    classes = label_index(df, label).select(label, F.col("label_idx").alias(target))
    return df.join(few(classes, MAX_CLASSES, "classes"), label, "left")


def decode_label(df: DataFrame, index: str, classes: DataFrame, label: str, target: str, suffix: str = "") -> DataFrame:
    """Turn a class index back into its display name, e.g. ``"6 cyl"``."""
    names = classes.select(
        F.col("label_idx").alias(index),
        F.concat(F.col(label).cast("string"), F.lit(suffix)).alias(target),
    )
    return df.join(few(names, MAX_CLASSES, "classes"), index, "left")


def bad_feature_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, nulls, nans)`` from one aggregation over the table."""
    sums = []
    for i, c in enumerate(features):
        value = F.col(c).cast("double")
        sums.append(F.count_if(value.isNull()).alias(f"null_{i}"))
        sums.append(F.count_if(F.isnan(value)).alias(f"nan_{i}"))
    row = df.agg(*sums)
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(f"null_{i}").alias("nulls"), F.col(f"nan_{i}").alias("nans"))
        for i, c in enumerate(features)
    ]
    return row.select(F.inline(F.array(*cells)))


def bad_vector_counts(df: DataFrame, features: str) -> DataFrame:
    """``(n_rows, null_rows, null_entry_rows, nan_rows, min_width, max_width)`` of an array column."""
    return df.agg(*bad_vector_aggregates(F.col(features).cast("array<double>")))


def bad_vector_aggregates(value: Column) -> list[Column]:
    """The columns of `bad_vector_counts`, for use beside other aggregates."""
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(value.isNull()).alias("null_rows"),
        F.count_if(F.exists(value, lambda x: x.isNull())).alias("null_entry_rows"),
        F.count_if(F.exists(value, lambda x: F.isnan(x))).alias("nan_rows"),
        F.min(F.size(value)).alias("min_width"),
        F.max(F.size(value)).alias("max_width"),
    ]


def refuse_bad_vectors(counts: Row, features: str) -> None:
    """A ``ValueError`` if a row of `bad_vector_counts` has anything unfit for training."""
    if not counts["n_rows"]:
        raise ValueError(f"{features}: no rows")
    if counts["null_rows"] or counts["null_entry_rows"] or counts["nan_rows"] or counts["min_width"] != counts["max_width"]:
        raise ValueError(f"{features}: {counts.asDict()}")


def clean_vector_shape(df: DataFrame, features: str) -> tuple[int, int]:
    """Rows and width of an array column, or a ``ValueError`` that counts the rows unfit for training."""
    counts = bad_vector_counts(df, features).first()
    refuse_bad_vectors(counts, features)
    return counts["n_rows"], counts["max_width"]


def require_clean_vectors(df: DataFrame, features: str) -> DataFrame:
    """``df`` itself, or a ``ValueError`` that counts the rows unfit for training."""
    clean_vector_shape(df, features)
    return df


def require_clean(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` itself, or a ``ValueError`` that counts the null and NaN features."""
    bad = bad_feature_counts(df, features).where("nulls + nans > 0").collect()  # at most one row per feature
    if bad:
        raise ValueError("; ".join(f"{r.feature}: {r.nulls} null, {r.nans} NaN" for r in bad))
    return df
