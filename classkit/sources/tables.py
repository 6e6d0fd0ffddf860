"""Reading, previewing and writing feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read a CSV file with a header, or parquet for any other path.

    Give ``schema`` for CSV: without it Spark reads the file once more to infer
    types. A blank header cell arrives as ``_c0``, see :func:`rename_column`.
    """
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        reader = spark.read.option("header", True)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        return reader.csv(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a derived table as parquet, or as CSV with a header for ``*.csv``."""
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    if path.rstrip("/").endswith(".csv"):
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def explode_features(df: DataFrame, features: str, names: Sequence[str]) -> DataFrame:
    """Turn one array column into one double column per name."""
    kept = [F.col(c) for c in df.columns if c != features]
    return df.select(*kept, *[F.col(features)[i].cast("double").alias(n) for i, n in enumerate(names)])


def pack_features(df: DataFrame, names: Sequence[str], features: str = "features") -> DataFrame:
    """The inverse: named columns become one ``array<double>`` column."""
    kept = [F.col(c) for c in df.columns if c not in set(names)]
    return df.select(*kept, F.array(*[F.col(n).cast("double") for n in names]).alias(features))


def preview(df: DataFrame, order_by: str | Column | Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order (planned as ``TakeOrderedAndProject``)."""
    keys = [order_by] if isinstance(order_by, str | Column) else list(order_by)
    return df.orderBy(*keys).limit(n)
