"""Session-wide helpers: the shared folder and tables written into it."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

# A label column with more classes than this is refused, so every "one row per
# class" table in this package has a proven size and may be broadcast.
MAX_CLASSES = 10_000


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``, else one in the session's warehouse.

    On a cluster, a warehouse in one machine's own files is refused: other machines would not see what is written there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {warehouse} may be one machine's own")
    return f"{warehouse}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/classkit/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the shared folder: cuts lineage and survives
    the loss of executors, and later scans still prune columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a table made by `written` that nothing reads any more."""
    jvm, paths = df.sparkSession._jvm, {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    for path in paths:
        if "/classkit/" in path:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def small(df: DataFrame, limit: int, what: str) -> DataFrame:
    """Compute a table of at most ``limit`` rows now and keep it as a local relation.

    For fitted state (cut keys, means, a grid): later plans then start from its
    few rows instead of computing them again. A larger table is refused.
    """
    rows = df.limit(limit + 1).toArrow()
    if rows.num_rows > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def local_table(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A few driver-side rows as a local relation, which joins without a job."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(schema)), schema=schema)


def few(df: DataFrame, limit: int, what: str) -> DataFrame:
    """A lazily checked broadcast side: the query fails once ``df`` passes ``limit`` rows.

    At most one row more than the limit is ever looked at.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy())
    message = F.lit(f"too many {what}: more than {limit}")
    cut = df.limit(limit + 1).withColumn("_n", n)
    first, *rest = df.columns
    checked = F.when(F.col("_n") > limit, F.raise_error(message)).otherwise(F.col(first)).alias(first)
    return F.broadcast(cut.select(checked, *rest))


def bounded(count: Column, value: Column, what: str, limit: int = MAX_CLASSES) -> Column:
    """``value``, or a failing query once ``count`` passes ``limit``."""
    message = F.concat(F.lit(f"too many {what}: "), count.cast("string"), F.lit(f" > {limit}"))
    return F.when(count > limit, F.raise_error(message)).otherwise(value)
