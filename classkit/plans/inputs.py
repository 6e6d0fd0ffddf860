"""The feature tables that queries start from, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from classkit.sources import read_table

SEED = 42
TEST_SIZE = 0.3
VALID_SIZE = 0.2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten classes, 64 features in one array."""
    df = table(spark, sf_dir, "embeddings")
    return df.select("vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")


VECTORS = "vectors AS (SELECT vec_id, embedding::DOUBLE[] AS features, label FROM embeddings)"


def binary_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).withColumn("label", (F.col("label") >= 5).cast("int"))


BINARY_VECTORS = (
    "vectors AS (SELECT vec_id, embedding::DOUBLE[] AS features, (label >= 5)::INTEGER AS label FROM embeddings)"
)

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with a unique id, four numeric features and three classes."""
    df = table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    keys = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    return df.select(
        F.concat_ws("|", *keys, cents.cast("string")).alias("line_id"), *LINE_FEATURES, "l_returnflag", "l_linenumber"
    )


LINES = """lines AS (
  SELECT concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_extendedprice * 100)::BIGINT) AS line_id,
         l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linenumber
  FROM lineitem)"""

DOC_FEATURES = ["n_chars", "n_words", "n_digits", "n_lines"]


def judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a quality label (imbalanced) and counts over their whole text."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    # Only labelled documents' texts are looked at: the counts stand above the join.
    judged = documents.join(labels.select("doc_id", F.col("quality").alias("label"), "toxic"), "doc_id")
    return judged.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", " ")).cast("double").alias("n_words"),
        F.length(F.regexp_replace("text", "[^0-9]", "")).cast("double").alias("n_digits"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        "label",
        "toxic",
    )


JUDGED = """judged AS (
  SELECT doc_id, n_chars::DOUBLE AS n_chars, len(string_split(text, ' '))::DOUBLE AS n_words,
         length(regexp_replace(text, '[^0-9]', '', 'g'))::DOUBLE AS n_digits,
         len(string_split(text, chr(10)))::DOUBLE AS n_lines, quality AS label, toxic
  FROM documents JOIN labels USING (doc_id))"""


def split_sql(name: str, source: str, id_col: str, label: str, size: float, seed: int | str = SEED) -> str:
    """CTEs ending in ``name``: ``source`` plus ``part``, by plain ranks over whole classes."""
    return f"""{name}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5(concat({id_col}::VARCHAR, '|{seed}')), {id_col}) AS rk
  FROM {source}),
{name}_sizes AS (
  SELECT {label}, count(*)::HUGEINT AS n, (sum(count(*)) OVER ())::HUGEINT AS total FROM {source} GROUP BY {label}),
{name}_want AS (SELECT *, ceil({size}::DOUBLE * total)::HUGEINT AS want FROM {name}_sizes),
{name}_base AS (SELECT *, (n * want) // total AS base, (n * want) % total AS rest FROM {name}_want),
{name}_take AS (
  SELECT {label}, base + (row_number() OVER (ORDER BY rest DESC, {label}) <= want - sum(base) OVER ())::INT AS take
  FROM {name}_base),
{name} AS (
  SELECT r.* EXCLUDE (rk), CASE WHEN rk <= take THEN 'test' ELSE 'train' END AS part
  FROM {name}_ranked r JOIN {name}_take USING ({label}))"""


def folds_sql(name: str, source: str, id_col: str, label: str, k: int = 5, seed: int | str = SEED) -> str:
    """CTEs ending in ``name``: ``source`` plus ``fold``, sizes dealt round robin over the sorted labels."""
    return f"""{name}_dealt AS (
  SELECT {label}, (row_number() OVER (ORDER BY {label}) - 1) % {k} AS fold FROM {source}),
{name}_ends AS (
  SELECT {label}, fold, sum(count(*)) OVER (PARTITION BY {label} ORDER BY fold) AS last
  FROM {name}_dealt GROUP BY {label}, fold),
{name}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5(concat({id_col}::VARCHAR, '|{seed}')), {id_col}) AS rk
  FROM {source}),
{name} AS (
  SELECT r.* EXCLUDE (rk), (SELECT min(e.fold) FROM {name}_ends e
                            WHERE e.{label} = r.{label} AND r.rk <= e.last)::INTEGER AS fold
  FROM {name}_ranked r)"""
