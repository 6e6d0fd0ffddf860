"""A corpus pipeline from raw documents to packed sequences, in stages that are written one after the other."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from classkit.llm.common import documents, text_of, written
from classkit.llm.langid import keep_identified
from classkit.llm.line_templates import drop_recurring_lines
from classkit.llm.packing import pack, piece_digests
from classkit.llm.pii import sanitise
from classkit.llm.simhash import one_per_group

# Texts whose best language needs at least this share less than the second; prose lies far above.
MIN_LANGUAGE_SCORE = 0.02


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.char_length(text_of("text")).cast("long")).select(*docs.columns) if "n_chars" in docs.columns else docs


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; those without letters or without a clear language go."""
    return keep_identified(docs, MIN_LANGUAGE_SCORE)


def recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of templates that stand in an earlier document already."""
    return _counted(drop_recurring_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (3-word shingles, at most 3 bits apart): the smallest id."""
    return one_per_group(docs, words=3, max_bits=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and the terms that reveal it replaced by names of their kinds."""
    return _counted(sanitise(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, dealt into sequences of 2,048 ids."""
    return piece_digests(pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("recurring_lines", recurring_lines),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

# The stages learn models, cluster fingerprints and call tokenizers, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage's rows but the last's are written and read again by the next one."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
