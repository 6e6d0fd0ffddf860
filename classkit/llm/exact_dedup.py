"""Exact duplicates: group by a 128-bit content hash, keep one row a group, compare the bytes inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classkit.llm.common import named, text_of, written

# Deleted before texts are compared: space and the control characters tab to carriage return.
WHITE_SPACE = " \t\n\x0b\x0c\r"

# Groups with several rows are looked up in the text scan. Up to this many, 16 bytes each, their hashes are broadcast;
# beyond it the scan is joined to them by a shuffle. Either way gives the same rows.
BROADCAST_GROUPS = 1_000_000


def content_hash(text: Column) -> Column:
    """128 bits of the content."""
    return F.unhex(F.md5(text))


def _rank(n_chars: str = "n_chars", doc_id: str = "doc_id") -> list[Column]:
    """Longest original text first, then the smallest id; a null id comes after all others."""
    return [(-F.col(n_chars)).alias("less"), F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("doc_id")]


def _decide(rows: DataFrame, groups: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(groups, key).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("best.tag") == F.col("tag")).alias("kept"),
        "text_sha256",
    )


def _groups(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("group_size"), F.min(F.struct(*_rank(), "tag")).alias("best"))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
    broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their characters other than white space are; a null text is empty. The row with the most code
    points in its own text stays, then the smallest id; a null id stays only if no other row could. Of rows that agree
    in id and length exactly one stays. An empty table gives an empty result; other columns are not looked at.

    Rows are grouped by ``hashed`` of the normalised text. In every group of several rows the smallest and the largest
    text are found, texts being combined in each task before they move: a group is one text exactly if the two are the
    same bytes. Groups that hold several texts are grouped again by the text itself.
    """
    pure = F.translate(text_of(text_col), WHITE_SPACE, "")
    texts = docs.select(named(id_col).alias("doc_id"), F.char_length(text_of(text_col)).cast("long").alias("n_chars"), pure.alias("pure"))
    digests = texts.select(
        "doc_id",
        "n_chars",
        hashed(F.col("pure")).alias("hash"),
        F.sha2("pure", 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("tag"),
    )
    rows = written(digests, "digests")
    groups = written(_groups(rows, ["hash"]), "groups")

    several = groups.where("group_size > 1").select("hash")
    n = several.count()
    if not n:
        return _decide(rows, groups, ["hash"])
    wanted = F.broadcast(several) if n <= broadcast_groups else several
    again = texts.withColumn("hash", hashed(F.col("pure"))).join(wanted, "hash", "left_semi")
    compared = again.groupBy("hash").agg(F.min("pure").alias("low"), F.max("pure").alias("high"))
    mixed = written(compared.where("low != high").select("hash"), "mixed")
    if mixed.isEmpty():
        return _decide(rows, groups, ["hash"])

    parted = texts.withColumns({"hash": hashed(F.col("pure")), "text_sha256": F.sha2("pure", 256), "tag": F.monotonically_increasing_id()})
    parted = written(parted.join(mixed, "hash", "left_semi"), "parted")
    plain = _decide(rows.join(mixed, "hash", "left_anti"), groups, ["hash"])
    return plain.unionByName(_decide(parted, written(_groups(parted, ["pure"]), "parted_groups"), ["pure"]))
