"""Token ids of documents in Parquet files that can be read in parts, in the order of the documents' ids.

The layout, under one folder:

* ``tokens``: one row per document with ``part, doc_id, start, n_tokens, ids``. A part is a range of ids and one task's
  files; parts and the rows inside them ascend. ``ids`` are dictionary encoded (a vocabulary's ids fit a dictionary
  page), the ascending numbers are delta encoded. Row groups and pages are small, and the writer adds page indexes, so a
  reader skips row groups and pages by ``part``, ``doc_id`` and ``start``, and reads no ids where it asks for none.
* ``manifest``: ``part, n_docs, n_tokens, base``, ``base`` being the ids of all parts before. ``start`` in the files
  counts from the part's begin, so that no task waits for another; readers add ``base``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from classkit.llm.common import named, text_of
from classkit.llm.tokens import _byte_letters
from classkit.runtime import few, local_table

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES, PAGE_ROWS = 256 << 10, 4_096
# Rows and ids that leave a task together; a longer document leaves alone.
BATCH_ROWS, BATCH_IDS = 1_000, 1 << 20
# Characters whose words are looked up at once, and words that a worker remembers.
SLICE_CHARS, KEPT_WORDS = 1 << 20, 500_000
KEPT_RUNS = 10_000  # runs of marks that a worker remembers
MAX_PARTS = 1_000_000

# What a file's pre-tokeniser must be so that no match ever holds white space (fixed value).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_GAP = re.compile(r"[ \t\n\r\f\v]")
# Words that the normalisers only lower, in which the pattern finds the letters and the marks: Latin-1 letters, then ASCII
# marks but for the apostrophe.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")

_MANIFEST = T.StructType([T.StructField("part", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("n_docs", "n_tokens", "base")]])


class _Known(dict):
    """Ids by word. What is not known comes from the words known before, so those that recur are kept, or is made."""

    def __init__(self, make, before: dict[bytes, bytes]):
        super().__init__()
        self.make, self.before = make, dict(before)

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.before.get(word) or self.make(word)
        return ids


class WordEncoder:
    """Ids by the `tokenizers` library, without added begin or end ids, truncation or padding.

    Where the file's pattern leaves white space out of every match, and its normalisers change nothing across white
    space, the ids of a text are those of its words one after the other, whatever added tokens stand in them. Words are
    then encoded once and remembered. Other files encode each text whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            about = json.load(file)
        self.by_words = self._divides(about)
        # Added tokens are of other characters, the bytes' letters those of the usual byte-level vocabularies.
        self.simple = self.by_words and not any(_SIMPLE.fullmatch(t["content"]) for t in about.get("added_tokens") or [])
        self.letters = {byte: letter for letter, byte in _byte_letters().items()}
        self.known = _Known(self.word, {})
        self.runs: dict[str, bytes] = {}

    @staticmethod
    def _divides(about: dict) -> bool:
        before, change = about.get("pre_tokenizer") or {}, about.get("normalizer") or {}
        split, *rest = before.get("pretokenizers") or [{}]
        added = about.get("added_tokens") or []
        return (
            split.get("type") == "Split"
            and split["pattern"] == {"Regex": _PATTERN}
            and (split["behavior"], split["invert"]) == ("Removed", True)
            and all(r["type"] == "ByteLevel" and not r["use_regex"] and not r["add_prefix_space"] for r in rest)
            and all(n["type"] in ("NFC", "Lowercase") or n == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "} for n in change.get("normalizers", [change] if change else []))
            and not about["model"].get("dropout")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in added)
        )

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: bytes) -> bytes:
        """The ids of a word: a simple one's straight from the library's merges, several times as fast."""
        text = word.decode()
        if self.simple and word.isalpha() and word.islower():  # of ASCII letters, as most are
            return self._merged(text)
        simple = _SIMPLE.fullmatch(text) if self.simple else None
        if not simple:
            return self._library(text)
        letters, marks = simple[1].lower(), simple[2]
        if marks or letters != text:  # made of others
            return self.known[letters.encode()] + (self._marks(marks) if marks else b"")
        return self._merged(text if text.isascii() else "".join(map(self.letters.__getitem__, word)))

    def _marks(self, marks: str) -> bytes:
        """The same few runs of marks end very many words."""
        ids = self.runs.get(marks)
        if ids is None:
            if len(self.runs) >= KEPT_RUNS:
                self.runs.clear()
            ids = self.runs[marks] = self._merged(marks)
        return ids

    def _merged(self, run: str) -> bytes:
        ids = [t.id for t in self.tokenizer.model.tokenize(run)]
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """All ids of the text, as little-endian unsigned 32-bit integers."""
        if not self.by_words:
            return self._library(text)
        made, start = [], 0
        while start < len(text):
            cut = _GAP.search(text, start + SLICE_CHARS) if len(text) - start > SLICE_CHARS else None
            end = cut.start() if cut else len(text)
            words = text[start:end].encode().split()  # of bytes, ASCII white space alone divides
            if len(self.known) > KEPT_WORDS:
                self.known = _Known(self.word, self.known)
            made.append(b"".join(map(self.known.__getitem__, words)))
            start = end
        return b"".join(made)


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    """One encoder a worker."""
    return WordEncoder(path)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """(id, text) rows in order as rows of the files: (part, doc_id, start, n_tokens, ids)."""
    own, last = word_encoder(path), np.array([end_id], "<u4").tobytes()
    part, done = TaskContext.get().partitionId(), 0

    def batch_of(ids: pa.Array, held: list[bytes]) -> pa.RecordBatch:
        nonlocal done
        sizes = np.array([len(h) // 4 for h in held], np.int64)
        starts = done + np.cumsum(sizes) - sizes
        done += int(sizes.sum())
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(held))])
        arrays = [pa.array(np.full(len(held), part, np.int32)), ids, pa.array(starts), pa.array(sizes), pa.ListArray.from_arrays(offsets, values)]
        return pa.RecordBatch.from_arrays(arrays, names=["part", "doc_id", "start", "n_tokens", "ids"])

    for batch in batches:
        first, held, size = 0, [], 0
        for row, text in enumerate(batch.column(1)):
            held.append(own.encode(text.as_py()) + last)
            size += len(held[-1]) // 4
            if len(held) >= BATCH_ROWS or size >= BATCH_IDS:
                yield batch_of(batch.column(0).slice(first, len(held)), held)
                first, held, size = row + 1, [], 0
        if held:
            yield batch_of(batch.column(0).slice(first, len(held)), held)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Write the ids of all documents below ``path``, which must not exist yet; see the module for the layout.

    A document's ids are its text's, then ``end_id``; a null text is empty, so it has one id. Documents ascend by id,
    null ids first; of repeated ids the order is by a hash of the texts, so only equal rows are alike. An empty table
    gives tables without rows. Other columns are not looked at. A document holds at most 2^31 - 2 ids.

    Texts are exchanged once, by ranges of (id, hash of the text, place in the task), so neither repeated ids nor a group of copies lands in
    one task, and encoded after that. Spark writes the files, so lost tasks are written anew.
    """
    text = text_of(text_col)
    rows = docs.select(named(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("n"))
    rows = rows.repartitionByRange("doc_id", "h", "n").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    ddl = f"part int, doc_id {rows.schema['doc_id'].dataType.simpleString()}, start long, n_tokens long, ids array<int>"
    made = rows.mapInArrow(lambda batches: _encoded(batches, tokenizer, end_id), ddl)
    layout = {
        "compression": "zstd",
        "parquet.writer.version": "v2",  # delta encodings for what has no dictionary
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.enable.dictionary": "true",
    }
    layout |= {f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "start", "n_tokens")}
    made.write.options(**layout).parquet(f"{path}/tokens")
    spark = docs.sparkSession
    parts = spark.read.schema(made.schema).parquet(f"{path}/tokens").groupBy("part")
    counted = parts.agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).limit(MAX_PARTS + 1).collect()
    if len(counted) > MAX_PARTS:
        raise ValueError(f"more than {MAX_PARTS} parts")
    entries, base = [], 0
    for row in sorted(counted):
        entries.append(row.asDict() | {"base": base})
        base += row["n_tokens"]
    local_table(spark, entries, _MANIFEST).coalesce(1).write.parquet(f"{path}/manifest")


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of what `write_tokens` wrote, ``start`` being the ids of all documents before.

    Only the columns that are asked for are read. ``where`` is a predicate on ``part``, ``doc_id`` or ``n_tokens`` that
    the scan gets, to skip row groups and pages by it.
    """
    tokens = spark.read.parquet(f"{path}/tokens")
    tokens = tokens if where is None else tokens.where(where)
    bases = few(_manifest(spark, path).select("part", "base"), MAX_PARTS, "parts")
    return tokens.join(bases, "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")


def read_span(spark: SparkSession, path: str, first: int, end: int) -> DataFrame:
    """``doc_id, start, ids``: the ids at places ``first`` to ``end`` (exclusive) of all ids, by document.

    Parts, row groups and pages outside the span are skipped.
    """
    inside = _manifest(spark, path).where((F.col("base") < end) & (F.col("base") + F.col("n_tokens") > first))
    wanted = F.lit(False)
    reach = inside.agg(F.min("part").alias("low"), F.max("part").alias("high")).head()
    if reach["low"] is not None:
        ends = {r["part"]: r["base"] for r in inside.where(F.col("part").isin(reach["low"], reach["high"])).collect()}
        low, high = reach["low"], reach["high"]
        begins = (F.col("part") > low) | (F.col("start") + F.col("n_tokens") > first - ends[low])
        wanted = F.col("part").between(low, high) & begins & ((F.col("part") < high) | (F.col("start") < end - ends[high]))
    rows = read_tokens(spark, path, wanted)
    skipped = F.greatest(F.lit(first) - F.col("start"), F.lit(0)).cast("int")
    taken = (F.least(F.lit(end), F.col("start") + F.col("n_tokens")) - F.col("start") - skipped).cast("int")
    return rows.select("doc_id", (F.col("start") + skipped).alias("start"), F.slice("ids", skipped + 1, taken).alias("ids"))


@F.arrow_udf(T.LongType())
def ids_crc32(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """CRC-32 of a list's ids as little-endian unsigned 32-bit integers."""
    for lists in ids:
        values = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
        edges = lists.offsets.to_numpy().tolist()
        yield pa.array([crc32(values[4 * a : 4 * b]) for a, b in zip(edges, edges[1:])], pa.int64())
