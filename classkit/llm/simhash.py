"""Near duplicates by SimHash: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classkit.llm.common import in_small_batches, named, packed, tagged, text_of, unpacked, written
from classkit.llm.components import connected_components

SEED = 42
# Bytes of a text that are cut into words at once, and shingles that are hashed at once.
SLICE_BYTES = 1 << 20
SHINGLES = 1 << 15
# Fingerprints of one block key that are compared in one task; larger sets are dealt into pairs of parts.
BLOCK_ROWS = 100_000

_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _words(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words, slice by slice; only A to Z are changed."""
    start = 0
    while start < len(text):
        end = start + SLICE_BYTES
        if end < len(text):
            cut = _SPACE.search(text, end)
            end = cut.start() if cut else len(text)
        yield text[start:end].lower().split()
        start = end


def _bit_sums(hashes: Iterator[int], sums: np.ndarray) -> int:
    """Add each bit's count over the hashes to ``sums``; how many hashes there were."""
    n = 0
    while (part := np.fromiter(islice(hashes, SHINGLES), np.uint64)).size:
        sums += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += part.size
    return n


def fingerprint(text: bytes, words: int = 3) -> int:
    """64 bits, as a signed integer; a bit is set if it is in over half of the shingles' hashes. No words: zero."""
    sums, n, held = np.zeros(64, np.int64), 0, []
    for part in _words(text):
        held += part
        if len(held) >= words:
            shingles = map(b" ".join, zip(*[held[i:] for i in range(words)])) if words > 1 else iter(held)
            n += _bit_sums(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), sums)
            held = held[len(held) - words + 1 :]
    if not n:
        if not held:
            return 0
        n = _bit_sums(iter([xxhash.xxh64_intdigest(b" ".join(held), SEED)]), sums)
    return int(np.packbits(sums * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, text_col: str = "text") -> DataFrame:
    """``docs`` packed in struct ``row``, with ``fingerprint`` (long). A null text is empty."""

    @F.arrow_udf("long")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            yield pa.array([fingerprint(t.as_py().encode(), words) for t in array], pa.int64())

    return in_small_batches(docs).select(packed(docs).alias("row"), of(text_of(text_col)).alias("fingerprint"))


def block_masks(max_bits: int, blocks: int | None = None) -> list[int]:
    """Bit masks of which one at least is free of differences between any two fingerprints that differ in ``max_bits``.

    The 64 bits are cut into ``blocks`` runs (two more than the bits, unless given). Differing bits touch ``max_bits``
    of them at most, so some choice of the others agrees; more blocks mean longer, rarer keys and more of them.
    """
    blocks = blocks or max_bits + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    runs = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    return [sum(kept) for kept in combinations(runs, blocks - max_bits)]


def _stars(values: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, int]]:
    """Links among sorted distinct fingerprints as stars: (members, centre), not as all pairs.

    A search from the smallest value takes each value it reaches out of the rest, so a crowd of close fingerprints costs
    little more than its size.
    """
    rest = values
    while rest.size > 1:
        centre, rest = int(rest[0]), rest[1:]
        queue = [np.int64(centre)]
        while queue and rest.size:
            near = np.bitwise_count((rest ^ queue.pop()).view(np.uint64)) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                yield found, centre
                queue.extend(found)


def _linker(max_bits: int):
    """mapInArrow over rows (key, fingerprint) sorted by both: links of each key's fingerprints."""

    def flush(keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        bigs, smalls = [], []
        for i in np.flatnonzero(np.diff(edges) > 1).tolist():
            for members, centre in _stars(np.unique(values[edges[i] : edges[i + 1]]), max_bits):
                bigs.append(members)
                smalls.append(np.full(members.size, centre, np.int64))
        if bigs:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(bigs)), pa.array(np.concatenate(smalls))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            values = np.concatenate([values, batch.column(1).to_numpy()])
            if keys[0] == keys[-1]:
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            yield from flush(keys[:last], values[:last])
            keys, values = keys[last:], values[last:]
        if keys.size:
            yield from flush(keys, values)

    return run


def link_fingerprints(distinct: DataFrame, max_bits: int = 3, blocks: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links ``a, b`` that join all of the distinct longs in column ``fingerprint`` differing in at most ``max_bits``.

    Every two such fingerprints are connected by the links, directly or over others as close. Fingerprints meet on the
    block keys; a key with more than ``block_rows`` of them is dealt into parts, and each pair of parts into a task.
    The column must hold no nulls (null texts have fingerprint zero); an empty table has no links.
    """
    masks = block_masks(max_bits, blocks)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fingerprint").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))) for i, m in enumerate(masks)])
    keyed = distinct.select(F.explode(keys).alias("key"), "fingerprint")
    sizes = keyed.groupBy("key").count().where(F.col("count") > block_rows)
    large = written(sizes.select("key", F.ceil(F.col("count") * 2 / block_rows).cast("int").alias("parts")), "large")
    if not large.isEmpty():
        part = F.pmod(F.xxhash64("fingerprint", F.lit(7)), F.col("parts"))
        split = keyed.join(large, "key").withColumn("part", part)
        split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        own = F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other"))
        keyed = keyed.join(large, "key", "left_anti").union(split.select(own.alias("key"), "fingerprint"))
    dealt = keyed.repartition("key").sortWithinPartitions("key", "fingerprint")
    return dealt.mapInArrow(_linker(max_bits), "a long, b long").distinct()


def _components(rows: DataFrame, max_bits: int, blocks: int | None) -> DataFrame:
    """``fingerprint, component`` (the component's smallest fingerprint) of every distinct fingerprint in ``rows``."""
    distinct = written(rows.select("fingerprint").distinct(), "distinct")
    found = written(connected_components(link_fingerprints(distinct, max_bits, blocks)), "components")
    found = found.withColumnRenamed("node", "fingerprint")
    joined = distinct.join(found, "fingerprint", "left")
    return joined.select("fingerprint", F.coalesce("component", "fingerprint").alias("component"))


def near_duplicates(
    docs: DataFrame, words: int = 3, max_bits: int = 3, blocks: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    Fingerprints that differ in ``max_bits`` or fewer bits are linked; ``component_id`` is the smallest id that can be
    reached over links, the row's own included. Texts without words, null ones too, have fingerprint zero and are linked
    like any other. A null id takes part but is nobody's component id, unless all ids of its component are null; then
    that is null. An empty table gives an empty result; other columns are not looked at.
    """
    narrow = docs.select(named(id_col).alias("doc_id"), named(text_col).alias("text"))
    rows = fingerprints(narrow, words).select(F.col("row.doc_id").alias("doc_id"), "fingerprint")
    rows = written(rows, "fingerprints")
    component = written(_components(rows, max_bits, blocks), "component")
    least = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    ids = component.join(least, "fingerprint").groupBy("component").agg(F.min("least").alias("component_id"))
    ids = written(component.join(ids, "component").select("fingerprint", "component_id"), "ids")
    return rows.join(ids, "fingerprint").select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(
    docs: DataFrame, words: int = 3, max_bits: int = 3, blocks: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when each group of near duplicates keeps its smallest id.

    Of repeated rows one stays; a null id stays only where all are null. An empty table gives an empty result.
    """
    rows = tagged(docs)
    narrow = rows.select(F.col("row").getField(id_col).alias("doc_id"), F.col("row").getField(text_col).alias("text"), "tag")
    prints = written(fingerprints(narrow, words).select("row.doc_id", "row.tag", "fingerprint"), "fingerprints")
    component = written(_components(prints, max_bits, blocks), "component")
    best = prints.groupBy("fingerprint").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag")).alias("best"))
    kept = component.join(best, "fingerprint").groupBy("component").agg(F.min("best").alias("best"))
    kept = written(kept.select(F.col("best.tag").alias("tag")), "kept")
    return unpacked(rows.join(kept.hint("merge"), "tag", "left_semi"), "row", docs.columns)
