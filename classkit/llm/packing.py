"""Packing of token ids into sequences of fixed length by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from classkit.llm.common import in_small_batches, named, rebatched, text_of
from classkit.llm.tokens import encoder

CAPACITY = 2048
# Documents' rests are cut into pieces of at most this many ids, so that a window holds several and differencing can
# even the windows out.
PIECE = 512
# Windows that are filled together, and the ids left free in each so that near-equal windows need no further one.
# Pieces of so many windows, and no more, are held in memory.
BLOCK_WINDOWS = 64
SLACK = 32


def difference(sizes: list[int], windows: int) -> tuple[np.ndarray, list[list[int]]]:
    """Deal items into ``windows`` groups of near-equal totals; the totals, largest first, and each group's items.

    Every item begins as a partial partition of its own. The two partitions with the largest imbalance are merged with
    opposing order, the fullest group of one on the emptiest of the other, until one partition is left. Groups are nodes
    of a binary forest whose leaves are the items; -1 is an empty group.
    """
    heap = []
    for i, size in enumerate(sizes):
        totals, nodes = np.zeros(windows, np.int64), np.full(windows, -1)
        totals[0], nodes[0] = size, i
        heap.append((-size, i, totals, nodes))
    heapq.heapify(heap)
    tie, made, lefts, rights = len(sizes), len(sizes), [], []
    while len(heap) > 1:
        _, _, totals, nodes = heapq.heappop(heap)
        _, _, other, others = heapq.heappop(heap)
        totals, others = totals + other[::-1], others[::-1]
        both = np.flatnonzero((nodes >= 0) & (others >= 0))
        joined = np.maximum(nodes, others)
        joined[both] = np.arange(made, made + both.size)
        lefts += nodes[both].tolist()
        rights += others[both].tolist()
        made += both.size
        order = np.argsort(-totals, kind="stable")
        totals, joined = totals[order], joined[order]
        heapq.heappush(heap, (int(totals[-1] - totals[0]), tie, totals, joined))
        tie += 1
    if not heap:
        return np.zeros(windows, np.int64), [[] for _ in range(windows)]

    def leaves(node: int) -> list[int]:
        found, open_nodes = [], [node] if node >= 0 else []
        while open_nodes:
            node = open_nodes.pop()
            if node < len(sizes):
                found.append(node)
            else:
                open_nodes += (lefts[node - len(sizes)], rights[node - len(sizes)])
        return sorted(found)

    return heap[0][2], [leaves(node) for node in heap[0][3].tolist()]


def windows_of(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Items by window, no window over ``capacity``: the fewest windows that could do, more while one is too full."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        totals, groups = difference(sizes, windows)
        over = int(totals.max()) - capacity
        if over <= 0:
            return [g for g in groups if g]
        windows += max(1, over * windows // (4 * capacity))


def _packed(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, piece: int, block: int) -> Iterator[tuple]:
    """Pieces of one task's documents: (id, start, length, ids, document's ids, sequence, offset)."""
    own = encoder(path)
    last = np.array([end_id], "<u4")
    sequence = TaskContext.get().partitionId() << 33
    goal = block * max(1, capacity - min(SLACK, capacity // 64))
    held: list[tuple] = []
    size = 0

    def deal() -> Iterator[tuple]:
        nonlocal sequence
        for window in windows_of([len(ids) for _, _, ids, _ in held], capacity):
            offset = 0
            for doc_id, start, ids, total in (held[i] for i in window):
                yield doc_id, start, len(ids), ids.tobytes(), total, sequence, offset
                offset += len(ids)
            sequence += 1

    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        for doc_id, text in zip(doc_ids, batch.column(1)):
            ids = np.concatenate([own.encode(text.as_py()), last]).astype("<u4", copy=False)
            total, start = len(ids), 0
            while total - start >= capacity:
                yield doc_id, start, capacity, ids[start : start + capacity].tobytes(), total, sequence, 0
                sequence += 1
                start += capacity
            while start < total:
                n = min(piece, total - start, goal - size)
                held.append((doc_id, start, ids[start : start + n], total))
                start += n
                size += n
                if size == goal:
                    yield from deal()
                    held, size = [], 0
    if held:
        yield from deal()


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    block_windows: int = BLOCK_WINDOWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of a document: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    A document's ids are its text's, then ``end_id``; a null text is empty, so it is one piece of one id. ``ids`` are
    little-endian unsigned 32-bit integers, ``start`` counts the document's ids before the piece, ``doc_tokens`` all of
    them, ``offset`` the ids before it in its sequence. Null and repeated ids need no care, since pieces are told by
    sequence and offset. An empty table gives an empty result; other columns are not looked at.

    Each task packs the documents it reads; nothing is shuffled. Full windows of a long document are sequences of their
    own; rests are cut into pieces, and blocks of pieces are dealt into windows of near-equal totals, with more windows
    while one is over capacity. Besides that, each task leaves at most one block with less than a full last window.
    """
    texts = in_small_batches(docs).select(named(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], ddl).schema)
    return texts.mapInArrow(lambda batches: rebatched(_packed(batches, tokenizer, end_id, capacity, piece, block_windows), schema, 500), ddl)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
