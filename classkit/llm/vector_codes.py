"""Product quantisation of vectors: integer codebooks by Lloyd rounds whose members stay where they are.

A vector is cut into equal parts; each part position has a codebook of a few entries, and a part's code is the index of
its nearest entry. The rounds work on *members*, the parts of all vectors, which lie partitioned by (position, entry,
salt): the task that owns an entry has its members resident and updates the entry from them. In a round, the owners
compare their members with the new entries; only the parts whose nearest entry changes travel, in the next shuffle, and
join the residents of their new entry by a union that moves nothing else. The salt deals an entry's members to several
owners, so that an entry that holds most of the parts has as many of them as any other work.

All numbers are integers, so sums do not depend on order, and the result not on the partitioning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classkit.llm.common import named, packed, unpacked
from classkit.runtime import shared_dir

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
# Members of a block, the unit that tasks hold and send.
BLOCK = 1 << 14
# Rounds between checkpoints of the members.
CHECKPOINT_ROUNDS = 3
MAX_VALUES = 1 << 24  # numbers in all codebooks together, which go to every task: 128 MB

Books = list[np.ndarray]  # per part position, [entries, width] integers


def usable(vector: Column) -> Column:
    """Whether a vector is there and has neither nulls nor values that are not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~bad


def _scaled(vector: Column, scale: int) -> Column:
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale).cast("long"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def nearest(members: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each member the index of the nearest entry (the lower of equals) and its squared distance."""
    index = np.zeros(len(members), np.int64)
    least = np.full(len(members), np.iinfo(np.int64).max)
    for e, entry in enumerate(book):
        apart = members - entry
        distance = np.einsum("ij,ij->i", apart, apart)
        closer = distance < least
        index[closer], least[closer] = e, distance[closer]
    return index, least


Key = tuple[int, int, int]
Member = tuple[Key, tuple[bool, np.ndarray]]


def _blocks(parts: Iterator[tuple[Key, bool, np.ndarray]]) -> Iterator[Member]:
    """Pieces of equal key and state put together into blocks."""
    held: dict[tuple[Key, bool], list[np.ndarray]] = {}
    sizes: dict[tuple[Key, bool], int] = {}
    for key, moved, members in parts:
        at = key, moved
        held.setdefault(at, []).append(members)
        sizes[at] = sizes.get(at, 0) + len(members)
        if sizes[at] >= BLOCK:
            yield key, (moved, np.concatenate(held.pop(at)))
            del sizes[at]
    for (key, moved), pieces in held.items():
        yield key, (moved, np.concatenate(pieces))


def _assigned(books: Books):
    """Members by the entry that is nearest now; those it is new to are marked as moved."""

    def pieces(blocks: Iterator[Member]) -> Iterator[tuple[Key, bool, np.ndarray]]:
        for (position, entry, salt), (_, members) in blocks:
            index, _ = nearest(members, books[position])
            for e in np.unique(index).tolist():
                yield (position, e, salt), e != entry, members[index == e]

    return lambda blocks: _blocks(pieces(blocks))


def _sums(blocks: Iterator[Member]) -> Iterator[tuple[tuple[int, int], tuple[int, np.ndarray]]]:
    """Per position and entry, count and sum of a task's residents."""
    found: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
    for (position, entry, _), (_, members) in blocks:
        n, total = found.get((position, entry), (0, 0))
        found[position, entry] = n + len(members), total + members.sum(axis=0)
    yield from found.items()


def _members(vectors: DataFrame, parts: int, width: int, salts: int) -> RDD:
    """Blocks of parts that belong to no entry yet."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, batch in enumerate(batches):
            for start in range(0, batch.num_rows, BLOCK):
                rows = _matrix(batch.column(0).slice(start, BLOCK), parts * width)
                values = [rows[:, p * width : (p + 1) * width].tobytes() for p in range(parts)]
                arrays = [pa.array(range(parts), pa.int32()), pa.array([(n + start // BLOCK) % salts] * parts, pa.int32()), pa.array(values, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["position", "salt", "members"])

    made = vectors.select("v").mapInArrow(cut, "position int, salt int, members binary")
    # Few rows: each is a block.
    return made.rdd.mapPartitionsWithIndex(
        lambda at, rows: (((r[0], -1, (r[1] + at) % salts), (True, np.frombuffer(r[2], np.int64).reshape(-1, width))) for r in rows)
    )


def _first_book(vectors: DataFrame, parts: int, entries: int) -> Books:
    order = [F.col("id").isNull(), "id", "v"]
    rows = [r["v"] for r in vectors.orderBy(*order).limit(entries).select("v").collect()]
    return list(np.array(rows, np.int64).reshape(len(rows), parts, -1).transpose(1, 0, 2)) if rows else []


def _integers(vectors: DataFrame, scale: int, parts: int, id_col: str, vector_col: str) -> DataFrame:
    kept = vectors.where(usable(named(vector_col)))
    return kept.select(named(id_col).alias("id"), _scaled(named(vector_col), scale).alias("v"))


def train_codebooks(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Books:
    """Per part position, the entries after ``rounds`` Lloyd rounds over the parts of all usable vectors.

    A component x counts as floor(``scale`` * x). The books start as the parts of the vectors with the ``entries``
    smallest ids (null ids after all others, of repeated ids the smaller vector first). A round gives each part to the
    nearest entry, of equally near ones to the lower index, and replaces each entry by the componentwise floor of its
    members' mean; an entry without members stays. Vectors that are null or hold nulls or values that are not finite
    take no part. No usable vector gives no books. Refused with an error, by count: vectors of other widths than the
    first, widths that ``parts`` does not divide, and components so large that distances leave 64 bits.
    """
    spark = vectors.sparkSession
    sc = spark.sparkContext
    integers = _integers(vectors, scale, parts, id_col, vector_col)
    books = _first_book(integers, parts, entries) if _shape(integers, parts) else []
    if not books:
        return []
    width = books[0].shape[1]
    if sum(b.size for b in books) > MAX_VALUES:
        raise ValueError(f"codebooks of more than {MAX_VALUES} numbers")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(f"{shared_dir(spark)}/classkit-members")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), integers.rdd.getNumPartitions())
    salts = max(4, -(-4 * tasks // (parts * len(books[0]))))

    def owner(key: Key) -> int:
        position, entry, salt = key
        return (position * entries + entry) * salts + salt

    assigned = _members(integers, parts, width, salts).mapPartitions(_assigned(books))
    residents = moved = assigned.partitionBy(tasks, owner).persist(StorageLevel.MEMORY_AND_DISK)
    held = [residents]
    for done in range(rounds):
        if done:
            here = residents.mapPartitions(_assigned(books), preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
            moved = here.filter(lambda m: m[1][0]).partitionBy(residents.getNumPartitions(), owner)
            # Both sides have the owners' partitioning, so the union puts them side by side without a shuffle.
            residents = here.filter(lambda m: not m[1][0]).union(moved).persist(StorageLevel.MEMORY_AND_DISK)
            held += [here, residents]
        if done % CHECKPOINT_ROUNDS == CHECKPOINT_ROUNDS - 1 and done < rounds - 1:
            residents.checkpoint()
        sums = residents.mapPartitions(_sums).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), parts)
        books = [b.copy() for b in books]
        for (position, entry), (n, total) in sums.collect():
            books[position][entry] = total // n  # floors, of negative numbers too
        for old in held[: len(held) - 1]:
            old.unpersist()
        held = held[len(held) - 1 :]
    for old in held:
        old.unpersist()
    return books


def _shape(integers: DataFrame, parts: int) -> bool:
    """Check widths and magnitudes; whether there is anything to learn from."""
    size = F.size("v")
    most = F.floor(F.sqrt(F.lit(float(1 << 60)) / F.greatest(size, F.lit(1))))
    large = F.exists("v", lambda x: (x > most) | (x < -most))
    widths = integers.agg(F.count("*").alias("n"), F.min(size).alias("low"), F.max(size).alias("high"), F.count_if(large).alias("large")).head()
    if not widths["n"]:
        return False
    if widths["low"] != widths["high"]:
        raise ValueError(f"vectors of {widths['low']} to {widths['high']} components")
    if not widths["low"] or widths["low"] % parts:
        raise ValueError(f"vectors of {widths['low']} components in {parts} parts")
    if widths["large"]:
        raise ValueError(f"{widths['large']} vectors with components too large")
    return True


def encode_vectors(vectors: DataFrame, books: Books, scale: int = SCALE, vector_col: str = "embedding") -> DataFrame:
    """The usable vectors, all columns, with ``codes`` (one index a part) and ``error`` (squared distances, summed).

    The books go to every task, and rows are coded where they are read, without a shuffle. Columns ``codes`` and
    ``error`` of the table are replaced. Equal vectors get equal codes.
    """
    kept = vectors.where(usable(named(vector_col)))
    rows = kept.select(packed(kept).alias("row"), _scaled(named(vector_col), scale).alias("v"))
    width = books[0].shape[1] if books else 1

    @F.arrow_udf("codes array<int>, error long")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            matrix = _matrix(column, width * len(books)) if books else np.zeros((len(column), 0), np.int64)
            found = [nearest(matrix[:, p * width : (p + 1) * width], book) for p, book in enumerate(books)]
            codes = np.stack([f[0] for f in found], axis=1) if found else np.zeros((len(column), 0), np.int64)
            error = np.sum([f[1] for f in found], axis=0) if found else np.zeros(len(column), np.int64)
            offsets = np.arange(len(column) + 1, dtype=np.int32) * len(books)
            lists = pa.ListArray.from_arrays(offsets, pa.array(codes.astype(np.int32).reshape(-1)))
            yield pa.StructArray.from_arrays([lists, pa.array(error, pa.int64())], names=["codes", "error"])

    rows = rows.select("row", coded("v").alias("coded"))
    return unpacked(rows, "row", vectors.columns, F.col("coded.codes").alias("codes"), F.col("coded.error").alias("error"))


def decode_vectors(coded: DataFrame, books: Books, scale: int = SCALE, codes_col: str = "codes") -> DataFrame:
    """``coded`` with ``decoded``: the entries of its codes put together, as doubles (the middle of each integer's range)."""

    @F.arrow_udf("array<double>")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            codes = _matrix(column, len(books))
            values = (np.concatenate([book[codes[:, p]] for p, book in enumerate(books)], axis=1) + 0.5) / scale
            offsets = np.arange(len(column) + 1, dtype=np.int32) * values.shape[1]
            yield pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1)))

    return coded.withColumn("decoded", decoded(named(codes_col)))


def books_text(books: Books) -> str:
    """All components in decimal, by part, entry and place, joined by commas."""
    return ",".join(str(x) for book in books for x in book.reshape(-1).tolist())


def code_digests(vectors: DataFrame, books: Books, id_col: str = "vec_id", label_col: str = "label", **options) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of `encode_vectors`: codes in hexadecimal, errors also summed
    over equal labels (nulls are equal)."""
    coded = encode_vectors(vectors.select(named(id_col).alias("vec_id"), named(label_col).alias("label"), named(options.get("vector_col", "embedding")).alias("v")), books, options.get("scale", SCALE), "v")
    digits = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    rows = coded.select("vec_id", "label", digits.alias("code"), "error")
    # Summed in each task first, so a label with most rows sends a row a task.
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = rows.join(sums, F.col("label").eqNullSafe(F.col("of")))
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
