"""Phrases whose words stand together more often than their parts would suggest.

Occurrences are counted by multikey three-way quicksort of suffix pointers, level by level. At depth d, every task sorts
pointers to the places of its texts by language and the d words there; the sizes of equal partitions are its counts.
Counts are routed by the language and the leading words and summed, and partitions that stay below the least count are
abandoned: a pointer is followed to depth d + 1 only if both phrases of d words in it, the leading and the trailing one,
are in partitions that live on. Tasks learn those from a bitmap of phrase hashes (`bitmap`) of bounded size. Pairs, of which most
are rare, are first routed by their hashes alone, and only those that live are spelled out. Phrases that share a hash or a
place in the bitmap are sorted and counted in vain and abandoned by their own count, so counts are exact at any size.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from classkit.llm.bitmap import Living, bitmap, bitmap_bits
from classkit.llm.common import named, rebatched, text_of
from classkit.runtime import written

# Pieces end at [.,;:!?\x0A-\x0D]; words are parted by [\x20\x09].
_ENDS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
_STOP = b"."
_GAP = re.compile(rb"[ \t.]")
_WORD = re.compile(rb"\.|[^ \t.]+")

SLICE_BYTES = 1 << 22
# Places that are sorted together, and the size below which a partition is sorted at once.
BLOCK_WORDS, SMALL = 1 << 20, 2_048
# Different words that a task counts together, and rows that leave it together.
KEPT_WORDS, ROWS = 500_000, 20_000
# Rows of a language that are ranked together before its first ones meet.
RANK_SALTS = 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _slices(text: bytes, ahead: int) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """A text's words with stops between pieces, slice by slice, each with the next ``ahead`` words after it."""
    text = text.lower().translate(_ENDS)  # of bytes, lower() changes A-Z alone
    at = 0
    while at < len(text):
        cut = _GAP.search(text, at + SLICE_BYTES) if len(text) - at > SLICE_BYTES else None
        end = cut.start() if cut else len(text)
        words = text[at:end].replace(_STOP, b" . ").split()
        yield words, [m[0] for m in islice(_WORD.finditer(text, end), ahead)] if cut else []
        at = end


def _folded(hashes: list[np.ndarray]) -> np.ndarray:
    """A hash of each row of hashes (language, word, word, ...), which depends on their order."""
    made = hashes[0].copy()
    for column in hashes[1:]:
        made = (made ^ column) * _ODD
        made ^= made >> np.uint64(29)
        made *= _MIX
    return made ^ (made >> np.uint64(32))


def _digest(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


def multikey_quicksort(keys: list[np.ndarray], small: int = SMALL) -> tuple[np.ndarray, np.ndarray]:
    """Pointers in the order of their keys, and where each partition of equal keys starts.

    ``keys[d][p]`` is the key of pointer p at depth d. A partition is split by a pivot into smaller, equal and larger
    keys; equal ones are split by the next depth, down to the last. Partitions of at most ``small`` pointers are sorted
    at once.
    """
    n = len(keys[0])
    order = np.arange(n)
    todo = [(0, n, 0)] if n else []
    while todo:
        low, high, depth = todo.pop()
        part = order[low:high]
        if high - low <= small:
            order[low:high] = part[np.lexsort([k[part] for k in reversed(keys[depth:])])]
            continue
        values = keys[depth][part]
        some = np.sort(values[:: max(1, (high - low) // 9)])
        pivot = some[len(some) // 2]
        smaller, larger = values < pivot, values > pivot
        equal = ~(smaller | larger)
        a = low + int(np.count_nonzero(smaller))
        b = a + int(np.count_nonzero(equal))
        order[low:high] = np.concatenate([part[smaller], part[equal], part[larger]])
        todo += [(x, y, depth) for x, y in ((low, a), (b, high)) if y - x > 1]
        if depth + 1 < len(keys) and b - a > 1:
            todo.append((a, b, depth + 1))
    if not n:
        return order, np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    return order, np.flatnonzero(new)


class _Block:
    """Words of many texts, by number, with the language of each and whether a phrase may begin there."""

    def __init__(self):
        self.index: defaultdict[bytes, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.stop = self.index[_STOP]
        self.langs: dict[str, int] = {}
        self.codes: list[np.ndarray] = []
        self.spans: list[tuple[int, int, int]] = []  # language, words, words to look at only
        self.size = 0

    def add(self, lang: str, words: list[bytes], ahead: list[bytes]) -> None:
        all_words = chain(words, ahead, (_STOP,))
        made = np.fromiter(map(self.index.__getitem__, all_words), np.int64, len(words) + len(ahead) + 1)
        self.codes.append(made)
        self.spans.append((self.langs.setdefault(lang, len(self.langs)), len(words), len(ahead) + 1))
        self.size += len(made)

    def close(self) -> None:
        """Put the texts together."""
        self.words, self.names = list(self.index), list(self.langs)
        self.all = np.concatenate(self.codes)
        self.codes.clear()
        self.of = np.repeat([s[0] for s in self.spans], [s[1] + s[2] for s in self.spans])
        self.begins = np.repeat([True, False] * len(self.spans), [x for s in self.spans for x in s[1:]])
        self.hashes = np.fromiter(map(_digest, self.words), np.uint64, len(self.words))
        self.lang_hashes = np.fromiter((_digest(n.encode()) for n in self.names), np.uint64, len(self.names))

    def hashed(self, pointers: np.ndarray, depth: int) -> np.ndarray:
        return _folded([self.lang_hashes[self.of[pointers]], *[self.hashes[self.all[pointers + d]] for d in range(depth)]])

    def places(self, depth: int, living: Living) -> np.ndarray:
        """Pointers at which a living phrase of ``depth`` words lies within a piece, those to look at only included."""
        inside, reach = self.all != self.stop, max(0, len(self.all) - depth + 1)
        at = np.flatnonzero(np.logical_and.reduce([inside[d : d + reach] for d in range(depth)]))
        return at[living.holds(self.hashed(at, depth))]

    def partitions(self, depth: int, living: Living, whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """A pointer into each equal partition of depth ``depth``, and its size. Followed are pointers to phrases that
        live or, if not ``whole``, whose leading and trailing words, all but one, live."""
        if whole:
            pointers = self.places(depth, living)
        else:
            lives = np.zeros(len(self.all) + 1, bool)
            lives[self.places(depth - 1, living)] = True
            pointers = np.flatnonzero(lives[:-1] & lives[1:])
        pointers = pointers[self.begins[pointers]]
        order, starts = multikey_quicksort([self.of[pointers], *[self.all[pointers + d] for d in range(depth)]])
        return pointers[order[starts]], np.diff(np.append(starts, len(order)))

    def spelled(self, first: np.ndarray, depth: int) -> tuple[pa.Array, pa.Array]:
        """Language and phrase at each pointer."""
        vocabulary = pa.array(self.words, pa.binary())
        columns = [vocabulary.take(pa.array(self.all[first + d])).cast(pa.string()) for d in range(depth)]
        return pa.array(self.names, pa.string()).take(pa.array(self.of[first])), pc.binary_join_element_wise(*columns, " ")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(lang, word, n): the equal partitions of depth one, which are just counted."""
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(*batch.columns):
            own = counts.setdefault(lang.as_py(), Counter())
            for words, _ in _slices(text.as_py().encode(), 0):
                own.update(words)
            if sum(map(len, counts.values())) >= KEPT_WORDS:
                yield from _listed(counts)
                counts.clear()
    yield from _listed(counts)


def _listed(counts: dict[str, Counter]) -> Iterator[tuple]:
    for lang, own in counts.items():
        own.pop(_STOP, None)
        yield from ((lang, word.decode(), n) for word, n in own.items())


def _sorted(depth: int, report):
    """mapInArrow over (lang, text): what ``report`` gives of each block of texts, whose phrases have ``depth`` words at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()

        def closed() -> Iterator[pa.RecordBatch]:
            if block.size:
                block.close()
                yield from report(block)

        for batch in batches:
            for lang, text in zip(*batch.columns):
                for words, ahead in _slices(text.as_py().encode(), depth - 1):
                    block.add(lang.as_py(), words, ahead)
                    if block.size >= BLOCK_WORDS:
                        yield from closed()
                        block = _Block()
        yield from closed()

    return run


def _hashed_pairs(shared):
    """(hash, n) of the pairs of living words."""

    def report(block: _Block) -> Iterator[pa.RecordBatch]:
        first, sizes = block.partitions(2, Living.of(shared), False)
        for start in range(0, len(first), ROWS):
            part = slice(start, start + ROWS)
            hashes = block.hashed(first[part], 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(sizes[part], pa.int32())], names=["hash", "n"])

    return _sorted(2, report)


def _spelled_phrases(wanted: list[tuple[int, bool]], shared):
    """(words, lang, phrase, n) of the phrases of each wanted length; see `_Block.partitions`."""

    def report(block: _Block) -> Iterator[pa.RecordBatch]:
        living = Living.of(shared)
        for depth, whole in wanted:
            first, sizes = block.partitions(depth, living, whole)
            for start in range(0, len(first), ROWS):
                part = slice(start, start + ROWS)
                lang, phrase = block.spelled(first[part], depth)
                words = pa.array(np.full(len(phrase), depth, np.int32))
                yield pa.RecordBatch.from_arrays([words, lang, phrase, pa.array(sizes[part], pa.int64())], names=["words", "lang", "phrase", "n"])

    return _sorted(max(depth for depth, _ in wanted), report)


def _phrase_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of phrases (lang, phrase) of one length."""
    for batch in batches:
        langs = np.fromiter((_digest(x.encode()) for x in batch.column(0).to_pylist()), np.uint64, batch.num_rows)
        words = list(zip(*(p.encode().split(b" ") for p in batch.column(1).to_pylist())))
        columns = [np.fromiter(map(_digest, column), np.uint64, batch.num_rows) for column in words]
        yield pa.RecordBatch.from_arrays([pa.array(_folded([langs, *columns]).view(np.int64))], names=["hash"])


def phrase_counts(docs: DataFrame, max_words: int, least: int) -> tuple[DataFrame, list[DataFrame]]:
    """Of a table (lang, text): words per language (lang, n), and for each length the phrases (lang, phrase, n) that
    occur at least ``least`` times within pieces, overlaps included."""
    spark = docs.sparkSession
    ddl = "lang string, phrase string, n long"
    schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)
    found = docs.mapInArrow(lambda batches: rebatched(_word_counts(batches), schema, ROWS), ddl)
    words = written(found.groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    counted = [words.where(F.col("n") >= least)]

    def shared(hashes: DataFrame, count: int):
        return spark.sparkContext.broadcast(bitmap(hashes, bitmap_bits(count)))

    living = shared(counted[0].select("lang", "phrase").mapInArrow(_phrase_hashes, "hash long"), counted[0].count())
    # Most of a task's pairs are different: they are routed as they are and summed where they meet.
    pairs = docs.mapInArrow(_hashed_pairs(living), "hash long, n int").repartition("hash")
    pairs = written(pairs.groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("hash"), "pairs")
    living = shared(pairs, pairs.count())
    for depth in range(min(3, max_words), max_words + 1):
        wanted = [(2, True)] * (depth <= 3) + [(depth, False)] * (depth > 2)
        found = docs.mapInArrow(_spelled_phrases(wanted, living), f"words int, {ddl}")
        routed = found.groupBy("words", "lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        routed = written(routed, "phrases")
        counted += [routed.where(F.col("words") == w).drop("words") for w, _ in wanted]
        if depth < max_words:
            living = shared(counted[-1].select("lang", "phrase").mapInArrow(_phrase_hashes, "hash long"), counted[-1].count())
    return totals, counted


def _cut(phrase: Column, first: int, words: int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first + 1, words), " ")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1,000,000 * a * a / (left * right)), in decimals of 38 digits: exact for counts below 10**16."""
    a, left, right = (c.cast("decimal(16,0)") for c in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def collocations(
    docs: DataFrame,
    max_words: int = 3,
    least: int = 10,
    top: int | None = 2_000,
    absorbed_percent: int = 50,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's phrases of 2 to ``max_words`` words.

    Texts (null: empty) have A-Z in lower case, and are split at ``.,;:!?`` and line ends into pieces, those at spaces
    and tabs into words. A language is a value of ``lang_col`` (null: und); n counts its words, a a phrase's occurrences within pieces,
    overlaps included. Phrases with a >= ``least`` are candidates. Cut after its first k words, a candidate has
    l = f(first part), r = f(rest) and score floor(10^6 a a / (l r)); the cut with the lowest score counts, of ties the
    one with the smallest k. A candidate goes if a longer candidate, dropped or not, holds its words side by side and
    has at least ``absorbed_percent`` of its occurrences. Rows are ranked by score and a, largest first, then phrase by
    bytes; ``top`` limits a language's rows (None: all). Repeated rows count as often as they are there; no words, no
    rows, an empty table included. Other columns are not looked at.
    """
    texts = docs.select(F.coalesce(named(lang_col).cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))
    totals, counted = phrase_counts(texts, max_words, least)
    candidates = None
    for words in range(2, max_words + 1):
        rows = counted[words - 1].select("lang", "phrase", F.col("n").alias("a"))
        cuts = []
        for k in range(1, words):
            left = counted[k - 1].select("lang", F.col("phrase").alias("left"), F.col("n").alias(f"l{k}"))
            right = counted[words - k - 1].select("lang", F.col("phrase").alias("right"), F.col("n").alias(f"r{k}"))
            rows = rows.withColumns({"left": _cut(F.col("phrase"), 0, k), "right": _cut(F.col("phrase"), k, words)})
            rows = rows.join(left, ["lang", "left"]).drop("left").join(right, ["lang", "right"]).drop("right")
            score = _score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}"))
            cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        rows = rows.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0])
        # The most frequent longer candidate around each phrase, from all lengths above.
        around = None
        for longer in range(words + 1, max_words + 1):
            inner = F.transform(F.sequence(F.lit(1), F.lit(longer - words + 1)), lambda i: F.array_join(F.slice(F.split("phrase", " "), i, words), " "))
            found = counted[longer - 1].select("lang", F.explode(inner).alias("phrase"), "n")
            around = found if around is None else around.union(found)
        if around is not None:
            most = around.groupBy("lang", "phrase").agg(F.max("n").alias("most"))
            rows = rows.join(most, ["lang", "phrase"], "left")
            rows = rows.where(F.coalesce(100 * F.col("most") < absorbed_percent * F.col("a"), F.lit(True)))
        rows = rows.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        candidates = rows if candidates is None else candidates.union(rows)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    ranked = candidates
    if top is not None:  # of a language with most candidates, tasks rank parts first
        salt = F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS)).alias("salt")
        by_part = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
        ranked = ranked.select("*", salt).withColumn("place", by_part).where(F.col("place") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    ranked = ranked.join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

