"""Language identification by cross-parsing: longest matches in suffix automata of labelled text."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classkit.llm.common import in_small_batches, named, packed, text_of, unpacked

# Learning sample, per language: documents, and bytes of their normalised text (a middle part of each document).
SAMPLE_DOCS, SAMPLE_BYTES = 64, 32_768
MAX_LANGUAGES = 1_000
# Texts are parsed in segments of this many bytes, many at a time; a phrase ends with its segment.
SEGMENT, LANES = 512, 4_096
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def normalise(text: str) -> bytes:
    """Lower-cased letters as UTF-8, every run of other characters as one space; empty if there is no letter."""
    text = text.lower()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return b""
    keep = letter | np.concatenate([[False], letter[:-1]])
    return np.where(letter, codes, 32)[keep].astype("<u4").tobytes().decode("utf-32-le").encode().strip()


class Automaton:
    """Suffix automaton of a byte string as a table: state x symbol -> state; 0 is no match, 1 the start."""

    def __init__(self, text: bytes, symbols: np.ndarray, width: int):
        # A suffix automaton has fewer than two states a byte.
        edges = np.zeros((2 * len(text) + 2, width), np.int32)
        link, length = [0, 0], [0, 0]
        last = 1
        for c in symbols[np.frombuffer(text, np.uint8)].tolist():
            new = len(link)
            link.append(1)
            length.append(length[last] + 1)
            p = last
            while p and not edges[p, c]:
                edges[p, c] = new
                p = link[p]
            if p:
                q = int(edges[p, c])
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    twin = len(link)
                    edges[twin] = edges[q]
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p and edges[p, c] == q:
                        edges[p, c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        self.next = (edges[: len(link)] * width).ravel()  # states as offsets of their rows


class CrossParser:
    """Phrases of texts against each language's sample."""

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        used = np.unique(np.frombuffer(b"".join(samples.values()), np.uint8))
        # Symbol 0 stands for bytes that no sample has.
        self.symbols = np.zeros(256, np.uint8)  # UTF-8 never has all 256 bytes
        self.symbols[used] = np.arange(1, used.size + 1)
        self.width = used.size + 1
        self.automata = [Automaton(samples[x], self.symbols, self.width) for x in self.languages]
        self.bits = [math.log2(max(2, len(samples[x]))) for x in self.languages]

    def _phrases(self, lanes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases per language and lane; ``lanes`` is symbol x lane, longest lane first."""
        counts = np.zeros((len(self.languages), lanes.shape[1]), np.int64)
        active = np.searchsorted(-lengths, -np.arange(lanes.shape[0]), side="left")
        for out, automaton in zip(counts, self.automata):
            begin, follow = automaton.next[self.width : 2 * self.width], automaton.next
            state = np.zeros(lanes.shape[1], np.int32)
            for symbols, n in zip(lanes, active.tolist()):
                state, symbols = state[:n], symbols[:n]
                state = follow[state + symbols]
                ended = np.flatnonzero(state == 0)
                if ended.size:
                    # This byte begins the next phrase, or is one by itself if the sample doesn't have it: then the
                    # state stays 0, so that the byte after it begins a phrase again.
                    out[ended] += 1
                    state[ended] = begin[symbols[ended]]
        return counts

    def rates(self, texts: list[str]) -> list[list[float] | None]:
        """Per text the languages' bits per byte: phrases times the bits of a place in the sample; None: no letter."""
        pure = [normalise(t) for t in texts]
        parts, owner = [], []
        for i, text in enumerate(pure):
            for start in range(0, len(text), SEGMENT):
                parts.append(text[start : start + SEGMENT])
                owner.append(i)
        totals = np.zeros((len(texts), len(self.languages)), np.int64)
        order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
        for start in range(0, len(order), LANES):
            chosen = order[start : start + LANES]
            lengths = np.array([len(parts[i]) for i in chosen])
            flat = b"".join(parts[i].ljust(int(lengths[0]), b"\0") for i in chosen)
            lanes = self.symbols[np.frombuffer(flat, np.uint8)].reshape(len(chosen), -1).T.copy()
            np.add.at(totals, np.array([owner[i] for i in chosen]), self._phrases(lanes, lengths).T)
        bits = np.array(self.bits)
        return [(totals[i] * bits / len(t)).tolist() if t else None for i, t in enumerate(pure)]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text: the score is the share by which the best needs less than the next one."""
        out = []
        for rates in self.rates(texts):
            if rates is None or not rates:
                out.append((UNKNOWN, 0.0))
                continue
            best = min(range(len(rates)), key=lambda i: (rates[i], i))
            next_ = min([r for i, r in enumerate(rates) if i != best], default=8.0)
            out.append((self.languages[best], max(0.0, 1.0 - rates[best] / next_) if next_ > 0 else 0.0))
        return out


def learn(labelled: DataFrame, seed: int = 42, docs: int = SAMPLE_DOCS, size: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """Per language in ``labelled`` (doc_id, text, lang), a sample of normalised text.

    At most ``docs`` documents a language, those with the smallest hash of their id (one row of each id), give at most ``size`` bytes
    together: a middle part of each. Rows with a null language, id or text are left out, and so are languages whose
    sampled texts have no letter; more than MAX_LANGUAGES languages are refused.
    """
    rows = labelled.where("lang is not null and doc_id is not null and text is not null")
    key = F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("key")
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("count")).limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return {}
    # Hash limits that let about four times the wanted documents through, so that few rows are ranked.
    limits = [(r["lang"], min(2**63 - 1, 2**64 * 4 * docs // r["count"] - 2**63)) for r in counts]
    limits = F.broadcast(labelled.sparkSession.createDataFrame(limits, "lang string, most long"))
    few = rows.select("lang", "doc_id", key).join(limits, "lang").where("key <= most").distinct()
    few = few.withColumn("place", F.expr("row_number() over (partition by lang order by key, doc_id)"))
    chosen = few.where(F.col("place") <= docs).select("doc_id").distinct().collect()
    chosen = rows.where(F.col("doc_id").isin([r[0] for r in chosen]))
    # Normalising shortens a text, so a middle part of twice the share is taken.
    share = max(64, size // docs)
    middle = F.greatest(F.lit(1), F.floor((F.char_length("text") - 2 * share) / 2) + 1).cast("int")
    parts = chosen.select("lang", "doc_id", key, F.expr("text").substr(middle, F.lit(2 * share)).alias("part"))
    parts = parts.groupBy("lang", "key", "doc_id").agg(F.min("part").alias("part"))
    parts = parts.withColumn("place", F.expr("row_number() over (partition by lang order by key, doc_id)"))
    parts = parts.where(F.col("place") <= docs).orderBy("lang", "place").collect()
    lost = {r["lang"] for r in limits.collect()} - {r["lang"] for r in parts}
    if lost:
        raise RuntimeError(f"no sample of {sorted(lost)}")
    samples: dict[str, bytes] = {}
    for lang in sorted({r["lang"] for r in parts}):
        pure = [normalise(r["part"])[:share].decode("utf-8", "ignore").encode() for r in parts if r["lang"] == lang]
        joined = b" ".join(p for p in pure if p)[:size]
        if joined:
            samples[lang] = joined
    return samples


@lru_cache(maxsize=2)
def _parser(samples: tuple[tuple[str, bytes], ...]) -> CrossParser:
    """One parser a worker; the automata are built from the samples there."""
    return CrossParser(dict(samples))


def predicted(text: Column, samples: dict[str, bytes]) -> Column:
    """Struct of ``lang_pred`` and ``score`` of a text column."""
    fixed = tuple(sorted(samples.items()))

    @F.arrow_udf("lang_pred string, score double")
    def of(texts: pa.Array) -> pa.Array:
        parser, made = _parser(fixed), []
        for start in range(0, len(texts), 1_000):
            made += parser.predict(texts.slice(start, 1_000).to_pylist())
        names, scores = zip(*made) if made else ((), ())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return of(text)


def _fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 3


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, bytes]:
    labelled = docs.select(named(id_col).alias("doc_id"), named(text_col).cast("string").alias("text"), named(lang_col).alias("lang"))
    return learn(labelled.where(_fold(F.col("doc_id")) != 1))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score``.

    The parser learns from labelled documents whose ``crc32(id) mod 3`` is not 1; the others are ``held_out`` (a null id
    is neither). ``lang_pred`` is the learned language whose sample parses the text into the fewest phrases, each
    weighted by the bits that name a place in its sample; ties go to the first name. ``score`` is 0 to 1: the share by
    which the winner needs less than the second. Null texts, texts without letters, and all texts if nothing could be
    learned are ``und`` with score 0. An empty table gives an empty result; other columns are not looked at.
    """
    samples = _sample(docs, id_col, text_col, lang_col)
    rows = docs.select(
        named(id_col).alias("doc_id"),
        F.coalesce(_fold(named(id_col)) == 1, F.lit(False)).alias("held_out"),
        predicted(text_of(text_col), samples).alias("made"),
    )
    return in_small_batches(rows).select("doc_id", "held_out", "made.lang_pred", "made.score")


def keep_identified(
    docs: DataFrame, min_score: float = 0.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with a score of ``min_score`` at least.

    Rows that `identify` calls ``und`` go, null and empty texts among them. If the two best languages tie, the score is
    0, so the row stays only with a ``min_score`` of 0. Repeated rows are told alike and all stay or all go; an empty
    table gives an empty one. Learning is as in `identify`; if no row can be learned from, none stays.
    """
    samples = _sample(docs, id_col, text_col, lang_col)
    rows = in_small_batches(docs).select(packed(docs).alias("row"), predicted(text_of(text_col), samples).alias("made"))
    return unpacked(rows.where((F.col("made.lang_pred") != UNKNOWN) & (F.col("made.score") >= min_score)), "row", docs.columns)
