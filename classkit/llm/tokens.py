"""Token ids of whole texts, and token counts of documents of any length.

`ByteLevelEncoder` returns exactly the ids of the tokenizer file's own library. Byte-level BPE files with the usual
pattern are encoded by a second library, several times as fast, wherever both are known to agree; see `_fast`.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from classkit.llm.common import in_small_batches, named, per_text, text_of

# Characters that are encoded at once.
SLICE_CHARS = 1 << 20

# The byte-level pre-tokeniser's pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A space between two other characters: the pattern always starts a new match there, whatever stands before or after,
# so the ids on both sides do not depend on each other.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, as characters from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {chr(b if b in plain else next(rest)): b for b in range(256)}


@lru_cache(maxsize=1)
def _settled_characters() -> str:
    """A regular expression's class of the characters whose category has not changed since Unicode 3.2, so that
    libraries of any age sort them alike."""
    old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
    same = np.array([old(chr(c)) == new(chr(c)) not in ("Cn", "Cs") for c in range(0x10000)] + [False])
    edges = np.flatnonzero(np.diff(same, prepend=False))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2).tolist())


class ByteLevelEncoder:
    """Ids by the `tokenizers` library, without added begin or end ids, truncation or padding."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            about = json.load(file)
        self.added = [t["content"] for t in about.get("added_tokens") or []]
        self.margin = max([8, *map(len, self.added)])
        self.fast, self.lengths = self._fast(about), np.zeros(0, np.int64)
        if self.fast:
            sizes = {i: len(t) for t, i in about["model"]["vocab"].items()}
            sizes |= {t["id"]: len(t["content"].encode()) for t in about.get("added_tokens") or []}
            self.lengths = np.zeros(max(sizes) + 1, np.int64)
            self.lengths[list(sizes)] = list(sizes.values())
            self.odd = re.compile(f"[^{_settled_characters()}]")

    def _fast(self, about: dict) -> tiktoken.Encoding | None:
        """The same vocabulary in the faster library, if both must give the same ids.

        The pattern is the same, and characters are kept to those that both sort alike. The faster library merges any
        two neighbours that make a token, lowest id first; the file's own merges listed pairs in their order. The ids
        are in the order of the merges, and every token's text is merged to that token alone (both checked here): so two
        neighbours that make a token are always a listed pair.
        """
        before, model = about.get("pre_tokenizer") or {}, about["model"]
        extra = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        added = about.get("added_tokens") or []
        if (
            before.get("type") != "ByteLevel"
            or not before.get("use_regex", True)
            or before.get("add_prefix_space")
            or about.get("normalizer")
            or model["type"] != "BPE"
            or any(model.get(k) for k in extra)
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in added)
        ):
            return None
        letters, contents = _byte_letters(), {t["content"] for t in added}
        vocabulary = {t: i for t, i in model["vocab"].items() if t not in contents}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = [vocabulary.get(a + b, -1) for a, b in pairs]
        own = self.tokenizer.model
        if order != sorted(order) or any([t.id for t in own.tokenize(x)] != [i] for x, i in vocabulary.items()):
            return None
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _odd(self, text: str) -> bool:
        """Whether the text holds an added token or a character that libraries may sort differently."""
        return any(a in text for a in self.added) or (not text.isascii() and bool(self.odd.search(text)))

    def _plain(self, text: str) -> np.ndarray:
        """Ids of a text that is not odd, slice by slice, because the library's list of ids is large."""
        made, start = [], 0
        while start < len(text):
            cut = _CUT.search(text, start + SLICE_CHARS) if len(text) - start > SLICE_CHARS else None
            end = cut.start() if cut else len(text)
            made.append(np.array(self.fast.encode_ordinary(text[start:end]), np.uint32))
            start = end
        return np.concatenate(made) if made else np.zeros(0, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        """All ids of the text (uint32)."""
        if not self.fast:
            return self._library(text)
        if not self._odd(text):
            return self._plain(text)
        # Odd places go to the file's own library, each with the piece between cuts that holds it.
        edges = [0, *(m.start() for m in _CUT.finditer(text)), len(text)]
        made, done = [], 0
        for a, b in zip(edges, edges[1:]):
            if self._odd(text[a:b]):
                made += [self._plain(text[done:a]), self._library(text[a:b])]
                done = b
        return np.concatenate([*made, self._plain(text[done:])])

    def _chunk(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Offsets in ``text`` of the cuts inside ``text[start:end]``, and how many ids come before each, plus all."""
        chunk = text[start:end]
        ids = self.encode(chunk)
        cuts = np.array([m.start() for m in _CUT.finditer(chunk)], np.int64)
        codes = np.frombuffer(chunk.encode("utf-32-le"), np.uint32)
        width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        at_byte = np.concatenate([[0], np.cumsum(width)])[cuts]
        begins = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        before = np.searchsorted(begins, at_byte)
        stable = begins[before] == at_byte
        return start + cuts[stable], np.append(before[stable], len(ids))

    def count(self, text: str, chunk_chars: int = 32_768, overlap_chars: int = 512) -> int:
        """How many ids the text has.

        Longer texts are encoded in overlapping chunks with offsets. Two chunks are spliced at a cut that both have as
        an offset: the earlier chunk began at a true cut, so its cuts are true up to the margin before its end, where an
        added token or the end itself could matter; and from a true cut on, the later chunk is encoded as the text is.
        If the overlap holds no such place it is doubled, and once it covers the earlier chunk, that chunk grows.
        """
        if not self.fast or len(text) <= chunk_chars:
            return len(self.encode(text))
        done, at, end = 0, 0, min(len(text), chunk_chars)
        cuts, before = self._chunk(text, at, end)
        used = 0  # ids of the chunk that come before ``at``
        while end < len(text):
            overlap, found = overlap_chars, None
            while found is None and overlap < end - at:
                start = end - overlap
                stop = min(len(text), start + chunk_chars + overlap)
                new_cuts, new_before = self._chunk(text, start, stop)
                common = np.intersect1d(cuts, new_cuts, assume_unique=True)
                # An added token that a chunk's edge divides is not seen there: keep off both edges.
                common = common[(common >= start + self.margin) & (common <= end - self.margin)]
                if common.size:
                    found = int(common[0])
                overlap *= 2
            if found is None:
                end = min(len(text), end + 2 * (end - at))
                cuts, before = self._chunk(text, at, end)
                used = 0
                continue
            done += int(before[np.searchsorted(cuts, found)]) - used
            used = int(new_before[np.searchsorted(new_cuts, found)])
            at, end, cuts, before = found, stop, new_cuts, new_before
        return done + int(before[-1]) - used


@lru_cache(maxsize=4)
def encoder(path: str) -> ByteLevelEncoder:
    """One encoder a worker."""
    return ByteLevelEncoder(path)


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = 32_768,
    overlap_chars: int = 512,
) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens).

    A null text is empty and has no tokens. Ids may be null or repeated; an empty table gives an empty result; other
    columns are not looked at. Rows are counted where they are read, without a shuffle; a document's memory is its text
    and one chunk.
    """

    def start():
        own = encoder(tokenizer)
        return lambda text: (own.count(text, chunk_chars, overlap_chars),)

    texts = in_small_batches(docs).select(named(id_col).alias("doc_id"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"), text_of(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    counted = texts.mapInArrow(per_text(start, [pa.int64()]), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
