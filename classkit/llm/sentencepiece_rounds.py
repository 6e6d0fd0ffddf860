"""SentencePiece BPE by vectorised merge rounds, and its decoding."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classkit.llm.common import in_small_batches, named, text_of

# The character that stands for a space inside pieces.
SPACE = "▁"
# Words kept in a worker's table, and the longest word kept.
KEPT_WORDS, KEPT_CHARS = 400_000, 48
# Words that are merged together.
ROUND_WORDS = 20_000


class MergeRounds:
    """Ids of a BPE model with identity normalisation, byte fallback and a space before the text.

    A word is a run of spaces with the characters up to the next space. No piece has a space after another character
    (checked when the model is loaded), so merges never cross words, and words can be encoded by themselves.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        own = [i for i in range(n) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        self.ids = {pieces[i]: i for i in own}
        self.bytes = [self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = self.model.unk_id()
        # What a text may show of how the model was made: the same probe must come back from the model and from here.
        if any(self.model.is_unused(i) for i in own) or any(re.search(f"[^{SPACE}]{SPACE}", pieces[i]) for i in own):
            raise ValueError("only BPE models whose pieces have spaces at their start are supported")
        # Merge rank: a higher score merges first. Pieces are told by id; -1 - c is a character without a piece.
        order = sorted(own, key=lambda i: -self.model.get_score(i))
        rank = {i: r for r, i in enumerate(order)}
        # Every way to write a piece as two others.
        lefts, rights, ranks, wholes = [], [], [], []
        for i in own:
            piece = pieces[i]
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    lefts.append(a), rights.append(b), ranks.append(rank[i]), wholes.append(i)
        keys = np.array(lefts, np.int64) * n + np.array(rights, np.int64)
        self.n, self.ranks, self.wholes = n, np.array(ranks, np.int64), np.array(wholes, np.int64)
        self._index(keys)
        # A piece is settled if no merge that it takes part in comes before its own.
        self.settled = np.ones(n, bool)
        for part in (np.array(lefts, np.int64), np.array(rights, np.int64)):
            early = np.array(ranks, np.int64) < np.array([rank[i] for i in part.tolist()], np.int64)
            self.settled[part[early]] = False
        self.longest = max([1, *(len(pieces[i]) for i in own)])
        self.words: dict[str, tuple[str, int]] = {}
        probe = " \n a  b\tĀ<s> 日本\U0001f600x" * 3
        if self.split_ids(probe) != self.model.encode(probe):
            raise ValueError("the model needs a normaliser or prefix that is not supported")

    def _index(self, keys: np.ndarray) -> None:
        """A hash table of pair keys, at most a quarter full: place -> key, and which rule it is."""
        self.bits = max(4, int(4 * max(1, keys.size)).bit_length())
        self.table, self.rule = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        rules, place = np.arange(keys.size), self._place(keys)
        self.probes = 0
        while rules.size:
            free = self.table[place] == -1
            _, first = np.unique(place[free], return_index=True)
            set_ = np.flatnonzero(free)[first]
            self.table[place[set_]], self.rule[place[set_]] = keys[rules[set_]], rules[set_]
            rules, place = np.delete(rules, set_), (np.delete(place, set_) + 1) % (1 << self.bits)
            self.probes += 1

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rules(self, keys: np.ndarray) -> np.ndarray:
        """The merge rule of each pair key, -1 for none."""
        place, found, open_ = self._place(keys), np.full(keys.size, -1), np.arange(keys.size)
        for _ in range(self.probes):
            got = self.table[place]
            hit = got == keys[open_]
            found[open_[hit]] = self.rule[place[hit]]
            more = ~hit & (got != -1)
            if not more.any():
                break
            open_, place = open_[more], (place[more] + 1) % (1 << self.bits)
        return found

    def merge(self, words: list[str]) -> list[list[int]]:
        """Ids of each word.

        All words' symbols stand in one flat array. In each round every word's pair of smallest merge rank is merged, in
        all words at once; the array is closed up, and rounds go on until no pair is left. Words without a pair leave
        the array. If the new piece is settled, merging it cannot bring up an earlier merge, so all its pairs in the
        word are merged in the round, each run of overlapping ones from the left. Else a merge can bring up earlier ones,
        which all grow the same piece and so stay within the longest piece's length: then the pairs that have no other
        to their left within twice that length are merged, which cannot reach each other.
        """
        found: list[list[int]] = [[] for _ in words]
        chars = [[self.ids.get(c, -1 - ord(c)) for c in w] for w in words]
        symbols = np.array([s for w in chars for s in w], np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) for w in chars])
        while symbols.size:
            near = (word[1:] == word[:-1]) & (symbols[1:] >= 0) & (symbols[:-1] >= 0)
            left = np.flatnonzero(near)
            at = self._rules(symbols[left] * self.n + symbols[left + 1])
            left, at = left[at >= 0], at[at >= 0]
            busy = np.zeros(len(words), bool)
            keep = np.ones(symbols.size, bool)
            if left.size:
                owner, rank = word[left], self.ranks[at]
                starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, left.size)))
                best = rank == least
                left, at, owner = left[best], at[best], owner[best]
                first = np.concatenate([[True], owner[1:] != owner[:-1]])
                run = first | np.concatenate([[True], left[1:] != left[:-1] + 1])
                begin = np.maximum.accumulate(np.where(run, np.arange(left.size), 0))
                even = (np.arange(left.size) - begin) % 2 == 0
                alone = np.concatenate([[True], left[1:] - left[:-1] > 2 * self.longest])
                chosen = first | alone | (even & self.settled[self.wholes[at]])
                left, at = left[chosen], at[chosen]
                symbols[left] = self.wholes[at]
                keep[left + 1] = False
                busy[owner] = True
            done = np.flatnonzero(~busy[word])
            if done.size:
                self._store(symbols[done], word[done], found)
                keep[done] = False
            symbols, word = symbols[keep], word[keep]
        return found

    def _store(self, symbols: np.ndarray, word: np.ndarray, found: list[list[int]]) -> None:
        for symbol, w in zip(symbols.tolist(), word.tolist()):
            if symbol >= 0:
                found[w].append(symbol)
            else:
                found[w] += [self.bytes[b] for b in chr(-1 - symbol).encode()]

    def split(self, text: str) -> list[str]:
        """Words, spaces as `SPACE`; together they are the text after its added space."""
        text = (SPACE + text).replace(" ", SPACE)
        if SPACE * 2 not in text and text[-1] != SPACE:
            return text[1:].split(SPACE)
        return [w[1:] for w in re.findall(f"{SPACE}+[^{SPACE}]*", text)]

    def entries(self, texts: list[str]) -> list[list[tuple[str, int]]]:
        """Per text and word: the word's ids in decimal, joined by spaces, and how many. Words are merged together."""
        split, table = [self.split(text) if text else [] for text in texts], self.words
        if len(table) > KEPT_WORDS:
            table.clear()
        new = list({w for words in split for w in words if w not in table})
        own: dict[str, tuple[str, int]] = {}
        for start in range(0, len(new), ROUND_WORDS):
            part = new[start : start + ROUND_WORDS]
            for w, ids in zip(part, self.merge([SPACE + w for w in part])):
                (table if len(w) <= KEPT_CHARS else own)[w] = (" ".join(map(str, ids)), len(ids))
        if own:
            return [[own.get(w) or table[w] for w in words] for words in split]
        return [list(map(table.__getitem__, words)) for words in split]

    def split_ids(self, text: str) -> list[int]:
        return [int(i) for entry, _ in self.entries([text])[0] for i in entry.split()]


@lru_cache(maxsize=2)
def merge_rounds(path: str) -> MergeRounds:
    """One model a worker."""
    return MergeRounds(path)


def encode_and_decode(docs: DataFrame, model: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids, decoded``.

    ``ids`` are the text's ids with the end id last, in decimal, joined by one space; ``n_tokens`` counts all of them;
    ``decoded`` is the text that the library reads from them. A null text is empty: its only id is the end. Ids of rows
    may be null or repeated; an empty table gives an empty result; other columns are not looked at. Rows are encoded
    where they are read, without a shuffle.
    """

    def run(batches):
        own = merge_rounds(model)
        end = own.model.eos_id()
        for batch in batches:
            # Few rows at a time: ids and decoded texts take several times a text's room.
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                counts, joined, decoded = [], [], []
                for entries in own.entries(part.column(1).to_pylist()):
                    line = " ".join([e for e, _ in entries] + [str(end)])
                    counts.append(sum(n for _, n in entries) + 1)
                    joined.append(line)
                    decoded.append(own.model.decode(list(map(int, line.split(" ")))))
                arrays = [part.column(0), pa.array(counts, pa.int64()), pa.array(joined, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids", "decoded"])

    texts = in_small_batches(docs).select(named(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids string, decoded string")
