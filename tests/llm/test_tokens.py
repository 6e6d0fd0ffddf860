import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from classkit.llm import packing, tokens
from classkit.llm.queries import QUERIES
from classkit.llm.sentencepiece_rounds import MergeRounds, encode_and_decode
from tests.llm.conftest import SF, make_docs

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "\n", "a", "the", " word", "<|endoftext|>", "é", "日本", "\U0001f600", "'ll", "12", "...", "\t", "ẞ", "\x1c", " ", "\xa0", "ǆ", "𐐷"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(JSON)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def piece_model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_encoder_is_exact(library):
    own, rng = tokens.ByteLevelEncoder(JSON), random.Random(1)
    assert own.fast
    for _ in range(800):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(80)))
        ids = library(text)
        assert own.encode(text).tolist() == ids
        assert own.count(text, rng.choice([20, 40, 64]), rng.choice([2, 8, 16])) == len(ids)


def test_huge_texts_are_spliced(library, monkeypatch):
    own = tokens.ByteLevelEncoder(JSON)
    monkeypatch.setattr(tokens, "SLICE_CHARS", 50)
    for text in ("word and number 12 " * 300, "x" * 5_000, "ab" * 900 + " end " * 9, "a<|endoftext|> b" * 200, " " * 700 + "q"):
        assert own.encode(text).tolist() == library(text)
        assert own.count(text, 200, 16) == len(library(text))


def test_other_tokenizers_use_their_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, tokenizer = tokens.ByteLevelEncoder(path), Tokenizer.from_file(path)
    assert own.fast is None
    assert own.count("Some WORDS here" * 9) == len(tokenizer.encode("Some WORDS here" * 9, add_special_tokens=False).ids)


def test_token_counts(spark, odd_pairs, library):
    got = tokens.count_tokens(make_docs(spark, odd_pairs), JSON, limit=100)
    want = [(i, len((t or "").encode()), n := len(library(t or "")), n > 100) for i, t in odd_pairs]
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(map(str, want))
    assert tokens.count_tokens(make_docs(spark, []), JSON).count() == 0


def test_registered_token_counts(spark, sample, library):
    got = QUERIES["op5_token_counts"](spark, SF)
    want = [(i, len(t.encode()), n := len(library(t)), n > 512) for i, t, _ in sample]
    assert sorted(tuple(r) for r in got.collect()) == want


def check_packing(rows, pairs, library, capacity):
    ids = defaultdict(list)
    for i, t in pairs:
        ids[i].append([*library(t or ""), 1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for i, documents in ids.items():
        lengths = sorted(len(d) for d in documents)
        assert sum(p[1] for p in pieces[i]) == sum(lengths)
        assert {p[2] for p in pieces[i]} == set(lengths)
        if len(documents) == 1:
            at = 0
            for start, length, _, crc in sorted(pieces[i]):
                assert start == at
                assert crc == zlib.crc32(np.array(documents[0][start : start + length], "<u4").tobytes())
                at += length
    return len(sequences)


def test_packing(spark, odd_pairs, library):
    rows = packing.piece_digests(packing.pack(make_docs(spark, odd_pairs).coalesce(2), JSON, capacity=256, piece=64, block_windows=8))
    check_packing(rows.collect(), odd_pairs, library, 256)
    assert packing.pack(make_docs(spark, []), JSON).count() == 0


def test_registered_packing_has_little_padding(spark, sample, library):
    pairs = [(i, t) for i, t, _ in sample]
    rows = QUERIES["op6_packed_sequences"](spark, SF).collect()
    sequences = check_packing(rows, pairs, library, packing.CAPACITY)
    assert sum(r["length"] for r in rows) > 0.95 * packing.CAPACITY * sequences


def test_differencing():
    rng = random.Random(2)
    for windows in (1, 2, 7):
        sizes = [rng.randrange(1, 100) for _ in range(60)]
        totals, groups = packing.difference(sizes, windows)
        assert sorted(i for g in groups for i in g) == list(range(60))
        assert sorted(totals.tolist()) == sorted(sum(sizes[i] for i in g) for g in groups)
        assert totals.max() - totals.min() <= 8
    assert packing.windows_of([], 10) == []
    for sizes, capacity in (([10] * 5, 10), ([7, 7, 7], 10), ([6, 5, 5, 4], 10)):
        groups = packing.windows_of(sizes, capacity)
        assert all(sum(sizes[i] for i in g) <= capacity for g in groups)
        assert sorted(i for g in groups for i in g) == list(range(len(sizes)))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_merge_rounds_are_exact(piece_model):
    own, rng = MergeRounds(MODEL), random.Random(3)
    alphabets = (" \t\n ab▁éß日本\x00\U0001f600'<s>ththe  xyz", "aeinrst thonl .=-*")
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(60))) for _ in range(1_500)]
    for _ in range(800):
        text = "".join(piece_model.id_to_piece(rng.randrange(259, 32_000)) for _ in range(rng.randrange(20)))
        texts.append(text.replace("▁", " " if rng.random() < 0.5 else ""))
    texts += ["a" * 5_000, "ab" * 3_000 + " " * 70, "".join(rng.choice("abcdeth") for _ in range(5_000))]
    for text in texts:
        assert own.split_ids(text) == piece_model.encode(text)


def test_sentencepiece_rows(spark, odd_pairs, piece_model):
    got = encode_and_decode(make_docs(spark, odd_pairs), MODEL)
    want = []
    for i, t in odd_pairs:
        ids = piece_model.encode(t or "", add_eos=True)
        want.append((i, len(ids), " ".join(map(str, ids)), piece_model.decode(ids)))
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(map(str, want))
    assert encode_and_decode(make_docs(spark, []), MODEL).count() == 0


def test_registered_sentencepiece(spark, sample, piece_model):
    want = []
    for i, t, _ in sample:
        ids = piece_model.encode(t, add_eos=True)
        want.append((i, len(ids), digest(" ".join(map(str, ids))), digest(piece_model.decode(ids))))
    assert sorted(tuple(r) for r in QUERIES["op10_sentencepiece"](spark, SF).collect()) == want
