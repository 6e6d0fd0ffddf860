"""Phrase counts and collocations against plain counting."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from classkit.llm import collocations as C
from classkit.llm import queries

from .conftest import SF, make_docs


def plain(rows, max_words=3, least=10, top=2000, percent=50):
    """By definition, with Python's integers."""
    counts, totals = {}, Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        own = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals["und" if lang is None else lang] += len(words)
            for n in range(1, max_words + 1):
                own.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if 2 <= len(p) and a >= least}
        inner = {}
        for p, a in candidates.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    inner[p[i : i + n]] = max(a, inner.get(p[i : i + n], 0))
        found = []
        for p, a in candidates.items():
            if p in inner and 100 * inner[p] >= percent * a:
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 3)] * 3), max_size=80), st.integers(1, 40))
def test_multikey_quicksort(rows, small):
    keys = [np.array([r[d] for r in rows], np.int64) for d in range(3)]
    order, starts = C.multikey_quicksort(keys, small)
    made = [rows[i] for i in order]
    assert sorted(order.tolist()) == list(range(len(rows))) and made == sorted(rows)
    assert dict(zip([made[s] for s in starts], np.diff(np.append(starts, len(made))))) == Counter(rows)


def test_registered(spark, sample):
    found = rows_of(queries.QUERIES["op12_collocations"](spark, SF))
    assert found and found == plain([(lang, text) for _, text, lang in sample])


@pytest.mark.parametrize("max_words", [2, 3, 4])
def test_lengths_small_blocks_and_slices(spark, sample, monkeypatch, max_words):
    # In this process alone; tasks of the local session are other processes, so the block itself is tested below.
    docs = make_docs(spark, [(i, t) for i, t, _ in sample[:60]], [lang for _, _, lang in sample[:60]])
    found = rows_of(C.collocations(docs, max_words=max_words, least=4, top=None))
    assert found == plain([(lang, t) for _, t, lang in sample[:60]], max_words, 4, None)


def test_slices_lose_no_phrase(monkeypatch):
    monkeypatch.setattr(C, "SLICE_BYTES", 7)
    text = "Aa bb cc. dd\tee  ff,gg hh;ii " * 5 + "x" * 30 + " aa bb cc"
    every = C.Living(np.full(1 << 10, 255, np.uint8))
    for depth in (2, 3):
        block, counts = C._Block(), Counter()
        for words, ahead in C._slices(text.encode(), depth - 1):
            block.add("en", words, ahead)
        block.close()
        for whole in (True, False):
            first, sizes = block.partitions(depth, every, whole)
            counts = dict(zip(block.spelled(first, depth)[1].to_pylist(), sizes.tolist()))
            pieces = [re.findall(r"[^ \t]+", p) for p in re.split("[.,;]", text.lower())]
            assert counts == Counter(" ".join(p[i : i + depth]) for p in pieces for i in range(len(p) - depth + 1))


def test_odd_documents(spark, odd_pairs):
    langs = [None if i % 3 else "und" if i % 2 else "日本" for i in range(len(odd_pairs))]
    docs = make_docs(spark, odd_pairs, langs)
    found = rows_of(C.collocations(docs, least=3))
    assert found == plain([(lang, t) for (_, t), lang in zip(odd_pairs, langs)], least=3)
    assert C.collocations(docs.limit(0)).collect() == []


def test_large_counts_are_exact(spark):
    row = spark.createDataFrame([(3_000_000_000_000_000, 3_000_000_000_000_001, 3_000_000_000_000_007)], "a long, l long, r long")
    a, left, right = row.head()
    assert row.select(C._score(row.a, row.l, row.r)).head()[0] == 10**6 * a * a // (left * right)
