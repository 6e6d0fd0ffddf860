import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from classkit.llm import simhash
from classkit.llm.components import connected_components
from classkit.llm.exact_dedup import content_hash, exact_duplicates
from classkit.llm.queries import QUERIES
from tests.llm.conftest import SF, make_docs


def expected_exact(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[re.sub(r"[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    rows = []
    for pure, members in groups.items():
        members.sort(key=lambda m: m[:3])
        digest = hashlib.sha256(pure.encode()).hexdigest()
        rows += [(m[3], members[0][3], len(members), n == 0, digest) for n, m in enumerate(members)]
    return sorted(map(str, rows))


@pytest.mark.parametrize("hashed", [content_hash, lambda c: F.substring(F.md5(c), 1, 1), lambda c: F.lit("same")])
@pytest.mark.parametrize("broadcast_groups", [0, 1000])
def test_exact_duplicates(spark, odd_pairs, hashed, broadcast_groups):
    got = exact_duplicates(make_docs(spark, odd_pairs), hashed=hashed, broadcast_groups=broadcast_groups)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(str(tuple(r)) for r in got.collect()) == expected_exact(odd_pairs)


def test_exact_duplicates_of_nothing(spark):
    assert exact_duplicates(make_docs(spark, [])).count() == 0


def plain_fingerprint(text, words=3):
    found = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in re.findall(rb"[^\x20\x09-\x0d]+", text.encode())]
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(prints, max_bits):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    array = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= max_bits):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def expected_near(pairs, max_bits=3):
    prints = [plain_fingerprint(t or "") for _, t in pairs]
    roots = plain_components(prints, max_bits)
    least = defaultdict(lambda: None)
    for (i, _), r in zip(pairs, roots):
        if i is not None and (least[r] is None or i < least[r]):
            least[r] = i
    return sorted(str((i, f"{p:016x}", least[r])) for (i, _), p, r in zip(pairs, prints, roots)), roots


def test_fingerprint_in_slices(monkeypatch):
    text = "One two THREE four\tfive\nsix é " * 50
    monkeypatch.setattr(simhash, "SLICE_BYTES", 16)
    monkeypatch.setattr(simhash, "SHINGLES", 3)
    for words in (1, 2, 3):
        assert simhash.fingerprint(text.encode(), words) % 2**64 == plain_fingerprint(text, words)
    for short in ("", " \n", "One", "One two", "One two three"):
        assert simhash.fingerprint(short.encode()) % 2**64 == plain_fingerprint(short)


def test_near_duplicates(spark, odd_pairs):
    got = simhash.near_duplicates(make_docs(spark, odd_pairs))
    assert sorted(str(tuple(r)) for r in got.collect()) == expected_near(odd_pairs)[0]
    assert simhash.near_duplicates(make_docs(spark, [])).count() == 0


def test_one_per_group(spark, odd_pairs, tmp_path):
    make_docs(spark, odd_pairs).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(expected_near(odd_pairs)[1]))


@pytest.mark.parametrize("max_bits,blocks,block_rows", [(3, None, 100_000), (3, 4, 5), (1, 2, 8), (2, 5, 100_000), (0, None, 3)])
def test_links_connect_all_close_fingerprints(spark, max_bits, blocks, block_rows):
    rng = np.random.default_rng(max_bits)
    centres = rng.integers(0, 2**64, 30, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in range(400)], np.uint64)
    prints = np.unique(rng.choice(centres, 400) ^ flips)
    prints = np.sort(prints.view(np.int64)).tolist()
    links = simhash.link_fingerprints(spark.createDataFrame([(p,) for p in prints], "fingerprint long"), max_bits, blocks, block_rows)
    found = {r[0]: r[1] for r in connected_components(links).collect()}
    want = plain_components([p % 2**64 for p in prints], max_bits)
    assert [found.get(p, p) for p in prints] == [prints[r] for r in want]


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 60)], [(5, 3), (3, 5), (None, 2), (9, 8)]])
def test_connected_components(spark, edges):
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({n for a, b in edges if a is not None and a != b for n in (a, b)})
    least = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            if a is not None and a != b:
                least[a] = least[b] = min(least[a], least[b])
    assert got == least


def test_registered_near_duplicates(spark, sample):
    got = QUERIES["op1_near_duplicates"](spark, SF)
    assert sorted(str(tuple(r)) for r in got.collect()) == expected_near([(i, t) for i, t, _ in sample])[0]
