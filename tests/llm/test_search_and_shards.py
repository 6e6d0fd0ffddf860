import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from classkit.llm.mtree import MTree, top_inner_products
from classkit.llm.queries import ORACLES, QUERIES
from classkit.llm.sharding import communication_matrix, hypergeometric, shuffle_into_shards
from tests.llm.conftest import SF, make_docs


def expected_top(rows, asks, k, scale=256):
    fine = []
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            fine.append((i, tuple(math.floor(scale * float(np.float32(x))) for x in v)))
    out = []
    for i, v in fine:
        if asks(i):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in fine if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def run_top(spark, rows, k=3, tree_rows=40):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, vector string, tag int")
    return sorted(tuple(r) for r in top_inner_products(df, F.col("vec_id") % 10 == 0, k, tree_rows=tree_rows).collect())


def test_top_inner_products(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.2).tolist()) for i in range(300)]
    rows += [(400 + i, rows[3][1]) for i in range(60)]  # copies: ties by id
    rows += [(500, None), (501, [1.0, None] + [0.0] * 6), (502, [float("nan")] * 8), (503, [float("inf")] * 8)]
    rows += [(None, [1.0] * 8), (510, [0.0] * 8), (520, [3.0, 1.0]), (530, []), rows[0], rows[7]]
    assert run_top(spark, rows) == expected_top(rows, lambda i: i % 10 == 0, 3)


def test_few_vectors(spark):
    assert run_top(spark, []) == []
    assert run_top(spark, [(0, None)]) == []
    assert run_top(spark, [(0, [1.0])]) == []
    rows = [(0, [1.0, 2.0]), (3, [0.5, 0.5])]
    assert run_top(spark, rows) == expected_top(rows, lambda i: i % 10 == 0, 3)


def test_repeated_vectors_as_in_sql(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(120)]
    rows += [rows[1], *[rows[7]] * 90, rows[50], rows[50], (100, [0.5] * 6), (1, None)]
    schema = "vec_id long, embedding array<float>"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    mine = QUERIES["op2_top_vectors"](spark, str(tmp_path)).collect()
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
        want = duck.execute(ORACLES["op2_top_vectors"]).fetchall()
    assert sorted(map(tuple, mine)) == sorted(want) and len(want) == 6 * 5
    few = [(0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [3.0])]
    assert run_top(spark, few, 5) == [(0, 1, 2, 256 * 768), (0, 2, 1, 256 * 512), (0, 3, 1, 256 * 512)]


def test_tree_passes_over_pages():
    rng = np.random.default_rng(6)
    vectors = (rng.normal(size=(20, 4))[rng.integers(0, 20, 2_000)] * 200 + rng.normal(size=(2_000, 4)) * 4).astype(np.int64)
    norm2 = int((vectors**2).sum(1).max())
    tree = MTree.unpacked(MTree(np.arange(2_000), vectors, norm2).packed())
    for q in range(0, 2_000, 97):
        scores = vectors @ vectors[q]
        want = sorted(((int(s), i) for i, s in enumerate(scores) if i != q), key=lambda x: (-x[0], x[1]))[:5]
        assert tree.search(vectors[q], q, 5, None) == want
        assert tree.search(vectors[q], q, 5, want[2][0])[:3] == want[:3]


def test_matrix_has_exact_sums():
    for rows, shards in (([5, 0, 17, 100], 3), ([1], 4), ([], 4), ([3, 3, 3], 24)):
        matrix = communication_matrix(rows, shards, 1)
        assert [sum(line) for line in matrix] == rows
        sizes = [sum(line[s] for line in matrix) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == sum(rows)


@pytest.mark.parametrize("good,bad,draws", [(5, 5, 4), (3, 20, 10), (40, 10, 25), (10**10, 3 * 10**10, 12)])
def test_hypergeometric_distribution(good, bad, draws):
    rng, n = np.random.default_rng(1), 20_000
    seen = Counter(hypergeometric(rng, good, bad, draws) for _ in range(n))
    for k in range(draws + 1):
        p = math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
        assert abs(seen[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9


def test_shards(spark, odd_pairs):
    docs = make_docs(spark, odd_pairs).repartition(5)
    got = shuffle_into_shards(docs, 4)
    assert sorted(got.columns) == sorted([*docs.columns, "slot"])
    slots = defaultdict(list)
    for r in got.collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(map(len, slots.values())) == [8, 9, 9, 9] and set(slots) == {0, 1, 2, 3}
    ids = lambda df: sorted(map(str, (tuple(r) for r in df.select("doc_id", "text").collect())))
    assert ids(got) == ids(docs)
    assert shuffle_into_shards(make_docs(spark, []), 4).count() == 0


def test_shards_are_uniform(spark):
    """Over seeds, a row is in every shard and slot about equally often, and neighbours part."""
    shard, slot, together = Counter(), Counter(), 0
    for seed in range(30):
        rows = {r["id"]: (r["shard"], r["slot"]) for r in shuffle_into_shards(spark.range(0, 40, 1, 4), 4, seed).collect()}
        shard.update(s for i, (s, _) in rows.items() if i < 10)
        slot.update(s for i, (_, s) in rows.items() if i < 10)
        together += sum(rows[i][0] == rows[i + 1][0] for i in range(0, 40, 2))
    assert all(40 < shard[s] < 115 for s in range(4)) and all(10 < slot[s] < 55 for s in range(10))
    assert 90 < together < 190  # 9 of 39 pairs in 600: 138


def test_registered_shards(spark, sample):
    rows = QUERIES["op7_uniform_shards"](spark, SF).collect()
    want = sorted((i, len(t.encode()) + 8, zlib.crc32(t.encode()), "rows", None) for i, t, _ in sample)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows) == want
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) <= set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
