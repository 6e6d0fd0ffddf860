"""Integer codebooks against plain Lloyd rounds."""

import hashlib
import math

import numpy as np
import pytest

from classkit.llm.vector_codes import books_text, code_digests, decode_vectors, encode_vectors, train_codebooks

SCHEMA = "vec_id long, embedding array<float>, label string, codes string, v string, error int, row int"


def plain(rows, parts, entries, rounds, scale=4096):
    """(codes, error) per usable row, and the books, by definition."""
    usable = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ints = [[math.floor(scale * float(np.float32(x))) for x in r[1]] for r in usable]
    if not ints:
        return [], []
    width = len(ints[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in ints]
    order = sorted(range(len(usable)), key=lambda i: (usable[i][0] is None, usable[i][0] or 0, ints[i]))
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def best(member, book):
        return min((sum((a - b) ** 2 for a, b in zip(member, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(best(c[p], books[p])[1], []).append(c[p])
            books[p] = [tuple(sum(x) // len(groups[e]) for x in zip(*groups[e])) if e in groups else entry for e, entry in enumerate(books[p])]
    coded = [[best(c[p], books[p]) for p in range(parts)] for c in cut]
    return [(r[0], r[2], tuple(e for _, e in c), sum(d for d, _ in c)) for r, c in zip(usable, coded)], books


def random_rows(n, width, seed):
    rng = np.random.default_rng(seed)
    return [(int(i), rng.normal(size=width).astype("float32").tolist(), f"l{i % 3}" if i % 5 else None, "c", "v", 1, 2) for i in rng.permutation(n)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_books_and_codes(spark, partitions):
    rows = random_rows(150, 12, 3)
    rows += rows[:10] + [(None, rows[0][1], None, "", "", 0, 0), (500, None, "l0", "", "", 0, 0), (501, [1.0] * 11 + [None], "l1", "", "", 0, 0)]
    rows += [(502, [float("nan")] * 12, "l1", "", "", 0, 0), (503, [float("inf")] * 12, "l1", "", "", 0, 0)] + [(-1 - i, [0.25] * 12, "l2", "", "", 0, 0) for i in range(60)]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    codes, books = plain(rows, 3, 7, 5)
    made = train_codebooks(vectors, parts=3, entries=7, rounds=5)
    assert [[tuple(e) for e in b.tolist()] for b in made] == books
    found = sorted(str((r["vec_id"], r["label"], tuple(r["codes"]), r["error"])) for r in encode_vectors(vectors, made).collect())
    assert found == sorted(map(str, codes))
    back = decode_vectors(encode_vectors(vectors, made), made).where("vec_id = 7").head()
    assert np.allclose(back["decoded"], np.concatenate([(made[p][c] + 0.5) / 4096 for p, c in enumerate(back["codes"])]))
    digest = {str(r["vec_id"]): r for r in code_digests(vectors, made).collect()}
    sums = {}
    for _, label, _, error in codes:
        sums[label] = sums.get(label, 0) + error
    assert all(digest[str(i)]["label_error"] == sums[label] and digest[str(i)]["code"] == "".join(f"{c:02x}" for c in code) for i, label, code, _ in codes)
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    assert {r["codebooks_sha256"] for r in digest.values()} == {hashlib.sha256(text.encode()).hexdigest()}


def test_few_and_no_vectors(spark):
    rows = random_rows(4, 8, 5)
    made = train_codebooks(spark.createDataFrame(rows, SCHEMA), parts=2, entries=16, rounds=2)
    assert [[tuple(e) for e in b.tolist()] for b in made] == plain(rows, 2, 16, 2)[1]
    none = spark.createDataFrame([(1, None, None, "", "", 0, 0)], SCHEMA)
    for empty in (none, none.limit(0)):
        assert train_codebooks(empty) == [] and books_text([]) == ""
        assert code_digests(empty, []).collect() == []


def test_refused(spark):
    rows = random_rows(4, 8, 5)
    with pytest.raises(ValueError, match="4 to 8"):
        train_codebooks(spark.createDataFrame([*rows, (9, [1.0] * 4, None, "", "", 0, 0)], SCHEMA), parts=2)
    with pytest.raises(ValueError, match="8 components in 3"):
        train_codebooks(spark.createDataFrame(rows, SCHEMA), parts=3)
    with pytest.raises(ValueError, match="1 vectors"):
        train_codebooks(spark.createDataFrame([*rows, (9, [3e38] * 8, None, "", "", 0, 0)], SCHEMA), parts=2)
