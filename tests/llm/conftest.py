import random

import duckdb
import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        # Names that the operators use for columns of their own.
        *[T.StructField(c, T.StringType()) for c in ("fingerprint", "hash", "tag", "row", "kept", "shard", "c0", "a.b", "key", "n_lines")],
    ]
)
EXTRA = ("x",) * 10


def make_docs(spark, pairs, langs=None):
    rows = [(i, t, langs[n] if langs else None, *EXTRA) for n, (i, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def odd_pairs():
    """Nulls, empty, white space, very long and repeated texts, null and repeated ids."""
    rng = random.Random(4)
    words = ["the", "Ärger", "naïve", "日本", "x1", "foo.bar", "<|endoftext|>", "1.2.3.4", "a@b.co", "'ll"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(20)]
    pairs = list(enumerate(texts)) + [(100 + i, t) for i, t in enumerate(texts[:5])]
    pairs += [(200, None), (201, ""), (202, " \t\n"), (None, "no id"), (None, None), (203, "\n\n"), (0, texts[0])]
    pairs += [(300, "long " * 30_000), (301, "x" * 50_000), (302, "日本語" * 9_000)]
    return pairs


@pytest.fixture(scope="session")
def sample():
    """(doc_id, text, lang) of the smallest table."""
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
