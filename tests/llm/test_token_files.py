"""Token files: the library's ids, their layout, and reading parts of them."""

from itertools import accumulate
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from classkit.llm import queries
from classkit.llm.token_files import WordEncoder, read_span, read_tokens, write_tokens

from .conftest import SF, make_docs

WORDS = public_tokenizers.path("word_bpe_49k.json")


def library(path, text):
    own = Tokenizer.from_file(path)
    return own.encode(text or "", add_special_tokens=False).ids


def test_words_are_encoded_as_texts_are(sample):
    own, theirs = WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    assert own.by_words and not WordEncoder(public_tokenizers.path("byte_bpe_50k.json")).by_words
    odd = ["ΑΣ ΣΑΣ. Σ", "<|startoftext|> a<|endoftext|>b  c", "ä ̈o x\x85y\xa0z\x1ck l", "İstanbul ﬁ ÄÖ.!", "'ll we'll 'S don't", "", "  ", "日本語 12 3a\x00b", "가 ᅡᆨ", "a\x0bb\x0cc\r\n", "x" * 5000, "É##' ÿ?'s"]
    for text in [t or "" for _, t, _ in sample] + odd:
        assert own.encode(text) == np.array(theirs.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text[:80]


def test_registered(spark, sample):
    found = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.QUERIES["op11_token_files"](spark, SF).collect()}
    ids = {i: np.array([*library(WORDS, t), 2], "<u4") for i, t, _ in sample}
    begins = dict(zip(sorted(ids), accumulate((len(ids[i]) for i in sorted(ids)), initial=0)))
    assert found == {i: (begins[i], len(x), crc32(x.tobytes())) for i, x in ids.items()}


def test_layout(spark, tmp_path, sample):
    docs = make_docs(spark, [(i, t) for i, t, _ in sample])
    write_tokens(docs, f"{tmp_path}/t", WORDS, 2, row_group_bytes=20_000, page_bytes=2_000, page_rows=20)
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "t" / "tokens").glob("*.parquet")]
    groups = [m.row_group(g) for m in files for g in range(m.num_row_groups)]
    assert len(groups) > len(files)
    for group in groups:
        columns = {group.column(c).path_in_schema: group.column(c) for c in range(group.num_columns)}
        assert all(c.has_offset_index and c.has_column_index for c in columns.values())
        assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
        assert all("DELTA_BINARY_PACKED" in columns[c].encodings for c in ("doc_id", "start", "n_tokens"))
    narrow = read_tokens(spark, f"{tmp_path}/t").select("doc_id", "n_tokens")
    plan = narrow._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_parts_of_the_files(spark, tmp_path, odd_pairs):
    docs = make_docs(spark, odd_pairs)
    path = f"{tmp_path}/t"
    write_tokens(docs.repartition(3), path, WORDS, 2)
    rows = sorted(read_tokens(spark, path).collect(), key=lambda r: r["start"])
    ids = [i for r in rows for i in r["ids"]]
    assert [r["start"] for r in rows] == list(accumulate((r["n_tokens"] for r in rows[:-1]), initial=0))
    order = [r["doc_id"] for r in rows]  # null ids first, repeated ones side by side
    assert order == sorted((i for i, _ in odd_pairs), key=lambda i: (i is not None, i or 0))
    assert sorted((str(r["doc_id"]), tuple(r["ids"])) for r in rows) == sorted((str(i), (*library(WORDS, t), 2)) for i, t in odd_pairs)
    for first, end in ((0, 1), (0, len(ids)), (17, 911), (len(ids) - 3, len(ids) + 9), (len(ids), len(ids) + 1), (5, 5)):
        part = sorted(read_span(spark, path, first, end).collect(), key=lambda r: r["start"])
        assert [i for r in part for i in r["ids"]] == ids[first:end]
    only = read_tokens(spark, path, F.col("doc_id") == 202)
    assert [r["n_tokens"] for r in only.collect()] == [1]


def test_no_documents(spark, tmp_path):
    write_tokens(make_docs(spark, []), f"{tmp_path}/t", WORDS, 2)
    assert read_tokens(spark, f"{tmp_path}/t").collect() == [] and read_span(spark, f"{tmp_path}/t", 0, 5).collect() == []


def test_runs_of_marks_are_merged_once():
    own = WordEncoder(WORDS)
    merged, asked = own._merged, []
    own._merged = lambda run: asked.append(run) or merged(run)
    text = " ".join(f"word{'abcdefghij'[i]}, Word{'klmnopqrst'[i]}?!" for i in range(10))
    assert own.encode(text) == np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert asked.count(",") == asked.count("?!") == 1
