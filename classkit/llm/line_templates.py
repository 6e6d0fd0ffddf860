"""Lines that recur across documents, found as templates of a fixed-depth parse tree."""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classkit.llm.common import in_small_batches, tagged, unpacked, written

# Tokens with a digit are variable fields wherever they stand.
_VARIABLE = re.compile(rb"\S*[0-9]\S*")
MASK = b"<*>"
# Scripts without spaces (Thai, Lao, Myanmar, Khmer, kana, Chinese characters) in UTF-8: in longer runs, each character is
# a token.
_UNSPACED = (
    rb"(?:\xe0[\xb8-\xbb][\x80-\xbf]|\xe1[\x80-\x82\x9e\x9f][\x80-\xbf]|\xe2[\xba-\xbf][\x80-\xbf]"
    rb"|[\xe3-\xe9][\x80-\xbf]{2}|\xef[\xa4-\xab][\x80-\xbf]|\xf0[\xa0-\xb3][\x80-\xbf]{2})"
)
_CHARACTER, _RUN = re.compile(_UNSPACED), re.compile(_UNSPACED + rb"{6,}")
# What a line must have for one of them to match at all.
_DIGIT, _WIDE = re.compile(rb"[0-9]"), re.compile(rb"[\xe0-\xff]")
DEPTH = 3
# Equal lines of so many tokens recur if two documents have them.
LONG_TOKENS = 50
# Percent of a leaf's lines that must have a token at a place to make it a constant there.
LEAF_PERCENT = 10


def _parse(line: bytes, depth: int, min_tokens: int) -> tuple[int, int, list[bytes]] | None:
    """Leaf (token count and leading tokens), the line's own hash, and its tokens, variable fields masked."""
    if len(line) < 2 * min_tokens - 1:
        return None
    if _WIDE.search(line):
        line = _RUN.sub(lambda run: b" " + _CHARACTER.sub(rb"\g<0> ", run[0]), line)
    tokens = (_VARIABLE.sub(MASK, line) if _DIGIT.search(line) else line).split()
    if len(tokens) < min_tokens:
        return None
    leaf = xxhash.xxh64_intdigest(b" ".join(tokens[:depth]), len(tokens))
    return _signed(leaf), _signed(xxhash.xxh64_intdigest(b" ".join(tokens))), tokens


def _signed(value: int) -> int:
    return value - (value >> 63 << 64)


def _occurrences(depth: int, min_tokens: int):
    """mapInArrow over (tag, text): (tag, leaf, line, codes) of each different line of a document, 32 bits a token."""

    def emit(tags: pa.Array, rows, leaves, lines, sizes, codes) -> pa.RecordBatch:
        values = np.fromiter(codes, np.uint32, len(codes)).view(np.int32)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        arrays = [tags.take(pa.array(rows, pa.int64())), pa.array(leaves, pa.int64()), pa.array(lines, pa.int64())]
        return pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(offsets, values)], names=["tag", "leaf", "line", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: tuple[list, ...] = ([], [], [], [], [])
            for row, text in enumerate(batch.column(1)):
                seen = set()
                for raw in text.as_py().encode().split(b"\n"):
                    parsed = _parse(raw, depth, min_tokens)
                    if parsed and parsed[1] not in seen:
                        seen.add(parsed[1])
                        leaf, line, tokens = parsed
                        for column, value in zip(held, (row, leaf, line, len(tokens))):
                            column.append(value)
                        held[4].extend(map(crc32, tokens))
                        if len(held[4]) >= 200_000:
                            yield emit(batch.column(0), *held)
                            held = ([], [], [], [], [])
            if held[0]:
                yield emit(batch.column(0), *held)

    return run


def _dropper(depth: int, min_tokens: int):
    kind = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])

    def one(text: str | None, gone: set[int]) -> dict:
        if text is None:
            return {"text": None, "n_lines": 0, "n_dropped": 0}
        raws = text.encode().split(b"\n")
        kept = [r for r in raws if not (gone and (p := _parse(r, depth, min_tokens)) and p[1] in gone)]
        return {"text": b"\n".join(kept).decode() if gone else text, "n_lines": len(raws), "n_dropped": len(raws) - len(kept)}

    @F.arrow_udf("text string, n_lines long, n_dropped long")
    def drop(texts: pa.Array, lines: pa.Array) -> pa.Array:
        parts = [pa.array([], kind)]
        for start in range(0, len(texts), 200):  # few texts at a time as Python objects
            pairs = zip(texts.slice(start, 200), lines.slice(start, 200))
            parts.append(pa.array([one(t.as_py(), set(g.as_py() or ())) for t, g in pairs], kind))
        return pa.concat_arrays(parts)

    return drop


def recurring_lines(
    docs: DataFrame, min_docs: int, share: float, depth: int, min_tokens: int, long_tokens: int, leaf_percent: int
) -> DataFrame:
    """``tag, lines``: per document (tag, id, text) the hashes of the lines that go.

    A line that ``min_docs`` documents have, equal but for fields with digits, recurs; so does one of at least
    ``long_tokens`` tokens that two documents have. Lines with equal token count and equal leading tokens share a leaf of
    the tree. In a leaf, a token that ``leaf_percent`` of its lines (each counted once a document), and at least
    ``min_docs`` of them, have at a place is a constant there, any other is a variable field, common values of a field
    included. A line whose constants make up ``share`` of its tokens has a template, the leaf with its constants, which
    recurs if ``min_docs`` documents have it. What recurs stays in the document with the smallest id and goes from all
    others.

    Nothing is gathered by leaf: constants, templates and documents are counted, in each task first. Only lines in
    leaves that recur are looked at token by token.
    """
    texts = docs.select("tag", F.coalesce("text", F.lit("")).alias("text"))
    schema = f"tag {docs.schema['tag'].dataType.simpleString()}, leaf long, line long, codes array<int>"
    seen = written(texts.mapInArrow(_occurrences(depth, min_tokens), schema), "occurrences")
    counted = seen.groupBy("leaf", "line").agg(F.count("*").alias("docs"), F.min("tag").alias("tag"), F.max(F.size("codes")).alias("size"))
    counted = written(counted, "counted")
    leaves = written(counted.groupBy("leaf").agg(F.sum("docs").alias("total")).where(F.col("total") >= min_docs), "leaves")
    # Joins with all lines and all texts are shuffled ones at every size: their small sides grow with the corpus. Of a
    # line's many copies only one, by its document and so evenly spread, is asked for its tokens.
    chosen = counted.drop("size").join(leaves.select("leaf").hint("merge"), "leaf", "left_semi")
    lines = chosen.hint("merge").join(seen.select("tag", "line", "codes"), ["tag", "line"]).drop("tag")
    lines = written(lines, "lines")
    tokens = lines.select("leaf", "line", "docs", F.size("codes").alias("n"), F.posexplode("codes").alias("place", "code"))
    constants = tokens.groupBy("leaf", "place", "code").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    constants = constants.join(leaves, "leaf").where(100 * F.col("docs") >= leaf_percent * F.col("total"))
    constants = written(constants.select("leaf", "place", "code"), "constants")
    constant = tokens.join(constants, ["leaf", "place", "code"]).groupBy("line", "leaf", "n")
    templates = constant.agg(F.bit_xor(F.xxhash64("place", "code")).alias("constants"), F.count("*").alias("constant"))
    templates = templates.where(F.col("constant") >= share * F.col("n"))
    templates = templates.select("line", F.xxhash64("leaf", "constants").alias("template"), F.lit(min_docs).alias("least"))
    equal = counted.select("line", "docs", F.when(F.col("size") >= long_tokens, F.least(F.lit(2), F.lit(min_docs))).otherwise(min_docs).alias("least"))
    templates = templates.union(equal.where("docs >= least").select("line", F.xxhash64("line", F.lit("equal")), "least"))
    templates = written(templates, "templates")

    hits = written(seen.select("tag", "line").join(templates, "line"), "hits")
    per_doc = hits.groupBy("template", "tag").agg(F.max("least").alias("least"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag")
    ids = docs.select("tag", "doc_id")
    homes = per_doc.join(ids, "tag").groupBy("template").agg(F.count("*").alias("docs"), F.max("least").alias("least"), F.min(order).alias("home"))
    homes = homes.where("docs >= least").select("template", F.col("home.tag").alias("home"))
    homes = written(homes, "homes")
    gone = hits.join(homes, "template").where("tag != home")
    return gone.groupBy("tag").agg(F.collect_set("line").alias("lines"))


def drop_recurring_lines(
    docs: DataFrame,
    min_docs: int = 3,
    share: float = 0.7,
    depth: int = DEPTH,
    min_tokens: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    counts: bool = False,
    long_tokens: int = LONG_TOKENS,
    leaf_percent: int = LEAF_PERCENT,
) -> DataFrame:
    """``docs``, all rows and columns, without the lines of recurring templates; ``counts`` adds n_lines and n_dropped.

    See `recurring_lines` for what recurs. A line ends at a line feed; lines of fewer than ``min_tokens`` tokens always
    stay; in runs of six or more characters of a script without spaces, each character is a token. The first occurrence
    of everything stays, in the document with the smallest id (null ids after all others, and of repeated ids one), so no
    content is lost; a document all of whose lines stand elsewhere becomes empty. Null texts stay null. Repeated rows are
    documents of their own. An empty table gives an empty result.
    """
    rows = tagged(in_small_batches(docs))
    narrow = rows.select("tag", F.col("row").getField(id_col).alias("doc_id"), F.col("row").getField(text_col).alias("text"))
    gone = written(recurring_lines(narrow, min_docs, share, depth, min_tokens, long_tokens, leaf_percent), "gone")
    text = F.col("row").getField(text_col)
    made = rows.join(gone.hint("merge"), "tag", "left").select("row", _dropper(depth, min_tokens)(text, F.col("lines")).alias("made"))
    more = [F.col("made.n_lines"), F.col("made.n_dropped")] if counts else []
    names = [*docs.columns, *(c for c in ("n_lines", "n_dropped") if counts and c not in docs.columns)]
    out = unpacked(made, "row", docs.columns, F.col("made.text").alias(text_col), *more)
    return out.select(*[F.col("`" + c.replace("`", "``") + "`") for c in names])
