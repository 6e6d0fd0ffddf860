"""Personal data: fixed patterns, and terms that the corpus shows to reveal what the patterns found."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from classkit.llm.bitmap import Living, bitmap, bitmap_bits
from classkit.llm.common import OUT_ROWS, in_small_batches, named, packed, rebatched, text_of, unpacked, written

# Kinds in the order that breaks ties between spans; terms are the ones added by the method.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "term")
_INT = T.IntegerType()
SPANS = T.ArrayType(T.StructType([T.StructField("start", _INT), T.StructField("kind", _INT), T.StructField("end", _INT)]))

MIN_TERM_CHARS = 3
KEPT_TERMS = 200_000
# So many further documents with a term, which hold an entity as often as all documents do, are added to those counted.
SMOOTHING = 0.5
# A term this many code points before or after something found, or nearer, stands near it.
NEAR_CHARS = 80
# So many different texts must hold a term together with an entity if it stands near none.
FAR_TEXTS = 2

# The patterns find what the plain ones in comments do, without trying a run of digits again from its middle.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")  # with what stands before it: [A-Za-z0-9._%+-]+@...
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")  # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    past = 0
    for found in _AT.finditer(text):
        start = found.start()
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        if start < found.start():
            past = found.end()
            yield start, past


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for found in _IP.finditer(text):
        parts = [p.lstrip("0") for p in found[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield found.span()


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        digits = _digits(found[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 9 <= len(_digits(found[0])) <= 15:
            yield found.span()


_FINDERS = (_emails, _ips, _cards, _phones)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start and kind; of each kind, the leftmost matches that do not overlap."""
    return sorted((start, kind, end) for kind, find in enumerate(_FINDERS) for start, end in find(text))


def _entity(text: str, span: tuple[int, int, int]) -> str:
    """A digest of what a span names, however it is written."""
    start, kind, end = span
    value = text[start:end]
    value = value.lower() if kind == 0 else value if kind == 1 else _digits(value)
    return hashlib.blake2b(f"{BASE_KINDS[kind]}:{value}".encode(), digest_size=16).hexdigest()


def _words(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
    """The words of a text outside its spans, wherever they stand: (term, start, end)."""
    words, at, past = [], 0, 0
    for found in _WORD.finditer(text):
        a, b = found.span()
        while at < len(spans) and spans[at][0] < b:
            past, at = max(past, spans[at][2]), at + 1
        if b - a >= MIN_TERM_CHARS and past <= a:
            words.append((found[0].lower(), a, b))
    return words


def _near(words: list[tuple[str, int, int]], spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, bool]]:
    """The term of each word and whether it stands near a span; both lists are by start."""
    at, past = 0, -NEAR_CHARS - 1
    for term, a, b in words:
        while at < len(spans) and spans[at][0] < b:
            past, at = max(past, spans[at][2]), at + 1
        yield term, a - past <= NEAR_CHARS or (at < len(spans) and spans[at][0] - b <= NEAR_CHARS)


def _private(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(text key, text, entities) of the texts with findings."""
    for batch in batches:
        for text in batch.column(0):
            text = text.as_py()
            spans = base_spans(text)
            if spans:
                yield hashlib.md5(text.encode()).hexdigest(), text, sorted({_entity(text, s) for s in spans})


def _text_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(text number, term, near): the different terms of a text, and whether one stands near something found in it."""
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            spans, terms = base_spans(text), {}
            for term, near in _near(_words(text, spans), spans):
                terms[term] = near or terms.get(term, False)
            for term, near in terms.items():
                yield doc.as_py(), term, near


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(text key, spans of its disclosing terms)."""
    term = KINDS.index("term")
    for batch in batches:
        for key, text, terms in zip(*batch.columns):
            text, terms = text.as_py(), set(terms.as_py())
            found = [(a, b) for w, a, b in _words(text, base_spans(text)) if w in terms]
            yield key.as_py(), [{"start": a, "kind": term, "end": b} for a, b in found]


def _place(key: str) -> int:
    """Where a text's MD5 stands in a bitmap of keys, as `_places` says it."""
    return int(key[:15], 16)


def _places(key: str) -> Column:
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("long")


def _is_copied(texts: list[str], copied: Living) -> tuple[list[str], np.ndarray]:
    """Keys of the texts, and which of them may have copies: all that have, and few others."""
    keys = [hashlib.md5(t.encode()).hexdigest() for t in texts]
    return keys, copied.holds(np.fromiter(map(_place, keys), np.uint64, len(keys)))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    """Few texts at a time as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            yield batch.column(batch.num_columns - 1).slice(start, 200).to_pylist()


def _term_counts(shared):
    """(term, texts): in how many texts, added up over as many texts as have KEPT_TERMS different terms.

    Texts in the bitmap of copied ones are left out; without a bitmap none is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        counts: Counter[str] = Counter()
        copied = None if shared is None else Living.of(shared)
        for texts in _parts(batches):
            left_out = np.zeros(len(texts), bool) if copied is None else _is_copied(texts, copied)[1]
            for text in (t for t, out in zip(texts, left_out) if not out):
                counts.update({w for w in _WORD.findall(text.lower()) if len(w) >= MIN_TERM_CHARS})
            if len(counts) >= KEPT_TERMS:
                yield from counts.items()
                counts.clear()
        yield from counts.items()

    return run


def _copied_texts(shared):
    """(text key, text) of the texts in the bitmap of copied ones, each once a task for as long as it remembers them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        copied, sent = Living.of(shared), set()
        for texts in _parts(batches):
            for text, key, may in zip(texts, *_is_copied(texts, copied)):
                if may and key not in sent:
                    sent.add(key)
                    yield key, text
            if len(sent) >= KEPT_TERMS:
                sent.clear()

    return run


def _rows(df: DataFrame, function, ddl: str, size: int = OUT_ROWS * 5) -> DataFrame:
    schema = to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)
    return df.mapInArrow(lambda batches: rebatched(function(batches), schema, size), ddl)


def _set_of(*columns: str) -> list[Column]:
    """Two hashes of the set of a group's members, which stand in it once."""
    return [F.bit_xor(F.xxhash64(*columns)).alias("a"), F.bit_xor(F.xxhash64(*columns, F.lit(1))).alias("b")]


def disclosing_spans(docs: DataFrame, share: float = 0.9, text_col: str = "text") -> DataFrame:
    """``key, terms``: per text (by MD5) the spans of terms that disclose something the patterns found in it.

    Documents are counted by text: copies of one text are pooled into one. Over them, an entity e (an address, a
    number) has information content IC = log2(1 / p), where p = with e / all. A word t anywhere in a text with e has
    PMI = log2((with e and t + SMOOTHING * p) / ((with t + SMOOTHING) * p)). It discloses e if PMI reaches ``share`` of
    IC, that is, if knowing t nearly tells e, and there is evidence that the two belong together: in one of the texts
    with both t stands near something found (NEAR_CHARS code points), or there are FAR_TEXTS such texts. A rare word far
    from every mention, met once, is no evidence and stays. Smoothing leaves a term seen once, in the only document of an entity, a
    PMI of log2(1 + SMOOTHING) bits less than IC: at a share of 0.9 that is enough among 58 texts or more. All
    occurrences of a term that discloses an entity are spans, in every text that holds that entity.
    """
    texts = in_small_batches(docs).select(text_of(text_col).alias("text"))
    schema = f"key string, terms {SPANS.simpleString()}"
    private = _rows(texts, _private, "key string, text string, entities array<string>", 200).dropDuplicates(["key"])
    private = written(private.withColumn("doc", F.monotonically_increasing_id()), "private")
    if private.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)
    key = F.md5("text").alias("key")
    copies = written(texts.groupBy(key).agg(F.count("*").alias("n")).where("n > 1"), "copies")
    extra = copies.agg(F.count("*"), F.sum(F.col("n") - 1)).head()
    total = texts.count() - (extra[1] or 0)
    # Terms are counted where texts are read, but for texts that have copies: only those travel, to be counted once.
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(copies.select(_places("key").alias("at")), bitmap_bits(extra[0])))
    once = _rows(texts, _copied_texts(shared), "key string, text string", 200).dropDuplicates(["key"]).select("text")
    ddl = "term string, docs long"
    terms = _rows(texts, _term_counts(shared), ddl).union(_rows(once, _term_counts(None), ddl))
    terms = terms.groupBy("term").agg(F.sum("docs").alias("with_term"))

    named_in = written(private.select("doc", F.explode("entities").alias("entity")), "named")
    p = F.col("with_entity") / F.lit(float(total))
    content = -F.log2(p)
    # No term in more texts than this can reach the share, even if it is in all texts of the entity.
    most = (F.col("with_entity") + SMOOTHING * p) * F.pow(p, share - 1) - SMOOTHING
    # Entities in the same texts are told alike by any term, and terms in the same texts, near in the same of them, tell
    # alike: of either, only the sets of texts meet, so a list of many addresses and names does not make a row for each pair.
    entities = named_in.groupBy("entity").agg(F.count("*").alias("with_entity"), *_set_of("doc"))
    entities = entities.where(content > 0).select("entity", "with_entity", F.struct("with_entity", "a", "b").alias("e"))
    entities = written(entities.withColumn("most", most + 1e-6), "entities")
    rare = terms.where(F.col("with_term") <= F.lit(entities.agg(F.max("most")).head()[0] or 0.0))
    held = _rows(private.select("doc", "text"), _text_terms, "doc long, term string, near boolean").join(rare, "term")
    held = written(held, "held")
    sets = held.groupBy("term").agg(*_set_of("doc", "near"), F.first("with_term").alias("with"))
    sets = sets.select("term", F.struct("with", "a", "b").alias("t"))
    held = written(held.join(sets, "term"), "terms-of")
    ours = held.select("doc", "near", "t", "with_term").distinct()
    theirs = named_in.join(entities, "entity").select("doc", "e", "with_entity", "most").distinct()
    pairs = written(ours.join(theirs, "doc").where("with_term <= most").drop("most"), "pairs")
    known = pairs.groupBy("e", "t", "with_entity", "with_term").agg(
        F.count("*").alias("together"), F.max("near").alias("near")
    )
    pmi = F.log2((F.col("together") + SMOOTHING * p) / ((F.col("with_term") + SMOOTHING) * p))
    telling = written(known.where((pmi >= share * content) & (F.col("near") | (F.col("together") >= FAR_TEXTS))).select("e", "t"), "telling")
    told = pairs.join(telling, ["e", "t"]).select("doc", "t").distinct()
    found = held.join(told, ["doc", "t"]).groupBy("doc").agg(F.collect_set("term").alias("telling"))
    located = private.join(found, "doc").select("key", "text", "telling")
    return _rows(located, _located, schema, 200)


@F.arrow_udf(SPANS)
def _found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([pa.field("start", pa.int32()), pa.field("kind", pa.int32()), pa.field("end", pa.int32())]))
    for array in texts:
        made = [[{"start": a, "kind": k, "end": b} for a, k, b in base_spans(t.as_py())] for t in array]
        yield pa.array(made, kind)


def _spans(docs: DataFrame, kept: Column, share: float, text_col: str) -> DataFrame:
    """Columns ``kept`` (a struct), ``base`` and ``spans`` (base and terms)."""
    terms = written(disclosing_spans(docs, share, text_col), "terms")
    rows = docs.select(kept.alias("row"), text_of(text_col).alias("text"), _found(text_of(text_col)).alias("base"))
    # Texts without findings have no terms; keys of their own kind keep them spread.
    key = F.when(F.size("base") > 0, F.md5("text")).otherwise(F.xxhash64("text").cast("string"))
    rows = rows.select("row", "base", key.alias("key")).join(terms, "key", "left")
    none = F.array().cast(SPANS)
    return rows.select("row", "base", F.array_sort(F.concat("base", F.coalesce("terms", none))).alias("spans"))


def private_spans(
    docs: DataFrame, share: float = 0.9, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, base, spans``, arrays of (start, kind, end) by start, then kind.

    ``base`` are the matches of the fixed patterns, ``spans`` those and the disclosing terms of the text; offsets count
    code points, ends are exclusive, kinds are indexes of `KINDS`. A null text is empty. Ids may be null or repeated; an
    empty table gives an empty result; other columns are not looked at. Equal texts get equal spans.
    """
    rows = _spans(docs, F.struct(named(id_col).alias("doc_id")), share, text_col)
    return rows.select("row.doc_id", "base", "spans")


def spelled(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def _generalised(word: str) -> str:
    if any(c.isdigit() for c in word):
        return "<code>"
    return "<name>" if word[:1].isupper() else "<term>"


def _redact(text: str | None, spans: list[dict]) -> str | None:
    if not text or not spans:
        return text
    parts, at = [], 0
    for span in spans:
        start, kind, end = span["start"], span["kind"], span["end"]
        if start >= at:
            new = _generalised(text[start:end]) if KINDS[kind] == "term" else f"<{KINDS[kind]}>"
            parts += [text[at:start], new]
        at = max(at, end)
    return "".join(parts) + text[at:]


@F.arrow_udf(T.StringType())
def _redacted(texts: pa.Array, spans: pa.Array) -> pa.Array:
    parts = [pa.array([], pa.string())]
    for start in range(0, len(texts), 200):  # few texts at a time as Python objects
        pairs = zip(texts.slice(start, 200), spans.slice(start, 200))
        parts.append(pa.array([_redact(t.as_py(), s.as_py()) for t, s in pairs], pa.string()))
    return pa.concat_arrays(parts)


def sanitise(docs: DataFrame, share: float = 0.9, text_col: str = "text") -> DataFrame:
    """``docs``, all rows and columns, with every span of `private_spans` in the text replaced by a name of its kind.

    Ids are not looked at: repeated rows are changed alike, an empty table gives an empty one. Findings become ``<email>`` and so on; terms are generalised to ``<code>`` (with digits), ``<name>`` (capitalised)
    or ``<term>``. Of spans that overlap, the first one's name is put in and all are taken out. Null texts stay null.
    """
    rows = _spans(docs, packed(docs), share, text_col)
    text = F.col("row").getField(text_col)
    rows = rows.select("row", _redacted(text, F.col("spans")).alias(text_col))
    return unpacked(rows, "row", docs.columns, named(text_col)).select(*[named(c) for c in docs.columns])
