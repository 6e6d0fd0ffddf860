"""One registered query per operator, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from classkit.llm.collocations import collocations
from classkit.llm.common import documents, text_of
from classkit.llm.exact_dedup import exact_duplicates
from classkit.llm.langid import identify
from classkit.llm.line_templates import drop_recurring_lines
from classkit.llm.mtree import top_inner_products
from classkit.llm.packing import pack, piece_digests
from classkit.llm.pii import BASE_KINDS, private_spans, spelled
from classkit.llm.sentencepiece_rounds import encode_and_decode
from classkit.llm.sharding import shuffle_into_shards
from classkit.llm.simhash import near_duplicates
from classkit.llm.token_files import ids_crc32, read_tokens, write_tokens
from classkit.llm.tokens import count_tokens
from classkit.llm.vector_codes import ROUNDS, code_digests, train_codebooks
from classkit.runtime import scratch_path
from classkit.sources import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


@query()
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=3, max_bits=3)


@query("""
WITH v AS (
  SELECT row_number() OVER () AS tag, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.tag, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""")
def op2_top_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, f"{sf_dir}/embeddings.parquet")
    return top_inner_products(vectors, F.col("vec_id") % 50 == 0, k=5)


@query()
def op3_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


@query("""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS place,
             first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size
      FROM t)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g""")
def op4_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query()
def op6_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")))


@query()
def op7_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = (F.octet_length(text_of("text")) + 8).cast("long").alias("size")
    rows = documents(spark, sf_dir).select("doc_id", size, F.crc32(text_of("text")).alias("text_crc32"))
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return shuffle_into_shards(rows, shards=24).select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query()
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_spans(documents(spark, sf_dir))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)]
    return found.select("doc_id", *counts, F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))


@query()
def op9_recurring_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = drop_recurring_lines(documents(spark, sf_dir), counts=True)
    text = text_of("text")
    return docs.select("doc_id", "n_lines", "n_dropped", F.char_length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("text_sha256"))


@query()
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_and_decode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", ids_crc32("ids").alias("ids_crc32"))


@query("""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, range(1, 4) AS depth(k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY lang, k, phrase HAVING count(*) >= 10),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
x AS MATERIALIZED (SELECT lang, k, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS first, array_to_string(ws[cut + 1:k], ' ') AS rest
                   FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
s AS (SELECT x.lang, x.k, x.phrase, x.a, x.cut, l.n AS l, r.n AS r, ((x.a::HUGEINT * x.a * 1000000) // (l.n::HUGEINT * r.n))::BIGINT AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = x.first JOIN f r ON r.lang = x.lang AND r.phrase = x.rest),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, k, phrase ORDER BY score, cut) = 1),
h AS (SELECT lang, phrase, max(a) AS most
      FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM c WHERE k = 3)
      GROUP BY lang, phrase),
o AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score,
             row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
      FROM b LEFT JOIN h ON b.k = 2 AND h.lang = b.lang AND h.phrase = b.phrase
      WHERE h.most IS NULL OR 100 * h.most < 50 * b.a)
SELECT o.lang, o.rank, o.phrase, o.a, o.l, o.r, t.n, o.score FROM o JOIN t ON t.lang = o.lang WHERE o.rank <= 2000""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def _rounds_sql(rounds: int) -> str:
    """Codebooks and codes of all rounds as one chain of common tables."""
    sql = """
WITH k AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS row,
         list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
m AS MATERIALIZED (SELECT row, p, v[len(v) // 8 * p + 1:len(v) // 8 * (p + 1)] AS m FROM k, range(8) AS parts(p)),
b0 AS MATERIALIZED (SELECT p, row - 1 AS e, m AS c FROM m WHERE row <= 16)"""
    for r in range(rounds + 1):
        sql += f""",
a{r} AS MATERIALIZED (
  SELECT m.row, m.p, b.e, list_sum(list_transform(list_zip(m.m, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM m JOIN b{r} b ON b.p = m.p QUALIFY row_number() OVER (PARTITION BY m.row, m.p ORDER BY d, b.e) = 1)"""
        if r < rounds:
            sql += f""",
s{r} AS (SELECT a.p, a.e, i, sum(m.m[i]) AS total, count(*) AS n
         FROM a{r} a JOIN m ON m.row = a.row AND m.p = a.p, range(1, len(m.m) + 1) AS places(i) GROUP BY a.p, a.e, i),
n{r} AS (SELECT p, e, list(((total - (total % n + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{r} GROUP BY p, e),
b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.c, b.c) AS c FROM b{r} b LEFT JOIN n{r} n ON n.p = b.p AND n.e = b.e)"""
    return sql + f""",
o AS (SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY row),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT k.vec_id, o.code, o.error, (sum(o.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, h.codebooks_sha256
FROM k JOIN o ON o.row = k.row, h"""


@query(_rounds_sql(ROUNDS))
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, f"{sf_dir}/embeddings.parquet")
    return code_digests(vectors, train_codebooks(vectors))
