"""The registered queries of this package, each over its whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann, bpe, hamming, html_text, langid, lexical, licenses, packing, periodic, quality, shards,
    simhash, toxicity,
)
from .common import new_folder, table

VOCABULARY = "byte_bpe_50k.json"

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def held_out():
    """Rows kept out of learning: a quarter, by a checksum of the id."""
    return F.coalesce(
        F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False)
    )


@query
def op8_pack(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 tokens."""
    path = public_tokenizers.path(VOCABULARY)
    return packing.pack_documents(table(spark, folder, "documents"), path)


@query
def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the token ids and of the decoded text of all documents."""
    path = public_tokenizers.path(VOCABULARY)
    return bpe.round_trip_digests(table(spark, folder, "documents"), path)


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels of three quarters."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.learned(docs, table(spark, folder, "labels"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", toxicity.predicted("score").alias("predicted")
    )


@query
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of all documents."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of all documents, learned from three quarters of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, "_found")
    return found.select(
        "doc_id", held_out().alias("held_out"), "_found.lang_pred", "_found.score"
    )


@query
def op3_hamming(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest sign codes of every 20th vector, by Hamming distance."""
    codes = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), hamming.sign_code(F.col("embedding")).alias("code")
    )
    return hamming.nearest_codes(codes, F.col("id") % 20 == 0).select(
        "query_id", "rank", "vec_id", "distance"
    )


ORACLE["op3_hamming"] = """
WITH codes AS (
    SELECT vec_id, list_aggregate(list_transform(range(64), lambda i:
        CASE WHEN embedding[i + 1] > 0 THEN (1::UBIGINT << i::UBIGINT) ELSE 0::UBIGINT END), 'bit_or') AS code
    FROM embeddings WHERE len(embedding) = 64
), ranked AS (
    SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code))::INTEGER AS distance,
        row_number() OVER (PARTITION BY q.vec_id
            ORDER BY bit_count(xor(q.code, c.code)), c.vec_id)::INTEGER AS rank
    FROM codes q JOIN codes c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10
"""


@query
def op6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest vectors found of every 100th vector."""
    return ann.nearest(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


@query
def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and templates in all documents."""
    return licenses.scan(table(spark, folder, "documents"))


ORACLE["op2_licenses"] = licenses.oracle_sql()


@query
def op5_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extract(table(spark, folder, "pages"))


@query
def op4_training_order(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' sequences as read back, in slot order, from the shards written of them."""
    path = new_folder(spark, "shards")
    shards.write_shards(
        table(spark, folder, "documents"), path, public_tokenizers.path(VOCABULARY), key=20_240_229
    )
    return shards.digests(shards.read_shards(spark, path))


@query
def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of every benchmark item, by its terms."""
    index = lexical.build(table(spark, folder, "documents"))
    return lexical.search(index, table(spark, folder, "benchmark"))


ORACLE["op13_lexical"] = lexical.oracle_sql()


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; of one id in ten the words from a place on repeat with some period."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n, g = F.size("_words"), F.expr("_h div 10")
    rewritten = F.expr(
        "array_join(transform(_words, (w, i) -> IF(i >= _a, _words[CAST(_a + (i - _a) % _p AS INT)], w)), ' ')"
    )
    return (
        docs.select("doc_id", "text", crc.alias("_h"))
        .withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
        .withColumn("_a", F.when(n > 0, g % n))
        .withColumn("_p", 1 + F.expr("(size(_words) - _a) div (3 + (_h div 10) % 8)"))
        .select("doc_id", F.when(n > 0, rewritten).otherwise(F.col("text")).alias("text"))
    )


@query
def op12_periodic(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of repeating words in all documents, and digests of the texts without them."""
    found = periodic.find_runs(with_periodic_tails(table(spark, folder, "documents")))
    key = F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n")))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return found.withColumn("_best", F.array_max(key)).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.expr("(1000L * _best.length) div (-_best.period)").alias("exponent_milli"),
        digest(F.array_join(lines, "")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
        "n_words",
    )


@query
def op11_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Word, symbol and repeat counts of all documents, and whether rules and votes keep them."""
    return quality.judged(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "probability",
    )
