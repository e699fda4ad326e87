"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.llm import (
    codes,
    decontaminate,
    langid,
    mixing,
    nearest,
    packing,
    pii,
    quality,
    simhash,
    spelling,
    suffixdedup,
    token_counts,
    warc,
)
from adstream.llm.common import scratch, table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512
# Fixed values of the contracts.
HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 4, 2
QUERY_EVERY = 100


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document; the cache of this run begins empty."""
    docs = table(spark, sf_dir, "documents")
    counts = token_counts.count_tokens(docs, TOKENIZER, scratch(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without strings of 200 bytes that also start elsewhere."""
    return suffixdedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    read = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return read.where("gap IS NULL").select(
        warc.page_id_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_id_of("refers_to").alias("refers_to"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("_words").alias("n_words"),
        F.col("_hit").alias("n_hit"),
        F.col("_items").alias("n_items"),
        F.col("_digest").alias("items_sha256"),
        (F.col("_hit") > 0).alias("contaminated"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.detect(table(spark, sf_dir, "documents"))[0]


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; its source is the host, a language of it the path."""
    return quality.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang")
    )


def held_out() -> F.Column:
    """Documents that language ID does not learn from; a NULL id is as the empty text."""
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(number) % HELD_OUT_MODULUS == HELD_OUT_REMAINDER


def language_model(docs: DataFrame) -> langid.Model:
    return langid.fit(docs.where(~held_out()))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return langid.identify(rows, language_model(docs)).drop("text")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return simhash.label(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document and their places in sequences."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the corpus, their near words, forms and roots."""
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of sources takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, with the error of each and of its label."""
    coded = codes.label_errors(codes.compress(table(spark, sf_dir, "embeddings")))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def queries() -> dict[str, Query]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_warc": op3_warc,
        "op4_decontamination": op4_decontamination,
        "op5_pii": op5_pii,
        "op6_quality": op6_quality,
        "op7_language_id": op7_language_id,
        "op8_simhash": op8_simhash,
        "op9_packing": op9_packing,
        "op10_nearest": op10_nearest,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_mixing": op12_mixing,
        "op13_vector_codes": op13_vector_codes,
    }
