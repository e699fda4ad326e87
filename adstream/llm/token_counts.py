"""Token counts by a digest cache: stored counts are joined, only distinct misses encoded.

The cache is a Parquet table (content digest, tokenizer digest, n_tokens) that each run
appends to. A text is known by the SHA-256 of its normalised content, the count by that and
the digest of the tokenizer's version, so another version of either never meets old counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.llm import tokenizer as tok
from adstream.llm.common import prepare, saved, scratch, text_column

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The stored counts; none where the table does not exist yet."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    normalised: F.Column | None = None,
) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row of ``docs``.

    ``normalised`` is the content that is counted, by default the text with NULL as the
    empty text; it may be any expression over ``docs``. Texts are shuffled once, after equal
    ones have been merged in each task, so a text that a third of the rows hold crosses the
    network once a task. A NULL or repeated ``doc_id`` keeps its row; an empty table gives
    an empty result; other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    content = text_column() if normalised is None else normalised
    version = tok.version(tokenizer)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), content.alias("content_text")
    ).select(
        "doc_id",
        "content_text",
        F.unhex(F.sha2("content_text", 256)).alias("content"),
        F.octet_length("content_text").cast("long").alias("n_bytes"),
    )
    stored = (
        read_cache(spark, cache)
        .where(F.col("tokenizer") == version)
        .groupBy("content")
        .agg(F.min("n_tokens").alias("n_tokens"))
    )
    texts = rows.groupBy("content").agg(F.any_value("content_text").alias("content_text"))
    known = texts.join(stored, "content", "left")
    # A known text need not reach Python.
    asked = known.withColumn(
        "content_text", F.when(F.col("n_tokens").isNull(), F.col("content_text"))
    )
    counts = saved(
        asked.mapInArrow(_encoder(tokenizer, version), "content binary, n_tokens long, new boolean"),
        scratch(spark, "token-counts"),
    )
    (
        counts.where("new")
        .select("content", F.lit(version).alias("tokenizer"), "n_tokens")
        .write.mode("append")
        .parquet(cache)
    )
    return rows.select("doc_id", "content", "n_bytes").join(
        counts.select("content", "n_tokens"), "content"
    ).select("doc_id", "n_bytes", "n_tokens")


def _encoder(path: str, version: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tok.version(path) != version:
            raise ValueError(f"{path} is another version on this machine")
        tokenizer = tok.load(path)
        for batch in batches:
            new = [n is None for n in batch["n_tokens"].to_pylist()]
            counts = [
                len(tokenizer.ids(text)) // 4 if text is not None else known
                for text, known in zip(
                    batch["content_text"].to_pylist(), batch["n_tokens"].to_pylist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["content"], pa.array(counts, pa.int64()), pa.array(new, pa.bool_())],
                ["content", "n_tokens", "new"],
            )

    return encode


