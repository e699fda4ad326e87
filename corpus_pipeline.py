"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and returns what it keeps; ``run`` writes
each result as Parquet in the shared folder and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.llm import decontaminate, langid, packing, pii, simhash
from adstream.llm.common import saved, scratch, table, with_plain_names
from adstream.llm.queries import TOKENIZER, language_model


# A text of which the model knows a smaller share of the words is in none of its languages.
LEAST_KNOWN = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no text, no letter in it, or hardly a word known in any."""
    plain = with_plain_names(docs, "text")
    found = langid.identify(plain, language_model(docs), "lang", "score", "known")
    kept = found.where((F.col("lang") != langid.UNKNOWN) & (F.col("known") >= LEAST_KNOWN))
    return kept.select(*plain.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints of 3-word shingles lie within 2 bits, in chains, one stays."""
    return simhash.deduplicate(docs, simhash.SHINGLE, simhash.RADIUS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays."""
    cleaned = pii.redact(docs, pii.detect(docs)[1])
    return cleaned.withColumn("n_chars", F.length("text").cast("long"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document is cut and packed: a row for each piece."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", best_fit_packing),
]

# Hash functions, the tokenizer and fitted models are beyond SQL; the pipeline is tested
# against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), scratch(spark, f"pipeline-{name}"))
    return docs
