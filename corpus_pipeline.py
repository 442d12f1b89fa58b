"""From documents to token ids: quality rules, line, near-duplicate, mixing and encoding stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import bpe, line_dedup, mixing, quality, simhash
from marketlake.session import scratch_path, staged_tables


def _own(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are more likely bad than good go."""
    return quality.filter_quality(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; documents stay, ``n_chars`` follows the text. Copies of a page count once."""
    out = line_dedup.drop_boilerplate(docs, copies=False)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*_own(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates stays (five-word shingles, similarity 0.8)."""
    return simhash.drop_similar(docs, width=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled to the flattened weights of source, language and topic."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids instead of text: doc_id, lang, source, n_tokens, ids (little-endian unsigned 32-bit)."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    out = bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN).drop("text")
    return out.select("doc_id", "lang", "source", bpe.n_tokens().alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Fingerprints and merges have no SQL twin; the pipeline is tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written as Parquet and read again. What a stage staged goes then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with staged_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
