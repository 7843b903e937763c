"""A corpus from raw documents to token files, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farebox.llm import decontaminate, mixing, quality, simhash, tokens
from farebox.llm.common import new_folder, ship, stored
from farebox.llm.queries import token_digests, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counts and compression bands keep."""
    ship(spark)
    return quality.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return simhash.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ship(spark)
    return mixing.mixture(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place, number and checksum of each document's ids, read from the token files."""
    ship(spark)
    manifest = tokens.write_tokens(docs, new_folder(spark, "tokens"), vocabulary())
    return token_digests(spark, manifest)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", source_mix),
    ("token output", token_files),
]

# Fingerprints, templates, rounding and tokens have no SQL form; the stages are tested
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, f"stage-{place}")
    return docs
