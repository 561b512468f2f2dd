"""From raw documents to token files: five stages, each one's rows written and read again for the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import decontamination, fertility, forest, replication, token_files
from tidemart.session import materialize, new_shared_path

MIX_SEED, MIX_TEMPERATURE = 17, 2.0

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the band of their language or script."""
    return fertility.keep_fitting(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return forest.one_of_each_class(docs)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate has it, shuffled over all sources."""
    return replication.mix(docs, seed=MIX_SEED, temperature=MIX_TEMPERATURE).drop("copy")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all that is left; the rows are read back from them."""
    manifest = token_files.write_token_files(docs, new_shared_path(spark, "tokens"))
    return token_files.read_token_files(spark, manifest, ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("benchmark_items", benchmark_items),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: Tokenisers, tries and searches cannot be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *earlier, last = STAGES
    for name, stage in earlier:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return last[1](spark, docs, sf_dir)
