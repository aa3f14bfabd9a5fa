"""From raw documents to token files, in five stages.

Every stage takes the documents that the one before it kept; all but the last give back documents with
their columns unchanged. Stages are written to the shared folder and read again, so a stage first deletes
the intermediate tables of those before it, unless its documents are read from them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import decontamination, mixing, neardup, quality, tokenfiles
from orderflow.llm.common import recorded, release, stored, table
from orderflow.llm.queries import tokenizer_path


def staged(work: Callable) -> Callable:
    """A stage that deletes the intermediate tables of earlier stages and whose own may be deleted by later ones."""

    @functools.wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(docs)
        with recorded():
            return work(spark, docs, sf_dir)

    return stage


@staged
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules hold for good."""
    return quality.keep_good(docs)


@staged
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate component, on runs of five words."""
    return neardup.keep_first(docs, join=neardup.Join(shingle=5))


@staged
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


@staged
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.emit(mixing.mix(docs))


@staged
def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens stand in the files."""
    return tokenfiles.round_trip(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources", mix_sources),
    ("token files", token_files),
]

#: Expectation-maximisation, random trees and token files are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
