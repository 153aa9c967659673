"""The corpus pipeline: stages over `documents`, each written as Parquet and read again by the next."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from merchlens.llm import decontaminate, language, mixing, quality, simhash  # noqa: E402
from merchlens.llm.shared import read_table, written  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones, accepts."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"), learn=quality.training_rows())
    return quality.keep_good(docs, model)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled ones."""
    model = language.fit(docs, learn=language.training_rows())
    return language.keep_known(docs, model, limits=language.limits(docs, model, ~language.training_rows()))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: fingerprints of four-word shingles at most four bits apart."""
    return simhash.keep_one(docs, simhash.SimHash(words=4, distance=4))


def remove_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a test item."""
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The readings of the remaining documents in the target mix."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", remove_test_items),
    ("mixing", mix_sources),
]

# Trained models and fingerprint links have no SQL form; tests compare the stages with brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each handing over through a table in the shared folder.

    NULL and empty texts, repeated rows and other columns are treated as each stage's operator states: texts without a
    letter go at the language stage, of repeated rows one stays. Without documents there are no rows.
    """
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
