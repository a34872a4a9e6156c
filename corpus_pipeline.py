"""Corpus pipeline: each stage is one operator and works on what the stage before it kept."""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm.common import Steps, documents, staged
from ledgerspark.llm.labels import labelled
from ledgerspark.llm.packing import WORD_BPE, pack
from ledgerspark.llm.quality_model import kept_by_model
from ledgerspark.llm.quality_rules import kept_by_rules
from ledgerspark.llm.secrets import redacted
from ledgerspark.llm.shingles import without_near_copies


#: Runs that call the stages one by one, by thread and folder of the tables.
RUNS: dict[tuple[int, str], Steps] = {}


def stage(number: int) -> Callable:
    """Marks a stage: when it starts, what earlier stages of its run had to write is removed, unless ``docs`` still reads
    it. A run is ``steps``; without it, stages that one thread calls for one ``sf_dir`` from the first on are a run."""

    def mark(function: Callable) -> Callable:
        @wraps(function)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, steps: Steps | None = None) -> DataFrame:
            if steps is None:
                key = threading.get_ident(), sf_dir
                steps = RUNS[key] = RUNS.get(key, Steps()) if number else Steps()
            with steps.step(number, docs):
                return function(spark, docs, sf_dir)

        return run_stage

    return mark


@stage(0)
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model predicts as good."""
    return kept_by_model(docs, labelled(spark, sf_dir, "quality"))


@stage(1)
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned rules keep. Learned from all labelled documents, as the stage before leaves few bad ones.
    The base of the query's contract isn't applied: it fails every text of fewer than 50 words, good ones too."""
    return kept_by_rules(docs, labelled(spark, sf_dir, "quality"), documents(spark, sf_dir), base=False)


@stage(2)
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    return without_near_copies(docs)


@stage(3)
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return redacted(docs)


@stage(4)
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids, one row per piece."""
    return pack(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("secrets", secret_scan),
    ("packing", packing),
]

#: The classifier, the tokenizer and 64-bit fingerprints have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over ``documents``; what a stage returns is written and read again. What a stage
    had to write goes when a later one starts that doesn't read it."""
    docs, steps = documents(spark, sf_dir), Steps()
    for number, (name, function) in enumerate(STAGES[:-1]):
        rows = function(spark, docs, sf_dir, steps)
        with steps.step(number, docs):
            docs = staged(rows, name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir, steps)
