"""Corpus pipeline: quality, near copies, repeated passages, benchmark leaks, then the mix of sources.

Each stage takes the documents that the one before it kept, in the columns of the documents table; ``run`` writes what a
stage returns to the shared folder and reads it again for the next. The last stage adds what the mix takes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.llm.decontaminate import drop_leaking
from clearbook.llm.mixing import mix
from clearbook.llm.passages import drop_repeated
from clearbook.llm.quality import fit, quality_scores, score_quality
from clearbook.llm.shared import columns_of, keep, read_table
from clearbook.llm.simhash_dedup import drop_near_copies
from clearbook.session import apply_settings

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: A document of a lower score is rejected.
LEAST_QUALITY = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose quality score is at least ``LEAST_QUALITY``; the model learns from all labels."""
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model)
    return scored.where(F.col("quality_score") >= LEAST_QUALITY).select(columns_of(docs))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return drop_near_copies(docs)


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out of all documents but the first."""
    return drop_repeated(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item."""
    return drop_leaking(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words of, with their source's target and the words taken, repeats counted.

    The weight of a document is its score, as it arrives here, by the model of the quality stage.
    """
    model = fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    weights = quality_scores(docs, model).select("doc_id", F.col("quality_score").alias("weight"))
    return mix(docs, weights).where("taken > 0")


def _with_settings(stage: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(apply_settings(spark), docs, sf_dir)

    return run_stage


STAGES = [
    ("quality", _with_settings(quality_stage)),
    ("near_copies", _with_settings(near_copies_stage)),
    ("passages", _with_settings(passages_stage)),
    ("benchmark", _with_settings(benchmark_stage)),
    ("mixing", _with_settings(mixing_stage)),
]

#: Compression, fingerprints and MinHash are not expressible in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
