"""A corpus pipeline: documents in, token files out.

``STAGES`` lists its stages in order. Each takes (spark, docs, sf_dir), gives the
session the library's settings and returns a table; ``run`` writes each result as
Parquet in the shared folder and reads it again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm.common import free_name, fresh_path, table, written
from lakeshore.llm.decontamination import with_leaks
from lakeshore.llm.mixing import repeat_documents
from lakeshore.llm.near_dedup import drop_near_duplicates
from lakeshore.llm.quality import THRESHOLD, fit, score, statistics
from lakeshore.llm.token_files import read_token_files, write_token_files
from lakeshore.session import apply_settings

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(fn: Stage) -> Stage:
    """``fn`` under the library's settings: without them a Python worker gets ten times the texts at once."""

    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_settings(spark)
        return fn(spark, docs, sf_dir)

    return run


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    stats, scored = free_name(docs, "stats"), free_name(docs, "score")
    rows = docs.withColumn(stats, statistics(F.col("text")))
    model = fit(rows.select("doc_id", F.col(stats).alias("stats")), table(spark, sf_dir, "labels"))
    return score(rows, model, stats, scored).where(F.col(scored) >= THRESHOLD).select(*docs.columns)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy or paraphrase of a benchmark item."""
    leaks = free_name(docs, "leaks")
    found = with_leaks(docs, table(spark, sf_dir, "benchmark"), leaks)
    return found.where(F.size(leaks) == 0).select(*docs.columns)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return repeat_documents(docs)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and each document's place in them."""
    files = write_token_files(docs, fresh_path(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(written(files, "token-files-placed"))


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix),
    ("token files", tokens),
]

ORACLE_SQL = None  # scores, retrieval and tokens are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
