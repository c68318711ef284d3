"""A training corpus from raw documents: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import exact, mixing, near, packing, quality
from kerbside.llm.queries import TOKENIZER, documents
from kerbside.session import Workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact.drop_copies(docs, Workspace(spark, "pipeline-exact"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near.drop_near_copies(docs, Workspace(spark, "pipeline-near"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs, Workspace(spark, "pipeline-mixing"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and the sequence that holds each."""
    pieces = packing.token_pieces(docs, TOKENIZER, keep_ids=False, literal=False).drop("ids")
    packed = packing.pack(pieces, Workspace(spark, "pipeline-packing"))
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

# Packing and near-duplicate search are not expressible in SQL; tests compare the run with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the last stage's rows."""
    docs = documents(spark, sf_dir)
    work = Workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = work.store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
