"""The operators' queries: each applies one, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import (
    centroids,
    exact,
    infill,
    mixing,
    near,
    packing,
    phrases,
    quality,
    records,
    sharding,
    suffix,
    toxicity,
    trusted,
)
from kerbside.session import Workspace

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts, _, _ = exact.exact_groups(documents(spark, sf_dir), Workspace(spark, "exact"))
    return verdicts.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.removed_spans(documents(spark, sf_dir), Workspace(spark, "suffix"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span[1] - span[0])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = quality.ordered_rules(docs)
    cut, parts, _ = quality.with_parts(docs)
    judged = cut.select(
        "doc_id", *[metric.alias(name) for name, metric in quality.base_metrics(parts).items()],
        quality.first_rejection(parts, [r for r in rules if r.name not in ("short", "repeats")]).alias("rejected_by"),
    )
    failed = quality.base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return judged.withColumns({"base_failed": failed, "kept": ~failed & F.col("rejected_by").isNull()}).drop("rejected_by")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(documents(spark, sf_dir), TOKENIZER, keep_ids=False, literal=False).drop("ids")
    packed = packing.pack(pieces, Workspace(spark, "packing"))
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.planned_mix(documents(spark, sf_dir), Workspace(spark, "mixing"))
    return planned.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "records")
    path = work.path("files")
    records.write_records(documents(spark, sf_dir), path, TOKENIZER, literal=False)
    index = records.with_starts(records.build_index(spark, path, work))
    return index.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes, _, _ = near.near_classes(documents(spark, sf_dir), Workspace(spark, "near"))
    return classes.select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")


def op8_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.kept_words(documents(spark, sf_dir), Workspace(spark, "phrases"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span[1] - span[0])
    return found.select(F.col("id").alias("doc_id"), "n_words", removed.alias("n_removed"), "kept_sha256")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")

    def held_out(doc_id: str) -> Column:
        return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4 == 2

    work = Workspace(spark, "toxicity")
    model = toxicity.fit(toxicity.labelled_rows(docs, labels, held_out("id")), work)
    return toxicity.scored(docs, model).select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(documents(spark, sf_dir), Workspace(spark, "sharding"))
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = centroids.integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    found = centroids.cluster_vectors(vectors, Workspace(spark, "centroids"))
    return centroids.with_cluster_facts(found).withColumnRenamed("id", "vec_id")


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    def held_out(doc_id: str) -> Column:
        return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4 == 2

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores, _ = trusted.quality_scores(documents(spark, sf_dir), labels, held_out("id"), Workspace(spark, "quality"))
    return scores.select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= trusted.THRESHOLD).cast("int").alias("predicted"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = infill.with_restored(infill.rearranged(documents(spark, sf_dir)))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(F.col("restored"), 256).alias("restored_sha256"),
    )


QUERIES = {
    fn.__name__: fn
    for fn in (
        op1_exact_dedup,
        op2_suffix_dedup,
        op3_quality_rules,
        op4_best_fit_packing,
        op5_source_mixing,
        op6_token_records,
        op7_order_minhash,
        op8_phrase_dedup,
        op9_toxicity,
        op10_sharding,
        op11_centroid_clustering,
        op12_quality_classifier,
        op13_fill_in_middle,
    )
}
