"""The registered queries: each operator over its whole table."""

from __future__ import annotations

import os
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import (
    centroids,
    decontaminate,
    hard_negatives,
    language_id,
    lm_scoring,
    near_dedup,
    ngrams,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    token_counts,
    url_filters,
)
from strandline.llm.keep import keep
from strandline.llm.oracle import SQL

# The rules of the url query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


# Of the C library's allocator and Arrow's pool, in Python workers.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": "4194304",
    "MALLOC_TRIM_THRESHOLD_": "16777216",
}

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Python workers find this package where the driver found it; on
    a cluster without that folder, ship it with ``--py-files``. They get texts in small
    batches, which bounds what either side holds, and give freed memory back at once
    instead of keeping it from stage to stage."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    env.update(WORKER_MEMORY)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove(table(spark, sf_dir, "documents"), length=100)
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = ngrams.fold("doc_id", 3) == 1
    model = language_id.fit(docs.filter(~held_out))
    return language_id.predict(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = ngrams.fold("doc_id", 4) == 2
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return quality_classifier.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), max_edit_share=0.1
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(table(spark, sf_dir, "documents"), percent=75, words=5)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pieces(table(spark, sf_dir, "documents"), tokenizer, capacity=4096, end_id=1)
    # Placing needs no ids, so only their digest travels on.
    rows = rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    placed = packing.pack(rows, capacity=4096, with_bound=True)
    return placed.select(
        *("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"),
        *("n_sequences", "least_sequences"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    proposed = keep(pii.proposals(table(spark, sf_dir, "documents")), "proposals")
    found = pii.detect(proposed, pii.fit(proposed))
    counts = [pii.count("base", kind).alias(f"n_{kind}") for kind in pii.BASE]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Literals need no Python worker.
    listed = F.array(*[F.struct(*map(F.lit, rule)) for rule in URL_RULES])
    kind = "array<struct<host:string,path:string,action:string>>"
    rules = spark.range(1, numPartitions=1).select(F.inline(listed.cast(kind)))
    return url_filters.judge(table(spark, sf_dir, "pages"), rules)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = ngrams.fold("doc_id", 7) == 2
    model = lm_scoring.fit(docs.filter(~held_out))
    return lm_scoring.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        *("n_tokens", "n_known", "train_tokens", "base_score", "score"),
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count(table(spark, sf_dir, "documents"), tokenizer, limit=2048)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", relabelled.otherwise(F.col("label"))
    )
    return hard_negatives.mine(rows, "vec_id % 100 = 0")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2)
    return centroids.with_inertia(found).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


ALL = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_quality_rules,
        op3_language_id,
        op4_decontamination,
        op5_near_dedup,
        op6_best_fit_packing,
        op7_pii,
        op8_url_filters,
        op9_quality_classifier,
        op10_lm_scoring,
        op11_token_counts,
        op12_hard_negatives,
        op13_centroid_clustering,
    )
}


