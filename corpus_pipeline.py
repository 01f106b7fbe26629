"""From raw documents to packed training sequences, in five stages.

A stage is a function of (spark, docs, sf_dir) and returns what it keeps; between
stages the rows are written to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import decontaminate, near_dedup, packing, pii, quality_classifier
from strandline.llm.keep import fresh, keep, numbered, without
from strandline.llm.queries import WORKER_MEMORY, table

# Stages run in the same processes, one after another: what one of them holds or leaves
# behind, in a Python worker or as Arrow buffers beside the heap, counts for all.
BATCH = "2m"
STAGE_MEMORY = WORKER_MEMORY | {
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": "1048576",
    "MALLOC_TRIM_THRESHOLD_": "1048576",
}


def lean(spark: SparkSession) -> SparkSession:
    """The session, with smaller batches between Spark and Python workers than the single
    queries have, and workers that give back arrays of a megabyte."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    spark.sparkContext.environment.update(STAGE_MEMORY)
    return spark


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; it is read with the settings of the single queries."""
    found = table(spark, sf_dir, name)
    lean(spark)
    return found


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Null and empty texts have no terms: they get the labels' mean, and go or stay all
    alike. Repeated rows and null ids are judged by their texts. Without labels all stay.
    """
    model = quality_classifier.fit(docs, given(spark, sf_dir, "labels"))
    return quality_classifier.accept(docs, model, threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group of near-duplicates.

    Rows without an id, and rows that share one, are documents of their own and come
    after all others: of copies among them one stays too. Texts without a word, null
    ones included, are linked with nothing and stay.
    """
    (row,) = fresh(docs, "_row")
    lean(spark)
    rows = numbered(docs, "doc_id", row)
    linked = near_dedup.link(rows, percent=75, words=5, id_col=row)
    return without(rows, linked.filter("NOT kept").select(row).distinct(), row).drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.

    Null and empty texts hold none. Rows that share an id, or have none, are judged each
    for itself.
    """
    (row,) = fresh(docs, "_row")
    rows = numbered(docs, "doc_id", row)
    found = decontaminate.matches(
        rows, given(spark, sf_dir, "benchmark"), max_edit_share=0.1, id_col=row
    )
    return without(rows, keep(found, "matches").select(row).distinct(), row).drop(row)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text.

    Null texts stay null. Rows are told apart by id and text, so repeated rows and null
    ids are all redacted.
    """
    proposed = keep(pii.proposals(docs), "proposals")
    found = pii.detect(proposed, pii.fit(proposed))
    clean = pii.redact(docs, found, "doc_id", "text")
    if "n_chars" in clean.columns:
        kind = clean.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of at most 4096 tokens: its document, token ids, sequence, place.

    Each row is packed, repeated ones and those without an id too; a null or empty text is
    one end token.
    """
    lean(spark)
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pieces(docs, tokenizer, capacity=4096, end_id=1)
    return packing.pack(rows, capacity=4096)


STAGES = [
    ("quality_classifier", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

# Models and tokenizers have no SQL; tests hold each stage against its operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = given(spark, sf_dir, "documents")
    *inner, (_, last) = STAGES
    for name, stage in inner:
        docs = keep(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
