"""Corpus pipeline over `documents`: quality rules, exact dedup, near-duplicate join, personal data, packing.

`STAGES` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of `documents`; the
last returns the packed pieces. `run` writes every stage to the shared folder
and reads it back as the next one's input, so that a stage never repeats its
predecessors and a lost executor costs one stage at most.

Defined results: a null, empty or blank text fails the quality rules and goes;
of equal texts the row with the smallest identifier stays (all rows of that
identifier, should it be repeated); of linked documents the one with the
smallest identifier stays, and rows without an identifier stay always; a text
without personal data stays as it is; `n_chars` is counted anew after redaction
where there is such a column; further columns pass through all stages but the
last, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.llm import exact_dedup, jaccard_join, packing, pii, quality_rules
from veleta.llm.shared import forget, keep


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule passes."""
    return quality_rules.filter_documents(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest identifier."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest identifier."""
    groups = jaccard_join.link_components(spark, docs)
    gone = keep(spark, groups.filter("doc_id <> component_id").select("doc_id").distinct(), "gone")
    few = gone.count() <= jaccard_join.BROADCAST_IDS  # then whole documents are not shuffled
    return docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind in brackets."""
    redacted = pii.redact(docs, weights=pii.fit(docs))
    return redacted.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else redacted


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.pack(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", filter_quality),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL has no tokenizer and no random field; a test compares every piece with a plain-Python chain of the five stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = keep(spark, stage(spark, docs, sf_dir), name)
        if before is not None:
            forget(spark, before)
        before = docs
    return docs
