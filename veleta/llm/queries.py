"""The thin queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.llm import (
    bpe, conversations, exact_dedup, jaccard_join, packing, periodic_runs, pii, quality_classifier, quality_rules, recurrent_lm, sentencepieces,
    url_filters, warc,
)
from veleta.llm.text import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(table(spark, sf_dir, "documents"))


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score(spark, table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.judge(url_filters.dated_captures(pages), url_filters.derived_list(pages))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.report(pii.detect(docs, weights=pii.fit(docs)))


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))
    return done.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(spark, table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(spark, table(spark, sf_dir, "conversations"))


def op12_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = sentencepieces.round_trip(table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"))
    return done.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detect(table(spark, sf_dir, "documents"), change=periodic_runs.make_periodic)
    return periodic_runs.digest(found)


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_url_filters": op3_url_filters,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_pii": op6_pii,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_warc": op8_warc,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_sentencepiece_round_trip": op12_sentencepiece_round_trip,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES = {
    "op1_quality_rules": quality_rules.ORACLE_SQL,
    "op3_url_filters": url_filters.ORACLE_SQL,
    "op4_quality_classifier": quality_classifier.ORACLE_SQL,
    "op8_warc": warc.ORACLE_SQL,
    "op10_exact_dedup": exact_dedup.ORACLE_SQL,
}
