"""Registered queries of the text operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from floorlens.llm import (
    chat_repair,
    decontaminate,
    html_text,
    ngram_join,
    packing,
    paragraph_dedup,
    pii,
    pitman_yor,
    quality,
    sharding,
    spelling,
    structure_repair,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(_table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.rendered(chat_repair.repaired(_table(spark, sf_dir, "conversations")))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(sharding.shuffled_shards(_table(spark, sf_dir, "documents")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(packing.packed(_table(spark, sf_dir, "documents")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.decontamination_digest(found)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.found_spans(_table(spark, sf_dir, "documents")))


def op7_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeats_digest(paragraph_dedup.repeated(_table(spark, sf_dir, "documents"), least_words=51))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(quality.quality(_table(spark, sf_dir, "documents")))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_digest(pitman_yor.scored(_table(spark, sf_dir, "documents")))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(_table(spark, sf_dir, "documents")))


def op12_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return structure_repair.structure_digest(turns, structure_repair.faulted(structure_repair.damaged(turns), "conv"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return toxicity.scored(documents, toxicity.fit(documents, _table(spark, sf_dir, "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {}
