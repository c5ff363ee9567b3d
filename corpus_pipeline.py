"""The corpus pipeline: quality rules, near duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as
the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floorlens.llm import decontaminate, ngram_join, packing, pii, quality
from floorlens.llm.common import fresh, shared_folder, text_of

#: The stages run models and iterate; none of them is a SQL statement.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.quality(docs)
    return judged.where(F.col("quality.kept")).select(*[f"`{c}`" for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word of a benchmark window."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    name, node, hit = (fresh(docs, x) for x in ("_mark", "_node", "_hit"))
    # a document is known by its key and text: several may share a key, or have none
    marked = docs.withColumn(node, F.md5(text_of("text")))
    found = decontaminate.decontaminated(marked.withColumn(name, F.struct("doc_id", node)), benchmark, name).where("contaminated")
    found = found.select(F.col(f"{name}.doc_id").alias(hit), F.col(f"{name}.{node}").alias(name)).distinct()
    return marked.join(found, F.col("doc_id").eqNullSafe(F.col(hit)) & (F.col(node) == F.col(name)), "left_anti").drop(node)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; n_chars follows the text."""
    return pii.sanitised(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences."""
    return packing.packing_digest(packing.packed(docs))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
