"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of ``docs``, in their order. Rows of one doc_id are one document: they stay or go
together. Rows with a null doc_id stay unless their own text is rejected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regista.llm import decontamination, packing, simhash, substrings, toxicity
from regista.workspace import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` less the rows whose doc_id is in ``ids``."""
    gone = ids.select(F.col("doc_id").cast("bigint").alias("__gone")).where(F.col("__gone").isNotNull()).distinct()
    return docs.join(gone, F.col("doc_id").cast("bigint") == F.col("__gone"), "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the models learn from the labels of ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _without(docs, settle(toxicity.score(docs, labels).where("predicted = 1").select("doc_id")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest doc_id stays."""
    found = simhash.near_duplicates(docs)
    return _without(docs, found.where("doc_id <> component_id"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that an earlier document holds leave the text; all rows stay."""
    cut = substrings.without_repeats(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(kind))
    return cut.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, settle(decontamination.contaminated(docs, benchmark).select("doc_id")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents left as pieces of token sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: no SQL can express the language models and the tokenizer; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``; every stage reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
