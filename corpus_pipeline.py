"""The corpus pipeline: what remains of ``documents`` for training, in shards.

Each stage takes all that the one before it kept, as read again from where that was written, and returns the columns of
``documents``; the last adds ``shard`` and ``slot``.  The mix may repeat a document, so its rows may too.

Defined cases: a null or empty text, or one without a letter, goes in the first stage (no language can be told).  A null id,
source or language stays; rows without an id that have words count as documents of their own.  Of repeated rows, the second
stage keeps one.  Texts of any length pass whole.  Other columns pass through all stages; one that is called shard or slot is
replaced in the last.  An empty table gives empty shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import common, decontaminate, language_id, mix, near_dedup, shard


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that language identification rejects."""
    return language_id.accepted(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is alike in five-word shingles, at similarity 0.8 or more."""
    return near_dedup.one_of_each(docs)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that passages of benchmark items make up a twentieth of."""
    return decontaminate.remove_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix.mixed_rows(docs)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their shard and their place in it."""
    return shard.shard_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", remove_near_duplicates),
    ("decontaminate", remove_benchmarks),
    ("mix", mix_sources),
    ("shard", shard_documents),
]

#: SQL can't express the stages that learn a model, sketch sets or draw by hash; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written to the shared folder and read again."""
    docs, to = common.table(spark, sf_dir, "documents"), common.scratch(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{to}/{name}")
        docs = spark.read.parquet(f"{to}/{name}")
    return docs
