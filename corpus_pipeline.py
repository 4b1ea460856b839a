"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from budgetloom.llm import decontamination, language_id, line_dedup, ngram_join, sequence_packing
from budgetloom.llm.common import documents, stored, tasks_for, work_dir
from budgetloom.llm.queries import END_ID, WORD_BPE, with_package
from budgetloom.operators.lookup import attach

MIN_LANGUAGE_SCORE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of the labelled ones with a calibrated probability of at least one half."""
    predicted = language_id.predict(docs.select("*", F.struct(*docs.columns).alias("_kept")), language_id.train(docs))
    known = predicted.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return known.select("_kept.*").coalesce(tasks_for(docs, "text"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that came earlier; documents with nothing else go."""
    return line_dedup.dedup_lines(docs, drop_empty=True).coalesce(tasks_for(docs, "text"))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of similar documents, null before all others.

    Documents are told apart by a hash of id and text, so those without an id or with a repeated one are compared too;
    rows with equal id and text stay or go together.
    """
    tasks = tasks_for(docs, "text")
    rows = docs.withColumn("_key", F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.coalesce("text", F.lit(""))))
    found = stored(ngram_join.similar_components(rows, "_key"), "components", tasks)
    several = found.where("id != component_id").select(F.col("component_id").alias("c")).distinct()
    members = stored(attach(found, several, {"c": F.col("component_id")}, how="left_semi").select("id", "component_id"), "members", tasks)
    named = rows.select("_key", "doc_id").join(members, F.col("_key") == F.col("id"))
    kept = named.groupBy(F.col("component_id").alias("c")).agg(F.min(F.struct("doc_id", "_key")).alias("kept"))
    copies = attach(members, kept, {"c": F.col("component_id")}, how="inner").where("id != kept._key").select(F.col("id").alias("_copy"))
    return rows.join(copies, F.col("_key") == F.col("_copy"), "left_anti").select(*docs.columns).coalesce(tasks)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tasks = tasks_for(docs, "text")
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), tasks=tasks).coalesce(tasks)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences: doc_id, start, length, ids, doc_tokens, sequence_id, offset, padded."""
    tasks = tasks_for(docs, "text")
    return sequence_packing.pack(docs, "doc_id", "text", public_tokenizers.path(WORD_BPE), END_ID, tasks=tasks).withColumnRenamed("id", "doc_id").coalesce(tasks)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", keep_one_of_similar),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: Stages with trained models or tokenizers are outside SQL; tests hold the stages against brute force.
ORACLE_SQL = None


@with_package
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = work_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
