"""The registered queries of the operators, each over the whole of its table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from budgetloom.llm import chat_format, conversation_repair, decontamination, language_id, line_dedup, lm_scoring, ngram_join, quality, secret_scan, sequence_packing, spelling, suffix_dedup, vector_search
from budgetloom.llm.common import documents, share, work_dir

WORD_BPE, END_ID = "word_bpe_49k.json", 2
BYTE_BPE = "byte_bpe_50k.tiktoken"
#: Fixed value: what both turns of conversation -1 say.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_counts(documents(spark, sf_dir))
    told = F.transform("dropped", lambda d: F.concat_ws(":", *[d[c].cast("string") for c in ("line", "kept_doc", "kept_line")]))
    return found.withColumn("dropped", F.array_join(told, ","))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secret_scan.scan(docs, work_dir(spark, "blob-ledger"))
    base = [r.name for r in secret_scan.BASE_RULES]
    told = secret_scan.with_findings(docs.select("doc_id", "text"), found)
    joined = lambda f: F.array_join(F.transform(f, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda k: F.filter("findings", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in base]
    return told.select("doc_id", *counts, F.sha2(joined(F.filter("findings", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = share("doc_id", 4) == 2
    model = language_id.train(docs.where(~held_out))
    return language_id.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    tokenizer, pattern = public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN
    nodes, ends = chat_format.format_chats(rows.unionByName(extra), tokenizer, pattern)
    return chat_format.read_back(nodes, ends, tokenizer, pattern).withColumnRenamed("conv", "conv_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sequence_packing.pack(documents(spark, sf_dir), "doc_id", "text", public_tokenizers.path(WORD_BPE), END_ID)
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(vector_search.usable(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 64))
    found = vector_search.top_k(vectors.select("vec_id", whole.alias("v")), F.col("vec_id") % 20 == 0, "vec_id", "v")
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), good)
    return quality.score(docs, model).select("doc_id", "score", "p_text", "p_metadata", "keep")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = share("doc_id", 5) == 1
    scored = lm_scoring.score(docs.select("doc_id", "text"), docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.removed_spans(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(documents(spark, sf_dir), damage=31)
    return spelling.variant_forms(words)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_repair.repair(conversation_repair.damaged(rows), rows)


def with_package(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, run so that Python workers find this package where the driver has it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = str(Path(__file__).resolve().parents[2])
        paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
        spark.sparkContext.environment["PYTHONPATH"] = ":".join(dict.fromkeys([*filter(None, paths), root]))
        return query(spark, sf_dir)

    return run


OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: with_package(f) for f in (op1_line_dedup, op2_secret_scan, op3_language_id, op4_decontamination, op5_chat_format, op6_packing, op7_exact_top_k, op8_ngram_jaccard, op9_quality, op10_lm_scoring, op11_suffix_dedup, op12_spelling_variants, op13_conversation_repair)
}
