"""How many files the pipeline's stages store where there are many more shuffle partitions than texts to fill them."""

from pathlib import Path

import pytest

import corpus_pipeline
from budgetloom.llm import common

PLAIN = "a long line of plain words that says {} and then goes on for {} more of them"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", ["line_dedup", "ngram_jaccard"])
def test_small_tables_have_few_files(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(common, "work_dir", lambda _, table: f"{tmp_path}/{table}-{len(list(tmp_path.iterdir()))}")
    rows = [(i, "\n".join(PLAIN.format(f"word{i % 40}x{j}", j) for j in range(i % 5 + 1))) for i in range(80)]
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(24)
        kept = STAGES[name](spark, docs, "")
        assert kept.count() > 0
        kept.write.parquet(f"{tmp_path}/result")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {p.name: len(list(Path(p).glob("part-*"))) for p in tmp_path.iterdir()}
    assert len(files) > 5 and max(files.values()) <= spark.sparkContext.defaultParallelism, files


def test_tasks_grow_with_the_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "x" * 1000) for i in range(100)] + [(None, None)], "doc_id long, text string")
    cores = spark.sparkContext.defaultParallelism
    assert common.tasks_for(docs, "text") == cores == common.tasks_for(docs.where("text is null"), "text")
    monkeypatch.setattr(common, "TASK_BYTES", 999)
    assert common.tasks_for(docs, "text") == 101
