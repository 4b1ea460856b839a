"""What stored tables leave on the disk."""

import time
from pathlib import Path

from budgetloom.llm import common

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[Path]:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {p for d in manager.localDirs() for p in Path(d.getPath()).glob("*/shuffle_*")}


def test_a_stored_table_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "work_dir", lambda _, name: f"{tmp_path}/{name}")
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    for tasks in (None, 2):
        sums = spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()
        kept = common.stored(sums, f"sums-{tasks}", tasks)
        assert sorted(r["count"] for r in kept.collect()) == [142] + [143] * 6
    for _ in range(100):  # files go by a message to the executors
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(CLEANUP) == setting
