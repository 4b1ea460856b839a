import pytest
from pyspark.sql import functions as F

from budgetloom.operators.lookup import attach, lookup
from budgetloom.operators.xref import code_xref
from tests.helpers import table


def dim(spark):
    return spark.createDataFrame([("a", 1), ("b", None), ("c", 3), ("c", 4), (None, 9)], "code string, id long")


def found(spark, code, on_many="max"):
    left = spark.createDataFrame([(code,)], "k string")
    return lookup(left, dim(spark), {"code": F.col("k")}, {"found_id": F.col("id")}, -1, on_many).first()["found_id"]


@pytest.mark.parametrize("code, want", [("a", 1), ("b", None), ("x", -1), (None, -1), ("c", 4)])
def test_no_row_one_row_many_rows(spark, code, want):
    assert found(spark, code) == want


def test_many_rows_marked_or_raised(spark):
    assert found(spark, "c", "ambiguous") == -2
    assert found(spark, "a", "error") == 1
    with pytest.raises(Exception, match="more than one row"):
        found(spark, "c", "error")
    with pytest.raises(ValueError):
        found(spark, "a", "any")


def test_xref_pairs(spark):
    t = {
        "er_tbl_name": table(spark, "er_tbl_name", *[{"tbl_name_id": i, "tbl_name_physical": n} for i, n in ((1, "ER_GC_COVER_TYPE"), (2, "ER_REVENUE_DM_CONTRACT_SUBTYPE"), (3, "OTHER"))]),
        "er_gc_cover_type": table(spark, "er_gc_cover_type", {"tbl_code_id": 10, "short_code": "A"}, {"tbl_code_id": 11, "short_code": "B"}),
        "er_revenue_dm_contract_subtype": table(spark, "er_revenue_dm_contract_subtype", {"tbl_code_id": 20, "short_code": "X"}),
        "er_cross_reference": table(
            spark,
            "er_cross_reference",
            *[dict(zip(("fk_tbl_name_id_from", "fk_tbl_name_id_to", "fk_tbl_code_id_from", "fk_tbl_code_id_to"), v)) for v in ((1, 2, 10, 20), (1, 3, 11, 20), (1, 2, 12, 20))],
        ),
    }
    assert [tuple(r) for r in code_xref(t, "er_gc_cover_type", "er_revenue_dm_contract_subtype").collect()] == [("A", "X")]


def test_hot_key_is_split_and_results_stay_whole(spark):
    """A third of the rows share one key, broadcasting is off: the hot partition of the join must be split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 300_000
        key = F.when(F.col("id") % 3 == 0, F.lit(-2)).otherwise(F.col("id"))
        left = spark.range(0, n, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        partners = spark.range(0, n, 1, 4).select(F.col("id").alias("code"), (F.col("id") + 1).alias("v")).union(spark.createDataFrame([(-2, 7)], "code long, v long"))
        out = lookup(left, partners, {"code": F.col("k")}, {"hit": F.col("v")}, -1, "max")
        rows = out.select(F.count(F.lit(1)), F.sum("hit"), F.count_if(F.col("hit") == 7), F.sum(F.length("pad")))
        want = sum(i + 1 for i in range(n) if i % 3) + 7 * (n // 3)
        assert tuple(rows.collect()[0]) == (n, want, n // 3, 64 * n)
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_attach_keeps_only_its_own_columns(spark):
    left = spark.createDataFrame([("a", 1)], "k string, x int")
    assert attach(left, dim(spark), {"code": F.col("k")}).columns == ["k", "x", "id"]
    assert attach(left, dim(spark).select("code"), {"code": F.col("k")}, "left_anti").count() == 0


def test_rows_without_a_key_are_spread_over_tasks(spark):
    """They meet nothing, so that their hash need not bring them together."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(200).select("id", F.when(F.col("id") < 4, F.col("id")).alias("k"))
        known = spark.createDataFrame([(1, "a")], "code long, name string")
        out = attach(rows, known, {"code": F.col("k")}, spread=F.xxhash64("id"))
        assert [r["id"] for r in out.filter(F.col("name") == "a").collect()] == [1] and out.count() == 200
        assert out.filter(F.col("k").isNull()).select(F.spark_partition_id()).distinct().count() > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
