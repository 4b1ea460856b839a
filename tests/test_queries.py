"""Every registered query against its DuckDB counterpart, and the driver's entry points."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import duck_rows, rows_of
from checks.fixtures import CODE_LISTS, derive
from checks.spark_queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_a_counterpart():
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_duckdb(spark, name):
    df = entry_points.queries()[name](spark, SF)
    names, want = duck_rows(SF, entry_points.oracle_sql()[name])
    assert names == sorted(df.columns)
    assert rows_of(df) == want


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["budget_fact", "accrual_errors"])
def test_results_do_not_depend_on_broadcasting(spark, name):
    """As with dimensions too large to broadcast: every join shuffles, none is a nested loop."""
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = spark.conf.get(settings[0])
    try:
        for s in settings:
            spark.conf.set(s, "-1")
        df = entry_points.queries()[name](spark, SF)
        assert rows_of(df) == duck_rows(SF, entry_points.oracle_sql()[name])[1]
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set(settings[0], before)
        spark.conf.unset(settings[1])


def test_code_lists_are_known_to_be_small(spark):
    """A sum over a large table counts as large until it is stored; then looking it up shuffles no wide row."""
    for name, df in derive(spark, SF, *CODE_LISTS).items():
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        assert size < 10_000 and "Scan parquet" in df._jdf.queryExecution().executedPlan().toString() and "Aggregate" not in df._jdf.queryExecution().optimizedPlan().toString(), name


def test_the_fact_reads_its_lines_once(spark):
    """Stage 2 and the contracts, which are needed more than once, are stored."""
    plan = entry_points.queries()["budget_fact"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "er_tbl_name" not in plan
