"""Versions, years, pruning, plans that read once, and builds that go on where they stopped."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from budgetloom.plans import classify, contract_map, pipeline
from budgetloom.plans.budget_stage import budget_lines
from budgetloom.sources.control import Taken
from budgetloom.sources.warehouse import Warehouse, surrogate_key
from tests.helpers import table
from tests.test_budget_fact import RUN, facts, inputs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stage(spark, *texts):
    return table(spark, "budget_contract_map", *[{"contract_dsc": t} for t in texts])


def test_a_refresh_that_fails_leaves_the_old_rows(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert wh.read("budget_contract_map").count() == 0
    wh.refresh("budget_contract_map", stage(spark, "a"))
    old = wh.read("budget_contract_map")
    bad = stage(spark, "b", "c").withColumn("contract_dsc", F.when(F.col("contract_dsc") == "c", F.raise_error(F.lit("broken"))).otherwise(F.col("contract_dsc")))
    with pytest.raises(Exception, match="broken"):
        wh.refresh("budget_contract_map", bad)
    assert [r["contract_dsc"] for r in wh.read("budget_contract_map").collect()] == ["a"]
    wh.refresh("budget_contract_map", stage(spark, "b"))
    assert [r["contract_dsc"] for r in wh.read("budget_contract_map").collect()] == ["b"]
    assert [r["contract_dsc"] for r in old.collect()] == ["a"]  # a reader that has begun


def fact(spark, *rows):
    return table(spark, "budget_fact", *[{"revenue_year": y, "budget_fact_id": i, "contract_dim_id": c} for y, i, c in rows])


def told(wh):
    return sorted((r["revenue_year"], r["budget_fact_id"]) for r in wh.read("budget_fact").collect())


def test_years_are_switched_together_and_only_once_written(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.replace_years("budget_fact", fact(spark, (2024, 1, 5), (2025, 2, 5), (2026, 3, 5)), [2024, 2025, 2026])
    monkeypatch.setattr(Warehouse, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        wh.replace_years("budget_fact", fact(spark, (2024, 9, 5)), [2024, 2025])
    assert told(wh) == [(2024, 1), (2025, 2), (2026, 3)]
    monkeypatch.undo()
    assert wh.replace_years("budget_fact", fact(spark, (2024, 9, 5)), [2024, 2025]) == {2024: 1, 2025: 0}
    assert told(wh) == [(2024, 9), (2026, 3)]
    text = plan(wh.read("budget_fact").filter("revenue_year = 2026"))
    assert "PartitionFilters: [isnotnull(revenue_year" in text


def test_two_runs_on_other_years_both_count_and_on_one_year_the_second_fails(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.replace_years("budget_fact", fact(spark, (2024, 1, 5), (2025, 2, 5)), [2024, 2025])
    _, seen = wh.control.latest("budget_fact")
    wh.replace_years("budget_fact", fact(spark, (2025, 7, 5)), [2025])  # meanwhile
    wh._publish("budget_fact", seen, {2024: None})
    assert told(wh) == [(2025, 7)]
    with pytest.raises(Taken):
        wh._publish("budget_fact", seen, {2025: None})


def test_an_update_rewrites_only_the_years_it_touches(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.replace_years("budget_fact", fact(spark, (2024, 1, -1), (2024, 2, 5), (2025, 3, 5)).withColumn("business_classification_dim_id", F.when(F.col("contract_dim_id") == 5, 8)), [2024, 2025])
    before = {p.name for p in (tmp_path / "wh/budget_fact/revenue_year=2025").rglob("*.parquet")}
    assert pipeline.apply_class_defaults(wh) == [2024]
    assert {p.name for p in (tmp_path / "wh/budget_fact/revenue_year=2025").rglob("*.parquet")} == before
    rows = {r["budget_fact_id"]: r["business_classification_dim_id"] for r in wh.read("budget_fact").collect()}
    assert rows == {1: -1, 2: 8, 3: 8}
    assert pipeline.apply_class_defaults(wh) == []


def test_a_record_whose_writer_died_is_passed_over(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.control.claim("x", 1, {"a": 1})
    (tmp_path / "wh/_control/x/000000000002").write_text("")
    assert wh.control.latest("x", wait=0.1) == (2, {"a": 1})
    with pytest.raises(Taken):
        wh.control.claim("x", 2)
    assert wh.control.claim_next("x") == [3]


def test_keys_beyond_their_range_raise(spark, monkeypatch):
    monkeypatch.setattr("budgetloom.sources.warehouse.TASK_BITS", 1)
    assert [r[0] for r in spark.range(0, 2, 1, 1).select(surrogate_key(11)).collect()] == [11, 12]
    with pytest.raises(Exception, match="more rows than one key range holds"):
        spark.range(0, 3, 1, 1).select(surrogate_key(11)).collect()


def test_the_extract_is_pruned_by_its_year_tag(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    t = inputs(spark, {"jan_amt": Decimal(1)}, {"feb_amt": Decimal(2), "clvr_fiscal_year_mbr": "FY25"})
    stored = wh.store("clvr_level0_extract", t["clvr_level0_extract"])
    lines = budget_lines(stored, 2024)
    assert lines.count() == 1
    assert re.search(r"PartitionFilters: \[[^]]*clvr_fiscal_year_mbr", plan(lines))


def test_contracts_are_matched_with_one_scan_of_the_dimension(spark, tmp_path):
    t = inputs(spark, {"jan_amt": Decimal(1)})
    t["contract_dim"].write.parquet(str(tmp_path / "contract_dim"))
    t["contract_dim"] = spark.read.parquet(str(tmp_path / "contract_dim"))
    stage_2 = table(spark, "er_hyperion_stage_2", {"budget_year": 2024, "contract_dsc": "CO_1_2", "contract_decode": "1", "profit_center_dsc": "PC"})
    assert plan(contract_map.contract_map(stage_2, t)).count("FileScan") == 1
    used = spark.createDataFrame([(50,)], "contract_dim_id long")
    classes = classify.contract_class_keys(used, t)
    assert plan(classes).count("FileScan") == 1
    assert [r["k_contract"] for r in classes.collect()] == [50]  # no class is computed for a contract that is not used


def test_a_failed_build_goes_on_behind_its_last_stored_step(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    good = inputs(spark, {"jan_amt": Decimal(1)})
    with monkeypatch.context() as m:
        m.setattr(pipeline, "fact_rows", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            pipeline.build_budget_fact(wh, good, 2024, RUN, run_id="r1")
    assert pipeline.finished_steps(wh, "r1") == {"er_hyperion_stage_1", "er_hyperion_stage_2", "budget_contract_map"}
    pipeline.build_budget_fact(wh, inputs(spark, {"jan_amt": Decimal(7)}), 2024, RUN)  # another run in between
    for step in ("stage1", "stage2", "contract_rows"):
        monkeypatch.setattr(pipeline, step, lambda *a: pytest.fail("a stored step ran again"))
    assert pipeline.build_budget_fact(wh, good, 2024, RUN, run_id="r1") == "r1"
    assert facts(wh) == [(2024, 20240101, Decimal("1.00"))]
    log = {r["step"]: r["n_rows"] for r in wh.read(pipeline.STEPS).filter("run_id = 'r1'").collect()}
    assert log == {"er_hyperion_stage_1": 1, "er_hyperion_stage_2": 1, "budget_contract_map": 2, "budget_fact": 1}
