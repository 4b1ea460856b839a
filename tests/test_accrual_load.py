from datetime import datetime

import pytest
from pyspark.sql import functions as F

from budgetloom.plans import accrual_load as load
from budgetloom.sources.control import Taken
from budgetloom.sources.warehouse import Warehouse
from tests.helpers import table
from tests.test_accrual_rules import GOOD, known

RUN = datetime(2024, 1, 31, 8)


def submitted(spark, *records):
    return table(spark, load.RECORDS, *records, **GOOD).drop("created_dt", "status", "pk_accr_recs_id")


def test_insert_appends_pending_records_with_new_keys(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load.insert_accruals(wh, submitted(spark, {"accr_amt": ""}, {}), RUN)
    load.insert_accruals(wh, submitted(spark, {"fk_accr_file_id": "007"}), RUN)
    rows = wh.read(load.RECORDS).collect()
    assert len(rows) == 3 and len({r["pk_accr_recs_id"] for r in rows}) == 3
    assert {(r["status"], r["created_dt"]) for r in rows} == {("Pending", RUN)}
    assert {r["fk_accr_file_id"] for r in rows} == {"f1", "007"}
    assert sorted(str(r["accr_amt"]) for r in rows) == ["10.5", "10.5", "None"]


def test_empty_submission_is_refused(spark, tmp_path):
    with pytest.raises(load.EmptySubmission):
        load.insert_accruals(Warehouse(spark, str(tmp_path / "wh")), submitted(spark).limit(0), RUN)


def test_validation_job(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load.insert_accruals(wh, submitted(spark, {"accr_amt": None, "c14": "X"}, {}, {"fk_accr_file_id": "f2"}), RUN)
    t = known(spark)
    bad, good = load.validate_accruals(wh, t, "f1", RUN), load.validate_accruals(wh, t, "f2", RUN)
    assert good == bad + 1
    assert tuple(load.load_verdict(wh, bad).first()) == (bad, "ERROR", 2)
    assert tuple(load.load_verdict(wh, good).first()) == (good, "SUCCESS", 0)
    assert {(r["rule_id"], r["n_errors"]) for r in load.load_rule_counts(wh, bad).collect()} == {("V05", 1), ("V11", 1)}
    assert {r["status"] for r in wh.read(load.RECORDS).collect()} == {"Pending"}
    assert load.validate_accruals(wh, t, "f1", RUN, load_num=40) == 40
    assert load.validate_accruals(wh, t, "f1", RUN) == 41


def test_failed_validation_is_logged_and_stores_no_errors(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load.insert_accruals(wh, submitted(spark, {"r12_code": "D", "accr_amt": None}), RUN)
    with pytest.raises(Exception, match="more than one profit center"):
        load.validate_accruals(wh, known(spark), "f1", RUN)
    assert wh.read(load.ERRORS).count() == 0
    log = wh.read(load.LOG).collect()
    assert [(r["er_accrual_load_num"], r["status"]) for r in log] == [(1, "Error on validate")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_on_file_and_day_reach_the_scan(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load.insert_accruals(wh, submitted(spark, {}, {"fk_accr_file_id": "f2"}), RUN)
    text = plan(wh.read(load.RECORDS).filter("fk_accr_file_id = 'f2' and load_date = date'2024-01-31'"))
    assert "PartitionFilters: [isnotnull(load_date" in text and "EqualTo(fk_accr_file_id,f2)" in text


def test_many_tasks_give_few_files(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load.insert_accruals(wh, submitted(spark, *[{"fk_accr_file_id": f"f{i % 7}"} for i in range(200)]).repartition(40), RUN)
    assert len(list((tmp_path / "wh" / load.RECORDS).rglob("part-*.parquet"))) == 1
    rows = wh.read(load.RECORDS).select("fk_accr_file_id", load.KEY).collect()
    assert [r[0] for r in rows] == sorted(r[0] for r in rows)
    assert len({r[1] for r in rows}) == 200


def test_no_data_table_is_read_for_a_key(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    monkeypatch.setattr(Warehouse, "read", lambda *a: pytest.fail("a table was read"))
    starts = [wh.reserve_keys(load.RECORDS, load.KEY) for _ in range(3)]
    assert starts[0] == 1 and len({b - a for a, b in zip(starts, starts[1:])}) == 1
    load.insert_accruals(wh, submitted(spark, {}), RUN)


def test_keys_go_on_behind_those_of_an_adopted_table(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.append(load.RECORDS, load.pending(submitted(spark, {}), RUN).withColumn(load.KEY, F.lit(10**12)))
    wh.adopt_keys(load.RECORDS, load.KEY)
    assert wh.reserve_keys(load.RECORDS, load.KEY) > 10**12


def test_only_one_run_gets_a_load_number(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load.insert_accruals(wh, submitted(spark, {"accr_amt": None}), RUN)
    assert load.validate_accruals(wh, known(spark), "f1", RUN, load_num=3) == 3
    before = wh.read(load.ERRORS).count()
    with pytest.raises(Taken, match="3 has been used"):
        load.validate_accruals(Warehouse(spark, wh.root), known(spark), "f1", RUN, load_num=3)
    assert wh.read(load.ERRORS).count() == before
    assert wh.control.claim_next(load.LOADS, count=2) == [4, 5]


def test_the_outcome_is_known_without_reading_the_errors(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load.insert_accruals(wh, submitted(spark, {"accr_amt": None, "c14": "X"}, {"accr_amt": None}), RUN)
    read = Warehouse.read
    monkeypatch.setattr(Warehouse, "read", lambda self, name, *a: pytest.fail("errors were read") if name == load.ERRORS else read(self, name, *a))
    load.validate_accruals(wh, known(spark), "f1", RUN)
    assert [(r["status"], r["comments"], r["file_id"]) for r in read(wh, load.LOG).collect()] == [("ERROR", "3 error rows; V05 2, V11 1", "f1")]


def test_all_waiting_files_in_one_pass(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load.insert_accruals(wh, submitted(spark, {"accr_amt": None}, {"fk_accr_file_id": "f2"}, {"fk_accr_file_id": "f3", "c14": "X"}), RUN)
    loads = load.validate_waiting(wh, known(spark), RUN)
    assert loads == {"f1": 1, "f2": 2, "f3": 3}
    log = {r["file_id"]: (r["er_accrual_load_num"], r["status"], r["comments"]) for r in wh.read(load.LOG).collect()}
    assert log == {"f1": (1, "ERROR", "1 error rows"), "f2": (2, "SUCCESS", "0 error rows"), "f3": (3, "ERROR", "1 error rows")}
    assert load.validate_waiting(wh, known(spark), RUN) == {}
    load.insert_accruals(wh, submitted(spark, {"fk_accr_file_id": "f4"}), RUN)
    assert load.validate_waiting(wh, known(spark), RUN) == {"f4": 4}


def test_the_log_names_the_rule_that_failed(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load.insert_accruals(wh, submitted(spark, {"r12_code": "D", "accr_amt": None}, {"fk_accr_file_id": "f2"}), RUN)
    with pytest.raises(Exception, match="more than one profit center"):
        load.validate_waiting(wh, known(spark), RUN)
    assert wh.read(load.ERRORS).count() == 0
    log = [tuple(r) for r in wh.read(load.LOG).select("er_accrual_load_num", "status", "file_id", F.left("comments", F.lit(53))).orderBy("file_id").collect()]
    assert log == [(n, "Error on validate", f, "V01 validate; more than one profit center for R12 cod") for n, f in ((1, "f1"), (2, "f2"))]
    assert load.waiting_files(wh) == ["f1", "f2"]
