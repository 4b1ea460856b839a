from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from budgetloom.plans import budget_fact as bf
from budgetloom.plans import classify
from budgetloom.plans.pipeline import budget_fact, build_budget_fact
from budgetloom.sources.warehouse import Warehouse
from tests.helpers import table
from tests.test_budget_stage import BASE

RUN = datetime(2024, 1, 31)


def inputs(spark, *lines):
    """One of everything: extract lines and the tables around them."""

    def code(name, id_, short):
        return table(spark, name, {"tbl_code_id": id_, "short_code": short})

    links = ("fk_tbl_name_id_from", "fk_tbl_name_id_to", "fk_tbl_code_id_from", "fk_tbl_code_id_to")
    names = ("ER_GC_CLASS_OF_BUSINESS", "ER_REVENUE_DM_BUSINESS_CLASS", "ER_GC_COVER_TYPE", "ER_REVENUE_DM_CONTRACT_SUBTYPE")
    return {
        "clvr_level0_extract": table(spark, "clvr_level0_extract", *lines, **BASE),
        "er_budget_revenue_type_xref": table(
            spark,
            "er_budget_revenue_type_xref",
            {"er_budget_revenue_type_code": "ACCT", "fk_er_source_code": "S", "fk_er_revenue_type_code": "R", "fk_er_transaction_type_code": "T"},
        ),
        "er_dm_hyp_pc_xref": table(spark, "er_dm_hyp_pc_xref", *[{"er_hyperion_pc_dsc": d, "er_profit_center_code": "P1", "active_ind": "Y"} for d in ("PC~1", "PC,1")]),
        "er_pc_application_xref": table(spark, "er_pc_application_xref", {"profit_code": "P1", "dd_application_id": 22}),
        "source_dim": table(spark, "source_dim", {"source_dim_id": None, "source_code": "S"}),
        "revenue_type_dim": table(spark, "revenue_type_dim", {"revenue_type_id": 5, "revenue_type_code": "R"}),
        "transaction_dim": table(spark, "transaction_dim", {"transaction_dim_id": 6, "transaction_type_code": "other"}),
        "profit_center_dim": table(spark, "profit_center_dim", {"profit_center_dim_id": 7, "profit_code": "P1"}),
        "trading_partner_dim": table(spark, "trading_partner_dim", *[{"tp_dim_id": d, "tp_id": i, "tp_ult_parent_id": p} for d, i, p in ((1, 104, 9), (2, 104, 9), (3, 8, 104))]),
        "contract_dim": table(spark, "contract_dim", {"contract_dim_id": 50, "contract_ref": "000104", "contract_eff_dt": date(2020, 1, 1), "dd_er_section_id": 60, "er_contract_id": 70}),
        "er_contract_section": table(spark, "er_contract_section", {"er_contract_section_id": 60, "fk_er_contract_id": 70, "fk_gc_cover_type": "CV"}),
        "er_contract_section_class": table(spark, "er_contract_section_class", {"fk_er_contract_section_id": 60, "fk_gc_class_of_business": "CB"}),
        "er_contract": table(spark, "er_contract", {"er_contract_id": 70}),
        "business_classification_dim": table(spark, "business_classification_dim", {"business_classification_dim_id": 80, "busness_class_code": "RB"}),
        "contract_classification_dim": table(spark, "contract_classification_dim", {"contract_classification_dim_id": 90, "contract_sub_type_code": "RC"}),
        "er_gc_class_of_business": code("er_gc_class_of_business", 11, "CB"),
        "er_revenue_dm_business_class": code("er_revenue_dm_business_class", 12, "RB"),
        "er_gc_cover_type": code("er_gc_cover_type", 13, "CV"),
        "er_revenue_dm_contract_subtype": code("er_revenue_dm_contract_subtype", 14, "RC"),
        "er_cross_reference": table(spark, "er_cross_reference", *[dict(zip(links, v)) for v in ((1, 2, 11, 12), (3, 4, 13, 14))]),
        "er_tbl_name": table(spark, "er_tbl_name", *[{"tbl_name_id": i, "tbl_name_physical": n} for i, n in enumerate(names, 1)]),
    }


def test_whole_build(spark):
    lines = [
        {"jan_amt": Decimal(5), "dec_amt": Decimal("0.004"), "mar_amt": Decimal(-2)},
        {"clvr_contract_mbr": "CL_104_NA", "feb_amt": Decimal(1)},
        {"clvr_contract_mbr": "Unallocated", "feb_amt": Decimal(3), "clvr_account_mbr": "ELSE"},
    ]
    rows = {(r["contract_dsc"], r["revenue_date_dim_id"]): r for r in budget_fact(inputs(spark, *lines), 2024).collect()}
    assert set(rows) == {("CO_000104", 20240101), ("CO_000104", 20240301), ("CL_104_NA", 20240201), ("Not_Available", 20240201)}
    one = rows["CO_000104", 20240101]
    assert (one["contract_dim_id"], one["business_classification_dim_id"], one["contract_classification_dim_id"]) == (50, 80, 90)
    assert (one["source_dim_id"], one["revenue_type_id"], one["transaction_dim_id"], one["profit_center_dim_id"], one["budget_version_dim_id"]) == (None, "5", -1, 7, -1)
    assert one["cedent_dim_id"] == 2 and one["budget_amt_usd"] == Decimal("5.00")
    assert rows["CL_104_NA", 20240201]["cedent_dim_id"] == 3
    rest = rows["Not_Available", 20240201]
    assert (rest["contract_dim_id"], rest["business_classification_dim_id"], rest["contract_classification_dim_id"], rest["cedent_dim_id"], rest["source_dim_id"]) == (-1, -1, -2, -1, -1)


def test_unpivot_drops_zero_and_missing_months(spark):
    stage_2 = table(spark, "er_hyperion_stage_2", {"budget_year": 2024, "client_code": 1, "jan_budget_amt_usd": Decimal(1), "feb_budget_amt_usd": Decimal(0), "dec_budget_amt_usd": Decimal(2)})
    out = bf.unpivot_months(bf.numeric_clients(stage_2)).select("revenue_date_dim_id", "budget_amt_usd").collect()
    assert sorted(tuple(r) for r in out) == [(20240101, Decimal("1.00")), (20241201, Decimal("2.00"))]
    assert bf.numeric_clients(table(spark, "er_hyperion_stage_2", {"client_code": None}, {"client_code": -2})).count() == 1


def test_several_business_classes(spark):
    t = inputs(spark, {"jan_amt": Decimal(1)})
    t["business_classification_dim"] = table(spark, "business_classification_dim", *[{"business_classification_dim_id": i, "busness_class_code": "RB"} for i in (80, 81)])
    with pytest.raises(Exception, match="more than one business class"):
        classify.with_classes(t["contract_dim"].select("contract_dim_id"), t).collect()
    assert classify.with_classes(t["contract_dim"].select("contract_dim_id"), t, "max").first()["business_classification_dim_id"] == 81
    unnamed = spark.createDataFrame([(-1,)], "contract_dim_id long")
    assert classify.with_classes(unnamed, t).first()["business_classification_dim_id"] == -1  # several classes of a contract that no row names


def test_years_outside_are_refused(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    both = inputs(spark, {"jan_amt": Decimal(1)}, {"feb_amt": Decimal(2), "clvr_fiscal_year_mbr": "FY25"})
    build_budget_fact(wh, both, [2024, 2025], RUN)
    before = facts(wh)
    with pytest.raises(Exception, match="outside the years to replace"):
        wh.replace_years("budget_fact", wh.read("budget_fact").withColumn("revenue_year", F.lit(2026)), [2024])
    assert facts(wh) == before


def test_class_defaults(spark):
    fact = spark.createDataFrame([(-1, 5), (-2, None), (7, None), (8, 3)], "contract_dim_id long, business_classification_dim_id long")
    assert [r[1] for r in classify.class_defaults(fact).collect()] == [-1, -2, -1, 3]


def facts(wh):
    return sorted((r["revenue_year"], r["revenue_date_dim_id"], r["budget_amt_usd"]) for r in wh.read("budget_fact").collect())


def test_stored_build_replaces_only_its_years(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    both = inputs(spark, {"jan_amt": Decimal(1)}, {"feb_amt": Decimal(2), "clvr_fiscal_year_mbr": "FY25"}, {"feb_amt": Decimal(4), "clvr_fiscal_year_mbr": "FY25", "clvr_account_mbr": "ELSE"})
    build_budget_fact(wh, both, [2024, 2025], RUN)
    first = facts(wh)
    assert first == [(2024, 20240101, Decimal("1.00")), (2025, 20250201, Decimal("2.00")), (2025, 20250201, Decimal("4.00"))]
    fact, second = wh.read("budget_fact"), wh.read("er_hyperion_stage_2")
    assert fact.select("budget_fact_id").distinct().count() == 3
    assert fact.join(second, "er_hyperion_stage_2_id", "left_anti").count() == 0
    total = second.select(F.sum(F.coalesce("jan_budget_amt_usd", F.lit(0)) + F.coalesce("feb_budget_amt_usd", F.lit(0)))).first()[0]
    assert total == fact.select(F.sum("budget_amt_usd")).first()[0]

    build_budget_fact(wh, both, 2024, RUN)  # again: same rows, new keys
    assert facts(wh) == first
    assert wh.read("budget_fact").select("budget_fact_id").distinct().count() == 3

    build_budget_fact(wh, inputs(spark, {"jan_amt": Decimal(9)}), 2025, RUN)  # nothing budgeted for 2025 any more
    assert facts(wh) == [(2024, 20240101, Decimal("1.00"))]


def test_failed_step_leaves_the_fact_as_it_was(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    good = inputs(spark, {"jan_amt": Decimal(1)})
    build_budget_fact(wh, good, 2024, RUN)
    twice = {**good, "source_dim": good["source_dim"].union(good["source_dim"])}
    with pytest.raises(Exception, match="more than one row"):
        build_budget_fact(wh, twice, 2024, RUN)
    assert facts(wh) == [(2024, 20240101, Decimal("1.00"))]
