from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from budgetloom.plans import budget_stage as stage
from tests.helpers import table

BASE = {
    "clvr_entity_mbr": "PC~1",
    "clvr_contract_mbr": "CO_000104_104",
    "clvr_account_mbr": "ACCT",
    "clvr_currency_type_mbr": "Reporting_USD",
    "clvr_scenario_mbr": "Budget",
    "clvr_version_mbr": "Final",
    "clvr_fiscal_year_mbr": "FY24",
}

MEMBERS = [
    # member, contract text, client name, client code, decoded contract
    ("CL_123_NA", "CL_123_NA", "123", 123, "-1"),
    ("CO_000112YY01_15_112", "CO_000112YY01_15", "112", 112, "000112"),
    ("CO_ABY9YY7_10_689", "CO_ABY9YY7_10", "689", 689, "ABY9YY7"),
    ("CO_00000103YY-01-02-03-1_103_103", "CO_00000103YY-01-02-03-1_103", "103", 103, "00000103-01-02-03"),
    ("CO_000104_104", "CO_000104", "104", 104, "000104"),
    ("CO_000105-MX_96_1_105", "CO_000105-MX_96_1", "105", 105, "000105-MX_96"),
    ("A&B-107", "Not_Available", "107", 107, "-1"),
    ("Line (A) 106", "Not_Available", "Line (A) 106", -2, "-1"),
    ("Unallocated", "Not_Available", "Unallocated", -2, "-1"),
    ("Client_9_12", "Not_Available", "12", 12, "-1"),
    ("CL_55_NA2024", "CL_55", "552024", 552024, "-1"),
    ("a:12", "Not_Available", "12", 12, "-1"),
    ("b\\13.", "Not_Available", "13", 13, "-1"),
    ("New_", "New", None, -2, "-1"),
    ("99", None, "99", 99, None),
    ("CO__5", "CO_", "5", 5, None),
    ("CO_Orphan_x_5", "CO_Orphan_x", "5", 5, "-1"),
    # long texts with YY
    ("CO_12345678YY-A-B-C_x_77", "CO_12345678YY-A-B-C_x", "77", 77, "12345678-A-0B-C"),
    ("CO_1234567890YY12_34_88", "CO_1234567890YY12_34", "88", 88, "123456789012"),
    ("CO_1YY_90", "CO_1YY", "90", 90, None),
]


def staged(spark, *rows, years=2024):
    return stage.stage1(table(spark, "clvr_level0_extract", *rows, **BASE), years)


@pytest.mark.parametrize("member, dsc, name, code, decode", MEMBERS)
def test_member_parsing(spark, member, dsc, name, code, decode):
    row = stage.decode_members(staged(spark, {"clvr_contract_mbr": member, "jan_amt": Decimal(1)})).first()
    assert (row["contract_dsc"], row["hyperion_client_name"], row["client_code"], row["contract_decode"]) == (dsc, name, code, decode)


def test_filters_and_month_sums(spark):
    rows = [
        {"jan_amt": Decimal("1.005"), "feb_amt": Decimal("2")},
        {"jan_amt": Decimal("1.005")},
        {"jan_amt": Decimal(50), "clvr_currency_type_mbr": "Local"},
        {"jan_amt": Decimal(50), "clvr_scenario_mbr": "Actual"},
        {"jan_amt": Decimal(50), "clvr_version_mbr": "Draft"},
        {"jan_amt": Decimal(50), "clvr_fiscal_year_mbr": "FY23"},
        {"jan_amt": Decimal(50), "clvr_entity_mbr": "No_GC_Entity"},
        {"jan_amt": Decimal(50), "clvr_entity_mbr": None},
        {"jan_amt": Decimal(50), "clvr_contract_mbr": "No_Customer"},
        {"jan_amt": Decimal(50), "clvr_account_mbr": "FX_Gain"},
    ]
    row = staged(spark, *rows).collect()
    assert len(row) == 1
    assert row[0]["jan_budget_amt_usd"] == Decimal("2.01") and row[0]["feb_budget_amt_usd"] == Decimal("2.00") and row[0]["mar_budget_amt_usd"] is None


def test_several_years_stay_apart(spark):
    out = staged(spark, {"jan_amt": Decimal(1)}, {"jan_amt": Decimal(2), "clvr_fiscal_year_mbr": "FY25"}, years=[2024, 2025])
    assert {(r["budget_year"], r["jan_budget_amt_usd"]) for r in out.collect()} == {(2024, Decimal("1.00")), (2025, Decimal("2.00"))}
    with pytest.raises(ValueError):
        stage.as_years([1924, 2024])


def test_filters_reach_the_scan(spark, tmp_path, capsys):
    table(spark, "clvr_level0_extract", {"jan_amt": Decimal(1)}, **BASE).write.parquet(str(tmp_path / "x"))
    stage.stage1(spark.read.parquet(str(tmp_path / "x")), 2024).explain("formatted")
    pushed = next(line for line in capsys.readouterr().out.splitlines() if line.startswith("PushedFilters"))
    for column in ("currency_type", "scenario", "version", "fiscal_year"):
        assert f"EqualTo(clvr_{column}_mbr," in pushed
    assert "Not(EqualTo(clvr_contract_mbr,No_Customer))" in pushed and "Not(StringStartsWith(clvr_account_mbr,FX))" in pushed


def test_source_type_other_than_known_raises(spark):
    bad = staged(spark, {"jan_amt": Decimal(1)}).withColumn("source_type", F.lit("X"))
    with pytest.raises(Exception, match="unknown source type"):
        stage.decode_members(bad).collect()


def lookups(spark, pc=(), accounts=()):
    return {
        "er_dm_hyp_pc_xref": table(spark, "er_dm_hyp_pc_xref", *pc),
        "er_budget_revenue_type_xref": table(spark, "er_budget_revenue_type_xref", *accounts),
    }


def test_stage2_codes(spark):
    t = lookups(
        spark,
        [{"er_hyperion_pc_dsc": " PC~1 ", "er_profit_center_code": "P1", "active_ind": "Y"}, {"er_hyperion_pc_dsc": "PC~1", "er_profit_center_code": "P9", "active_ind": "N"}],
        [{"er_budget_revenue_type_code": "ACCT", "fk_er_revenue_type_code": "R", "fk_er_transaction_type_code": "T"}],
    )
    one = staged(spark, {"jan_amt": Decimal(1)}, {"jan_amt": Decimal(1), "clvr_account_mbr": "OTHER", "clvr_entity_mbr": "PC~2"})
    rows = {r["profit_center_dsc"]: r for r in stage.stage2(one, t).collect()}
    known, unknown = rows["PC,1"], rows["PC,2"]
    assert (known["profit_center_code"], known["source_id"], known["revenue_type"], known["transaction_type"]) == ("P1", "-1", "R", "T")
    assert (unknown["profit_center_code"], unknown["source_id"], unknown["revenue_type"], unknown["transaction_type"]) == ("-1",) * 4
    assert known["contract_code"] is None
    assert [r["profit_center_dsc"] for r in stage.missing_profit_centers(one, t).collect()] == ["PC~2"]


def test_duplicate_codes_raise_only_when_used(spark):
    dup = [{"er_budget_revenue_type_code": "DUP"}, {"er_budget_revenue_type_code": "DUP"}]
    stage.stage2(staged(spark, {"jan_amt": Decimal(1)}), lookups(spark, (), dup)).collect()
    with pytest.raises(Exception, match="more than one row"):
        stage.stage2(staged(spark, {"jan_amt": Decimal(1), "clvr_account_mbr": "DUP"}), lookups(spark, (), dup)).collect()
    two = [{"er_hyperion_pc_dsc": "PC~1", "er_profit_center_code": c, "active_ind": "Y"} for c in ("A", "B")]
    with pytest.raises(Exception, match="more than one active code"):
        stage.stage2(staged(spark, {"jan_amt": Decimal(1)}), lookups(spark, two)).collect()
