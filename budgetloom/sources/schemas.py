"""Declared column types of every table, as DDL strings; nothing is inferred on read."""

from __future__ import annotations

from .fields import AMOUNTS, DESCRIPTORS, MONTHS, RECORD_FIELDS


def _strings(names) -> str:
    return ", ".join(f"{n} string" for n in names)


_MONEY_COLUMNS = ", ".join(f"{a} decimal(38,2)" for a in AMOUNTS)
_CODE_TABLE = "tbl_code_id long, short_code string"

INPUTS: dict[str, str] = {
    "clvr_level0_extract": _strings(f"clvr_{c}_mbr" for c in ("entity", "contract", "account", "currency_type", "scenario", "version", "fiscal_year"))
    + ", "
    + ", ".join(f"{m}_amt decimal(38,10)" for m in MONTHS),
    "er_budget_revenue_type_xref": _strings(
        ("er_budget_revenue_type_code", "fk_er_source_code", "fk_er_revenue_type_code", "fk_er_transaction_type_code")
    ),
    "er_dm_hyp_pc_xref": _strings(("er_hyperion_pc_dsc", "er_profit_center_code", "er_profit_center_dsc", "active_ind")),
    "er_pc_application_xref": "profit_code string, dd_application_id long",
    "source_dim": "source_dim_id long, source_code string",
    "revenue_type_dim": "revenue_type_id long, revenue_type_code string",
    "transaction_dim": "transaction_dim_id long, transaction_type_code string",
    "trading_partner_dim": "tp_dim_id long, tp_id long, tp_ult_parent_id long",
    "profit_center_dim": "profit_center_dim_id long, profit_code string, hyperion_responsibility_center string",
    "contract_dim": "contract_dim_id long, contract_ref string, budget_ref string, gc_our_contract_ref string, section_number string, "
    "under_writing_year int, contract_eff_dt date, dd_er_section_id long, er_contract_id long",
    "er_contract_section": "er_contract_section_id long, fk_er_contract_id long, fk_gc_cover_type string",
    "er_contract_section_class": "fk_er_contract_section_id long, fk_gc_class_of_business string",
    "er_contract": "er_contract_id long",
    "business_classification_dim": "business_classification_dim_id long, busness_class_code string, busness_class_dsc string",
    "contract_classification_dim": "contract_classification_dim_id long, contract_sub_type_code string, contract_sub_type_dsc string",
    "er_gc_class_of_business": _CODE_TABLE,
    "er_revenue_dm_business_class": _CODE_TABLE,
    "er_gc_cover_type": _CODE_TABLE,
    "er_revenue_dm_contract_subtype": _CODE_TABLE,
    "er_cross_reference": "fk_tbl_name_id_from long, fk_tbl_name_id_to long, fk_tbl_code_id_from long, fk_tbl_code_id_to long",
    "er_tbl_name": "tbl_name_id long, tbl_name_physical string",
    "er_gl_profit_center": "short_code string",
    "er_tp_references": "tp_reference string, gc_reference_type string",
    "er_currency_info": "gc_currency_code string",
    "er_accruals_revenue_type": "short_code string",
}

OUTPUTS: dict[str, str] = {
    "er_hyperion_stage_1": "budget_year int, "
    + _strings(("source_type", "profit_center_dsc", "hyperion_client_name", "contract_dsc", "hyperion_revenue_type"))
    + ", "
    + _MONEY_COLUMNS,
    "er_hyperion_stage_2": "er_hyperion_stage_2_id long, budget_year int, profit_center_dsc string, profit_center_code string, "
    "hyperion_client_name string, client_code long, contract_dsc string, contract_decode string, contract_code string, "
    "revenue_type string, source_id string, " + _MONEY_COLUMNS + ", transaction_type string",
    "budget_fact": "budget_fact_id long, contract_dim_id long, source_dim_id long, revenue_date_dim_id int, cedent_dim_id long, "
    "profit_center_dim_id long, budget_version_dim_id long, budget_amt_usd decimal(38,2), er_hyperion_stage_2_id long, "
    "created_dt timestamp, update_dt timestamp, revenue_type_id string, transaction_dim_id long, "
    "business_classification_dim_id long, contract_classification_dim_id long, revenue_year int",
    "budget_contract_keys": "budget_year int, contract_dsc string, contract_decode string, profit_center_dsc string, app_id long, contract_dim_id long",
    "budget_contract_map": "budget_year int, contract_dsc string, contract_decode string, profit_center_dsc string, app_id long, "
    "contract_dim_id long, business_classification_dim_id long, contract_classification_dim_id long",
    "er_selfservice_accrual_records": _strings((*RECORD_FIELDS, *DESCRIPTORS, "file_id", "fk_accr_file_id", "user_id"))
    + ", created_dt timestamp, status string, pk_accr_recs_id long, r12_code string, load_date date",
    "er_accrual_stg_error": _strings(RECORD_FIELDS)
    + ", error_message string, error_dt timestamp, er_accrual_load_num long, "
    + _strings((*DESCRIPTORS, *(f"unused_{i}" for i in range(1, 6)), "r12_code", "rule_id"))
    + ", error_date date",
    "er_accural_log": "er_accrual_load_num long, dt_updated timestamp, status string, comments string, file_id string, log_date date",
    "build_step_log": "run_id string, step string, dt_updated timestamp, n_rows long, log_date date",
}

SCHEMAS: dict[str, str] = {**INPUTS, **OUTPUTS}

#: Inputs stored by a column that scans filter on.
INPUT_PARTITIONS: dict[str, str] = {"clvr_level0_extract": "clvr_fiscal_year_mbr"}

#: Tables that are replaced as a whole.
REFRESHED = ("er_hyperion_stage_1", "er_hyperion_stage_2", "budget_contract_keys", "budget_contract_map")

#: Tables of which whole years are replaced, and their year.
YEARS: dict[str, str] = {"budget_fact": "revenue_year"}

#: Tables that grow by appends: the day they are stored by, and the order of rows within its files.
APPENDED: dict[str, tuple[str, list[str]]] = {
    "er_selfservice_accrual_records": ("load_date", ["fk_accr_file_id"]),
    "er_accrual_stg_error": ("error_date", ["er_accrual_load_num", "rule_id"]),
    "er_accural_log": ("log_date", ["er_accrual_load_num"]),
    "build_step_log": ("log_date", ["run_id"]),
}


def columns(name: str) -> list[str]:
    return [part.split()[0] for part in SCHEMAS[name].replace("decimal(38,2)", "decimal").replace("decimal(38,10)", "decimal").split(",")]
