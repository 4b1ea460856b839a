"""Registered Spark queries: every operator of the two jobs over whole derived tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from budgetloom.operators.xref import code_xref
from budgetloom.plans import accrual_load, accrual_rules, budget_fact, budget_stage, classify, contract_map, pipeline
from budgetloom.sources.warehouse import Warehouse, surrogate_key

from .fixtures import FIXTURES, MEMBER_RULES, YEARS, derive, scratch

STAGE_TABLES = ["clvr_level0_extract", "er_budget_revenue_type_xref", "er_dm_hyp_pc_xref"]
DIM_TABLES = ["source_dim", "revenue_type_dim", "transaction_dim", "profit_center_dim", "trading_partner_dim"]
MAP_TABLES = ["er_pc_application_xref", "contract_dim"]
CODE_TABLES = [
    "er_cross_reference",
    "er_tbl_name",
    "er_gc_class_of_business",
    "er_revenue_dm_business_class",
    "er_gc_cover_type",
    "er_revenue_dm_contract_subtype",
]
CLASS_TABLES = [
    "contract_dim",
    "er_contract_section",
    "er_contract_section_class",
    "er_contract",
    "business_classification_dim",
    "contract_classification_dim",
    *CODE_TABLES,
]
BUDGET_TABLES = list(dict.fromkeys([*STAGE_TABLES, *DIM_TABLES, *MAP_TABLES, *CLASS_TABLES]))
RECORDS = "er_selfservice_accrual_records"
ACCRUAL_TABLES = [n for n in FIXTURES if n in ("er_gl_profit_center", "er_tp_references", "er_currency_info", "er_accruals_revenue_type")] + [
    "profit_center_dim",
    "contract_dim",
    "business_classification_dim",
    "contract_classification_dim",
]
RUN_TS = datetime(2024, 1, 31, 12, 0, 0)
LOAD_NUM = 7

STAGE2_KEYS = ["budget_year", "profit_center_dsc", "hyperion_client_name", "client_code", "contract_dsc"]
CODES = ["profit_center_code", "revenue_type", "source_id", "transaction_type"]
DIM_KEYS = ["source_dim_id", "revenue_type_id", "transaction_dim_id", "profit_center_dim_id", "cedent_dim_id", "budget_version_dim_id"]
CLASS_KEYS = ["business_classification_dim_id", "contract_classification_dim_id"]
CONTRACT_COLUMNS = contract_map.CONTRACT_KEYS

Query = Callable[[SparkSession, str], DataFrame]


def years(spark: SparkSession, sf: str) -> list[int]:
    """The years of the planning extract. The DuckDB text names its years, so others than those are an error."""
    shipped = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.year("l_shipdate").alias("y")).dropna().distinct().collect()
    found = sorted(r["y"] for r in shipped)
    if not set(found) <= set(YEARS):
        raise ValueError(f"years outside {YEARS[0]} to {YEARS[-1]}: {sorted(set(found) - set(YEARS))}")
    return found


def file_ids(spark: SparkSession, sf: str) -> list[str]:
    found = derive(spark, sf, RECORDS)[RECORDS].select("fk_accr_file_id").dropna().distinct().collect()
    return sorted(r["fk_accr_file_id"] for r in found)


def _stage1(spark: SparkSession, sf: str) -> DataFrame:
    return budget_stage.stage1(derive(spark, sf, "clvr_level0_extract")["clvr_level0_extract"], years(spark, sf))


def _stage2(spark: SparkSession, sf: str) -> DataFrame:
    t = derive(spark, sf, *STAGE_TABLES)
    return budget_stage.stage2(budget_stage.stage1(t["clvr_level0_extract"], years(spark, sf)), t)


def stage1_refresh(spark: SparkSession, sf: str) -> DataFrame:
    wh = scratch(spark)
    wh.refresh("er_hyperion_stage_1", _stage1(spark, sf))
    return wh.refresh("er_hyperion_stage_1", _stage1(spark, sf))


def stage2_decode(spark: SparkSession, sf: str) -> DataFrame:
    rows = budget_stage.decode_members(_stage1(spark, sf))
    return rows.select("budget_year", "profit_center_dsc", "hyperion_revenue_type", "hyperion_client_name", "contract_dsc", "client_code", "contract_decode")


def stage2_lookups(spark: SparkSession, sf: str) -> DataFrame:
    return _stage2(spark, sf).select(*STAGE2_KEYS, "contract_decode", *CODES, *budget_stage.AMOUNTS)


def missing_profit_centers(spark: SparkSession, sf: str) -> DataFrame:
    return budget_stage.missing_profit_centers(_stage1(spark, sf), derive(spark, sf, "er_dm_hyp_pc_xref"))


def fact_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    rows = budget_fact.unpivot_months(budget_fact.numeric_clients(_stage2(spark, sf)))
    return rows.select(*STAGE2_KEYS, *CODES, "revenue_date_dim_id", "budget_amt_usd")


def fact_dims(spark: SparkSession, sf: str) -> DataFrame:
    rows = budget_fact.unpivot_months(budget_fact.with_fact_dims(_stage2(spark, sf), derive(spark, sf, *DIM_TABLES)))
    return rows.select(*STAGE2_KEYS, "revenue_date_dim_id", "budget_amt_usd", *DIM_KEYS)


def _map_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return derive(spark, sf, "er_dm_hyp_pc_xref", *MAP_TABLES)


def _contracts(spark: SparkSession, sf: str) -> DataFrame:
    return contract_map.with_application(contract_map.candidates(_stage2(spark, sf)), _map_tables(spark, sf))


def _matches(spark: SparkSession, sf: str) -> DataFrame:
    return contract_map.match_index(derive(spark, sf, "contract_dim")["contract_dim"])


def app_resolve(spark: SparkSession, sf: str) -> DataFrame:
    return _contracts(spark, sf).select(*CONTRACT_COLUMNS, "app_id")


def _by_rule(kind: str, office: bool | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        keyed = contract_map.with_search_keys(_contracts(spark, sf)).filter(F.col("kind") == kind)
        if office is not None:
            is_office = F.coalesce(F.col("app_id") == 13, F.lit(False))
            keyed = keyed.filter(is_office if office else ~is_office)
        return contract_map.find_contracts(keyed, _matches(spark, sf)).select(*CONTRACT_COLUMNS, "primary_id")

    return run


def contract_fallback(spark: SparkSession, sf: str) -> DataFrame:
    keyed = contract_map.with_search_keys(_contracts(spark, sf))
    return contract_map.find_contracts(keyed, _matches(spark, sf)).select(*CONTRACT_COLUMNS, "back_id")


def contract_keys(spark: SparkSession, sf: str) -> DataFrame:
    return contract_map.contract_map(_stage2(spark, sf), _map_tables(spark, sf))


def xref_codes(spark: SparkSession, sf: str) -> DataFrame:
    t = derive(spark, sf, *CODE_TABLES)
    business = code_xref(t, "er_gc_class_of_business", "er_revenue_dm_business_class").withColumn("kind", F.lit("business"))
    return business.unionByName(code_xref(t, "er_gc_cover_type", "er_revenue_dm_contract_subtype").withColumn("kind", F.lit("cover")))


def _classes(spark: SparkSession, sf: str) -> DataFrame:
    t = derive(spark, sf, *CLASS_TABLES)
    return classify.with_classes(t["contract_dim"].select("contract_dim_id"), t)


def business_class(spark: SparkSession, sf: str) -> DataFrame:
    return _classes(spark, sf).select("contract_dim_id", "business_classification_dim_id")


def contract_class(spark: SparkSession, sf: str) -> DataFrame:
    return _classes(spark, sf).select("contract_dim_id", "contract_classification_dim_id")


def _fact_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The fact's rows, with stage 2 and the contracts stored: both are read more than once."""
    wh, t = scratch(spark), derive(spark, sf, *BUDGET_TABLES)
    second = budget_stage.stage2(budget_stage.stage1(t["clvr_level0_extract"], years(spark, sf)), t)
    second = wh.refresh(pipeline.STAGE_2, second.withColumn(pipeline.STAGE_KEY, surrogate_key(1)))
    contracts = wh.refresh(pipeline.CONTRACTS, pipeline.contract_rows(second, t, keep=lambda df: wh.refresh(pipeline.CONTRACT_KEYS, df)))
    return pipeline.fact_rows(second, t, contracts=contracts)


def whole_fact(spark: SparkSession, sf: str) -> DataFrame:
    return _fact_rows(spark, sf).select(*STAGE2_KEYS, "revenue_date_dim_id", "budget_amt_usd", *DIM_KEYS, "contract_dim_id", *CLASS_KEYS)


def budget_by_class(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.sum("budget_amt_usd").cast("decimal(38,2)").alias("amt")
    return _fact_rows(spark, sf).groupBy("revenue_year", *CLASS_KEYS).agg(F.count(F.lit(1)).alias("n_rows"), amount)


def fact_year_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Build every year, then replace one of them by itself: the table must come out as if built once."""
    wh, t = scratch(spark), derive(spark, sf, *BUDGET_TABLES)
    every = years(spark, sf)
    pipeline.build_budget_fact(wh, t, every, RUN_TS)
    pipeline.build_budget_fact(wh, t, every[0], RUN_TS)
    measures = ["revenue_year", "revenue_date_dim_id", "contract_dim_id", *DIM_KEYS, "budget_amt_usd", *CLASS_KEYS]
    return wh.read("budget_fact").select(*measures)


def _stored_fact(spark: SparkSession, sf: str) -> tuple[Warehouse, list[int]]:
    wh, every = scratch(spark), years(spark, sf)
    pipeline.build_budget_fact(wh, derive(spark, sf, *BUDGET_TABLES), every, RUN_TS)
    return wh, every


def fact_emptied_year(spark: SparkSession, sf: str) -> DataFrame:
    """Build every year, then the first one from an extract without rows: it is empty, the others stay."""
    wh, every = _stored_fact(spark, sf)
    t = derive(spark, sf, *BUDGET_TABLES)
    t["clvr_level0_extract"] = t["clvr_level0_extract"].filter(F.col("clvr_fiscal_year_mbr") != budget_stage.fiscal_tag(every[0]))
    pipeline.build_budget_fact(wh, t, every[0], RUN_TS)
    amount = F.sum("budget_amt_usd").cast("decimal(38,2)").alias("amt")
    return wh.read("budget_fact").groupBy("revenue_year").agg(F.count(F.lit(1)).alias("n_rows"), amount)


def fact_class_update(spark: SparkSession, sf: str) -> DataFrame:
    """Take the default classes out of the first year, let them be stored again, and tell which years' files were rewritten."""
    wh, every = _stored_fact(spark, sf)
    spoilt = F.when(F.col("business_classification_dim_id") == -1, None).otherwise(F.col("business_classification_dim_id"))
    first = wh.read("budget_fact").filter(F.col("revenue_year") == every[0])
    wh.replace_years("budget_fact", first.withColumn("business_classification_dim_id", spoilt), [every[0]])
    _, before = wh.control.latest("budget_fact")
    pipeline.apply_class_defaults(wh)
    _, now = wh.control.latest("budget_fact")
    changed = [int(y) for y, version in now.items() if version != before[y]]
    rows = wh.read("budget_fact").groupBy("revenue_year", "business_classification_dim_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.withColumn("rewritten", F.col("revenue_year").isin(changed))


def contract_keys_latest_year(spark: SparkSession, sf: str) -> DataFrame:
    return contract_map.contract_map(_stage2(spark, sf), _map_tables(spark, sf), latest_year_only=True)


def profit_center_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return contract_map.profit_center_conflicts(derive(spark, sf, "er_dm_hyp_pc_xref"))


def member_rules(spark: SparkSession, sf: str) -> DataFrame:
    members = spark.sql(MEMBER_RULES, customer=spark.read.parquet(f"{sf}/customer.parquet"))
    m = F.col("member")
    parts = members.select("member", F.lit("T").alias("source_type"), budget_stage.client_name(m).alias("hyperion_client_name"), budget_stage.contract_dsc(m).alias("contract_dsc"))
    return budget_stage.decode_members(parts).select("member", "hyperion_client_name", "contract_dsc", "client_code", "contract_decode")


# --- accruals ------------------------------------------------------------------------------------

MARK_TABLES = {
    accrual_rules.mark_profit_center: ["profit_center_dim", "er_gl_profit_center"],
    accrual_rules.mark_account: ["er_tp_references"],
    accrual_rules.mark_revenue_type: ["er_accruals_revenue_type"],
    accrual_rules.mark_currency: ["er_currency_info"],
    accrual_rules.mark_contract: ["contract_dim"],
    accrual_rules.mark_business_class: ["business_classification_dim"],
    accrual_rules.mark_contract_class: ["contract_classification_dim"],
    None: [],
}


def _errors(spark: SparkSession, sf: str, rules: list[str] | None = None, file_id: str | None = None) -> DataFrame:
    needed = ACCRUAL_TABLES if rules is None else [t for r in rules for t in MARK_TABLES[accrual_rules.RULES[r].mark]]
    t = derive(spark, sf, RECORDS, *dict.fromkeys(needed))
    return accrual_rules.error_rows(
        t[RECORDS], t, load_num=LOAD_NUM, run_ts=F.lit(RUN_TS), file_id=file_id, rules=rules, keep=("pk_accr_recs_id", "fk_accr_file_id")
    )


def _rule(rule: str) -> Query:
    return lambda spark, sf: _errors(spark, sf, [rule]).select("pk_accr_recs_id", "fk_accr_file_id", "error_message", "rule_id")


ERROR_COLUMNS = [*accrual_rules.RECORD_FIELDS, "error_message", "er_accrual_load_num", *accrual_rules.DESCRIPTORS, "r12_code", "rule_id", "pk_accr_recs_id"]


def accrual_errors(spark: SparkSession, sf: str) -> DataFrame:
    return _errors(spark, sf).select(*ERROR_COLUMNS)


def accrual_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    return accrual_rules.rule_counts(_errors(spark, sf))


def accrual_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return accrual_rules.verdict(_errors(spark, sf), LOAD_NUM)


def accrual_file_errors(spark: SparkSession, sf: str) -> DataFrame:
    """The errors of each submitted file: the first by a scan of its own, the others in one pass."""
    first = file_ids(spark, sf)[0]
    rows = _errors(spark, sf, file_id=first).unionByName(_errors(spark, sf).filter(F.col("fk_accr_file_id") != first))
    return rows.groupBy("fk_accr_file_id", "rule_id").agg(F.count(F.lit(1)).alias("n_errors"))


def accrual_load_job(spark: SparkSession, sf: str) -> DataFrame:
    """Load the records in two submissions, the last file by itself, with keys that differ across them."""
    wh, records = scratch(spark), derive(spark, sf, RECORDS)[RECORDS].drop("pk_accr_recs_id")
    last = file_ids(spark, sf)[-1]
    for late in (False, True):
        accrual_load.insert_accruals(wh, records.filter((F.col("fk_accr_file_id") == last) == F.lit(late)), RUN_TS)
    stored = wh.read(RECORDS)
    return stored.groupBy("fk_accr_file_id", "status", "user_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("pk_accr_recs_id").alias("n_keys"), F.count("accr_amt").alias("n_amounts")
    )


def _validated(spark: SparkSession, sf: str, **changed: Callable[[DataFrame], DataFrame]) -> Warehouse:
    """Load all records and validate all files in one pass, with some of the code tables changed."""
    t = derive(spark, sf, RECORDS, *ACCRUAL_TABLES)
    t.update({name: change(t[name]) for name, change in changed.items()})
    wh = scratch(spark)
    accrual_load.insert_accruals(wh, t[RECORDS], RUN_TS)
    try:
        accrual_load.validate_waiting(wh, t, RUN_TS)
    except Exception:
        if not changed:
            raise
    return wh


def accrual_audit_log(spark: SparkSession, sf: str) -> DataFrame:
    return _validated(spark, sf).read("er_accural_log").select("er_accrual_load_num", "status", "comments")


def accrual_all_files(spark: SparkSession, sf: str) -> DataFrame:
    return accrual_rules.rule_counts(_validated(spark, sf).read("er_accrual_stg_error"))


def accrual_failed_log(spark: SparkSession, sf: str) -> DataFrame:
    """Every center twice, so that rule 1 fails: the log names the rule, and no errors are stored."""
    wh = _validated(spark, sf, profit_center_dim=lambda df: df.unionByName(df))
    log = wh.read("er_accural_log").join(wh.read("er_accrual_stg_error").select("er_accrual_load_num"), "er_accrual_load_num", "left_anti")
    return log.select("er_accrual_load_num", "status", F.substring_index("comments", " ", 1).alias("rule_id"), "file_id")


def accrual_null_type(spark: SparkSession, sf: str) -> DataFrame:
    """A NULL among the revenue types makes NOT IN true for no record."""
    t = derive(spark, sf, RECORDS, "er_accruals_revenue_type")
    types = t["er_accruals_revenue_type"]
    t["er_accruals_revenue_type"] = types.unionByName(types.limit(1).select(F.lit(None).cast("string").alias("short_code")))
    rows = accrual_rules.error_rows(t[RECORDS], t, load_num=LOAD_NUM, run_ts=F.lit(RUN_TS), rules=["V08", "V09", "V19"])
    return rows.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n_errors"))


def comparable(query: Query) -> Query:
    """The same rows with amounts as text, so that every digit and the declared scale are compared."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = query(spark, sf)
        return df.select(*[F.col(c).cast("string").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])

    return run


_ALL: dict[str, Query] = {
    "stage1_month_sums": _stage1,
    "stage1_refresh": stage1_refresh,
    "stage2_decode": stage2_decode,
    "stage2_lookups": stage2_lookups,
    "missing_profit_centers": missing_profit_centers,
    "fact_unpivot": fact_unpivot,
    "fact_dims": fact_dims,
    "fact_year_replace": fact_year_replace,
    "app_resolve": app_resolve,
    "contract_app1": _by_rule("section"),
    "contract_app10_prefix": _by_rule("prefix"),
    "contract_app10_suffix": _by_rule("suffix"),
    "contract_app13": _by_rule("ref", office=True),
    "contract_app14": _by_rule("budget"),
    "contract_generic": _by_rule("ref", office=False),
    "contract_fallback": contract_fallback,
    "contract_keys": contract_keys,
    "xref_codes": xref_codes,
    "business_class": business_class,
    "contract_class": contract_class,
    "budget_fact": whole_fact,
    "budget_by_class": budget_by_class,
    **{f"accrual_v{r[1:]}": _rule(r) for r in accrual_rules.RULES},
    "accrual_errors": accrual_errors,
    "accrual_rule_counts": accrual_rule_counts,
    "accrual_verdict": accrual_verdict,
    "accrual_file_errors": accrual_file_errors,
    "accrual_load": accrual_load_job,
    "accrual_audit_log": accrual_audit_log,
    "accrual_all_files": accrual_all_files,
    "accrual_failed_log": accrual_failed_log,
    "accrual_null_type": accrual_null_type,
    "contract_keys_latest_year": contract_keys_latest_year,
    "profit_center_conflicts": profit_center_conflicts,
    "fact_emptied_year": fact_emptied_year,
    "fact_class_update": fact_class_update,
    "member_rules": member_rules,
}

QUERIES: dict[str, Query] = {name: comparable(query) for name, query in _ALL.items()}
