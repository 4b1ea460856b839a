"""Accrual checks as DuckDB SQL, from the other side: every record is tested for what makes it valid, and what is not valid is an error.

One row per record holds the test of each rule; the errors are the rules whose test is not true. Known codes come as lists.
"""

from __future__ import annotations

from budgetloom.sources.fields import DESCRIPTORS, PROFIT_CENTER_PARTS, RECORD_FIELDS

from .fixtures import duck_ctes

_R = "er_selfservice_accrual_records"
# Account reference type by application; messages of the rules as (text before, value, text after) (fixed values).
_TYPES = {"G": "ACCCD", "T": "TACCD", "R": "RACCD", "F": "FACCD", "C": "CACCD"}
_MESSAGES = {
    "V01": ("Profit Center or R12 code ", "center", " does not exist"),
    "V02": ("Client Account Code", "accr_acct_code", " does not exists"),
    **{f"V0{i}": ("Client Account Code ", "accr_acct_code", " does not exists") for i in (3, 4, 6, 7)},
    "V05": ("Amount ", "accr_amt", " not Numeric"),
    "V08": ("Revenue Type ", "accr_revenue_code", " not valid (BSA, FEE, NCB, ACC, INS)"),
    "V09": ("Revenue Type  ", "accr_revenue_code", " not valid (BSA, FEE, ACC, INS)"),
    "V10": ("Underwriting Year ", "accr_underwriting_yr", " is invalid"),
    "V11": ("Revenue Source ", "c14", " not valid (N, P, R, O)"),
    "V12": ("Application ID ", "accr_app_id", " not valid (C, F, G, R, T)"),
    "V13": ("Original Currency Code ", "accr_org_ccy_code", " not found"),
    "V14": ("Accouting Period ", "accr_gl_period_mon_year", "is in wrong format"),
    "V15": ("Actual/Restate ", "accr_actual_restate", " not valid (Actual, Restate Acquisition, Restate Reclassification, Restate Other)"),
    "V16": ("Contract Ref ", "contract_ref", " not valid"),
    "V17": ("Business class dsc ", "business_class_dsc", " not valid"),
    "V18": ("Contract class dsc ", "contract_class_dsc", " not valid"),
    "V19": ("Cedent name ", "accr_client_name", " not valid"),
}


def _list(table: str, value: str) -> str:
    return f"(select coalesce(list(distinct {value}), []) from {table})"


def _account(app: str) -> str:
    """Valid: another application, or a known code; for R an account code that is missing or 1 passes too."""
    known = f"list_contains({_list('er_tp_references', 'gc_reference_type || chr(9) || tp_reference')}, '{_TYPES[app]}' || chr(9) || account)"
    return f"accr_app_id is distinct from '{app}' or {known}" + (" or coalesce(account, '1') = '1'" if app == "R" else "")


_RESTATED = "['RESTATE ACQUISITION', 'RESTATE RECLASSIFICATION', 'RESTATE OTHER']"
# A letter or one of these in front makes an amount invalid; hyphen and point, too, make a year invalid.
_FRONT = "A-Za-z=*$#@! _"


def _types(missing: str) -> str:
    return f"list_contains({_list('er_accruals_revenue_type', 'short_code')}, coalesce(accr_revenue_code, '{missing}'))"


_VALID = {
    "V01": f"""case when trim(r12_code) <> '' then list_contains({_list('profit_center_dim', 'hyperion_responsibility_center')}, r12_code) and trim(r12_code) = r12_code
      and exists (from er_gl_profit_center) else list_contains({_list('er_gl_profit_center', 'short_code')}, coalesce(r12_code, bare_center)) end""",
    "V02": _account("G"),
    "V03": _account("T"),
    "V04": _account("R"),
    "V05": f"not regexp_matches(accr_amt, '^[{_FRONT}]|[.].*[.]')",
    "V06": _account("F"),
    "V07": _account("C"),
    "V08": f"coalesce(restate_trimmed <> 'ACTUAL', true) or {_types('XXXX')}",
    "V09": f"not coalesce(list_contains({_RESTATED}, restate_trimmed), false) or {_types('xxxx')} and coalesce(accr_revenue_code <> 'NCB', true)",
    "V10": f"not regexp_matches(accr_underwriting_yr, '^[{_FRONT}.-]') and coalesce(length(bare_year) = 2, true)",
    "V11": "list_contains(['N', 'P', 'R', 'O'], trim(upper(c14)))",
    "V12": "case when trim(accr_app_id) = '' then true else list_contains(['C', 'F', 'G', 'R', 'T'], trim(accr_app_id)) end",
    "V13": f"list_contains({_list('(from er_currency_info where gc_currency_code <> $$XXX$$)', 'gc_currency_code')}, trim(accr_org_ccy_code))",
    "V14": "length(accr_gl_period_mon_year) = 7 and accr_gl_period_mon_year[3] = '-' and accr_gl_period_mon_year[:2] >= '01' and accr_gl_period_mon_year[:2] <= '12'",
    "V15": f"list_contains({_RESTATED} || ['ACTUAL'], upper(accr_actual_restate))",
    "V16": f"contract_ref is null or list_contains({_list('contract_dim', 'trim(gc_our_contract_ref)')}, bare_ref)",
    "V17": f"business_class_dsc is null or list_contains({_list('business_classification_dim', 'upper(busness_class_dsc)')}, upper(bare_business))",
    "V18": f"contract_class_dsc is null or list_contains({_list('contract_classification_dim', 'upper(contract_sub_type_dsc)')}, upper(bare_class))",
    "V19": "accr_client_name is not null",
}


def _bare(c: str) -> str:
    return f"nullif(trim(replace({c}, chr(39), '')), '')"


_TAIL = {t: f"contract_ref[:greatest(strpos(contract_ref, '{t}') - 2, 0)]" for t in ("MEX", "CHL")}
_CENTER = " || ".join(f"coalesce(rtrim({p}), '')" for p in PROFIT_CENTER_PARTS)
_BARE_CENTER = " || ".join(f"coalesce(rtrim(replace({p}, chr(39), '')), '')" for p in PROFIT_CENTER_PARTS)
_RECORDS = f"""records as (select *, coalesce(nullif({_CENTER}, ''), r12_code) as center, nullif({_BARE_CENTER}, '') as bare_center,
 {_bare("accr_acct_code")} as account, {_bare("accr_underwriting_yr")} as bare_year, trim(upper(accr_actual_restate)) as restate_trimmed,
 {_bare(f"case when suffix(contract_ref, 'MEX') then {_TAIL['MEX']} when suffix(contract_ref, 'CHL') then {_TAIL['CHL']} || 'CHL' else contract_ref end")} as bare_ref,
 {_bare("business_class_dsc")} as bare_business, {_bare("contract_class_dsc")} as bare_class from {_R})"""

_TABLES = {
    "V01": ["profit_center_dim", "er_gl_profit_center"],
    **{r: ["er_tp_references"] for r in ("V02", "V03", "V04", "V06", "V07")},
    "V08": ["er_accruals_revenue_type"],
    "V09": ["er_accruals_revenue_type"],
    "V13": ["er_currency_info"],
    "V16": ["contract_dim"],
    "V17": ["business_classification_dim"],
    "V18": ["contract_classification_dim"],
}


def _errors(rules: list[str], valid: dict[str, str] = _VALID) -> str:
    """Records with one row for each rule that they do not pass; a test that is not known has not been passed."""
    failed = ", ".join(f"case when not coalesce({valid[r]}, false) then {{'rule_id': '{r}', 'error_message': concat('{_MESSAGES[r][0]}', {_MESSAGES[r][1]}, '{_MESSAGES[r][2]}')}} end" for r in rules)
    return f"{_RECORDS},\nerrors as (select * exclude (failed, failure), failure.rule_id, failure.error_message from (select *, unnest(failed) as failure from (select *, [{failed}] as failed from records)) where failure is not null)"


def _query(rules: list[str], select: str, valid: dict[str, str] = _VALID) -> str:
    tables = dict.fromkeys([_R, *(t for r in rules for t in _TABLES.get(r, []))])
    return f"with {duck_ctes(*tables)},\n{_errors(rules, valid)}\n{select}"


_ALL = list(_MESSAGES)
_ALL.sort()
_FIELDS = ", ".join((*RECORD_FIELDS, *DESCRIPTORS, "r12_code", "pk_accr_recs_id"))
_LOADS = f"(select f, row_number() over (order by f) as load_num from (select distinct fk_accr_file_id as f from {_R}))"

ACCRUAL_SQL: dict[str, str] = {
    **{f"accrual_v{r[1:]}": _query([r], "select pk_accr_recs_id, fk_accr_file_id, error_message, rule_id from errors") for r in _ALL},
    "accrual_errors": _query(_ALL, f"select {_FIELDS}, error_message, rule_id, 7::bigint as er_accrual_load_num from errors"),
    "accrual_rule_counts": _query(_ALL, "select 7::bigint as er_accrual_load_num, rule_id, count(*) as n_errors from errors group by rule_id"),
    "accrual_verdict": _query(_ALL, "select 7::bigint as er_accrual_load_num, if(count(*) = 0, 'SUCCESS', 'ERROR') as status, count(*) as n_errors from errors"),
    "accrual_file_errors": _query(_ALL, "select fk_accr_file_id, rule_id, count(*) as n_errors from errors group by all"),
    "accrual_load": f"with {duck_ctes(_R)} select fk_accr_file_id, 'Pending' as status, user_id, count(*) as n_rows, count(*) as n_keys, count(accr_amt) as n_amounts from {_R} group by all",
    "accrual_audit_log": _query(_ALL, f"""select load_num as er_accrual_load_num, if(count(rule_id) = 0, 'SUCCESS', 'ERROR') as status, count(rule_id) || ' error rows' as comments
from {_LOADS} l left join errors e on e.fk_accr_file_id = l.f group by load_num"""),
    "accrual_all_files": _query(_ALL, f"select load_num as er_accrual_load_num, rule_id, count(*) as n_errors from errors e join {_LOADS} l on e.fk_accr_file_id = l.f group by all"),
    "accrual_failed_log": f"with {duck_ctes(_R)} select load_num as er_accrual_load_num, 'Error on validate' as status, 'V01' as rule_id, f as file_id from {_LOADS}",
    "accrual_null_type": _query(["V08", "V09", "V19"], "select rule_id, count(*) as n_errors from errors group by rule_id", {**_VALID, "V08": "true", "V09": "true"}),
}
