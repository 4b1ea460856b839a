"""Job inputs derived from the test tables, as SQL text that Spark and DuckDB both run unchanged.

``{orders}`` and the like stand for the test tables. Amounts, texts and keys all come from the rows, so
every derived table but the few code lists grows with the test data.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from budgetloom.sources.fields import MONTHS
from budgetloom.sources.warehouse import Warehouse

YEARS = list(range(1995, 2002))


def _pad(n: int, key: str = "c_custkey") -> str:
    return f"lpad(cast({key} as varchar(20)), {n}, '0')"


_MEMBER = f"""case cast(c_custkey % 10 as int)
  when 0 then concat('CL_', cast(c_custkey as varchar(20)), '_NA')
  when 1 then concat('CO_', cast(c_custkey as varchar(20)), '_NA')
  when 2 then concat('CO_', {_pad(6)}, 'YY01_', cast(c_custkey % 97 as varchar(20)), '_', cast(c_custkey as varchar(20)))
  when 3 then concat('CO_', {_pad(8)}, 'YY-01-02-03-1_', case when c_acctbal > 4000 then lpad(cast(c_custkey % 1000 as varchar(20)), 3, '0') else '7' end, '_', cast(c_custkey as varchar(20)))
  when 4 then concat('CO_', {_pad(6)}, '_', cast(c_custkey as varchar(20)))
  when 5 then concat('CO_', {_pad(6)}, '-MX_', cast(81 + c_custkey % 18 as varchar(20)), '_1_', cast(c_custkey as varchar(20)))
  when 6 then concat('Line (A) ', cast(c_custkey as varchar(20)))
  when 7 then case when c_acctbal > 5000 then concat('A&B-', cast(c_custkey as varchar(20)))
    when c_acctbal > 2000 then concat('CO_', {_pad(6)}, 'YYabc_XL-9-1-4_', cast(c_custkey as varchar(20)))
    else concat('CO_', {_pad(6)}, '-MX_ZZ_1_', cast(c_custkey as varchar(20))) end
  when 8 then case when c_mktsegment = 'BUILDING' then 'Unallocated' when c_mktsegment = 'MACHINERY' then 'No_Customer'
    when c_mktsegment = 'HOUSEHOLD' then concat('Client_', cast(c_custkey as varchar(20)), '_', cast(c_custkey as varchar(20)))
    else concat('CO_', {_pad(8)}, '-12-3_x_', cast(c_custkey as varchar(20))) end
  else concat('CO_ABY', cast(c_custkey % 10 as varchar(20)), 'YY7_', cast(c_custkey % 97 as varchar(20)), '_', cast(c_custkey as varchar(20))) end"""

_AMOUNTS = ",\n ".join(
    f"case when l.mon = {i} then l.amt end as {m}_amt"
    for i, m in enumerate(MONTHS, 1)
)

FIXTURES: dict[str, str] = {
    "clvr_level0_extract": f"""select c.entity as clvr_entity_mbr, c.member as clvr_contract_mbr,
 l.account as clvr_account_mbr,
 case when l.l_linenumber = 6 then 'Local' else 'Reporting_USD' end as clvr_currency_type_mbr,
 case when l.l_tax > 0.07 then 'Actual' else 'Budget' end as clvr_scenario_mbr,
 'Final' as clvr_version_mbr, l.tag as clvr_fiscal_year_mbr,
 {_AMOUNTS}
from (select l_orderkey, l_linenumber, l_tax, month(l_shipdate) as mon, concat('FY', substring(cast(year(l_shipdate) as varchar(4)), 3, 2)) as tag,
  case when l_linenumber = 7 then 'FX_Gain' else concat('ACCT_', l_returnflag, l_linestatus) end as account,
  cast(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(18,3)) as decimal(18,5)) as amt from {{lineitem}}) l
 join {{orders}} o on l.l_orderkey = o.o_orderkey
 join (select c_custkey, concat('PC~', cast(c_nationkey as varchar(10))) as entity, {_MEMBER} as member from {{customer}}) c on o.o_custkey = c.c_custkey""",
    "er_budget_revenue_type_xref": """select concat('ACCT_', l_returnflag, l_linestatus) as er_budget_revenue_type_code,
 case when l_returnflag = 'A' and l_linestatus = 'F' then null else concat('S', l_returnflag) end as fk_er_source_code,
 concat('R', l_linestatus) as fk_er_revenue_type_code, concat('T', l_returnflag, l_linestatus) as fk_er_transaction_type_code
from (select distinct l_returnflag, l_linestatus from {lineitem}) x where not (l_returnflag = 'R' and l_linestatus = 'O')""",
    "er_dm_hyp_pc_xref": """select concat(' PC~', cast(n_nationkey as varchar(10)), ' ') as er_hyperion_pc_dsc, concat('P', cast(n_nationkey as varchar(10))) as er_profit_center_code,
  n_name as er_profit_center_dsc, 'Y' as active_ind from {nation} where n_regionkey <> 4
union all select concat('PC~', cast(n_nationkey as varchar(10))), concat('Q', cast(n_nationkey as varchar(10))), n_name, case when n_regionkey = 1 then 'N' end from {nation}
union all select concat('PC,', cast(n_nationkey as varchar(10))), concat('P', cast(n_nationkey as varchar(10))), n_name, 'N' from {nation} where n_nationkey <> 20
union all select concat('PC,', cast(n_nationkey as varchar(10))), concat('P', cast(n_nationkey + 1 as varchar(10))), n_name, 'Y' from {nation} where n_nationkey in (7, 16)""",
    "er_pc_application_xref": """select concat('P', cast(n_nationkey as varchar(10))) as profit_code,
 cast(case n_nationkey % 7 when 0 then 1 when 1 then 10 when 2 then 13 when 3 then 14 when 4 then 1 when 5 then 1 else 22 end as bigint) as dd_application_id
from {nation} where n_nationkey <> 19
union all select concat('P', cast(n_nationkey as varchar(10))), cast(case n_nationkey when 22 then 10 when 21 then 1 when 4 then 13 when 11 then 13 when 18 then 10 else 14 end as bigint)
from {nation} where n_nationkey in (4, 5, 11, 12, 18, 21, 22)""",
    "source_dim": """select cast(case l_returnflag when 'A' then null else ascii(l_returnflag) end as bigint) as source_dim_id, concat('S', l_returnflag) as source_code
from (select distinct l_returnflag from {lineitem}) x where l_returnflag <> 'N'""",
    "revenue_type_dim": """select cast(ascii(l_linestatus) as bigint) as revenue_type_id, concat('R', l_linestatus) as revenue_type_code from (select distinct l_linestatus from {lineitem}) x
union all select cast(999 as bigint), '-1'""",
    "transaction_dim": """select cast(ascii(l_returnflag) * 100 + ascii(l_linestatus) as bigint) as transaction_dim_id, concat('T', l_returnflag, l_linestatus) as transaction_type_code
from (select distinct l_returnflag, l_linestatus from {lineitem}) x where l_returnflag <> 'A'""",
    "trading_partner_dim": """select c_custkey + 100000 as tp_dim_id, c_custkey as tp_id, cast(floor(c_custkey / 3) as bigint) * 10 as tp_ult_parent_id from {customer} where c_acctbal > -200
union all select c_custkey + 50000000, c_custkey, cast(null as bigint) from {customer} where c_acctbal > 5000""",
    "profit_center_dim": """select cast(n_nationkey + 700 as bigint) as profit_center_dim_id, concat('P', cast(n_nationkey as varchar(10))) as profit_code,
 concat('R12_', cast(n_nationkey as varchar(10))) as hyperion_responsibility_center from {nation} where n_nationkey <> 3""",
    "contract_dim": f"""select c_custkey * 10 + k as contract_dim_id,
 case cast(c_custkey % 10 as int)
  when 2 then concat({_pad(6)}, case when k = 0 then '001' else '002' end)
  when 3 then concat({_pad(8)}, case when c_acctbal > 4000 then '-001-01-03' else '-001-02-03' end, case when k = 1 then ' ' else '' end)
  when 4 then case when k = 0 then {_pad(6)} else concat({_pad(6)}, '00O') end
  when 5 then concat({_pad(6)}, '-MX', case 81 + c_custkey % 18 when 81 then '-ARG' when 82 then 'CHL' when 88 then '-VEN' when 93 then '-COL' when 94 then '-DOM'
    when 95 then '-MIA' when 96 then '-PER' when 97 then '' when 98 then '-RIO' else '-' end)
  when 8 then concat({_pad(8)}, '-012-03-00')
  when 9 then concat('ABY9YY7', case when k = 0 then '' else cast(c_custkey as varchar(20)) end)
  else {_pad(6)} end as contract_ref,
 case cast(c_custkey % 10 as int)
  when 3 then concat({_pad(8)}, '-01-02-03')
  when 5 then case k when 0 then concat({_pad(6)}, '-MX_', cast(81 + c_custkey % 18 as varchar(20))) else concat({_pad(6)}, '-MX0 ') end
  when 7 then concat({_pad(6)}, case when c_acctbal > 2000 then '' else '-MX_ZZ' end)
  when 8 then case when c_acctbal > 6000 then concat({_pad(8)}, '-12-3') else concat({_pad(8)}, '-012') end
  else {_pad(6)} end as budget_ref,
 concat({_pad(6)}, case when c_mktsegment = 'BUILDING' then ' ' else '' end, case when c_acctbal > 7000 then 'CHL' else '' end) as gc_our_contract_ref,
 case when c_custkey % 10 = 5 then 'MX' when c_custkey % 10 = 8 and k = 0 then '3' else lpad(cast(k as varchar(1)), 2, '0') end as section_number,
 case when k = 2 and c_acctbal < 1000 then null else 2020 + cast((c_custkey + k) % 4 as int) end as under_writing_year,
 case when k = 2 and c_acctbal > 3000 then null else make_date(2020 + cast((c_custkey * k) % 3 as int), 1 + k, 1) end as contract_eff_dt,
 c_custkey * 100 + k as dd_er_section_id, c_custkey as er_contract_id
from (select *, 0 as k from {{customer}} union all select *, 1 as k from {{customer}} where c_mktsegment <> 'BUILDING'
 union all select *, 2 as k from {{customer}} where c_mktsegment not in ('BUILDING', 'MACHINERY')) ks""",
    "er_contract_section": """select c_custkey * 100 + k as er_contract_section_id, case when c_acctbal > 9500 then c_custkey + 1 else c_custkey end as fk_er_contract_id, concat('CV_', c_mktsegment) as fk_gc_cover_type
from (select *, 0 as k from {customer} union all select *, 1 as k from {customer}) ks where c_acctbal > 0""",
    "er_contract_section_class": """select c_custkey * 100 + k as fk_er_contract_section_id, concat('CB_', c_mktsegment) as fk_gc_class_of_business
from (select *, 0 as k from {customer} union all select *, 1 as k from {customer}) ks where c_acctbal < 9000""",
    "er_contract": "select c_custkey as er_contract_id from {customer} where c_acctbal > 500",
    "business_classification_dim": """select min(c_custkey) + 3000000 as business_classification_dim_id, concat('RB_', c_mktsegment) as busness_class_code, concat('Class ', lower(c_mktsegment)) as busness_class_dsc
from {customer} group by c_mktsegment""",
    "contract_classification_dim": """select min(c_custkey) + 4000000 as contract_classification_dim_id, concat('RC_', c_mktsegment) as contract_sub_type_code, concat('Cover ', c_mktsegment) as contract_sub_type_dsc
from {customer} group by c_mktsegment""",
    "er_gc_class_of_business": "select min(c_custkey) as tbl_code_id, concat('CB_', c_mktsegment) as short_code from {customer} group by c_mktsegment",
    "er_revenue_dm_business_class": "select min(c_custkey) + 1000000 as tbl_code_id, concat('RB_', c_mktsegment) as short_code from {customer} group by c_mktsegment",
    "er_gc_cover_type": "select min(c_custkey) as tbl_code_id, concat('CV_', c_mktsegment) as short_code from {customer} group by c_mktsegment",
    "er_revenue_dm_contract_subtype": "select min(c_custkey) + 2000000 as tbl_code_id, concat('RC_', c_mktsegment) as short_code from {customer} group by c_mktsegment",
    "er_cross_reference": """select cast(1 as bigint) as fk_tbl_name_id_from, cast(2 as bigint) as fk_tbl_name_id_to, min(c_custkey) as fk_tbl_code_id_from, min(c_custkey) + 1000000 as fk_tbl_code_id_to
from {customer} where c_mktsegment <> 'FURNITURE' group by c_mktsegment
union all select cast(3 as bigint), cast(4 as bigint), min(c_custkey), min(c_custkey) + 2000000 from {customer} where c_mktsegment <> 'AUTOMOBILE' group by c_mktsegment""",
    "er_tbl_name": """select cast(1 as bigint) as tbl_name_id, 'ER_GC_CLASS_OF_BUSINESS' as tbl_name_physical union all select cast(2 as bigint), 'ER_REVENUE_DM_BUSINESS_CLASS'
union all select cast(3 as bigint), 'ER_GC_COVER_TYPE' union all select cast(4 as bigint), 'ER_REVENUE_DM_CONTRACT_SUBTYPE'""",
    "er_gl_profit_center": """select concat('01', lpad(cast(n_nationkey as varchar(10)), 2, '0'), 'D', cast(n_regionkey as varchar(10)), 'PRS') as short_code from {nation}""",
    "er_tp_references": """select 'ACCCD' as gc_reference_type, cast(c_custkey as varchar(20)) as tp_reference from {customer} where c_mktsegment <> 'BUILDING'
union all select 'TACCD', cast(c_custkey as varchar(20)) from {customer} where c_mktsegment <> 'MACHINERY'
union all select 'RACCD', cast(c_custkey as varchar(20)) from {customer} where c_mktsegment <> 'FURNITURE'
union all select 'FACCD', cast(c_custkey as varchar(20)) from {customer} where c_mktsegment <> 'HOUSEHOLD'
union all select 'CACCD', cast(c_custkey as varchar(20)) from {customer} where c_mktsegment <> 'AUTOMOBILE'
union all select 'OTHER', cast(c_custkey as varchar(20)) from {customer}""",
    "er_currency_info": "select 'USD' as gc_currency_code union all select 'EUR' union all select 'XXX'",
    "er_accruals_revenue_type": "select 'BSA' as short_code union all select 'FEE' union all select 'NCB' union all select 'ACC' union all select 'INS'",
    "er_selfservice_accrual_records": f"""select o_orderkey as pk_accr_recs_id, substring(o_orderpriority, 1, 1) as fk_accr_file_id, substring(o_orderpriority, 1, 1) as file_id, concat('user', o_orderstatus) as user_id,
 case cast(o_orderkey % 9 as int) when 0 then null when 1 then 'X' when 2 then '   ' when 3 then 'G' when 4 then 'T' when 5 then 'R' when 6 then 'C' when 7 then ' G' else 'F' end as accr_app_id,
 case cast(o_orderkey % 11 as int) when 0 then null when 1 then '1' when 2 then concat('''', cast(o_custkey as varchar(20)), ' ') else cast(o_custkey as varchar(20)) end as accr_acct_code,
 case cast(o_orderkey % 13 as int) when 0 then null when 1 then 'N/A' when 2 then '1.2.3' when 3 then ' 5' when 4 then '-7' when 5 then '12abc' else cast(cast(o_totalprice as decimal(18,2)) as varchar(30)) end as accr_amt,
 case cast(o_orderkey % 8 as int) when 0 then '''''' when 1 then null when 2 then '2019' when 3 then '1A' when 4 then '-1' else substring(cast(year(o_orderdate) as varchar(4)), 3, 2) end as accr_underwriting_yr,
 case cast(o_orderkey % 10 as int) when 0 then null when 1 then '13-2020' when 2 then '0A-2020' when 3 then '1' when 4 then ' ' else concat(lpad(cast(month(o_orderdate) as varchar(2)), 2, '0'), '-', cast(year(o_orderdate) as varchar(4))) end as accr_gl_period_mon_year,
 case cast(o_orderkey % 6 as int) when 0 then ' Actual ' when 1 then null when 2 then 'Restate Other' when 3 then 'restate acquisition' when 4 then 'Other' else 'ACTUAL' end as accr_actual_restate,
 case cast(o_orderkey % 5 as int) when 0 then 'NCB' when 1 then null when 2 then 'ZZZ' when 3 then 'BSA' else 'FEE' end as accr_revenue_code,
 case cast(o_custkey % 7 as int) when 0 then null when 1 then ' p ' when 2 then 'X' when 3 then '  ' when 4 then 'R' else 'N' end as c14,
 case cast(o_custkey % 6 as int) when 0 then null when 1 then ' EUR ' when 2 then 'XXX' when 3 then 'ZZZ' else 'USD' end as accr_org_ccy_code,
 case when o_orderstatus = 'P' and o_totalprice < 100000 then null else concat('Client ', cast(o_custkey as varchar(20))) end as accr_client_name,
 case when o_orderstatus = 'F' then '''01''' else '01  ' end as accr_gl_entity_code, lpad(cast(o_custkey % 30 as varchar(20)), 2, '0') as accr_gl_location_code,
 case when o_orderstatus = 'O' then null else 'D' end as accr_gl_dept_code, concat('''', cast(o_custkey % 5 as varchar(20)), 'P ') as accr_gl_product_code, 'RS' as accr_gl_business_seg_code,
 case cast(o_orderkey % 12 as int) when 0 then concat('R12_', cast(o_custkey % 30 as varchar(20))) when 1 then concat(' R12_', cast(o_custkey % 30 as varchar(20))) when 2 then '   ' else null end as r12_code,
 case cast(o_orderkey % 7 as int) when 0 then null when 1 then concat({_pad(6, "o_custkey")}, '-MEX') when 2 then concat({_pad(6, "o_custkey")}, '-CHL') when 3 then concat('''', {_pad(6, "o_custkey")}, '''') when 4 then 'MEX' when 5 then 'ab' else {_pad(6, "o_custkey")} end as contract_ref,
 case when o_orderstatus = 'F' then 'class BUILDING' when o_orderstatus = 'P' then concat('''Class household'' ', case when o_totalprice > 200000 then 'x' else '' end) end as business_class_dsc,
 case when o_orderstatus = 'O' then 'cover machinery' when o_orderstatus = 'P' then 'Cover none' end as contract_class_dsc
from {{orders}}""",
}


# Members whose rules the extract above does not reach: four characters behind NA, orphans, and clients with decimals.
MEMBER_RULES = """select concat(case cast(c_custkey % 5 as int) when 0 then concat('ab_NA', lpad(cast(c_custkey % 10000 as varchar(20)), 4, '0')) when 1 then concat('CO_Orphan', cast(c_custkey as varchar(20)), '_5')
 when 2 then concat('CO_', lpad(cast(c_custkey as varchar(20)), 6, '0'), '_', cast(c_custkey % 89 as varchar(20)), '.5') when 3 then concat('CO_12YY', cast(c_custkey as varchar(20)), '_x_7') else concat('CO_', lpad(cast(c_custkey as varchar(20)), 9, '0'), 'YY-1-2_', cast(c_custkey % 7 as varchar(20)), '_8') end, '') as member
from {customer}"""


#: Short code lists summed up from large tables. They are stored as they are derived, as those of the jobs are: Spark takes
#: a plan over the sum itself for nearly as large as its source, and would shuffle every wide row to look up a few codes.
CODE_LISTS = (
    "er_budget_revenue_type_xref",
    "source_dim",
    "revenue_type_dim",
    "transaction_dim",
    "business_classification_dim",
    "contract_classification_dim",
    "er_gc_class_of_business",
    "er_revenue_dm_business_class",
    "er_gc_cover_type",
    "er_revenue_dm_contract_subtype",
    "er_cross_reference",
)


def scratch(spark: SparkSession) -> Warehouse:
    """A fresh folder for what a query stores, below the session's warehouse."""
    return Warehouse(spark, f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/budgetloom-{uuid.uuid4().hex}")


def derive(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named job inputs as DataFrames over the test tables of ``sf_dir``."""
    used = {t for n in names for t in re.findall(r"\{(\w+)\}", FIXTURES[n])}
    base = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in sorted(used)}
    out = {n: spark.sql(FIXTURES[n], **{t: base[t] for t in re.findall(r"\{(\w+)\}", FIXTURES[n])}) for n in names}
    lists = scratch(spark)
    return {n: lists.store(n, df.coalesce(1)) if n in CODE_LISTS else df for n, df in out.items()}


def duck_ctes(*names: str) -> str:
    """The same inputs as the head of a DuckDB query."""
    tables = {t: t for n in names for t in re.findall(r"\{(\w+)\}", FIXTURES[n])}
    return ",\n".join(f"{n} as ({FIXTURES[n].format(**tables)})" for n in names)
