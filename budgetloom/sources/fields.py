"""Column groups that both the table schemas and the plans name."""

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
AMOUNTS = tuple(f"{m}_budget_amt_usd" for m in MONTHS)

PROFIT_CENTER_PARTS = tuple(f"accr_gl_{p}_code" for p in ("entity", "location", "dept", "product", "business_seg"))
RECORD_FIELDS = (
    *PROFIT_CENTER_PARTS,
    "accr_gl_period_mon_year",
    "accr_org_ccy_code",
    "accr_client_name",
    "accr_amt",
    "accr_acct_code",
    "accr_revenue_code",
    "accr_app_id",
    "accr_underwriting_yr",
    "c14",
    "accr_actual_restate",
)
DESCRIPTORS = ("contract_ref", "business_class_dsc", "contract_class_dsc")
