"""The 19 accrual checks as data: a condition over one record and a message.

Checks that ask "is this code known" read marker columns. Each marker comes from one left join with the
distinct known codes, shared by every check that needs it, so a file is read once whatever the number of
checks, and one record that fails k checks gives k error rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ora import bare, cat, delete, mid, nz
from ..operators.lookup import attach
from ..sources.fields import DESCRIPTORS, PROFIT_CENTER_PARTS, RECORD_FIELDS

# Account reference type of each application (fixed values).
ACCOUNT_TYPES = {"G": "ACCCD", "T": "TACCD", "R": "RACCD", "F": "FACCD", "C": "CACCD"}
APP_IDS = ("C", "F", "G", "R", "T")
REVENUE_SOURCES = ("N", "P", "R", "O")
RESTATED = ("RESTATE ACQUISITION", "RESTATE RECLASSIFICATION", "RESTATE OTHER")
RESTATE_VALUES = ("ACTUAL", *RESTATED)
LETTERS = tuple("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
# First characters that make an amount or an underwriting year invalid, besides letters (fixed values).
AMOUNT_MARKS = ("=", "*", "$", "#", "@", "!", " ", "_")
YEAR_MARKS = (*AMOUNT_MARKS, "-", ".")

TEXT_FIELDS = (*RECORD_FIELDS, *DESCRIPTORS, "r12_code")

Tables = dict[str, DataFrame]


# --- known codes ---------------------------------------------------------------------------------


def _has_rows(df: DataFrame) -> Column:
    return df.agg((F.count(F.lit(1)) > 0).alias("any")).scalar()


def mark_profit_center(df: DataFrame, t: Tables) -> DataFrame:
    """``ok_center``: the R12 code is a responsibility center, or the five parts are a known short code."""
    r12 = F.col("r12_code")
    parts = F.concat_ws("", *[F.rtrim(delete(F.col(p), "'")) for p in PROFIT_CENTER_PARTS])
    r12_keys = t["profit_center_dim"].select(F.lit("r12").alias("c_kind"), F.col("hyperion_responsibility_center").alias("c_key"))
    # a center with outer spaces never equals its own trimmed text, and without any short code no center is looked at
    r12_keys = r12_keys.filter((F.col("c_key") == F.trim("c_key")) & _has_rows(t["er_gl_profit_center"]))
    short_keys = t["er_gl_profit_center"].select(F.lit("short").alias("c_kind"), F.col("short_code").alias("c_key")).distinct()
    known = r12_keys.unionByName(short_keys).filter(F.col("c_key") != "").groupBy("c_kind", "c_key").agg(F.count(F.lit(1)).alias("c_n"))
    kind = F.when(F.trim(r12) != "", F.lit("r12")).otherwise(F.lit("short"))
    n = F.col("c_n")
    several = F.raise_error(F.concat(F.lit("V01: more than one profit center for R12 code "), r12)).cast("boolean")
    ok = F.when(n > 1, several).otherwise(n.isNotNull())
    return attach(df, known, {"c_kind": kind, "c_key": F.coalesce(r12, parts)}, add={"ok_center": ok})


def _marked(df: DataFrame, known: DataFrame, on: dict[str, Column], marks: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """Add the ``marks`` made from whether the key is among the known codes. '' is no code, so keys need no NULL for it."""
    present = reduce(and_, [F.col(c) != "" for c in known.columns])
    codes = known.filter(present).distinct().withColumn("_hit", F.lit(True))
    return attach(df, codes, on, add=marks(F.coalesce("_hit", F.lit(False))), spread=F.xxhash64(*df.columns))


def mark_account(df: DataFrame, t: Tables) -> DataFrame:
    known = t["er_tp_references"].select(F.col("gc_reference_type").alias("a_type"), F.col("tp_reference").alias("a_ref"))
    known = known.filter(F.col("a_type").isin(*ACCOUNT_TYPES.values()))
    kind = F.coalesce(*[F.when(F.col("accr_app_id") == app, F.lit(ref)) for app, ref in ACCOUNT_TYPES.items()])
    return _marked(df, known, {"a_type": kind, "a_ref": bare(F.col("accr_acct_code"))}, lambda hit: {"ok_account": hit})


def mark_revenue_type(df: DataFrame, t: Tables) -> DataFrame:
    """``bad_actual`` and ``bad_restated``: NOT IN the revenue types, with and without 'NCB'.

    A NULL in the list makes NOT IN true for nothing, so the markers are then false for every record.
    """
    types = t["er_accruals_revenue_type"].select(F.col("short_code").alias("t_code"))
    code = F.col("accr_revenue_code")
    key = F.coalesce(code, F.when(is_actual(), F.lit("XXXX")).otherwise(F.lit("xxxx")))
    listed = types.agg(F.coalesce(F.max(F.col("t_code").isNull()), F.lit(False))).scalar()
    return _marked(
        df, types, {"t_code": key}, lambda hit: {"bad_actual": ~hit & ~listed, "bad_restated": ~(hit & (key != "NCB")) & ~listed}
    )


def mark_currency(df: DataFrame, t: Tables) -> DataFrame:
    known = t["er_currency_info"].select(F.col("gc_currency_code").alias("y_code")).filter(F.col("y_code") != "XXX")
    return _marked(df, known, {"y_code": F.trim("accr_org_ccy_code")}, lambda hit: {"ok_currency": hit})


def bare_contract_ref(ref: Column) -> Column:
    """Reference without its country tail: a final MEX goes with the character before it, CHL only loses that character."""

    def head(tail: str) -> Column:
        return mid(ref, 1, F.instr(ref, tail) - 2)

    return bare(F.when(ref.endswith("MEX"), head("MEX")).when(ref.endswith("CHL"), F.concat(head("CHL"), F.lit("CHL"))).otherwise(ref))


def mark_contract(df: DataFrame, t: Tables) -> DataFrame:
    known = t["contract_dim"].select(F.trim("gc_our_contract_ref").alias("r_ref"))
    return _marked(df, known, {"r_ref": bare_contract_ref(F.col("contract_ref"))}, lambda hit: {"ok_contract": hit})


def mark_business_class(df: DataFrame, t: Tables) -> DataFrame:
    known = t["business_classification_dim"].select(F.upper("busness_class_dsc").alias("b_dsc"))
    return _marked(df, known, {"b_dsc": F.upper(bare(F.col("business_class_dsc")))}, lambda hit: {"ok_business": hit})


def mark_contract_class(df: DataFrame, t: Tables) -> DataFrame:
    known = t["contract_classification_dim"].select(F.upper("contract_sub_type_dsc").alias("k_dsc"))
    return _marked(df, known, {"k_dsc": F.upper(bare(F.col("contract_class_dsc")))}, lambda hit: {"ok_class": hit})


# --- the rules -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """``failed`` may be NULL, which counts as passed; ``mark`` adds the marker column the condition reads.

    ``message`` is the text before the value, the field with the value (None: the profit-center code), and
    the text after it.
    """

    id: str
    failed: Callable[[], Column]
    message: tuple[str, str | None, str]
    mark: Callable[[DataFrame, Tables], DataFrame] | None = None


def is_actual() -> Column:
    return F.trim(F.upper("accr_actual_restate")) == "ACTUAL"


def _center_code() -> Column:
    return F.coalesce(cat(*[F.rtrim(p) for p in PROFIT_CENTER_PARTS]), F.col("r12_code"))


def _first(field: str) -> Column:
    return F.upper(F.substring(field, 1, 1))


def _account_rule(id_: str, app: str, before: str = "Client Account Code ") -> Rule:
    def failed() -> Column:
        bad = (F.col("accr_app_id") == app) & ~F.col("ok_account")
        return bad & ~nz(bare(F.col("accr_acct_code"))).isin("1") if app == "R" else bad

    return Rule(id_, failed, (before, "accr_acct_code", " does not exists"), mark_account)


def _bad_amount() -> Column:
    amt = F.col("accr_amt")
    return amt.isNull() | _first("accr_amt").isin(*LETTERS, *AMOUNT_MARKS) | (F.regexp_count(amt, F.lit(r"\.")) > 1)


def _bad_year() -> Column:
    year = F.col("accr_underwriting_yr")
    return year.isNull() | _first("accr_underwriting_yr").isin(*LETTERS, *YEAR_MARKS) | (F.length(nz(bare(year))) != 2)


def _bad_period() -> Column:
    p = F.col("accr_gl_period_mon_year")
    return p.isNull() | (F.length(p) != 7) | (mid(p, 3, 1) != "-") | ~mid(p, 1, 2).between("01", "12")


def _bad_app() -> Column:
    app = F.col("accr_app_id")
    return app.isNull() | ~nz(F.trim(app)).isin(*APP_IDS)


def _unknown(field: str, marker: str) -> Callable[[], Column]:
    return lambda: F.col(field).isNotNull() & ~F.col(marker)


# Messages of the rules, spelling and spacing included (fixed values).
RULES: dict[str, Rule] = {
    r.id: r
    for r in (
        Rule("V01", lambda: ~F.col("ok_center"), ("Profit Center or R12 code ", None, " does not exist"), mark_profit_center),
        _account_rule("V02", "G", "Client Account Code"),
        _account_rule("V03", "T"),
        _account_rule("V04", "R"),
        Rule("V05", _bad_amount, ("Amount ", "accr_amt", " not Numeric")),
        _account_rule("V06", "F"),
        _account_rule("V07", "C"),
        Rule(
            "V08",
            lambda: is_actual() & F.col("bad_actual"),
            ("Revenue Type ", "accr_revenue_code", " not valid (BSA, FEE, NCB, ACC, INS)"),
            mark_revenue_type,
        ),
        Rule(
            "V09",
            lambda: F.trim(F.upper("accr_actual_restate")).isin(*RESTATED) & F.col("bad_restated"),
            ("Revenue Type  ", "accr_revenue_code", " not valid (BSA, FEE, ACC, INS)"),
            mark_revenue_type,
        ),
        Rule("V10", _bad_year, ("Underwriting Year ", "accr_underwriting_yr", " is invalid")),
        Rule(
            "V11",
            lambda: ~F.coalesce(F.trim(F.upper("c14")), F.lit(" ")).isin(*REVENUE_SOURCES),
            ("Revenue Source ", "c14", " not valid (N, P, R, O)"),
        ),
        Rule("V12", _bad_app, ("Application ID ", "accr_app_id", " not valid (C, F, G, R, T)")),
        Rule("V13", lambda: ~F.col("ok_currency"), ("Original Currency Code ", "accr_org_ccy_code", " not found"), mark_currency),
        Rule("V14", _bad_period, ("Accouting Period ", "accr_gl_period_mon_year", "is in wrong format")),
        Rule(
            "V15",
            lambda: F.col("accr_actual_restate").isNull() | ~F.upper("accr_actual_restate").isin(*RESTATE_VALUES),
            ("Actual/Restate ", "accr_actual_restate", " not valid (Actual, Restate Acquisition, Restate Reclassification, Restate Other)"),
        ),
        Rule("V16", _unknown("contract_ref", "ok_contract"), ("Contract Ref ", "contract_ref", " not valid"), mark_contract),
        Rule("V17", _unknown("business_class_dsc", "ok_business"), ("Business class dsc ", "business_class_dsc", " not valid"), mark_business_class),
        Rule("V18", _unknown("contract_class_dsc", "ok_class"), ("Contract class dsc ", "contract_class_dsc", " not valid"), mark_contract_class),
        Rule("V19", lambda: F.col("accr_client_name").isNull(), ("Cedent name ", "accr_client_name", " not valid")),
    )
}


def file_records(records: DataFrame, file_id: str | None) -> DataFrame:
    """Records of one file, or of every file when none is named."""
    return records if file_id is None else records.filter(F.col("fk_accr_file_id") == F.lit(file_id))


def error_message(rules: list[Rule]) -> Column:
    """Message of the row's ``rule_id``: one concatenation whose parts are chosen by rule."""

    def chosen(part: Callable[[Rule], Column]) -> Column:
        return reduce(lambda w, r: w.when(F.col("rule_id") == r.id, part(r)), rules[1:], F.when(F.col("rule_id") == rules[0].id, part(rules[0])))

    def text(position: int) -> Column:
        return F.element_at(F.create_map(*[F.lit(v) for r in rules for v in (r.id, r.message[position])]), F.col("rule_id"))

    value = chosen(lambda r: F.col(r.message[1]) if r.message[1] else _center_code())
    return F.concat_ws("", text(0), value, text(2))


def error_rows(
    records: DataFrame,
    tables: Tables,
    *,
    load_num: int | Column,
    run_ts: Column,
    file_id: str | None = None,
    rules: Iterable[str] | None = None,
    keep: tuple[str, ...] = (),
    place: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per record and failed rule, in the layout of the error table, with ``rule_id`` and the ``keep`` columns added.

    The load number is one for all, or a column of the records. An error of a rule itself raises, its text beginning with the rule's id.
    ``place`` distributes the rows that will be written: it is given each record once, with its failed rules beside it, since
    there are several error rows for a record.
    """
    chosen = [RULES[r] for r in (RULES if rules is None else rules)]
    number = load_num if isinstance(load_num, Column) else F.lit(load_num)
    rows = file_records(records, file_id).withColumn("_load_num", number.cast("long"))
    for mark in dict.fromkeys(r.mark for r in chosen if r.mark):
        rows = mark(rows, tables)
    ids = F.array_remove(F.array(*[F.when(r.failed(), F.lit(r.id)).otherwise(F.lit("")) for r in chosen]), "")
    # exploding the expression itself, or with records that fail nothing, keeps Spark from testing it in a filter first
    if place is None:
        failed = rows.withColumn("rule_id", F.explode(ids))
    else:
        failed = place(rows.withColumn("_failed", ids)).withColumn("rule_id", F.explode_outer("_failed")).filter(F.col("rule_id").isNotNull())
    return failed.select(
        *RECORD_FIELDS,
        error_message(chosen).alias("error_message"),
        run_ts.alias("error_dt"),
        F.col("_load_num").alias("er_accrual_load_num"),
        *DESCRIPTORS,
        *[F.lit(None).cast("string").alias(f"unused_{i}") for i in range(1, 6)],
        "r12_code",
        "rule_id",
        *keep,
    )


def rule_counts(errors: DataFrame) -> DataFrame:
    """Error rows per load and rule."""
    return errors.groupBy("er_accrual_load_num", "rule_id").agg(F.count(F.lit(1)).alias("n_errors"))


def verdict(errors: DataFrame, load_num: int) -> DataFrame:
    """One row for the load: SUCCESS without error rows, else ERROR, with their number."""
    n = F.col("n_errors")
    counted = errors.filter(F.col("er_accrual_load_num") == load_num).agg(F.count(F.lit(1)).alias("n_errors"))
    return counted.select(F.lit(load_num).cast("long").alias("er_accrual_load_num"), F.when(n == 0, "SUCCESS").otherwise("ERROR").alias("status"), n)
