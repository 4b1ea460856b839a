"""Contract keys of stage-2 rows.

The rules look only at the contract text and the profit center, so they run once per distinct
(year, contract, profit center) and the result goes back to the rows in a single join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ora import instr_last, mid, nz
from ..operators.lookup import attach

CONTRACT_KEYS = ["budget_year", "contract_dsc", "contract_decode", "profit_center_dsc"]

# Office number -> country suffix of the contract reference (fixed values).
OFFICE_COUNTRY = {
    "81": "ARG",
    "82": "CHL",
    "88": "VEN",
    "93": "COL",
    "94": "DOM",
    "95": "MIA",
    "96": "PER",
    "97": "",
    "98": "RIO",
}
# Offices whose reference joins the country without a hyphen (fixed values).
NO_HYPHEN_OFFICES = (82, 97)
# Contract texts whose section digit stands just before the last underscore (fixed value).
TAIL_SECTION = ".._........YY-..-..-..-._..."


# Contract texts that name no single contract: any character and NA at the end, or one of these beginnings, where a point
# stands for any character (fixed values).
NO_CONTRACT = r"(?s)^(?:CL.|Client|Unallocated|New.Client|Not.Available\z|.*.NA\z)"


# --- candidates and application ------------------------------------------------------------------


def candidates(stage_2: DataFrame) -> DataFrame:
    """Distinct contracts that name a single contract, with their decoded reference.

    One predicate names the text once: Spark copies the text's derivation into each reference it pushes down.
    """
    return stage_2.filter(~F.col("contract_dsc").rlike(NO_CONTRACT)).select(*CONTRACT_KEYS).distinct()


def profit_center_apps(tables: dict[str, DataFrame]) -> DataFrame:
    """Per profit-center description: its code, the code's number of applications, and all applications seen.

    A description with several codes takes the smallest for the count; ``profit_center_conflicts`` lists them.
    """
    xref = tables["er_dm_hyp_pc_xref"].select(F.col("er_hyperion_pc_dsc").alias("pc_dsc"), F.col("er_profit_center_code").alias("code"))
    xref = xref.dropna(subset=["pc_dsc"])
    apps = tables["er_pc_application_xref"].select(F.col("profit_code").alias("app_code"), F.col("dd_application_id").alias("app"))
    app = F.col("app")
    per_code = apps.dropna(subset=["app_code"]).groupBy("app_code").agg(
        F.count(F.lit(1)).alias("n_apps"),
        F.min(app).alias("app_low"),
        F.max(app).alias("app_high"),
        F.max(app == 13).alias("has_13"),
        F.max(app == 14).alias("has_14"),
    )
    seen = attach(xref, per_code, {"app_code": F.col("code")})
    return seen.groupBy("pc_dsc").agg(
        F.min(F.when(F.col("code").isNotNull(), F.struct("code", "n_apps", "app_low"))).alias("first"),
        F.min("app_low").alias("app_low"),
        F.max("app_high").alias("app_high"),
        F.max("has_13").alias("has_13"),
        F.max("has_14").alias("has_14"),
    )


def profit_center_conflicts(tables: dict[str, DataFrame]) -> DataFrame:
    """Profit-center descriptions that lead to more than one code."""
    by_dsc = tables["er_dm_hyp_pc_xref"].groupBy("er_hyperion_pc_dsc").agg(
        F.min("er_profit_center_code").alias("first_code"), F.max("er_profit_center_code").alias("last_code")
    )
    return by_dsc.filter(F.col("first_code") != F.col("last_code"))


def with_application(contracts: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Keep contracts of known profit centers and add ``app_id``.

    A profit center with exactly one application decides alone. Otherwise all applications of all the
    contract's profit centers decide, whatever their order: 13 before 14 (a contract whose first hyphen is
    at 14 goes to 1), then only 1 or only 10, else none.
    """
    rows = attach(contracts, profit_center_apps(tables), {"pc_dsc": F.col("profit_center_dsc")}, "inner")
    # A window holds the profit centers of one contract; its input is computed once.
    own = Window.partitionBy("budget_year", "contract_dsc")
    rows = rows.withColumns(
        {
            "all_low": F.min("app_low").over(own),
            "all_high": F.max("app_high").over(own),
            "any_13": F.max("has_13").over(own),
            "any_14": F.max("has_14").over(own),
        }
    )
    low, high = F.col("all_low"), F.col("all_high")
    moved = F.instr("contract_dsc", "-") == 14

    def one_or(app: int) -> Column:
        return F.when(moved, F.lit(1)).otherwise(F.lit(app)).cast("long")

    shared = (
        F.when(F.col("any_13"), one_or(13))
        .when(F.col("any_14"), one_or(14))
        .when((low == high) & low.isin(1, 10), low)
    )
    app = F.when(F.col("first.n_apps") == 1, F.col("first.app_low")).otherwise(shared)
    return rows.withColumn("app_id", app).drop("first", "app_low", "app_high", "has_13", "has_14", "all_low", "all_high", "any_13", "any_14")


# --- what each contract looks for ----------------------------------------------------------------


def with_positions(contracts: DataFrame) -> DataFrame:
    """Positions and parts of the two texts that several rules read, each computed once.

    ``c`` is the contract text, ``d`` its decoded reference.
    """
    c, d = F.col("contract_dsc"), F.col("contract_decode")
    rest = mid(d, 10, 8)
    out = contracts.withColumns(
        {
            "c_yy": F.instr(c, "YY"),
            "c_last": instr_last(c, "_"),
            "c_office": nz(mid(c, instr_last(c, "_", 2) + 1, 2)),
            "d_size": F.length(d),
            "d_hyphen": d.contains("-"),
            "d_head": mid(d, 1, 9),
            # third group: from position 10 to the next hyphen
            "d_middle": F.when(rest.contains("-"), F.substring_index(rest, "-", 1)).otherwise(F.lit("")),
            "d_tail": mid(F.substring_index(d, "-", -1), 1, 2),
        }
    )
    middle = F.col("d_middle")
    padded = F.when(F.length(middle) == 3, middle).otherwise(F.concat(F.lit("0"), middle))
    return out.withColumns({"d_middle": padded, "office_no": F.col("c_office").try_cast("decimal(38,10)")})


def zero_inserted(s: Column) -> Column:
    """Characters 1-9, a zero, characters 10-17."""
    return F.concat(mid(s, 1, 9), F.lit("0"), mid(s, 10, 8))


def section_reference() -> Column:
    """Reference searched by application 1."""
    c, d, last, tail = (F.col(n) for n in ("contract_dsc", "contract_decode", "c_last", "d_tail"))
    two = F.when(F.length(tail) == 2, tail).otherwise(F.concat(F.lit("0"), tail))
    rebuilt = F.concat("d_head", "d_middle", F.lit("-"), two, F.lit("-00"))
    # the section digit of the text replaces the reference's character 14
    mixed = F.concat_ws("", mid(d, 1, 13), mid(c, last - 1, 1), mid(d, 15, 3))
    return (
        F.when(c.rlike(TAIL_SECTION), zero_inserted(mixed))
        .when((F.col("d_size") == 17) & F.col("d_hyphen"), zero_inserted(d))
        .when(F.col("d_size").between(13, 15) & F.col("d_hyphen"), rebuilt)
        .otherwise(d)
    )


def year_mark_near_end() -> Column:
    """Whether YY starts 2 to 8 characters before the last underscore.

    A start before the text's beginning counts from its end, so texts with an early underscore, or none,
    also look at their last characters.
    """
    c, last = F.col("contract_dsc"), F.col("c_last")
    wrapped = F.concat(F.left(c, last - 1), F.lit("|"), F.right(c, F.lit(8) - last))
    return F.when(last >= 9, mid(c, last - 8, 8)).otherwise(wrapped).contains("YY")


def tail_suffix() -> Column:
    """Text between YY and the last underscore, padded to three characters when it is one or two long."""
    start = F.col("c_yy")
    size = F.col("c_last") - start - 2
    zeros = F.when(size == 1, "00").when(size == 2, "0").otherwise("")
    return F.concat(zeros, mid(F.col("contract_dsc"), start + 2, size))


def office_reference() -> Column:
    """Reference searched by application 13; NULL when the office is not a number."""
    d, office, number = (F.col(n) for n in ("contract_decode", "c_office", "office_no"))
    country = F.try_element_at(F.create_map(*[F.lit(v) for pair in OFFICE_COUNTRY.items() for v in pair]), office)
    joint = F.when(number.isin(*NO_HYPHEN_OFFICES), F.lit("")).otherwise(F.lit("-"))
    ref = F.concat_ws("", mid(d, 1, F.col("d_size") - 3), joint, country)
    return F.when(office.isNull() | number.isNotNull(), ref)


def with_search_keys(contracts: DataFrame) -> DataFrame:
    """Add the primary match (``kind``, ``key``, ``key2``) and the fallback matches of each contract."""
    rows = with_positions(contracts)
    d, app, near = F.col("contract_decode"), F.col("app_id"), F.col("near")
    rows = rows.withColumn("near", (app == 10) & year_mark_near_end())
    kind = (
        F.when(app == 1, "section").when(near, "prefix").when(app == 10, "suffix").when(app == 14, "budget").otherwise("ref")
    )
    sectioned = F.col("d_size").between(12, 15) & F.col("d_hyphen")
    rows = rows.withColumns({"kind": kind, "sectioned": sectioned})
    key = F.when(app == 1, section_reference()).when(app == 13, office_reference()).otherwise(d)
    sectioned = F.col("sectioned")
    rows = rows.withColumns(
        {
            "key": key,
            "key2": F.when(F.col("kind") == "suffix", tail_suffix()).otherwise(F.lit("-")),
            "back_kind": F.when(sectioned, "budget_section").otherwise("budget"),
            "back_key": F.when(sectioned, F.concat("d_head", "d_middle")).otherwise(d),
            "back_key2": F.when(sectioned, F.col("d_tail")).otherwise(F.lit("-")),
            "last_key": F.when(sectioned, d),
        }
    )
    return rows.drop("c_yy", "c_last", "c_office", "d_size", "d_hyphen", "d_head", "d_middle", "d_tail", "office_no", "near", "sectioned")


# --- what the contract dimension offers ----------------------------------------------------------


MATCH_KEYS = ["kind", "key", "key2"]


def match_index(dim: DataFrame, latest_year_only: bool = False) -> DataFrame:
    """(kind, key, key2, id), at most one row per kind and keys: all a contract can be matched on.

    One scan gives each contract one entry per kind. Entries of equal standing are counted first, then the best standing
    of each key is taken, so that the rows of a common key are reduced before they meet.

    ``section``: trimmed reference; the newest underwriting year that its untrimmed form has, of all rows of that year the
    largest id. ``prefix``: first six characters; the smallest suffix in the latest effective year, -2 when several rows
    have it, none when no row of that year has a suffix. ``suffix``: first six and next three characters; newest date, an
    open date being newest. ``ref``: exact reference with a date, -2 when several rows have it (with ``latest_year_only``
    only those of the newest year count). ``budget``: budget reference, latest effective year. ``budget_section`` and
    ``budget_uwy``: trimmed budget reference, with or without the section, newest underwriting year. Ties go to the largest id.
    """
    ref, eff, budget, uwy = (F.col(c) for c in ("contract_ref", "contract_eff_dt", "budget_ref", "under_writing_year"))
    year, trimmed, no, none = F.year(eff), F.trim(budget), F.lit("-"), F.lit(None).cast("string")

    def entry(kind: str, keep: Column, key: Column, key2: Column, rank: Column, open_: Column = F.lit(False), sub: Column = none, known: Column = F.lit(True)) -> Column:
        parts = {"kind": F.lit(kind), "key": key, "key2": key2, "open": open_, "rank": rank.cast("long"), "sub": sub, "known": known}
        return F.when(keep, F.struct(*[v.alias(k) for k, v in parts.items()]))

    entries = F.array(
        entry("section", uwy.isNotNull(), F.trim(ref), no, uwy, known=ref == F.trim(ref)),
        entry("prefix", year.isNotNull(), F.substring(ref, 1, 6), no, year, sub=nz(mid(ref, 7, 10))),
        entry("suffix", ref.isNotNull(), F.substring(ref, 1, 6), mid(ref, 7, 3), F.unix_seconds(eff.cast("timestamp")), open_=eff.isNull()),
        entry("ref", year.isNotNull(), ref, no, year),
        entry("budget", year.isNotNull(), budget, no, year),
        entry("budget_section", uwy.isNotNull(), trimmed, F.col("section_number"), uwy),
        entry("budget_uwy", uwy.isNotNull(), trimmed, no, uwy),
    )
    rows = dim.select(F.explode(entries).alias("e"), "contract_dim_id").select("e.*", "contract_dim_id")
    rows = rows.filter((F.col("key") != "") & (F.col("key2") != ""))
    alike = rows.groupBy(*MATCH_KEYS, "open", "rank", "sub").agg(F.count(F.lit(1)).alias("n"), F.max("contract_dim_id").alias("id"), F.max("known").alias("known"))
    standing = F.struct((~F.col("known")).alias("unknown"), (~F.col("open")).alias("closed"), (-F.col("rank")).alias("back"), F.col("sub").isNull().alias("bare"), "sub", "n", "id")
    best = alike.groupBy(*MATCH_KEYS).agg(F.min(standing).alias("b"), F.sum("n").alias("n"))
    kind = F.col("kind")
    found = best.filter(~((kind == "section") & F.col("b.unknown")) & ~((kind == "prefix") & F.col("b.bare")))
    counted = F.when(kind == "prefix", F.col("b.n")).when(kind == "ref", F.col("b.n") if latest_year_only else F.col("n")).otherwise(F.lit(1))
    return found.select(*MATCH_KEYS, F.when(counted > 1, F.lit(-2).cast("long")).otherwise(F.col("b.id")).alias("id"))


# --- putting both together -----------------------------------------------------------------------


def find_contracts(keyed: DataFrame, index: DataFrame) -> DataFrame:
    """Contracts with ``primary_id``, the application's own match (NULL: none, -2: ambiguous), and ``back_id``, the match
    on the budget reference that is tried when the primary one finds nothing.

    A contract asks for up to three keys; all are looked up in one join, so the index is computed and shuffled once. Keys that
    are NULL find nothing and are left out, but for the primary one, which keeps the contract.
    """
    asked = [
        F.struct(F.lit(slot).alias("slot"), kind.alias("kind"), key.alias("key"), key2.alias("key2"))
        for slot, (kind, key, key2) in enumerate(
            [
                (F.col("kind"), F.col("key"), F.col("key2")),
                (F.col("back_kind"), F.col("back_key"), F.col("back_key2")),
                (F.lit("budget_uwy"), F.col("last_key"), F.lit("-")),
            ]
        )
    ]
    about = [*CONTRACT_KEYS, "app_id", "back_kind"]
    wanted = F.filter(F.array(*asked), lambda a: (a["slot"] == 0) | (a["key"].isNotNull() & a["key2"].isNotNull()))
    rows = keyed.select(*about, F.explode(wanted).alias("asked"))
    side = index.withColumnsRenamed({"kind": "m_kind", "key": "m_key", "key2": "m_key2"})
    hits = attach(rows, side, {"m_kind": F.col("asked.kind"), "m_key": F.col("asked.key"), "m_key2": F.col("asked.key2")})
    of = [F.max(F.when(F.col("asked.slot") == i, F.col("id"))).alias(n) for i, n in enumerate(("primary_id", "back_id", "last_id"))]
    found = hits.groupBy(*about).agg(*of)
    back = F.col("back_id")
    retry = (F.col("back_kind") == "budget_section") & (back.isNull() | (back == -1))
    return found.withColumn("back_id", F.when(retry, F.col("last_id")).otherwise(back)).drop("last_id", "back_kind")


def resolve_contracts(contracts: DataFrame, tables: dict[str, DataFrame], latest_year_only: bool = False) -> DataFrame:
    """Contract keys of distinct contracts: (year, contract, profit center, app_id, contract_dim_id)."""
    index = match_index(tables["contract_dim"], latest_year_only)
    rows = find_contracts(with_search_keys(with_application(contracts, tables)), index)
    own = F.col("primary_id")
    found = F.when(own.isNull() | (own == -1), F.coalesce(F.col("back_id"), F.lit(-1))).otherwise(own)
    return rows.select(*CONTRACT_KEYS, "app_id", found.cast("long").alias("contract_dim_id"))


def contract_map(stage_2: DataFrame, tables: dict[str, DataFrame], latest_year_only: bool = False) -> DataFrame:
    """Contract key of every distinct contract in stage 2 that names one."""
    return resolve_contracts(candidates(stage_2), tables, latest_year_only)


def with_contract_keys(rows: DataFrame, contracts: DataFrame) -> DataFrame:
    """Bring the columns of a contract map back to stage-2 rows; rows outside the map get contract -1."""
    own = {f"m_{k}": F.coalesce(F.col(k), F.lit("")) if k == "contract_decode" else F.col(k) for k in CONTRACT_KEYS}
    side = contracts.withColumnsRenamed({k: f"m_{k}" for k in CONTRACT_KEYS})
    side = side.withColumn("m_contract_decode", F.coalesce("m_contract_decode", F.lit("")))
    found = {c: F.col(c) for c in contracts.columns if c not in CONTRACT_KEYS}
    found["contract_dim_id"] = F.coalesce("contract_dim_id", F.lit(-1).cast("long"))
    return attach(rows, side, own, add=found)
