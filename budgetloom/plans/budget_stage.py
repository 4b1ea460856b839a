"""Planning extract -> stage 1 (member parsing, month sums) -> stage 2 (client, contract, code lookups)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ora import delete, instr_last, mid, nz, to_whole
from ..operators.lookup import attach, lookup
from ..sources.fields import AMOUNTS, MONTHS

MONEY = T.DecimalType(38, 2)


def as_years(years: int | Iterable[int]) -> list[int]:
    """One year or several; two years with the same two last digits cannot be told apart in the extract."""
    out = [years] if isinstance(years, int) else sorted(set(years))
    if not out or len({y % 100 for y in out}) != len(out):
        raise ValueError(f"years must be given and differ in their last two digits: {out}")
    return out


def fiscal_tag(year: int) -> str:
    return "FY" + str(year)[-2:]


# Character sets and words of the member parsing rules (fixed values).
SPECIAL = r"[:^\\().&]"
MARKS_AND_LETTERS = r"[:^_\\().a-zA-Z&-]"
LETTERS_AND_SEPARATORS = r"[:^a-zA-Z_]"
UPPERCASE_OR_COLON = r"[:A-Z]"
NO_CONTRACT_MEMBER = SPECIAL + r"|^No_Customer\z|^Unallocated\z|^Client"

# Spark copies the text of a derived column into every filter it pushes below it, so the expressions here
# name their input as few times as they can.


def client_name(m: Column) -> Column:
    """Client part of a contract member."""
    after_last = F.substring_index(m, "_", -1)
    name = (
        F.when(m.like("%_NA") | m.like("%_NA____"), F.regexp_replace(m, LETTERS_AND_SEPARATORS, ""))
        .when(m.rlike(SPECIAL) & ~m.like("%(_)%"), F.trim(F.regexp_replace(m, MARKS_AND_LETTERS, "")))
        .otherwise(after_last)
    )
    return nz(name)


def contract_dsc(m: Column) -> Column:
    """Contract part of a contract member: what stands before the last underscore."""
    last = instr_last(m, "_")
    before_last = F.when(last > 1, mid(m, 1, last - 1))
    return F.when(m.like("%_NA"), m).when(m.rlike(NO_CONTRACT_MEMBER), F.lit("Not_Available")).otherwise(before_last)


def budget_lines(extract: DataFrame, years: int | Iterable[int]) -> DataFrame:
    """Extract rows of the final reporting-currency budget, with ``budget_year``. The filters reach the scan."""
    tags = {fiscal_tag(y): y for y in as_years(years)}
    entity, contract, account = (F.col(f"clvr_{c}_mbr") for c in ("entity", "contract", "account"))
    year = F.coalesce(*[F.when(F.col("clvr_fiscal_year_mbr") == t, F.lit(y)) for t, y in tags.items()])
    return (
        extract.filter(F.col("clvr_currency_type_mbr") == "Reporting_USD")
        .filter(F.col("clvr_scenario_mbr") == "Budget")
        .filter(F.col("clvr_version_mbr") == "Final")
        .filter(F.col("clvr_fiscal_year_mbr").isin(*tags))
        .filter(~entity.isin("No_GC_Entity", ""))
        .filter((contract != "No_Customer") & (contract != ""))
        .filter(~account.startswith("FX") & (account != ""))
        .withColumn("budget_year", year)
    )


def stage1(extract: DataFrame, years: int | Iterable[int]) -> DataFrame:
    """Twelve month sums per (year, contract, entity, account), with the member split into client and contract."""
    keys = ["budget_year", "clvr_contract_mbr", "clvr_entity_mbr", "clvr_account_mbr"]
    # the cast to two decimals rounds half away from zero
    sums = [F.sum(f"{m}_amt").cast(MONEY).alias(a) for m, a in zip(MONTHS, AMOUNTS)]
    member = F.col("clvr_contract_mbr")
    return (
        budget_lines(extract, years)
        .groupBy(*keys)
        .agg(*sums)
        .select(
            "budget_year",
            F.lit("T").alias("source_type"),
            F.col("clvr_entity_mbr").alias("profit_center_dsc"),
            client_name(member).alias("hyperion_client_name"),
            contract_dsc(member).alias("contract_dsc"),
            F.col("clvr_account_mbr").alias("hyperion_revenue_type"),
            *AMOUNTS,
        )
    )


def client_code(source_type: Column, name: Column) -> Column:
    """Numeric client, or -2 for a client that is grouped, new, missing or spelled out. Never NULL.

    Names that start with All, Strategic or New need no test of their own: they hold an uppercase letter.
    """
    unknown = F.raise_error(F.concat_ws(" ", F.lit("unknown source type:"), source_type)).cast("long")
    known_type = F.coalesce(source_type, F.lit("")).isin("T", "F")
    number = F.when(~name.rlike(UPPERCASE_OR_COLON), to_whole(name))
    return F.coalesce(F.when(~known_type, unknown), number, F.lit(-2).cast("long"))


# Text before the last underscore.
BEFORE_LAST_UNDERSCORE = r"(?s)^(.*)_"
# A text whose last two hyphens (or its start and only hyphen) enclose one character.
ONE_BETWEEN_HYPHENS = r"(?s)^((?:.*-)?)([^-])(-[^-]*)$"


def with_contract_decode(df: DataFrame) -> DataFrame:
    """Add ``contract_decode``, the contract reference written inside ``contract_dsc``.

    The cases apply only to texts that start with CO_, so the first underscore is at position 3 and the
    text after it starts at position 4.
    """
    c = F.col("contract_dsc")
    df = df.withColumns({"_yy": F.instr(c, "YY"), "_size": F.length(c)})
    yy, size, body = F.col("_yy"), F.col("_size"), mid(c, 4)
    long_text = (yy > 0) & (size >= 20)
    four_hyphens = size - F.length(delete(c, "-")) == 4

    # other long texts: without YY, up to the last underscore, a lone character between hyphens gets a zero in front
    bare = F.when((size >= 22) & c.contains("YY-"), F.replace(body, F.lit("YY-"), F.lit("-"))).otherwise(delete(body, "YY"))
    padded = F.regexp_replace(F.regexp_extract(bare, BEFORE_LAST_UNDERSCORE, 1), ONE_BETWEEN_HYPHENS, "$10$2$3")

    no_reference = ~c.startswith("CO_") | c.like("%_NA") | c.contains("Orphan")
    decode = (
        F.when(no_reference, F.lit("-1"))
        .when((yy > 9) & (size < 20), mid(c, 4, yy - 4))
        .when(long_text & four_hyphens, F.substring_index(delete(body, "YY"), "-", 4))
        .when(long_text, padded)
        .when((yy == 0) & (size == 9), delete(c, "CO_"))
        .otherwise(mid(c, 4, instr_last(c, "_") - 4))
    )
    return df.withColumn("_decode", decode).withColumn("contract_decode", nz(F.col("_decode"))).drop("_yy", "_size", "_decode")


def profit_center_codes(tables: dict[str, DataFrame]) -> DataFrame:
    """Active profit-center code per trimmed description; two different codes for one description are flagged."""
    x = tables["er_dm_hyp_pc_xref"].filter(F.col("active_ind") == "Y")
    code = F.coalesce(nz(F.col("er_profit_center_code")), F.lit("-1"))
    rows = x.select(nz(F.trim("er_hyperion_pc_dsc")).alias("pc_key"), code.alias("code")).dropna(subset=["pc_key"])
    return rows.groupBy("pc_key").agg(F.min("code").alias("pc_low"), F.max("code").alias("pc_high"))


def with_profit_center_code(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Add ``profit_center_code``, '-1' when the description is unknown."""
    low, high = F.col("pc_low"), F.col("pc_high")
    clash = F.raise_error(F.concat_ws(" ", F.lit("more than one active code for profit center:"), "profit_center_dsc")).cast("string")
    code = F.when(low != high, clash).otherwise(F.coalesce(low, F.lit("-1")))
    return attach(df, profit_center_codes(tables), {"pc_key": F.trim("profit_center_dsc")}, add={"profit_center_code": code})


def with_account_codes(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Add source, revenue and transaction codes of the account: one join for the three."""

    def code(name: str) -> Column:
        return F.coalesce(nz(F.col(name)), F.lit("-1"))

    take = {
        "source_id": code("fk_er_source_code"),
        "revenue_type": code("fk_er_revenue_type_code"),
        "transaction_type": code("fk_er_transaction_type_code"),
    }
    xref = tables["er_budget_revenue_type_xref"]
    return lookup(df, xref, {"er_budget_revenue_type_code": F.col("hyperion_revenue_type")}, take, default="-1")


def decode_members(stage_1: DataFrame) -> DataFrame:
    """Stage 1 with ``client_code`` and ``contract_decode``."""
    return with_contract_decode(stage_1.withColumn("client_code", client_code(F.col("source_type"), F.col("hyperion_client_name"))))


def stage2(stage_1: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Stage 1 with client code, decoded contract and all codes; ``~`` in texts becomes ``,`` after the lookups."""
    rows = with_profit_center_code(with_account_codes(decode_members(stage_1), tables), tables)

    def comma(c: str) -> Column:
        return F.translate(c, "~", ",").alias(c)

    return rows.select(
        "budget_year",
        comma("profit_center_dsc"),
        "profit_center_code",
        comma("hyperion_client_name"),
        "client_code",
        "contract_dsc",
        "contract_decode",
        F.lit(None).cast("string").alias("contract_code"),
        "revenue_type",
        "source_id",
        *AMOUNTS,
        "transaction_type",
    )


def missing_profit_centers(stage_1: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Descriptions without an active profit-center code, one row each (they once went out as notices)."""
    names = stage_1.select("profit_center_dsc").filter(F.col("profit_center_dsc").isNotNull()).distinct()
    return attach(names, profit_center_codes(tables).select("pc_key"), {"pc_key": F.trim("profit_center_dsc")}, "left_anti")
