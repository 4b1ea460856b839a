"""Stage 2 -> monthly budget fact: dimension keys first, then the unpivot, so lookups run on 1/12 of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import attach, lookup, one_per_key
from .budget_stage import AMOUNTS, MONEY


def numeric_clients(stage_2: DataFrame) -> DataFrame:
    """Rows with a numeric client code, -1 and -2 included: the code is a number, so this means not NULL."""
    return stage_2.filter(F.col("client_code").isNotNull())


def with_code_dims(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Source, revenue type, transaction and profit-center keys; -1 when a code is unknown."""
    df = lookup(df, tables["source_dim"], {"source_code": F.col("source_id")}, {"source_dim_id": F.col("source_dim_id")}, -1)
    revenue_id = {"revenue_type_id": F.col("revenue_type_id").cast("string")}
    df = lookup(df, tables["revenue_type_dim"], {"revenue_type_code": F.col("revenue_type")}, revenue_id, "-1")
    transaction_id = {"transaction_dim_id": F.col("transaction_dim_id")}
    df = lookup(df, tables["transaction_dim"], {"transaction_type_code": F.col("transaction_type")}, transaction_id, -1)
    center_id = {"profit_center_dim_id": F.col("profit_center_dim_id")}
    return lookup(df, tables["profit_center_dim"], {"profit_code": F.col("profit_center_code")}, center_id, -1)


def with_cedent(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Largest trading-partner key of the client, matched on the ultimate parent for CL_..._NA contracts.

    Each row needs one of the two matches, so both kinds of key form one build side and one join.
    """
    tp = tables["trading_partner_dim"]
    sides = [
        one_per_key(tp, [key], {"tp_dim": F.col("tp_dim_id")}).select(F.lit(kind).alias("tp_kind"), F.col(key).alias("tp_key"), "tp_dim", "_n")
        for kind, key in (("id", "tp_id"), ("parent", "tp_ult_parent_id"))
    ]
    kind = F.when(F.col("contract_dsc").like("CL_%_NA"), F.lit("parent")).otherwise(F.lit("id"))
    cedent = F.when(F.col("_n").isNull(), F.lit(-1).cast("long")).otherwise(F.col("tp_dim"))
    return attach(df, sides[0].unionByName(sides[1]), {"tp_kind": kind, "tp_key": F.col("client_code")}, add={"cedent_dim_id": cedent})


def unpivot_months(df: DataFrame) -> DataFrame:
    """One row per month with an amount other than zero, keyed yyyymm01."""
    ids = [c for c in df.columns if c not in AMOUNTS]
    months = df.select(*ids, *[F.col(a).alias(str(i)) for i, a in enumerate(AMOUNTS, 1)])
    long = months.unpivot(ids, [str(i) for i in range(1, 13)], "month", "budget_amt_usd")
    day = F.col("budget_year") * 10000 + F.col("month").cast("int") * 100 + 1
    return (
        long.filter(F.col("budget_amt_usd") != 0)
        .withColumns({"budget_amt_usd": F.col("budget_amt_usd").cast(MONEY), "revenue_date_dim_id": day.cast("int")})
        .drop("month")
    )


def with_fact_dims(stage_2: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Stage 2 rows of the fact with all keys but the contract's."""
    rows = with_cedent(with_code_dims(numeric_clients(stage_2), tables), tables)
    return rows.withColumn("budget_version_dim_id", F.lit(-1).cast("long"))
