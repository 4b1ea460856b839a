"""Business and contract classification. Both depend only on the contract, so they are built once per contract key in use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import attach
from ..operators.xref import code_xref


def _code_classes(tables: dict[str, DataFrame], source: str, target: str, dim: str, code: str, key: str, name: str) -> DataFrame:
    """Source code -> number and largest key of the classes it leads to; a code whose target is no class leads to none."""
    classes = tables[dim].select(F.col(code).alias("short_code_to"), F.col(key).alias("class"))
    pairs = code_xref(tables, source, target).join(classes, "short_code_to", "left")
    return pairs.groupBy(F.col("short_code_from").alias(f"{name}_code")).agg(F.count("class").alias(f"{name}_n"), F.max("class").alias(f"{name}_class"))


def contract_class_keys(used: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Both classes of the ``used`` contracts (contract_dim_id, distinct): k_contract, business_class_id, n_business_classes, contract_class_id.

    The walk starts at the used ids, so that sections and class rows are looked up for these contracts only, and the
    contract dimension and its sections are read once for both classes. The code tables shrink to one small map each.
    The business class needs the section to belong to the contract and the contract to be known; the largest of several
    counts, and their number is told. The contract class is the largest along the section's cover type, -2 when a step
    finds nothing.
    """
    dim = tables["contract_dim"].select(F.col("contract_dim_id").alias("d_contract"), "dd_er_section_id", "er_contract_id")
    rows = attach(used.filter(F.col("contract_dim_id").isNotNull()), dim, {"d_contract": F.col("contract_dim_id")}, "inner")
    section = tables["er_contract_section"].select(F.col("er_contract_section_id").alias("s_id"), "fk_er_contract_id", "fk_gc_cover_type")
    rows = attach(rows, section, {"s_id": F.col("dd_er_section_id")})
    own = (F.col("er_contract_id") == F.col("fk_er_contract_id")) & ~F.col("contract_dim_id").isin(-1, -2)
    rows = rows.withColumn("own_section", F.when(own, F.col("dd_er_section_id")))
    contract = tables["er_contract"].select(F.col("er_contract_id").alias("e_id"), F.lit(True).alias("e_known"))
    rows = attach(rows, contract, {"e_id": F.when(own, F.col("er_contract_id"))})
    codes = tables["er_contract_section_class"].select(F.col("fk_er_contract_section_id").alias("c_section"), "fk_gc_class_of_business")
    rows = attach(rows, codes, {"c_section": F.when(F.col("e_known"), F.col("own_section"))})
    business = _code_classes(tables, "er_gc_class_of_business", "er_revenue_dm_business_class", "business_classification_dim", "busness_class_code", "business_classification_dim_id", "b")
    cover = _code_classes(tables, "er_gc_cover_type", "er_revenue_dm_contract_subtype", "contract_classification_dim", "contract_sub_type_code", "contract_classification_dim_id", "v")
    rows = attach(rows, business, {"b_code": F.col("fk_gc_class_of_business")})
    rows = attach(rows, cover, {"v_code": F.col("fk_gc_cover_type")})
    return rows.groupBy(F.col("contract_dim_id").alias("k_contract")).agg(
        F.max("b_class").alias("business_class_id"),
        F.coalesce(F.sum("b_n"), F.lit(0)).alias("n_business_classes"),
        F.max(F.coalesce("v_class", F.lit(-2))).cast("long").alias("contract_class_id"),
    )


def business_class_default(contract: Column, value: Column) -> Column:
    """-1 and -2 contracts carry their mark over; otherwise a missing class is -1."""
    return F.when(contract.isin(-1, -2), contract).otherwise(F.coalesce(value, F.lit(-1))).cast("long")


def with_classes(df: DataFrame, tables: dict[str, DataFrame], on_many: str = "error") -> DataFrame:
    """Add both classification keys to rows with a ``contract_dim_id``.

    Several business classes are an error, or the largest counts (``on_many="max"``), for contracts that rows name.
    """
    if on_many not in ("error", "max"):
        raise ValueError(f"unknown on_many: {on_many}")
    contract, found = F.col("contract_dim_id"), F.col("business_class_id")
    if on_many == "error":
        text = F.concat(F.lit("more than one business class for contract "), contract.cast("string"))
        found = F.when(F.col("n_business_classes") > 1, F.raise_error(text).cast("long")).otherwise(found)
    business = business_class_default(contract, found)
    cover = F.coalesce("contract_class_id", F.lit(-2)).cast("long")
    classes = contract_class_keys(df.select("contract_dim_id").distinct(), tables)
    return attach(df, classes, {"k_contract": contract}, add={"business_classification_dim_id": business, "contract_classification_dim_id": cover})


def class_of_no_contract(tables: dict[str, DataFrame]) -> Column:
    """Contract class of member -1, as a scalar (NULL without such a member); the filter reaches the scan of the contract dimension."""
    member = {**tables, "contract_dim": tables["contract_dim"].filter(F.col("contract_dim_id") == -1)}
    return contract_class_keys(member["contract_dim"].select("contract_dim_id").distinct(), member).select("contract_class_id").scalar()


def class_defaults(fact: DataFrame) -> DataFrame:
    """Apply the business-class defaults to facts of any year, as a one-off for years built before."""
    value = business_class_default(F.col("contract_dim_id"), F.col("business_classification_dim_id"))
    return fact.withColumn("business_classification_dim_id", value)
