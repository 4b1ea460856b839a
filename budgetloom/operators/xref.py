"""Code-to-code cross-reference driven by a table of table names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def code_xref(tables: dict[str, DataFrame], source: str, target: str) -> DataFrame:
    """(short_code_from, short_code_to) pairs between two code tables, named by their physical names."""
    names = tables["er_tbl_name"]
    src = names.filter(F.col("tbl_name_physical") == source.upper()).select(F.col("tbl_name_id").alias("fk_tbl_name_id_from"))
    dst = names.filter(F.col("tbl_name_physical") == target.upper()).select(F.col("tbl_name_id").alias("fk_tbl_name_id_to"))
    a = tables[source].select(F.col("tbl_code_id").alias("fk_tbl_code_id_from"), F.col("short_code").alias("short_code_from"))
    b = tables[target].select(F.col("tbl_code_id").alias("fk_tbl_code_id_to"), F.col("short_code").alias("short_code_to"))
    return (
        tables["er_cross_reference"]
        .join(src, "fk_tbl_name_id_from")
        .join(dst, "fk_tbl_name_id_to")
        .join(a, "fk_tbl_code_id_from")
        .join(b, "fk_tbl_code_id_to")
        .select("short_code_from", "short_code_to")
    )
