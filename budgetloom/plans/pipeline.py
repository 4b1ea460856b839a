"""The whole budget build: as one lazy plan, or as a job that stores both stages and the fact."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.schemas import SCHEMAS
from ..sources.warehouse import Warehouse, surrogate_key
from .budget_fact import unpivot_months, with_fact_dims
from .budget_stage import as_years, stage1, stage2
from .classify import class_defaults, class_of_no_contract, with_classes
from .contract_map import contract_map, with_contract_keys


def contract_rows(stage_2: DataFrame, tables: dict[str, DataFrame], class_on_many: str = "error", keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Key and classes of every distinct contract in stage 2 that names one, and a row without texts for member -1.

    The classes are found for the keys in use and joined to the keys, which are read twice so; ``keep`` stores them in between.
    """
    none = stage_2.sparkSession.range(1).select(F.lit(-1).cast("long").alias("contract_dim_id"))
    contracts = contract_map(stage_2, tables).unionByName(none, allowMissingColumns=True)
    return with_classes(keep(contracts) if keep else contracts, tables, class_on_many)


def fact_rows(stage_2: DataFrame, tables: dict[str, DataFrame], class_on_many: str = "error", contracts: DataFrame | None = None) -> DataFrame:
    """Monthly fact rows with every key. Extra stage-2 columns, such as its id, are carried along.

    Rows that name no single contract have contract -1. Contract and class keys are found once per distinct contract
    (``contracts``: ``contract_rows`` that have been stored) and joined to the stage-2 rows before the unpivot, so the only wide
    shuffles are this join and, when the partners are many, the cedent's.
    """
    if contracts is None:
        contracts = with_classes(contract_map(stage_2, tables), tables, class_on_many)
        class_of_none = class_of_no_contract(tables)
    else:
        class_of_none = contracts.filter(F.col("contract_dsc").isNull()).select("contract_classification_dim_id").scalar()
    rows = with_contract_keys(with_fact_dims(stage_2, tables), contracts)
    rows = rows.withColumns(
        {
            "business_classification_dim_id": F.coalesce("business_classification_dim_id", F.lit(-1).cast("long")),
            "contract_classification_dim_id": F.coalesce("contract_classification_dim_id", class_of_none, F.lit(-2).cast("long")),
        }
    )
    return unpivot_months(rows).withColumn("revenue_year", F.col("budget_year"))


def budget_fact(tables: dict[str, DataFrame], years: int | Iterable[int]) -> DataFrame:
    """Extract to classified fact as one lazy plan, without stored keys."""
    return fact_rows(stage2(stage1(tables["clvr_level0_extract"], years), tables), tables)


FACT, STAGE_1, STAGE_2, CONTRACTS, STEPS = "budget_fact", "er_hyperion_stage_1", "er_hyperion_stage_2", "budget_contract_map", "build_step_log"
CONTRACT_KEYS = "budget_contract_keys"
STAGE_KEY, FACT_KEY = "er_hyperion_stage_2_id", "budget_fact_id"


def finished_steps(wh: Warehouse, run_id: str) -> set[str]:
    return {r["step"] for r in wh.read(STEPS).filter(F.col("run_id") == run_id).select("step").distinct().collect()}


def build_budget_fact(wh: Warehouse, tables: dict[str, DataFrame], years: int | Iterable[int], run_ts: datetime, run_id: str | None = None) -> str:
    """Rebuild both stages and the contract map, and replace the given years of the fact. Returns the run's id.

    Each step is stored before it is used: keys must not change between two readings, and a lost executor costs no more
    than the current step. The step log tells the rows of every step. A failed step raises and leaves the fact as it was;
    the run can then be called again with its ``run_id``, and goes on behind the last step that it stored.
    """
    years, run_id = as_years(years), run_id or uuid.uuid4().hex
    done = finished_steps(wh, run_id)

    def log(step: str, n_rows: int) -> None:
        wh.append(STEPS, wh.spark.createDataFrame([(run_id, step, run_ts, n_rows, run_ts.date())], SCHEMAS[STEPS]))

    def stored(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name in done:
            return wh.read(name, run_id)
        seen = Observation()
        out = wh.refresh(name, make(), run_id, (seen, [F.count(F.lit(1)).alias("n")]))
        log(name, seen.get["n"])
        return out

    first = stored(STAGE_1, lambda: stage1(tables["clvr_level0_extract"], years))
    second = stored(STAGE_2, lambda: stage2(first, tables).withColumn(STAGE_KEY, surrogate_key(wh.reserve_keys(STAGE_2, STAGE_KEY))))
    contracts = stored(CONTRACTS, lambda: contract_rows(second, tables, keep=lambda df: wh.refresh(CONTRACT_KEYS, df)))
    if FACT not in done:
        rows = fact_rows(second, tables, contracts=contracts).withColumns({"created_dt": F.lit(run_ts), "update_dt": F.lit(run_ts)})
        counts = wh.replace_years(FACT, rows, years, (FACT_KEY, wh.reserve_keys(FACT, FACT_KEY)))
        log(FACT, sum(counts.values()))
    return run_id


def apply_class_defaults(wh: Warehouse) -> list[int]:
    """Store the business-class defaults in facts of any year; only years with a row that changes are rewritten, and returned."""
    fact, name = wh.read(FACT), "business_classification_dim_id"
    new = class_defaults(fact.select(FACT_KEY, "contract_dim_id", F.col(name).alias("old"), name))
    changes = new.filter(~F.col("old").eqNullSafe(F.col(name))).select(FACT_KEY, name)
    return wh.update_years(FACT, changes, FACT_KEY, [name])
