"""Append submitted accrual records, and validate the records of one file or of all files that wait."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.ora import nz
from ..operators.lookup import attach
from ..sources.schemas import SCHEMAS
from ..sources.warehouse import Warehouse
from .accrual_rules import RULES, TEXT_FIELDS, Tables, error_rows, rule_counts, verdict

RECORDS, ERRORS, LOG = "er_selfservice_accrual_records", "er_accrual_stg_error", "er_accural_log"
LOADS, KEY = "er_accrual_load", "pk_accr_recs_id"


class EmptySubmission(ValueError):
    """A load was asked for with no records."""


def pending(records: DataFrame, run_ts: datetime) -> DataFrame:
    """Submitted records with the fields every load sets; '' in a text field is stored as NULL."""
    texts = [*TEXT_FIELDS, *(c for c in ("file_id", "fk_accr_file_id", "user_id") if c in records.columns)]
    set_ = {"created_dt": F.lit(run_ts), "status": F.lit("Pending"), "load_date": F.lit(run_ts.date())}
    return records.withColumns({c: nz(F.col(c)) for c in texts}).withColumns(set_)


def insert_accruals(wh: Warehouse, records: DataFrame, run_ts: datetime) -> None:
    """Append records as Pending with new keys. All or none are stored."""
    if records.isEmpty():
        raise EmptySubmission("no accrual records to load")
    wh.append(RECORDS, pending(records, run_ts), key=(KEY, wh.reserve_keys(RECORDS, KEY)))


def _log(wh: Warehouse, run_ts: datetime, rows: list[tuple[int, str, str, str | None]]) -> None:
    told = [(load, run_ts, status, comments, file_id, run_ts.date()) for load, status, comments, file_id in rows]
    wh.append(LOG, wh.spark.createDataFrame(told, SCHEMAS[LOG]))


def _failure(e: Exception) -> str:
    """What the log says of a rule that failed: the rule, then its error."""
    found = re.search(r"\b(V\d\d): ([^\n]*)", str(e))
    return f"{found[1]} validate; {found[2][:115]}" if found else f"validate; {str(e)[:115]}"


def _errors(wh: Warehouse, records: DataFrame, tables: Tables, load_num, run_ts: datetime) -> DataFrame:
    day = F.lit(run_ts.date())
    rows = error_rows(records, tables, load_num=load_num, run_ts=F.lit(run_ts), place=lambda df: wh.placed(ERRORS, df.withColumn("error_date", day)))
    return rows.withColumn("error_date", day)


def _outcome(n_errors: int) -> tuple[str, str]:
    return "ERROR" if n_errors else "SUCCESS", f"{n_errors} error rows"


def validate_accruals(wh: Warehouse, tables: Tables, file_id: str, run_ts: datetime, load_num: int | None = None) -> int:
    """Check one file's records, store the error rows and the outcome, and return the load number.

    The number is claimed before any row is written, so that only one run can have it; one that was used before is
    refused. All rules are stored together or, when one raises, none; the failure is logged with the rule's id and raised
    again. Errors are counted as they are written: the outcome is known without reading the error table.
    """
    if load_num is None:
        (load_num,) = wh.control.claim_next(LOADS, {"files": [file_id]})
    else:
        wh.control.claim(LOADS, load_num, {"files": [file_id]})
    records = wh.read(RECORDS).filter(F.col("fk_accr_file_id") == F.lit(file_id))
    seen = Observation()
    watch = (seen, [F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("rule_id") == r).alias(r) for r in RULES]])
    try:
        wh.append(ERRORS, _errors(wh, records, tables, load_num, run_ts), watch=watch, placed=True)
    except Exception as e:
        _log(wh, run_ts, [(load_num, "Error on validate", _failure(e), file_id)])
        raise
    status, text = _outcome(seen.get["n"])
    fired = ", ".join(f"{r} {seen.get[r]}" for r in RULES if seen.get[r])
    _log(wh, run_ts, [(load_num, status, f"{text}; {fired}" if fired else text, file_id)])
    return load_num


def waiting_files(wh: Warehouse) -> list[str]:
    """Files with records of which no validation has been logged, one name each."""
    files = wh.read(RECORDS).select(F.col("fk_accr_file_id").alias("f")).dropna().distinct()
    done = wh.read(LOG).filter(F.col("status") != "Error on validate").select("file_id").dropna().distinct()
    return sorted(r["f"] for r in attach(files, done, {"file_id": F.col("f")}, "left_anti").collect())


def validate_waiting(wh: Warehouse, tables: Tables, run_ts: datetime, file_ids: Iterable[str] | None = None) -> dict[str, int]:
    """Check all files that wait, or the named ones, in one pass; returns the load number of each file.

    One plan scans the records once, one write stores the errors of all files, and one append logs all outcomes. When a
    rule raises, no errors are stored and every file is logged as failed.
    """
    files = waiting_files(wh) if file_ids is None else list(file_ids)
    if not files:
        return {}
    loads = dict(zip(files, wh.control.claim_next(LOADS, {"files": files}, len(files))))
    # from Arrow, Spark knows the size of these few rows, and need not shuffle the records by their file
    numbers = wh.spark.createDataFrame(pa.table({"load_file": pa.array(loads, pa.string()), "load_num": pa.array(loads.values(), pa.int64())}))
    records = attach(wh.read(RECORDS), numbers, {"load_file": F.col("fk_accr_file_id")}, "inner")
    try:
        wh.append(ERRORS, _errors(wh, records, tables, F.col("load_num"), run_ts), placed=True)
    except Exception as e:
        _log(wh, run_ts, [(n, "Error on validate", _failure(e), f) for f, n in loads.items()])
        raise
    day = wh.read(ERRORS).filter((F.col("error_date") == F.lit(run_ts.date())) & F.col("er_accrual_load_num").between(min(loads.values()), max(loads.values())))
    counts = {r["er_accrual_load_num"]: r["n"] for r in day.groupBy("er_accrual_load_num").agg(F.count(F.lit(1)).alias("n")).collect()}
    _log(wh, run_ts, [(n, *_outcome(counts.get(n, 0)), f) for f, n in loads.items()])
    return loads


def load_verdict(wh: Warehouse, load_num: int) -> DataFrame:
    return verdict(wh.read(ERRORS), load_num)


def load_rule_counts(wh: Warehouse, load_num: int) -> DataFrame:
    return rule_counts(wh.read(ERRORS).filter(F.col("er_accrual_load_num") == load_num))
