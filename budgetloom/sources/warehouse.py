"""Parquet tables under one root folder: typed scans, full refresh, year replacement and update, appends, keys.

A refreshed table, and each year of a table that is replaced by years, lives in a folder of its own for every version. The
rows of a new version are written first; one control record then makes it the current one, for all its years at once. A
run that fails before leaves the version as it was, and readers that have begun keep the files they read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.lookup import attach
from .control import Control, Taken
from .schemas import APPENDED, INPUT_PARTITIONS, REFRESHED, SCHEMAS, YEARS, columns

#: What to tell about rows as they are written.
Watch = tuple[Observation, list[Column]]

#: Keys of one write task, as a power of two, and tasks of one reserved range.
TASK_BITS, RANGE_TASKS = 27, 1 << 12


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.control = Control(spark, f"{self.root}/_control")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _empty(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], SCHEMAS[name])

    # --- scans ---

    def read(self, name: str, version: str | None = None) -> DataFrame:
        """Scan with the declared types; filters and column choices reach the files.

        A refreshed or year-wise table is read in its current version, or a refreshed one in the version named; these and
        appended tables are empty before their first rows.
        """
        if name in APPENDED and not self.control.exists(self.path(name)):
            return self._empty(name)
        if name in YEARS:
            _, current = self.control.latest(name)
            folders = [f"{self.path(name)}/{YEARS[name]}={y}/version={v}" for y, v in sorted(current.items())]
            if not folders:
                return self._empty(name)
            scan = self.spark.read.schema(f"{SCHEMAS[name]}, version string").option("basePath", self.path(name))
            return scan.parquet(*folders).drop("version")
        if name in REFRESHED:
            version = version or self.control.latest(name)[1].get("version")
            if version is None:
                return self._empty(name)
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path(name)}/version={version}")
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))

    def tables(self, names: Iterable[str]) -> dict[str, DataFrame]:
        return {n: self.read(n) for n in names}

    # --- whole tables ---

    def store(self, name: str, df: DataFrame) -> DataFrame:
        """Write an input table, by its partition column where it has one, and return it as read back."""
        writer = df.select(*columns(name)).write.mode("errorifexists")
        if name in INPUT_PARTITIONS:
            writer = writer.partitionBy(INPUT_PARTITIONS[name])
        writer.parquet(self.path(name))
        return self.read(name)

    def refresh(self, name: str, df: DataFrame, version: str | None = None, watch: Watch | None = None) -> DataFrame:
        """Replace the whole table and return it as read back, which also ends the lineage of ``df``.

        A version that is named can be written again as long as it has not become the current one.
        """
        version = version or uuid.uuid4().hex
        _observed(df.select(*columns(name)), watch).write.mode("overwrite").parquet(f"{self.path(name)}/version={version}")
        self.control.claim_next(name, {"version": version})
        return self.read(name, version)

    # --- years ---

    def _publish(self, name: str, seen: dict, years: dict[int, str | None]) -> None:
        """Make versions of some years current, all in one step; None empties a year.

        When another run has published since ``seen`` was read, its years are taken over; the same year published twice is an error.
        """
        while True:
            number, current = self.control.latest(name)
            if any(current.get(str(y)) != seen.get(str(y)) for y in years):
                raise Taken(f"{name}: another run has replaced one of the years {sorted(years)}")
            new = {**current, **{str(y): v for y, v in years.items()}}
            try:
                self.control.claim(name, number + 1, {y: v for y, v in new.items() if v is not None})
                return
            except Taken:
                continue

    def replace_years(self, name: str, df: DataFrame, years: Iterable[int], key: tuple[str, int] | None = None) -> dict[int, int]:
        """Replace exactly the given years: each year's rows are swapped, and a year without rows is emptied. Returns their rows.

        A row of another year, or of none, is an error; nothing is published then. ``key`` is as in ``append``.
        """
        part, years, version, seen = YEARS[name], list(years), uuid.uuid4().hex, Observation()
        _, before = self.control.latest(name)
        inside = F.coalesce(F.col(part).isin(years), F.lit(False))
        text = F.concat(F.lit(f"a row of {name} is outside the years to replace: "), F.coalesce(F.col(part).cast("string"), F.lit("NULL")))
        rows = df.filter(F.when(inside, F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))
        rows = _keyed(rows.hint("rebalance", F.col(part)), key).select(*columns(name), F.lit(version).alias("version"))
        rows = rows.observe(seen, *[F.count_if(F.col(part) == y).alias(str(y)) for y in years])
        rows.write.mode("append").partitionBy(part, "version").parquet(self.path(name))
        counts = {y: seen.get[str(y)] for y in years}
        self._publish(name, before, {y: version if counts[y] else None for y in years})
        return counts

    def update_years(self, name: str, changes: DataFrame, on: str, values: list[str]) -> list[int]:
        """Set ``values`` of the stored rows whose key ``on`` is among the ``changes`` (one row for each key).

        Only years with such a row are rewritten; the files of the others stay. Returns the rewritten years.
        """
        part, rows = YEARS[name], self.read(name)
        side = changes.select(F.col(on).alias("_on"), *[F.col(v).alias(f"_new_{v}") for v in values], F.lit(True).alias("_hit"))
        touched = attach(rows.select(part, on), side.select("_on"), {"_on": F.col(on)}, "left_semi").select(part).distinct()
        years = sorted(r[0] for r in touched.collect())  # one row for each year
        if years:
            joined = attach(rows.filter(F.col(part).isin(years)), side, {"_on": F.col(on)})
            new = {v: F.when(F.col("_hit"), F.col(f"_new_{v}")).otherwise(F.col(v)) for v in values}
            self.replace_years(name, joined.withColumns(new).select(*columns(name)), years)
        return years

    # --- appends ---

    def placed(self, name: str, df: DataFrame) -> DataFrame:
        """Rows brought together by the day they are stored by, in parts of a file's size."""
        return df.hint("rebalance", F.col(APPENDED[name][0]))

    def append(self, name: str, df: DataFrame, key: tuple[str, int] | None = None, watch: Watch | None = None, placed: bool = False) -> None:
        """Add rows: few files for each day, sorted by what the table is looked up by, so that file statistics skip the rest.

        ``key`` names a column to fill with surrogate keys and their start. Keys are made, and rows watched, behind the last
        shuffle, in the tasks that write: a task that is run again writes all its rows anew. Rows that are ``placed``, or come
        from such by a step without a shuffle, are not shuffled again.
        """
        day, order = APPENDED[name]
        rows = _keyed(df if placed else self.placed(name, df), key).select(*columns(name)).sortWithinPartitions(day, *order)
        _observed(rows, watch).write.mode("append").partitionBy(day).parquet(self.path(name))

    # --- keys ---

    def reserve_keys(self, name: str, column: str) -> int:
        """First key of a range that no other run gets, for ``surrogate_key``; no table is read for it."""
        (n,) = self.control.claim_next(f"{name}.{column}")
        return 1 + ((n - 1) * RANGE_TASKS << TASK_BITS)

    def adopt_keys(self, name: str, column: str) -> None:
        """Once for a table that was filled elsewhere: let its ranges begin beyond its largest key."""
        largest = self.read(name).agg(F.max(column)).first()[0] or 0
        if largest:
            try:
                self.control.claim(f"{name}.{column}", 1 + ((largest - 1) >> TASK_BITS) // RANGE_TASKS)
            except Taken:
                pass


def _keyed(df: DataFrame, key: tuple[str, int] | None) -> DataFrame:
    return df if key is None else df.withColumn(key[0], surrogate_key(key[1]))


def _observed(df: DataFrame, watch: Watch | None) -> DataFrame:
    return df if watch is None else df.observe(watch[0], *watch[1])


def surrogate_key(start: int) -> Column:
    """Unique keys of the range that begins at ``start``, without a shuffle; they carry no order. Write them once before they are used.

    A task beyond the range's tasks, or a row beyond a task's keys, raises.
    """
    task, row = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    fits = (task < RANGE_TASKS) & (row < (1 << TASK_BITS))
    key = F.shiftleft(task.cast("long"), TASK_BITS) + row + F.lit(start)
    return F.when(fits, key).otherwise(F.raise_error(F.lit("more rows than one key range holds")).cast("long"))
