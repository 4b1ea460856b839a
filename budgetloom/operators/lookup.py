"""Lookups of dimension keys as left joins, with the outcome rules of a single-row SELECT INTO."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMBIGUOUS = -2


def attach(df: DataFrame, build: DataFrame, on: dict[str, Column], how: str = "left", add: dict[str, Column] | None = None, spread: Column | None = None) -> DataFrame:
    """Join ``df`` to ``build`` where each ``build`` column named in ``on`` equals the given ``df`` expression.

    The result has the columns of ``df`` and the other columns of ``build``, or the ``add`` columns (name ->
    expression over both) in place of the latter.

    No broadcast is forced: Spark broadcasts ``build`` when its estimated or measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides otherwise. The hash of the keys is an
    extra join key. It changes no result, but an aggregated ``build`` is already clustered on its keys, so
    Spark would leave out its shuffle, and adaptive execution splits a hot key's partition only where the
    join sits on a shuffle on both sides. Rows with a NULL key meet nothing; ``spread``, a number that differs among them,
    takes the place of their hash, so that they do not all go to one task.
    """
    names = list(on)
    keys = {f"_p{i}": on[k].cast(build.schema[k].dataType) for i, k in enumerate(names)}
    hashed = F.xxhash64(*keys.values())
    if spread is not None:
        hashed = F.when(reduce(or_, [k.isNull() for k in keys.values()]), spread).otherwise(hashed)
    probe = df.withColumns({**keys, "_ph": hashed})
    rest = [c for c in build.columns if c not in on]
    side = build.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(names)], F.xxhash64(*names).alias("_bh"), *rest)
    equal = reduce(and_, [F.col(f"_p{i}") == F.col(f"_b{i}") for i in range(len(names))], F.col("_ph") == F.col("_bh"))
    joined = probe.join(side, equal, how)
    if how in ("left_anti", "left_semi"):
        return joined.select(*df.columns)
    added = rest if add is None else [v.alias(name) for name, v in add.items()]
    return joined.select(*df.columns, *added)


def one_per_key(dim: DataFrame, keys: list[str], take: dict[str, Column]) -> DataFrame:
    """One row per non-NULL key: the number of rows as ``_n`` and the largest value of each taken column."""
    known = dim.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.max(v).alias(name) for name, v in take.items()])


def lookup(df: DataFrame, dim: DataFrame, on: dict[str, Column], take: dict[str, Column], default, on_many: str = "error") -> DataFrame:
    """Add the ``take`` columns (name -> expression over ``dim``) to ``df``.

    No row gives ``default``; one row gives its value, NULL included. Many rows raise for the keys that are
    really used (``error``), give the largest value (``max``) or give -2 (``ambiguous``).
    """
    if on_many not in ("error", "max", "ambiguous"):
        raise ValueError(f"unknown on_many: {on_many}")
    build = one_per_key(dim, list(on), take)
    n = F.col("_n")
    out = {}
    for name in take:
        kind = build.schema[name].dataType
        value = F.when(n.isNull(), F.lit(default).cast(kind)).otherwise(F.col(name))
        if on_many == "error":
            text = F.concat_ws(" ", F.lit(f"more than one row for {name}:"), *[e.cast("string") for e in on.values()])
            value = F.when(n > 1, F.raise_error(text).cast(kind)).otherwise(value)
        elif on_many == "ambiguous":
            value = F.when(n > 1, F.lit(AMBIGUOUS).cast(kind)).otherwise(value)
        out[name] = value
    return attach(df, build, on, add=out)
