"""Exact search for the largest inner products of integer vectors, by pivot-table elimination.

Distances of every vector to a few far-apart pivots are computed once and stored beside it. For a query and a
candidate, each pivot gives a lower bound of their distance (the difference of their distances to it); the largest of
these, with both norms, gives an upper bound of the inner product. Bounds hold for sets of candidates too, from the
least and greatest distance of the set to each pivot, and elimination works on sets, from large to small: first the
home of a query (the vectors nearest to the same pivot) gives a k-th score that the result cannot fall below; the query
is then sent only to homes whose bound reaches it; there, runs of ``run`` candidates are evaluated in the order of their
bounds until the next bound is below the k-th best so far: what is left cannot enter. A run of one is the method row by
row; longer runs make a bound cheaper than the products that it saves.

Homes are dealt into parts of bounded size, and so are the queries of a home, so that a home may hold most vectors.
Nothing is gathered on the driver but the pivots and one row for each home.

Defined results: vectors that are null, empty, or hold null components take no part, and only vectors of the same
dimension meet; there are pivots for each dimension. Rows with equal id and vector are one row. An id with several
vectors is one query for each, ranked apart. Rows with a query's id are no candidates of it. A null id is never a
query, but a candidate, behind other ids in ties; else ties go to the smaller id. Scores are exact; one beyond the
range of a long raises. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from budgetloom.llm.common import stored

SLACK = 1e-6
LOWEST = np.iinfo(np.int64).min
Hits = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def usable(vector: Column) -> Column:
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def choose_pivots(points: np.ndarray, pivots: int) -> np.ndarray:
    """Far-apart vectors among ``points``, chosen greedily."""
    chosen = [points[0]]
    far = ((points - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < min(pivots, len(points)) and far.max() > 0:
        chosen.append(points[int(far.argmax())])
        far = np.minimum(far, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def sampled_pivots(rows: DataFrame, pivots: int, sample: int) -> dict[int, np.ndarray]:
    """Pivots of each dimension, from at most ``sample`` vectors of it with the smallest hashes."""
    first = Window.partitionBy("dims").orderBy(F.xxhash64("id", "v"))
    drawn = rows.select("dims", "id", "v").withColumn("place", F.row_number().over(first)).where(F.col("place") <= sample)
    found: dict[int, list] = {}
    for r in drawn.orderBy("dims", "place").select("dims", "v").collect():
        found.setdefault(r["dims"], []).append(r["v"])
    return {dims: choose_pivots(np.array(points, np.int64).astype(float), pivots) for dims, points in found.items()}


def matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two integer matrices, exactly."""
    if np.abs(a.astype(float)).max() * np.abs(b.astype(float)).max() * a.shape[1] < 1 << 53:
        return np.rint(a.astype(float) @ b.astype(float).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    if exact.max() >= 1 << 63 or exact.min() <= LOWEST:
        raise OverflowError("an inner product is beyond the range of a long")
    return exact.astype(np.int64)


def bounds(q_table: np.ndarray, q_norms: np.ndarray, low: np.ndarray, high: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Upper bounds of inner products, queries by sets; a set has its range of distances to each pivot and greatest norm."""
    apart = np.zeros((len(q_table), len(low)))
    for p in range(q_table.shape[1]):
        np.maximum(apart, low[None, :, p] - q_table[:, p, None], out=apart)
        np.maximum(apart, q_table[:, p, None] - high[None, :, p], out=apart)
    sums = q_norms[:, None] + norms[None]
    return (sums - apart * apart) / 2 + SLACK * (1 + sums + (high * high).max(axis=1)[None])


def best(q_ids: np.ndarray, queries: np.ndarray, q_table: np.ndarray, least: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, points: np.ndarray, table: np.ndarray, home: int, k: int, run: int) -> Hits:
    """query number, score, id, unnamed of the k best candidates of each query that reach its ``least`` score."""
    order = np.argsort(table[:, home], kind="stable")
    ids, unnamed, points, table = ids[order], unnamed[order], points[order], table[order]
    starts = np.arange(0, len(ids), run)
    norms = np.maximum.reduceat((points.astype(float) ** 2).sum(axis=1), starts)
    upper = bounds(q_table, (queries.astype(float) ** 2).sum(axis=1), np.minimum.reduceat(table, starts), np.maximum.reduceat(table, starts), norms)
    visit = np.argsort(-upper, axis=1, kind="stable")
    least = least.copy()
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    active, taken, size = np.arange(len(q_ids)), 0, 1
    while taken < len(starts) and len(active):
        active = active[upper[active, visit[active, taken]] >= least[active]]
        picked = visit[active, taken : taken + size]
        new = [held]
        for g in np.unique(picked):
            who = active[(picked == g).any(axis=1)]
            who = who[upper[who, g] >= least[who]]
            if not len(who):
                continue
            rows = slice(starts[g], starts[g] + run)
            score = products(queries[who], points[rows])
            own = (q_ids[who][:, None] == ids[rows][None]) & ~unnamed[rows][None]
            q, c = np.nonzero((score >= least[who][:, None]) & ~own)
            new.append((who[q], score[q, c], ids[rows][c], unnamed[rows][c]))
        number, score, found, blank = (np.concatenate(x) for x in zip(*new, strict=True))
        ranked = np.lexsort((found, blank, ~score, number))
        number = number[ranked]
        begins = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1]))) if len(number) else np.zeros(0, np.int64)
        place = np.arange(len(number)) - np.repeat(begins, np.diff(np.append(begins, len(number))))
        kept = ranked[place < k]
        held = (number[place < k], score[kept], found[kept], blank[kept])
        last = ranked[place == k - 1]
        least[number[place == k - 1]] = score[last]
        taken, size = taken + size, 2 * size
    return held


def top_k(vectors: DataFrame, is_query: Column, key: str, vector: str, k: int = 20, pivots: int = 24, sample: int = 2000, block: int = 4096, query_block: int = 2048, run: int = 256) -> DataFrame:
    """query_id, rank (from 1), id, score for every row where ``is_query`` holds. ``vector`` is an array of integers.

    Pivots come from at most ``sample`` vectors of a dimension; every vector is searched.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<bigint>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = named.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull())).withColumn("dims", F.size("v"))
    centres = sampled_pivots(rows, pivots, sample)
    if not centres:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(4).to_numpy(zero_copy_only=False)
            for dims in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dims))
                points, c = matrix(part.column(2), part.num_rows).astype(float), centres[int(dims)]
                norms = (points**2).sum(axis=1)
                d = np.sqrt(np.maximum(norms[:, None] + (c**2).sum(axis=1)[None] - 2 * points @ c.T, 0))
                lists = pa.ListArray.from_arrays(np.arange(len(d) + 1, dtype=np.int32) * len(c), d.ravel())
                extra = [lists, pa.array(d.argmin(axis=1).astype(np.int32)), pa.array(norms)]
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], [*part.schema.names, "d", "home", "norm"])

    once = rows.groupBy("id", "v").agg(F.max("q").alias("q")).select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("unnamed"), "v", (F.col("q") & F.col("id").isNotNull()).alias("q"), F.size("v").alias("dims"))
    table = stored(once.mapInArrow(place, "id long, unnamed boolean, v array<bigint>, q boolean, dims int, d array<double>, home int, norm double"), "pivot-table")
    ranges = [f(F.get("d", F.lit(p))).alias(f"{n}{p}") for p in range(max(len(c) for c in centres.values())) for n, f in (("low", F.min), ("high", F.max))]
    homes = table.groupBy("dims", "home").agg(F.count("*").alias("n"), F.max("norm").alias("norm"), *ranges).orderBy("dims", "home").collect()
    sets = {}
    for dims, c in centres.items():
        own = [h for h in homes if h["dims"] == dims]
        low, high = (np.array([[h[f"{n}{p}"] for p in range(len(c))] for h in own]) for n in ("low", "high"))
        sets[dims] = (np.array([h["home"] for h in own], np.int32), low, high, np.array([h["norm"] for h in own]))
    parts = F.broadcast(spark.createDataFrame([(h["dims"], h["home"], -(-h["n"] // block)) for h in homes], "dims int, home int, parts long"))  # one row for each pivot
    deal = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")
    dealt = table.join(parts, ["dims", "home"]).withColumn("part", deal("parts", 1))

    def read(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return t["id"].to_numpy(), matrix(t["v"], t.num_rows), matrix(t["d"], t.num_rows)

    def first_scores(t: pa.Table) -> pa.Table:
        """The queries of a part, with a score that their k best reach and the homes that may hold one of these."""
        asked = t.filter(t["q"])
        found = np.full(asked.num_rows, LOWEST)
        home, dims = t["home"][0].as_py(), t["dims"][0].as_py()
        targets = []
        if asked.num_rows:
            ids, points, d = read(t)
            q_ids, queries, q_table = read(asked)
            number, score, _, _ = best(q_ids, queries, q_table, found, ids, t["unnamed"].to_numpy(), points, d, home, k, run)
            ends = np.cumsum(np.bincount(number, minlength=len(found)))
            whole = np.diff(ends, prepend=0) == k
            found[whole] = score[ends[whole] - 1]
            numbers, low, high, norms = sets[dims]
            reach = bounds(q_table, (queries.astype(float) ** 2).sum(axis=1), low, high, norms) >= found[:, None]
            targets = [numbers[r].tolist() for r in reach]
        return pa.table({"id": asked["id"], "v": asked["v"], "dims": asked["dims"], "d": asked["d"], "least": found, "home": pa.array(targets, pa.list_(pa.int32()))})

    started = dealt.groupBy("dims", "home", "part").applyInArrow(first_scores, "id long, v array<bigint>, dims int, d array<double>, least long, home array<int>")
    queries = stored(started, "queries").withColumn("home", F.explode("home"))
    shares = queries.groupBy("dims", "home").agg(F.ceil(F.count("*") / query_block).alias("shares"))
    asked = queries.join(parts, ["dims", "home"]).join(F.broadcast(shares), ["dims", "home"])  # one row for each pivot at most
    asked = asked.select("id", "v", "dims", "d", "least", "home", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))).alias("part"), deal("shares", 2).alias("share"))
    offered = dealt.join(F.broadcast(shares), ["dims", "home"]).select("id", "unnamed", "v", "dims", "d", "home", "part", F.explode(F.sequence(F.lit(0), (F.col("shares") - 1).cast("int"))).alias("share"))

    def search(c: pa.Table, q: pa.Table) -> pa.Table:
        if not (c.num_rows and q.num_rows):
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "version", "id", "score")})
        q_ids, wanted, q_table = read(q)
        number, score, ids, unnamed = best(q_ids, wanted, q_table, q["least"].to_numpy(), c["id"].to_numpy(), c["unnamed"].to_numpy(), *read(c)[1:], c["home"][0].as_py(), k, run)
        return pa.table({"query_id": q_ids[number], "version": q["version"].to_numpy()[number], "id": pa.array(ids, mask=unnamed), "score": score})

    keys = ["dims", "home", "part", "share"]
    versions = asked.withColumn("version", F.xxhash64("v"))
    local = offered.groupBy(*keys).cogroup(versions.groupBy(*keys)).applyInArrow(search, "query_id long, version long, id long, score long")
    ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "version").orderBy(F.desc("score"), F.asc_nulls_last("id"))))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
