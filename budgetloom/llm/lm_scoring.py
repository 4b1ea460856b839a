"""Language-model scoring: a log-bilinear model, trained with noise-contrastive estimation, and smoothed unigrams.

Tokens are the words of a text between white space, A-Z in lower case, and one end token for each text. Counts of all
tokens of the training rows are gathered by Spark. The ``model_words`` (at most: the table of normalisers has a row for
each) most frequent tokens are symbols of the model;
the others share a symbol for each shape (how they end, and whether they are ASCII). Two context symbols give a
vector by linear maps; its products with the symbols' vectors plus biases are the scores. Noise-contrastive estimation
fits all of it on all training rows, in tasks: trigrams are counted over the whole input first and dealt by their hash
into shards, whose number follows from the tokens alone; the parameters that the shards make of them are averaged
between rounds. So the same rows give the same model on any cluster, but for the rounding of sums; no row is drawn or
left out. The normalisers of all pairs of context symbols come from batched matrix products, so probabilities sum to
one. A token of a shape has the shape's probability times its smoothed share of the shape's counts (one event is kept
for the unseen), so a text's probability covers every token.

Counts of the most frequent tokens (``common_words`` at most; tokens of about the same count go together) travel to the
tasks as a dictionary; those of all other tokens come by a join.

Defined results: a null text is the empty text and has only the end token. Without training rows, every count is 0 and
the model is the uniform share of the one unseen event. Repeated rows are counted and scored each on its own.
"""

from __future__ import annotations

import copy
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from budgetloom.llm.common import stored

END = b""
SHAPES = 10
FLUSH = 400_000
#: With the shapes, as many symbols as a table of normalisers of 16 MB has rows.
MODEL_WORDS = 2048 - SHAPES
FLUSH_KEYS = 4_000_000
MOST_TIMES = 16
SLICE = 4096
#: A shard holds the distinct trigrams among so many tokens, on average, and is one task's group.
SHARD_TOKENS = 6_000_000
#: Tasks' sums of parameters are added in two steps, the first in so many groups for each slice.
SALTS = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str | None) -> list[bytes]:
    """bytes.lower and bytes.split know ASCII only: A-Z, and the six white-space characters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shape(token: bytes) -> int:
    last = token[-1:]
    kind = 1 if last in (b".", b"!", b"?") else 2 if last in (b",", b";", b":") else 3 if last.isdigit() else 0 if last.isalpha() or last >= b"\x80" else 4
    return 2 * kind + (not token.isascii())


def count_tokens(docs: DataFrame, text: str) -> DataFrame:
    """token (binary), n: partial counts in each task, summed by Spark. The end token counts once a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found.update(tokens_of(t))
                found[END] += 1
                if len(found) > FLUSH:
                    yield from _pairs(found)
                    found.clear()
        yield from _pairs(found)

    return docs.select(text).mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _pairs(found: Counter[bytes]) -> Iterator[pa.RecordBatch]:
    items = iter(found.items())
    while part := list(islice(items, 50_000)):
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.binary()), pa.array([v for _, v in part], pa.int64())], ["token", "n"])


@dataclass
class LogBilinear:
    """Symbols 0..words-1 are the most frequent tokens, then one for each shape. log10 probabilities by ``log10_probability``."""

    near: np.ndarray  # symbol x dims: what the symbol just before adds to the prediction
    far: np.ndarray  # the same for the one before that
    output: np.ndarray
    bias: np.ndarray
    normaliser: np.ndarray  # symbol before x symbol two before: log of the sum over all symbols

    def log10_probability(self, symbols: np.ndarray, end: int) -> np.ndarray:
        """For each symbol of a text; before its start stand end symbols."""
        before = np.concatenate(([end, end], symbols))
        near, far = before[1:-1], before[:-2]
        score = np.einsum("ij,ij->i", self.near[near] + self.far[far], self.output[symbols]) + self.bias[symbols]
        return (score - self.normaliser[near, far]) / np.log(10.0)


def train_log_bilinear(texts: list[np.ndarray], counts: np.ndarray, end: int, dims: int = 24, epochs: int = 3, batch: int = 1024, noise: int = 200, rate: float = 0.08, seed: int = 5) -> LogBilinear:
    """The model of texts that one process holds."""
    fit = Estimation(counts, dims, batch, noise, rate, seed)
    keys, times = repeated(np.concatenate([trigram_keys(t, end) for t in texts]) if texts else np.zeros(0, np.int64))
    for r in range(epochs):
        fit.learn(keys, times, np.random.default_rng((seed, r)))
    return fit.model()


def trigram_keys(symbols: np.ndarray, end: int) -> np.ndarray:
    """For each symbol of a text: itself, the one before and the one before that, in one number."""
    s = np.concatenate(([end, end], symbols)).astype(np.int64)
    return s[2:] << 32 | s[1:-1] << 16 | s[:-2]


def repeated(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in random order, with how often each comes; those of more than ``MOST_TIMES`` in several entries.

    ``n`` says how often each of ``keys`` comes, once where it is not given.
    """
    unique, n = counted(keys, n)
    entries = -(-n // MOST_TIMES)
    order = np.random.default_rng(len(unique)).permutation(int(entries.sum()))
    return np.repeat(unique, entries)[order], np.repeat((n / entries).astype(np.float32), entries)[order]


def counted(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of ``n``, or how often each comes."""
    if n is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def sharded(keys: np.ndarray, n: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """A row for each shard: its keys and how often they come, as bytes."""
    shard = (((keys.astype(np.uint64) * _ODD) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    shard, keys, n = shard[order], keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
    ends = np.append(first[1:], len(shard))
    for at in range(0, len(first), 256):
        some = list(zip(first[at : at + 256], ends[at : at + 256], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(shard[first[at : at + 256]]), *[pa.array([x[i:j].tobytes() for i, j in some], pa.binary()) for x in (keys, n)]], ["shard", "keys", "n"])


def merged(table: pa.Table) -> pa.Table:
    """One row of a shard from all of them: its distinct keys, in order, and their counts."""
    keys, n = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64) for c in ("keys", "n"))
    keys, n = counted(keys, n)
    return pa.table({"shard": table.column("shard").slice(0, 1), "keys": pa.array([keys.tobytes()], pa.binary()), "n": pa.array([n.tobytes()], pa.binary())})


class Estimation:
    """Noise-contrastive estimation in numpy, with Adagrad steps; a batch shares its noise symbols, drawn by their counts."""

    def __init__(self, counts: np.ndarray, dims: int, batch: int, noise: int, rate: float, seed: int) -> None:
        rng = np.random.default_rng(seed)
        size = len(counts)
        share = (counts + 0.5) / (counts + 0.5).sum()
        self.batch, self.noise, self.rate, self.seed = batch, noise, np.float32(rate), seed
        self.log_noise, self.cumulative = np.log(noise * share).astype(np.float32), np.cumsum(share)
        shapes = {"words": (size, dims), "near": (dims, dims), "far": (dims, dims), "output": (size, dims), "bias": (size,)}
        self.shapes = shapes
        self.values = np.concatenate([rng.normal(0, 0.1, s).astype(np.float32).ravel() for s in shapes.values()])
        self.history = np.full(len(self.values), 1e-4, np.float32)
        parts = self.parts(self.values)
        parts["near"] += np.eye(dims, dtype=np.float32)
        parts["bias"][:] = np.log(share)

    def parts(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """Views of a vector of all parameters."""
        ends = np.cumsum([int(np.prod(s)) for s in self.shapes.values()])
        return {k: x.reshape(s) for (k, s), x in zip(self.shapes.items(), np.split(flat, ends[:-1]), strict=True)}

    def learn(self, keys: np.ndarray, times: np.ndarray, rng: np.random.Generator) -> None:
        """One pass over trigrams; each counts as often as ``times`` says."""
        now, past = self.parts(self.values), self.parts(self.history)
        words, near_map, far_map, output, bias = now.values()
        one = np.float32(1)

        def step(name: str, at: np.ndarray | slice, g: np.ndarray) -> None:
            h = past[name][at] + g * g
            past[name][at] = h
            now[name][at] -= self.rate * g / np.sqrt(h)

        def by_symbol(at: np.ndarray, *g: np.ndarray) -> list[np.ndarray]:
            order = np.argsort(at, kind="stable")
            at = at[order]
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            return [at[first], *(np.add.reduceat(x[order], first, axis=0) for x in g)]

        order = rng.permutation(len(keys))
        for begin in range(0, len(order), self.batch):
            i = order[begin : begin + self.batch]
            w, n, f = (keys[i] >> 32).astype(np.uint16), (keys[i] >> 16 & 0xFFFF).astype(np.uint16), (keys[i] & 0xFFFF).astype(np.uint16)
            drawn = np.minimum(np.searchsorted(self.cumulative, rng.random(self.noise)), len(bias) - 1).astype(np.uint16)
            v_n, v_f, v_w, v_drawn = words[n], words[f], output[w], output[drawn]
            h = v_n @ near_map + v_f @ far_map
            scale = times[i] / times[i].sum()
            d_true = -scale / (one + np.exp(np.einsum("ij,ij->i", h, v_w) + bias[w] - self.log_noise[w]))
            d_noise = h @ v_drawn.T
            d_noise += bias[drawn] - self.log_noise[drawn]
            np.exp(np.negative(d_noise, out=d_noise), out=d_noise)
            d_noise += one
            np.divide(scale[:, None], d_noise, out=d_noise)
            g_h = d_true[:, None] * v_w + d_noise @ v_drawn
            g_near, g_far = v_n.T @ g_h, v_f.T @ g_h
            touched, g_out, g_bias = by_symbol(np.concatenate((w, drawn)), np.concatenate((d_true[:, None] * h, d_noise.T @ h)), np.concatenate((d_true, d_noise.sum(axis=0))))
            step("output", touched, g_out)
            step("bias", touched, g_bias)
            step("words", *by_symbol(np.concatenate((n, f)), np.concatenate((g_h @ near_map.T, g_h @ far_map.T))))
            step("near", slice(None), g_near)
            step("far", slice(None), g_far)

    def model(self) -> LogBilinear:
        words, near_map, far_map, output, bias = self.parts(self.values).values()
        near, far = words @ near_map, words @ far_map
        return LogBilinear(near, far, output, bias, normalisers(near, far, output, bias))


def learn_in_tasks(shards: DataFrame, fit: Estimation, rounds: int) -> None:
    """``rounds`` passes of ``fit`` over all ``shards`` (shard, keys, n), each on its own from the same parameters.

    Between rounds Spark takes, slice by slice, the mean of what the shards have made of each parameter, weighted by the
    squared gradients that each has seen of it; what no shard has touched stays. The squared gradients go on as their
    mean. A task holds one shard and the parameters, the driver the parameters alone.
    """
    for r in range(rounds):
        sent = shards.sparkSession.sparkContext.broadcast(fit)

        def learn(batches: Iterator[pa.RecordBatch], r: int = r, sent=sent) -> Iterator[pa.RecordBatch]:
            start = sent.value
            moved, mass, count = np.zeros(len(start.values)), np.zeros(len(start.values)), 0
            for batch in batches:
                for i in range(batch.num_rows):
                    shard, (keys, n) = batch.column(0)[i].as_py(), (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in (1, 2))
                    own = copy.deepcopy(start)
                    own.learn(*repeated(keys, n), np.random.default_rng((start.seed, r, shard)))
                    seen = own.history - start.history
                    moved += seen * (own.values - start.values)
                    mass += seen
                    count += 1
            if count:
                at = range(0, len(mass), SLICE)
                salt = TaskContext.get().partitionId() % SALTS
                yield pa.RecordBatch.from_arrays([pa.array([i // SLICE for i in at], pa.int32()), pa.array([salt] * len(at), pa.int32()), *[pa.array([x[i : i + SLICE].tobytes() for i in at], pa.binary()) for x in (moved, mass)], pa.array([count] * len(at), pa.int64())], names)

        def added(table: pa.Table) -> pa.Table:
            sums = [pa.array([sum(np.frombuffer(x, np.float64) for x in table.column(c).to_pylist()).tobytes()], pa.binary()) for c in ("moved", "mass")]
            return pa.table([*[table.column(c).slice(0, 1) for c in ("slice", "salt")], *sums, pa.array([sum(table.column("shards").to_pylist())], pa.int64())], names)

        schema = "slice int, salt int, moved binary, mass binary, shards long"
        names = ["slice", "salt", "moved", "mass", "shards"]
        made = shards.select("shard", "keys", "n").mapInArrow(learn, schema)
        for row in made.groupBy("slice", "salt").applyInArrow(added, schema).groupBy("slice").applyInArrow(added, schema).collect():
            at = slice(row["slice"] * SLICE, (row["slice"] + 1) * SLICE)
            moved, mass = (np.frombuffer(row[c], np.float64) for c in ("moved", "mass"))
            fit.values[at] += (moved / np.where(mass > 0, mass, 1)).astype(np.float32)
            fit.history[at] += (mass / row["shards"]).astype(np.float32)
        sent.destroy()


def most_frequent(counts: DataFrame, at_most: int) -> list[tuple[bytes, int]]:
    """(token, n) of the most frequent tokens, the largest n first, ties by token; those of about the same n go together.

    Their least count is found in a histogram, so that no task sends more of them than belong to the result.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 64).cast("int")
    left, cut = at_most, None
    for row in counts.groupBy(step.alias("step")).agg(F.count("*").alias("tokens")).orderBy(F.desc("step")).collect():
        left -= row["tokens"]
        if left < 0:
            break
        cut = row["step"]
    if cut is None:
        return []
    return sorted(((bytes(r["token"]), r["n"]) for r in counts.where(step >= cut).collect()), key=lambda x: (-x[1], x[0]))


def normalisers(near: np.ndarray, far: np.ndarray, output: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """log sum over the symbols of exp(score), for all pairs of context symbols: one matrix product for each 64 rows."""
    out = np.empty((len(near), len(far)), np.float32)
    base = far @ output.T + bias
    top = base.max(axis=1, keepdims=True)
    from_far = np.exp(base - top)
    for i in range(0, len(near), 64):
        a = near[i : i + 64] @ output.T
        high = a.max(axis=1, keepdims=True)
        out[i : i + 64] = np.log(np.exp(a - high) @ from_far.T) + high + top[:, 0]
    return out


def score(docs: DataFrame, training: DataFrame, text: str = "text", model_words: int = MODEL_WORDS, common_words: int = 1 << 17, rounds: int = 3) -> DataFrame:
    """``docs`` without its text, with n_tokens, n_known, train_tokens, base_score and score (log10).

    Columns of ``docs`` with these names are replaced.
    """
    spark = docs.sparkSession
    counts = stored(count_tokens(training, text), "token-counts")
    totals = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("kinds"), F.max(F.when(F.col("token") == F.lit(END), F.col("n"))).alias("texts")).first()
    train_tokens, kinds = totals["tokens"] or 0, totals["kinds"]
    common = most_frequent(counts, common_words)
    if all(t != END for t, _ in common[:model_words]):
        common = [(END, totals["texts"] or 0), *[x for x in common if x[0] != END]]
    words = min(model_words, len(common))
    model_tokens = {t for t, _ in common[:words]}

    @F.pandas_udf("int")
    def shape_of(tokens: pd.Series) -> pd.Series:
        return tokens.map(lambda t: -1 if t in model_tokens else shape(t)).astype("int32")

    shape_tokens, shape_kinds = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in counts.groupBy(shape_of("token").alias("shape")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():
        if r["shape"] >= 0:
            shape_tokens[r["shape"]], shape_kinds[r["shape"]] = r["n"], r["kinds"]
    shape_log = np.log10(shape_tokens + 0.5 * (shape_kinds + 1))
    symbols = {t: i for i, (t, _) in enumerate(common[:words])}
    end = symbols[END]
    shards = max(1, -(-train_tokens // SHARD_TOKENS))

    def symbols_of(text: str | None) -> np.ndarray:
        return np.array([symbols[t] if t in symbols else words + shape(t) for t in [*tokens_of(text), END]], np.uint16)

    def trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.append(trigram_keys(symbols_of(t), end))
                size += len(held[-1])
                if size >= FLUSH_KEYS:
                    yield from entries(held)
                    held, size = [], 0
        if held:
            yield from entries(held)

    def entries(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        yield from sharded(*counted(np.concatenate(held)), shards)

    fit = Estimation(np.concatenate(([n for _, n in common[:words]], shape_tokens)), dims=24, batch=1024, noise=200, rate=0.08, seed=5)
    dealt = "shard long, keys binary, n binary"
    learn_in_tasks(stored(training.select(text).mapInArrow(trigrams, dealt).groupBy("shard").applyInArrow(merged, dealt), "trigrams"), fit, rounds)
    model = fit.model()

    symbol_of = np.array([i if i < words else words + shape(t) for i, (t, _) in enumerate(common)], np.int64)
    sent = spark.sparkContext.broadcast((model, {t: i for i, (t, _) in enumerate(common)}, symbol_of, np.log10(np.array([n for _, n in common]) + 0.5), np.array([n > 0 for _, n in common])))

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, index, symbol_of, log_count, counted = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: list[tuple] = []
                for t in part.column(1).to_pylist():
                    tokens = [*tokens_of(t), END]
                    found = np.array(list(map(index.get, tokens, repeat(-1))))
                    line, missing = symbol_of[found], np.flatnonzero(found < 0)
                    rare = [tokens[i] for i in missing]
                    line[missing] = [words + shape(x) for x in rare]
                    shared, logs = line >= words, log_count[found]
                    logs[missing] = 0.0
                    lm_score = float(lm.log10_probability(line, end).sum(dtype=np.float64)) + float(logs[shared].sum()) - float(shape_log[line[shared] - words].sum())
                    out.append((len(tokens), int((counted[found] & (found >= 0)).sum()), float(logs.sum()), lm_score, [{"token": k, "n": v} for k, v in Counter(rare).items()]))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds_out)]], ["row", "n_tokens", "n_common", "base", "lm", "rare"])

    kinds_out = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int64())])))
    kept = [c for c in docs.columns if c not in (text, "n_tokens", "n_known", "train_tokens", "base_score", "score", "_row")]
    read = docs.select(*kept, F.monotonically_increasing_id().alias("_row"), F.struct(*kept).alias("_kept"), text) if kept else docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(F.lit(0).alias("_")).alias("_kept"), text)
    schema = read.schema["_kept"].dataType
    rows = read.select(F.struct("_row", "_kept").alias("_row"), text)
    scored = stored(rows.mapInArrow(evaluate, f"row struct<_row:bigint,_kept:{schema.simpleString()}>, n_tokens long, n_common long, base double, lm double, rare array<struct<token:binary,n:bigint>>"), "lm-rows")
    rare = scored.select(F.col("row._row").alias("_row"), F.explode("rare").alias("x")).select("_row", F.col("x.token").alias("token"), F.col("x.n").alias("times"))
    seen = rare.join(counts, "token", "left")
    by_row = seen.groupBy("_row").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rest"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"))
    rest = F.coalesce("rest", F.lit(0.0))
    done = scored.select(F.col("row._row").alias("_row"), "row._kept", "n_tokens", "n_common", "base", "lm").join(by_row, "_row", "left")
    return done.select(
        *[F.col(f"_kept.`{c}`").alias(c) for c in kept],
        "n_tokens",
        (F.col("n_common") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rest - F.col("n_tokens") * float(np.log10(train_tokens + 0.5 * (kinds + 1)))).alias("base_score"),
        (F.col("lm") + rest).alias("score"),
    )
