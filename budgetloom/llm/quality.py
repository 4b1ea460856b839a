"""Quality classification by co-training of a text view and a page-metadata view.

The text view holds hashed words and word endings of the whole text. The metadata view holds where a page comes from
(source, language, declared length) and how it is laid out (lines, word lengths, shares of capitals, digits, marks and
repeated words), but no words. Each view has its own logistic regression. In each round, each model labels all those
documents of the pool that it is sure of, by odds calibrated on labelled documents held back from both; the other model
learns from them, in the tasks that read them, and the tasks' changes are averaged by their numbers of documents. Both
then see the labelled documents again. After the rounds one logistic regression over the calibrated log odds, fitted on
the held-back documents, gives the score.

The pool is every document but the labelled ones in use, of which there are at most ``max_labelled``, with the smallest
hashes of their ids. Its features are written once and read in every round. The driver holds the labelled documents'
features and the two models, of fixed size.

Defined results: null texts are empty texts; null metadata is a value of its own; documents without an id are in the
pool. A document with several label rows is good only if all are; of several texts of a labelled id, the one with the
smallest hash is learned from. Without labels of both kinds, every score is the share of good labels (0.5 without any).
An empty pool leaves the models of the labelled documents. Columns called score, p_text, p_metadata or keep are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from budgetloom.llm.common import stored

TEXT_BITS = 18
META = 64 + 64 + 16 + 8
Sparse = tuple[np.ndarray, np.ndarray]


CHUNK = 1 << 12


def _bucket(word: bytes) -> int:
    return crc32(word) * 0x9E3779B1 % (1 << 32) >> (32 - TEXT_BITS)


_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\r\x0b\f")] = True


@cache
def _endings() -> np.ndarray:
    """The buckets of all words' endings, by the last two bytes; words of one byte follow them."""
    return np.array([_bucket(b"\x00" + n.to_bytes(2)) for n in range(1 << 16)] + [_bucket(bytes((0, n))) for n in range(256)])


def counted_view(text: str | None) -> Sparse:
    """Buckets of words (A-Z in lower case) and of their last two bytes, in order, with their counts."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    words = raw.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashed = np.fromiter(map(crc32, words), np.uint64, len(words)) * np.uint64(0x9E3779B1) % np.uint64(1 << 32) >> np.uint64(32 - TEXT_BITS)
    seen = np.frombuffer(b"  " + raw + b" ", np.uint8)
    blank = _BLANK[seen]
    end = 1 + np.flatnonzero(blank[2:] & ~blank[1:-1])
    last = seen[end].astype(np.int64)
    endings = _endings()[np.where(blank[end - 1], (1 << 16) + last, (seen[end - 1].astype(np.int64) << 8) + last)]
    buckets = np.sort(np.concatenate((hashed.astype(np.int64), endings)))
    first = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1])))
    return buckets[first], np.diff(first, append=len(buckets))


def of_length_one(at: np.ndarray, n: np.ndarray) -> Sparse:
    x = np.log1p(n)
    return at, x / np.sqrt(x @ x) if len(x) else x


def text_view(text: str | None) -> Sparse:
    """Log counts of the text's buckets, scaled to length one."""
    return of_length_one(*counted_view(text))


_LAYOUT = [list(s) for s in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!|{}[]<>#*@")]


def metadata_view(text: str | None, source: str | None, lang: str | None, size: float | None) -> Sparse:
    t = text or ""
    words, lines = t.split(), t.split("\n")
    letters = sum(map(len, words)) or 1
    seen = np.bincount(np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    capitals, digits, marks = (float(seen[s].sum()) / letters for s in _LAYOUT)
    layout = [capitals, digits, 5 * marks, len(set(words)) / (len(words) or 1), len(set(lines)) / len(lines), letters / (len(words) or 1) / 10, min(3.0, len(words) / len(lines) / 50), 1.0]
    length = 15 if size is None or size != size else min(14, max(0, int(size)).bit_length())
    hashed = [crc32(f"s{source}".encode("utf-8", "surrogatepass")) % 64, 64 + crc32(f"l{lang}".encode("utf-8", "surrogatepass")) % 64, 128 + length]
    return np.array([*hashed, *range(144, 144 + len(layout))]), np.array([0.3, 0.3, 0.5, *layout])


class View:
    """Logistic regression by Adagrad steps; the last weight is the bias."""

    def __init__(self, size: int):
        self.w, self.history = np.zeros(size + 1), np.full(size + 1, 1e-2)

    def step(self, row: Sparse, label: float, rate: float = 0.5, l2: float = 1e-6) -> None:
        at, x = np.append(row[0], len(self.w) - 1), np.append(row[1], 1.0)
        g = (1 / (1 + np.exp(-np.clip(self.w[at] @ x, -30, 30))) - label) * x + l2 * self.w[at]
        self.history[at] += g * g
        self.w[at] -= rate * g / np.sqrt(self.history[at])

    def fit(self, rows: list[Sparse], y: np.ndarray, epochs: int, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in rng.permutation(len(rows)):
                self.step(rows[i], y[i])


def logit(w: np.ndarray, row: Sparse) -> float:
    return float(np.clip(w[row[0]] @ row[1] + w[-1], -30, 30))


def newton(x: np.ndarray, y: np.ndarray, steps: int = 30, l2: float = 1e-2) -> np.ndarray:
    """A small dense logistic regression; the last weight is the bias."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + l2 * np.eye(len(w)), x.T @ (p - y) + l2 * w)
    return w


@dataclass
class QualityModel:
    text: np.ndarray
    metadata: np.ndarray
    calibration: tuple[np.ndarray, np.ndarray]  # slope and intercept of each view
    combined: np.ndarray

    def scores(self, text: Sparse, metadata: Sparse) -> tuple[float, float, float]:
        odds = [float(np.clip(c[0] * logit(w, row) + c[1], -30, 30)) for c, w, row in zip(self.calibration, (self.text, self.metadata), (text, metadata), strict=True)]
        both = float(np.clip(self.combined[0] * odds[0] + self.combined[1] * odds[1] + self.combined[2], -30, 30))
        return tuple(float(1 / (1 + np.exp(-z))) for z in (both, *odds))


def taught(pool: DataFrame, models: list[View], calibration: list[np.ndarray], sure: float, rate: float) -> None:
    """Let each model learn from the documents of the whole pool that the other is sure of.

    Every task learns from its documents in turn, beginning with the models as they are, and gives its change; a model
    moves by the mean change over the documents that were learned from. Changes are added up in chunks, in two steps.
    """
    sent = pool.sparkSession.sparkContext.broadcast(([(m.w.astype(np.float32), m.history.astype(np.float32)) for m in models], calibration))
    limit = np.log(sure / (1 - sure))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, scales = sent.value
        local = []
        for w, history in started:
            view = View(len(w) - 1)
            view.w, view.history = w.astype(float), history.astype(float)
            local.append(view)
        taken, part = [0, 0], 0
        for batch in batches:
            for n, (t, m) in enumerate(zip(batch.column("t").to_pylist(), batch.column("m").to_pylist(), strict=True)):
                row = (_unpack_counts(t), _unpack(m))
                part = part or crc32(t + m + n.to_bytes(4, "little"))
                odds = [s[0] * logit(w, r) + s[1] for (w, _), s, r in zip(started, scales, row, strict=True)]
                for v in (0, 1):
                    if abs(odds[v]) >= limit:
                        local[1 - v].step(row[1 - v], float(odds[v] > 0), rate)
                        taken[1 - v] += 1
        for v in (0, 1):
            if taken[v]:
                change = (local[v].w - started[v][0]) * taken[v]
                pieces = [change[i : i + CHUNK] for i in range(0, len(change), CHUNK)]
                used = [(i, p) for i, p in enumerate(pieces) if p.any() or not i]
                columns = [[v] * len(used), [i for i, _ in used], [part % 64] * len(used), [taken[v]] * len(used)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array([p.tolist() for _, p in used], pa.list_(pa.float64()))], ["view", "chunk", "part", "n", "change"])

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(len(t["change"][0]))
        for c in t["change"]:
            total += np.asarray(c.values)
        first = {c: [t[c][0].as_py()] for c in ("view", "chunk", "part")}
        return pa.table({**first, "n": [sum(t["n"].to_pylist())], "change": pa.array([total.tolist()], pa.list_(pa.float64()))})

    schema = "view long, chunk long, part long, n long, change array<double>"
    some = pool.mapInArrow(learn, schema).groupBy("view", "chunk", "part").applyInArrow(add, schema)
    summed = some.groupBy("view", "chunk").applyInArrow(add, schema).collect()  # at most one row for each chunk of the two models
    numbers = {r["view"]: r["n"] for r in summed if not r["chunk"]}
    for r in summed:
        at = r["chunk"] * CHUNK
        models[r["view"]].w[at : at + len(r["change"])] += np.array(r["change"]) / numbers[r["view"]]
    sent.destroy()


def co_train(labelled: list[tuple[Sparse, Sparse, int]], pool: DataFrame, rounds: int, sure: float, rate: float) -> QualityModel | float:
    """``labelled``: text view, metadata view, label. The share of good labels if there is only one kind."""
    y = np.array([r[2] for r in labelled], float)
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    held = np.arange(len(labelled)) % 4 == 0
    learn = ~held
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = learn = np.ones(len(labelled), bool)
    models = [View(1 << TEXT_BITS), View(META)]
    rows = [[labelled[i][v] for i in np.flatnonzero(learn)] for v in (0, 1)]
    check = np.flatnonzero(held)

    def calibrated() -> tuple[np.ndarray, list[np.ndarray]]:
        odds = np.array([[logit(models[v].w, labelled[i][v]) for v in (0, 1)] for i in check])
        return odds, [newton(odds[:, [v]], y[check]) for v in (0, 1)]

    for v in (0, 1):
        models[v].fit(rows[v], y[learn], epochs=6)
    for _ in range(rounds):
        taught(pool, models, calibrated()[1], sure, rate)
        for v in (0, 1):
            models[v].fit(rows[v], y[learn], epochs=1)
    odds, calibration = calibrated()
    even = np.column_stack([np.clip(c[0] * odds[:, v] + c[1], -30, 30) for v, c in enumerate(calibration)])
    return QualityModel(models[0].w, models[1].w, tuple(calibration), newton(even, y[check]))


def views(docs: DataFrame, text: str, source: str, lang: str, size: str) -> list[Column]:
    """The columns that both views are made of; absent metadata columns are null."""
    return [F.col(text).cast("string").alias("text"), *[(F.col(c) if c in docs.columns else F.lit(None)).cast(k).alias(n) for c, k, n in ((source, "string", "source"), (lang, "string", "lang"), (size, "double", "size"))]]


def _pack_counts(at: np.ndarray, n: np.ndarray) -> bytes:
    """Distances of the buckets and their counts, which compress better than buckets and weights."""
    return np.diff(at, prepend=0).astype(np.int32).tobytes() + n.astype(np.uint32).tobytes()


def _unpack_counts(raw: bytes) -> Sparse:
    n = len(raw) // 8
    return of_length_one(np.cumsum(np.frombuffer(raw, np.int32, n), dtype=np.int64), np.frombuffer(raw, np.uint32, n, 4 * n).astype(float))


def _pack(row: Sparse) -> bytes:
    return row[0].astype(np.int32).tobytes() + row[1].astype(np.float32).tobytes()


def _unpack(raw: bytes) -> Sparse:
    n = len(raw) // 8
    return np.frombuffer(raw, np.int32, n).astype(np.int64), np.frombuffer(raw, np.float32, n, 4 * n).astype(float)


def train(docs: DataFrame, labels: DataFrame, good: Column, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", size: str = "n_chars", max_labelled: int = 8000, rounds: int = 3, sure: float = 0.95, rate: float = 0.05) -> QualityModel | float:
    """``good`` is a condition over ``labels``, null where a row says nothing."""
    marks = labels.select(F.col(key).alias("_id"), good.cast("int").alias("_y")).where("_id is not null and _y is not null").groupBy("_id").agg(F.min("_y").alias("_y"))
    wanted = F.broadcast(stored(marks.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled), "labelled-ids"))  # at most max_labelled rows
    rows = docs.select(F.col(key).alias("_id"), *views(docs, text, source, lang, size))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, *others = (b.column(c).to_pylist() for c in ("text", "source", "lang", "size"))
            t = pa.array([_pack_counts(*counted_view(x)) for x in texts], pa.binary())
            m = pa.array([_pack(metadata_view(*r)) for r in zip(texts, *others, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in b.schema.names if c in ("_id", "_y")), t, m], [*(c for c in b.schema.names if c in ("_id", "_y")), "t", "m"])

    one = F.struct(F.xxhash64("text", "source", "lang", "size").alias("h"), "text", "source", "lang", "size")
    taken = rows.join(wanted, "_id").groupBy("_id", "_y").agg(F.min(one).alias("d")).select("_id", "_y", "d.*").drop("h")
    id_type = rows.schema["_id"].dataType.simpleString()
    got = sorted(taken.mapInArrow(featurise, f"_id {id_type}, _y int, t binary, m binary").collect(), key=lambda r: (crc32(str(r["_id"]).encode()), str(r["_id"])))
    labelled = [(_unpack_counts(r["t"]), _unpack(r["m"]), r["_y"]) for r in got]
    if len({r["_y"] for r in got}) < 2:
        return co_train(labelled, rows.limit(0), 0, sure, rate)
    pool = stored(rows.join(wanted, "_id", "left_anti").select("text", "source", "lang", "size").mapInArrow(featurise, "t binary, m binary"), "pool-features")
    return co_train(labelled, pool, rounds, sure, rate)


def score(docs: DataFrame, model: QualityModel | float, text: str = "text", source: str = "source", lang: str = "lang", size: str = "n_chars", threshold: float = 0.5) -> DataFrame:
    """``docs`` with score (combined), p_text, p_metadata and keep (score at least ``threshold``)."""
    kept = docs.select(*[c for c in docs.columns if c not in ("score", "p_text", "p_metadata", "keep")])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def evaluate(texts: pd.Series, sources: pd.Series, langs: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        m = sent.value
        clean = [s.astype(object).where(s.notna(), None) for s in (texts, sources, langs, sizes)]
        if isinstance(m, float):
            return pd.DataFrame([(m, m, m)] * len(texts), columns=["score", "p_text", "p_metadata"])
        return pd.DataFrame([m.scores(text_view(r[0]), metadata_view(*r)) for r in zip(*clean, strict=True)], columns=["score", "p_text", "p_metadata"])

    udf = F.pandas_udf(evaluate, T.StructType([T.StructField(c, T.DoubleType()) for c in ("score", "p_text", "p_metadata")]))
    done = kept.withColumn("_quality", udf(*views(kept, text, source, lang, size)))
    return done.select(*kept.columns, *[F.col(f"_quality.{c}").alias(c) for c in ("score", "p_text", "p_metadata")], (F.col("_quality.score") >= threshold).alias("keep"))
