"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over every labelled text. The weights are fitted with follow-the-regularised-leader
(per-coordinate steps, L1 and L2 penalties, so most weights are exactly zero) on a bounded sample: about
``max_train_docs`` texts, drawn by a hash of the text with the same quota for each language. A fifth of the sample is
held back to fit one temperature, so that scores are calibrated probabilities.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text where nothing
labelled was given. Repeated rows get equal predictions. Columns called ``lang_pred`` or ``score`` are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
BITS = 14
BLOCK = 1 << 20


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # language x bucket
    bias: np.ndarray
    temperature: float


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed 1-, 2- and 3-grams of code points, lower case; long texts go block by block."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(1 << BITS, np.int64)
    shift = np.uint32(32 - BITS)
    for at in range(0, len(points) - 2, BLOCK):
        c = points[at : at + BLOCK + 2]
        h = c[:-2] * np.uint32(0x9E3779B1)
        for n in range(3):
            if n:
                h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) + c[n : len(c) - 2 + n] * np.uint32(0xC2B2AE3D)
            out += np.bincount((h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F) >> shift, minlength=1 << BITS)
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def document_frequencies(labelled: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts; partial counts per task, summed by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if has_letter(t):
                    seen += gram_counts(t) > 0
                    docs += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], docs))], ["bucket", "docs"])

    rows = labelled.select(text).mapInArrow(count, "bucket long, docs long").groupBy("bucket").agg(F.sum("docs").alias("docs")).collect()
    out, docs = np.zeros(1 << BITS, np.int64), 0
    for r in rows:
        if r.bucket < 0:
            docs = r.docs
        else:
            out[r.bucket] = r.docs
    return out, docs


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf[at]
    return x / max(float(np.sqrt(x @ x)), 1e-12)


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = gram_counts(text)
    at = np.flatnonzero(counts)
    return at, weighted(at, counts[at], idf)


def packed(text: str | None) -> bytes:
    """The buckets of a text, as their distances, and its counts in them, in few bytes; ``unpacked`` gives both back."""
    counts = gram_counts(text) if has_letter(text) else np.zeros(0, np.int64)
    at = np.flatnonzero(counts)
    return zlib.compress(np.diff(at, prepend=0).astype(np.uint16).tobytes() + counts[at].astype(np.uint32).tobytes(), 1)


def unpacked(sent: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(sent)
    n = len(raw) // 6
    return np.cumsum(np.frombuffer(raw, np.uint16, n), dtype=np.int64), np.frombuffer(raw, np.uint32, n, 2 * n).astype(np.int64)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Follow the regularised leader with per-coordinate learning rates; the last column is the unpenalised bias."""
    z, n = (np.zeros((classes, (1 << BITS) + 1)) for _ in range(2))
    penalty = np.full((1 << BITS) + 1, l1)
    penalty[-1] = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        zs, ns = z[:, at], n[:, at]
        return np.where(np.abs(zs) <= penalty[at], 0.0, (np.sign(zs) * penalty[at] - zs) / ((beta + np.sqrt(ns)) / alpha + l2))

    for _ in range(epochs):
        for at, x, y in rows:
            at, x = np.append(at.astype(np.int64), 1 << BITS), np.append(x.astype(float), 1.0)
            w = weights(at)
            p = softmax(w @ x)
            p[y] -= 1.0
            g = p[:, None] * x
            step = (np.sqrt(n[:, at] + g * g) - np.sqrt(n[:, at])) / alpha
            z[:, at] += g - step * w
            n[:, at] += g * g
    every = weights(np.arange((1 << BITS) + 1))
    return every[:, :-1], every[:, -1]


def fit_temperature(rows: list[tuple[np.ndarray, np.ndarray, int]], weights: np.ndarray, bias: np.ndarray) -> float:
    """The temperature with the least log loss on rows that the weights have not seen."""
    logits = [(weights[:, at] @ x.astype(float) + bias, y) for at, x, y in rows]
    loss = lambda t: -sum(float(np.log(softmax(z / t)[y] + 1e-300)) for z, y in logits)
    return min(np.geomspace(0.1, 10.0, 41), key=loss) if logits else 1.0


def train(docs: DataFrame, text: str = "text", label: str = "lang", max_train_docs: int = 2400, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, max_languages: int = 1000) -> LanguageModel | None:
    """Fit on the rows of ``docs`` with a label and a letter; None if there are none. More than ``max_languages`` labels are an error."""
    labelled = docs.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label")).where(F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r.label: r.n for r in labelled.groupBy("label").agg(F.count("*").alias("n")).limit(max_languages + 1).collect()}
    if not sizes:
        return None
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    df, total = document_frequencies(labelled, "text")
    idf = np.log((1 + total) / (1 + df)) + 1
    quota = max(1, max_train_docs // len(sizes))
    wanted = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, int(min(1.0, quota / n) * (1 << 32)))])
    chosen = labelled.withColumn("h", F.xxhash64("text")).where(F.pmod("h", F.lit(1 << 32)) < wanted[F.col("label")])

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"label": b["label"], "h": b["h"], "grams": [packed(t) for t in b["text"]]})

    languages = sorted(sizes)
    index = {k: i for i, k in enumerate(languages)}
    got = sorted(chosen.mapInPandas(grams, "label string, h long, grams binary").collect(), key=lambda r: (r.h, r.label))
    rows = []  # the driver holds all of them: two bytes for a bucket and four for its weight
    for r in got:
        at, counts = unpacked(r["grams"])
        rows.append((at.astype(np.uint16), weighted(at, counts, idf).astype(np.float32), index[r["label"]]))
    order = np.random.default_rng(7).permutation(len(rows))
    rows = [rows[i] for i in order]
    held = rows[::5] if len(rows) >= 50 else []
    weights, bias = fit_ftrl([r for i, r in enumerate(rows) if i % 5 or not held], len(languages), epochs, alpha, beta, l1, l2)
    return LanguageModel(languages, idf, weights, bias, float(fit_temperature(held, weights, bias)))


def predict(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the calibrated probability of that language."""
    kept = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "score")])
    if model is None:
        return kept.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})

    def classify(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            if has_letter(t):
                at, x = vector(t, model.idf)
                p = softmax((model.weights[:, at] @ x + model.bias) / model.temperature)
                out.append((model.languages[int(p.argmax())], float(p.max())))
            else:
                out.append((UNKNOWN, 0.0))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    udf = F.pandas_udf(classify, T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    found = kept.withColumn("_language", udf(F.col(text)))
    return found.select(*kept.columns, F.col("_language.lang_pred").alias("lang_pred"), F.col("_language.score").alias("score"))
