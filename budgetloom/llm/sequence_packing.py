"""Packing of documents into training sequences along a Hilbert curve.

A document's tokens are hashed to a vector of few dimensions (each token id has fixed random weights); the vectors are
standardised with the mean and deviation over the corpus and mapped to a Hilbert curve. Documents are range-sorted by
their Hilbert key and laid end to end; the stream is cut every ``length`` tokens, so neighbours on the curve share
sequences and only the last sequence of the corpus is short. Offsets are prefix sums: within each range partition, and
over the partitions' totals. Token ids never pass through the sort.

Defined results: a null text is the empty text and holds only the end token. Repeated rows are packed each on its own.
Ties on the curve go by id, then by place in the input. An empty table gives no pieces.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator
from math import erf, sqrt
from sys import byteorder

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from budgetloom.llm.common import stored

DIMS, CURVE_BITS = 4, 12
#: Characters up to U+017F without those whose case or white space rules differ between libraries.
PLAIN = re.compile("[\t\n\r\x20-\x7e¡-įı-ſ]*")
LETTER, NUMBER = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾"
#: The tokenizer's own word pattern for such characters.
WORDS = re.compile(f"[{LETTER}]+|'(?:s|t|re|ve|m|ll|d)|[{NUMBER}]|[^\\s{LETTER}{NUMBER}]+")
CACHE_WORDS = 400_000
#: How byte-level tokenizers spell the bytes that are no printable Latin-1 characters: by those from U+0100 on.
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}
_STATE: dict = {}


class WordCache(dict):
    """Token ids of words, as little-endian unsigned 16-bit bytes. The tokenizer treats words one by one, so a text's ids
    are those of its words end to end; texts with other characters or control strings go to the tokenizer whole.

    A new word goes to the tokenizer's model alone, with its bytes spelled as the model's letters: the words are known, so
    they need no second search for them, and no offsets are wanted."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.control = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        if max(self.tokenizer.get_vocab().values()) > 65535:
            raise ValueError("ids of at most 16 bits are expected")

    def __missing__(self, word: str) -> bytes:
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = array("H", [t.id for t in self.model.tokenize(spelled)])
        if byteorder == "big":
            ids.byteswap()
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = raw = ids.tobytes()
        return raw

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; null is the empty text."""
        return [self.encode(t) if t else b"" for t in texts]

    def encode(self, text: str) -> bytes:
        if self.is_plain(text):
            return b"".join(map(self.__getitem__, WORDS.findall(text.lower())))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def is_plain(self, text: str) -> bool:
        return PLAIN.fullmatch(text) is not None and (text.isascii() or unicodedata.is_normalized("NFC", text)) and not any(c in text for c in self.control)


def word_cache(path: str) -> WordCache:
    """One cache for each worker process."""
    if _STATE.get("path") != path:
        _STATE.update(path=path, cache=WordCache(path))
    return _STATE["cache"]


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Keys along the Hilbert curve of points (rows of small unsigned integers), by the transpose method, row-wise at once."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def tokenised(docs: DataFrame, key: str, text: str, tokenizer: str, end_id: int) -> DataFrame:
    """row, id, ids (unsigned 16-bit, end token included), n_tokens and the hashed vector; row is unique."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(tokenizer)
        table = np.random.default_rng(11).standard_normal((65536, DIMS)).astype(np.float32)
        end = np.array([end_id], "<u2").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # small batches: ids and vectors of few texts at once
                part = batch.slice(at, 256)
                ids = [i + end for i in cache.encode_all(part.column(2).to_pylist())]
                vectors = [_vector(np.frombuffer(i, "<u2"), table) for i in ids]
                columns = [part.column(0), part.column(1), pa.array(ids, pa.binary()), pa.array([len(i) // 2 for i in ids], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(vectors, pa.list_(pa.float64()))], ["row", "id", "ids", "n_tokens", "v"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "row long, id long, ids binary, n_tokens long, v array<double>")


def _vector(ids: np.ndarray, table: np.ndarray) -> list[float]:
    total = np.zeros(DIMS)
    for at in range(0, len(ids), 4096):
        total += table.take(ids[at : at + 4096], axis=0).sum(axis=0)
    return (total / np.sqrt(len(ids))).tolist()


def curve_key(v: Column, mean: list[float], deviation: list[float]) -> Column:
    @F.pandas_udf("long")
    def key(values: pd.Series) -> pd.Series:
        z = (np.stack(values.to_numpy()) - mean) / deviation if len(values) else np.zeros((0, DIMS))
        cells = [[int(min((1 + erf(x / sqrt(2))) / 2, 1 - 1e-9) * (1 << CURVE_BITS)) for x in row] for row in z]  # equal shares of a normal distribution
        return pd.Series(hilbert_keys(np.array(cells, np.int64).reshape(-1, DIMS), CURVE_BITS))

    return key(v)


def pack(docs: DataFrame, key: str, text: str, tokenizer: str, end_id: int, length: int = 4096, tasks: int | None = None) -> DataFrame:
    """Pieces: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, padded. ``tasks``: how many store its tables at most."""
    tokens = stored(tokenised(docs, key, text, tokenizer, end_id), "tokens", tasks)
    stats = tokens.agg(*[f(F.col("v")[i]).alias(f"{f.__name__}{i}") for i in range(DIMS) for f in (F.mean, F.stddev_pop)]).first()
    mean = [stats[f"mean{i}"] or 0.0 for i in range(DIMS)]
    deviation = [stats[f"stddev_pop{i}"] or 1.0 for i in range(DIMS)]
    order = ["curve", "id", "row"]
    keyed = tokens.select("row", "id", "n_tokens", curve_key(F.col("v"), mean, deviation).alias("curve"))
    ranged = stored(keyed.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "curve", tasks)
    before = ranged.groupBy("part").agg(F.sum("n_tokens").alias("total")).select("part", (F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")).alias("before"), F.sum("total").over(Window.partitionBy()).alias("all"))
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("until", F.sum("n_tokens").over(within)).join(before, "part").select("row", (F.col("before") + F.col("until") - F.col("n_tokens")).alias("at"), "all")
    joined = tokens.select("row", "id", "ids").join(placed, "row").select("id", "ids", "at", "all")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows: list[tuple] = []
            for doc, raw, at, every in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                n, start = len(raw) // 2, 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(length - offset, n - start)
                    last = every - sequence * length  # what the last sequence holds
                    padded = length if last >= length or last & (last - 1) else last
                    rows.append((doc, start, size, np.frombuffer(raw, "<u2", size, 2 * start).astype("<u4").tobytes(), n, sequence, offset, padded))
                    start += size
                    if len(rows) >= 1024:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return joined.mapInArrow(cut, "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, padded long")
