"""Benchmark decontamination with spaced seeds.

A text and a benchmark item overlap where some ``window`` tokens in a row agree but for at most ``substitutions``
places. A window is cut into ``substitutions + 2`` equal blocks; whatever the substituted places, two blocks stay
clean, so the seeds are the masks that keep two blocks and ignore what is between them (one mask for each distance of
two blocks). Every place of every text is hashed under every mask; the hashes that the benchmark has are joined with
it; each hit fixes an alignment of text and item, and the windows of that alignment are compared token by token.

Most places of the texts are ruled out inside the tasks by a bitmap of the benchmark's hashes. Its size is fixed
(2 MB); when a benchmark is so large that it fills, more rows go to the join and the result is the same.

Tokens are runs of word characters in lower case. Items of fewer tokens than a window, but at least two blocks, must
agree as a whole, but for as many substitutions as their length allows in proportion (one of 8 to 15 tokens); one of
their blocks stays clean then, and blocks of such items are a seed of their own. Shorter items are no evidence and take
no part.

Defined results: null texts have no tokens. Null ids match null ids. Each repeated row is checked; one row for each
document id and item id is returned. Repeated items give rows of their own. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from budgetloom.llm.common import likely, row_key, stored
from budgetloom.operators.lookup import attach

TOKEN = re.compile(r"\w+")
BITMAP_BITS = 24
BLOCK = 1 << 18
_ODD = np.random.default_rng(17).integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    """Hashes of tokens, as 8 bytes each."""

    def __missing__(self, word: str) -> bytes:
        h = blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        if len(self) < 400_000:
            self[word] = h
        return h


_CACHE = _Hashes()
#: ASCII with every character that is none of a word's as a space.
_SPACED = "".join(c if TOKEN.match(c) else " " for c in map(chr, range(128)))


def token_hashes(text: str | None) -> np.ndarray:
    """Hashes of the text's tokens. In ASCII, where the characters of words are few, a table does what the pattern would."""
    lower = (text or "").lower()
    words = lower.translate(_SPACED).split() if lower.isascii() else TOKEN.findall(lower)
    return np.frombuffer(b"".join(map(_CACHE.__getitem__, words)), "<u8")


def masks(window: int, substitutions: int) -> list[np.ndarray]:
    """The token places that each seed keeps, from 0; the narrowest first."""
    size = window // (substitutions + 2)
    return [np.concatenate((np.arange(size), np.arange(size) + size * (d + 1))) for d in range(substitutions + 1)]


def allowed(tokens: int, window: int, substitutions: int) -> int:
    """Substitutions within a window, or within the whole of a shorter item: in proportion, and one block stays clean."""
    return substitutions if tokens >= window else min(substitutions * tokens // window, tokens // (window // (substitutions + 2)) - 1)


def _runs(seeds: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Each seed's places in runs of neighbours: number of the first kept place, length, place. All are cut at the same numbers,
    so that seeds share runs."""
    cuts = sorted({int(c) + 1 for kept in seeds for c in np.flatnonzero(np.diff(kept) != 1)})
    out = []
    for kept in seeds:
        ends = [0, *[c for c in cuts if c < len(kept)], len(kept)]
        out.append([(a, b - a, int(kept[a])) for a, b in zip(ends, ends[1:])])
    return out


def seed_hashes(tokens: np.ndarray, seeds: list[np.ndarray], runs: list[list[tuple[int, int, int]]] | None = None) -> list[np.ndarray]:
    """For each seed, the hash at every place where it fits.

    A hash is a sum over the kept places, so a run of neighbours that several seeds keep is summed once for all places
    (``runs``: those of the seeds, for callers with many texts).
    """
    out = []
    mixed, sums = tokens ^ (tokens >> np.uint64(29)), {}

    def summed(first: int, size: int) -> np.ndarray:
        if (first, size) not in sums:
            n = len(mixed) - size + 1
            total = mixed[:n] * _ODD[first]
            for i in range(1, size):
                total += mixed[i : i + n] * _ODD[first + i]
            sums[first, size] = total
        return sums[first, size]

    for k, (kept, parts) in enumerate(zip(seeds, runs or _runs(seeds), strict=True)):
        n = len(tokens) - int(kept[-1])
        if n <= 0:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.full(n, _ODD[60 + k % 4], np.uint64)
        for first, size, at in parts:
            h += summed(first, size)[at : at + n]
        out.append((h ^ (h >> np.uint64(31))) * _ODD[59])
    return out


def good_windows(text: np.ndarray, item: np.ndarray, shift: int, window: int, substitutions: int) -> np.ndarray:
    """Places of ``item`` where a window agrees well enough with ``text``, ``shift`` places further on."""
    if len(item) < window:
        window, substitutions = len(item), allowed(len(item), window, substitutions)
    first, last = max(0, -shift), min(len(item), len(text) - shift)
    if last - first < window:
        return np.zeros(0, np.int64)
    same = np.concatenate(([0], np.cumsum(text[first + shift : last + shift] == item[first:last])))
    return first + np.flatnonzero(same[window:] - same[:-window] >= window - substitutions)


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 16, substitutions: int = 2, tasks: int | None = None) -> DataFrame:
    """key, item, tokens (of the item, in good windows), text_start (token where the first of them begins in the text). ``tasks``: how many store its alignments at most."""
    size = window // (substitutions + 2)
    seeds = [*masks(window, substitutions), np.arange(size)]  # the last one for items shorter than a window
    runs = _runs(seeds)
    least = 2 * size
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).cast("string").alias("item_text"))
    item_type, key_type = items.schema["item"].dataType.simpleString(), docs.schema[key].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column(1).to_pylist()):
                tokens = token_hashes(t)
                if len(tokens) < least:
                    continue
                found = seed_hashes(tokens, seeds, runs)
                if len(tokens) < window:
                    places = np.arange(0, len(tokens) - size + 1, size)
                    hashes = found[-1][places].view(np.int64)
                else:
                    hashes = np.concatenate(found[:-1]).view(np.int64)
                    places = np.concatenate([np.arange(len(f)) for f in found[:-1]])
                which = batch.column(0).slice(i, 1).take(pa.array(np.zeros(len(hashes), np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(hashes), which, pa.array(places.astype(np.int32))], ["hash", "item", "item_at"])

    known = stored(items.mapInArrow(index, f"hash long, item {item_type}, item_at int"), "benchmark-seeds")
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    word = F.shiftrightunsigned("hash", 64 - BITMAP_BITS + 6)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITMAP_BITS}) & 63 as int))")
    words = known.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()  # at most 2^18 rows
    bitmap[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    sent = docs.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            for i, t in enumerate(batch.column(1).to_pylist()):
                tokens = token_hashes(t)
                for begin in range(0, max(1, len(tokens)), BLOCK):
                    for h in seed_hashes(tokens[begin : begin + BLOCK + window], seeds, runs):
                        at = np.flatnonzero((bits[h >> np.uint64(64 - BITMAP_BITS + 6)] >> ((h >> np.uint64(64 - BITMAP_BITS)) & np.uint64(63))) & np.uint64(1))
                        if len(at):
                            which = batch.column(0).slice(i, 1).take(pa.array(np.zeros(len(at), np.int64)))
                            yield pa.RecordBatch.from_arrays([which, pa.array(h[at].view(np.int64)), pa.array(at + begin)], ["key", "hash", "at"])

    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    hits = texts.mapInArrow(probe, f"key {key_type}, hash long, at long")
    matched = attach(hits, known.select(F.col("hash").alias("seed"), "item", "item_at"), {"seed": F.col("hash")}, how="inner")
    aligned = stored(matched.select("key", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "alignments", tasks)
    with_item = aligned.withColumnRenamed("item", "i").join(items, F.col("i").eqNullSafe(F.col("item"))).drop("i")
    pairs = likely(texts, F.col("key"), aligned, F.col("key")).join(with_item.withColumnRenamed("key", "k"), F.col("key").eqNullSafe(F.col("k"))).select("key", "item", "text", "item_text", "shift")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, counts, starts = [], [], []
            for i, (t, u, shift) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)), strict=True)):
                told, asked = token_hashes(t), token_hashes(u)
                good = good_windows(told, asked, shift, window, substitutions)
                if len(good):
                    covered = np.unique(good[:, None] + np.arange(min(window, len(asked)))[None])
                    kept.append(i)
                    counts.append(len(covered))
                    starts.append(int(good[0]) + shift)
            if kept:
                at = pa.array(kept)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(counts, pa.int64()), pa.array(starts, pa.int64())], ["key", "item", "tokens", "text_start"])

    checked = pairs.mapInArrow(verify, f"key {key_type}, item {item_type}, tokens long, text_start long")
    found = checked.groupBy("key", "item").agg(F.max("tokens").alias("tokens"), F.min("text_start").alias("text_start"))
    return found.select(F.col("key").alias(key), F.col("item").alias(item), "tokens", "text_start")


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` without those that overlap with any item. Each row is judged by its own text, whatever its id."""
    rows = docs.withColumn("_row", row_key(key, text))
    bad = overlaps(rows, benchmark, "_row", text, **settings).select(F.col("_row").alias("_bad")).distinct()
    return rows.join(bad, F.col("_row").eqNullSafe(F.col("_bad")), "left_anti").select(*docs.columns)
