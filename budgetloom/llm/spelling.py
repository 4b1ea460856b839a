"""Spelling variants: words one edit apart, found with Bloom filters over the vocabulary, and the form most used.

Every word generates its shorter and its replaced neighbours and probes blocked Bloom filters, one for each word length,
which every task holds; only those that may be words are shuffled, to an exact join with the vocabulary. An insertion is
a deletion seen from the other word, and of two words that differ by a replacement the one with the smaller code point
generates the other, so that each pair is found once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from budgetloom.llm.common import stored
from budgetloom.operators.lookup import attach

#: The letters of a word in lower case, and their code points.
LETTERS = "a-zÀ-ÿ"
ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.int64)

#: Words longer than this share one filter; bits for each word; 512-bit blocks of all filters together (16 MB), beyond
#: which more false positives reach the join; probes of one numpy step; letters a task counts before it passes them on.
LONGEST, BITS, MAX_BLOCKS, STEP, HELD = 64, 16, 1 << 18, 1 << 20, 1 << 24

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


# --- words ---------------------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch], least: int, damage: int | None) -> Iterator[pa.RecordBatch]:
    words = re.compile(f"[{LETTERS}]{{{least},}}")
    seen: Counter[str] = Counter()
    size = 0

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
            start = zlib.crc32(f"{doc}:".encode())
            for word, n in Counter(words.findall(text.encode().lower().decode())).items():  # lowers ASCII only
                if damage and not (h := zlib.crc32(word.encode(), start)) % damage:
                    cut = h % len(word)
                    word = word[:cut] + word[cut + 1 :]
                    if len(word) < least:
                        continue
                size += 0 if word in seen else len(word)
                seen[word] += n
            if size > HELD:
                yield told()
                seen.clear()
                size = 0
    yield told()


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 7, least_count: int = 2, damage: int | None = None) -> DataFrame:
    """word, n: runs of Latin letters (code points of ``LETTERS``), A-Z in lower case, with their number over all texts.

    Words with fewer code points or occurrences than asked for are left out. ``damage`` plants variants: a run loses the
    code point h % length where the number divides h, the crc32 of its document's id (null: empty), a colon and the run.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).cast("string").alias("body")).where(F.col("body").isNotNull())
    counts = rows.mapInArrow(lambda it: _count(it, least_length, damage), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- filters -------------------------------------------------------------------------------------


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, base, np.uint64)])


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length).astype(np.int64)


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


class Filters:
    """Blocked Bloom filters by word length: 512-bit blocks, six bits of one block for each word."""

    def __init__(self, counts: dict[int, int]):
        wanted = {shard: -(-n * BITS // 512) for shard, n in sorted(counts.items())}
        total = sum(wanted.values())
        self.blocks = {s: max(1, n if total <= MAX_BLOCKS else n * MAX_BLOCKS // total) for s, n in wanted.items()}
        self.start, at = {}, 0
        for s, n in self.blocks.items():
            self.start[s], at = at, at + n
        self.bits = np.zeros(at * 8, np.uint64)

    def slots(self, h: np.ndarray, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """First 64-bit word of each hash's block, and six 9-bit places in it."""
        h = _mix(h)
        block = ((h >> np.uint64(32)) * np.uint64(self.blocks[shard])) >> np.uint64(32)
        return (block.astype(np.int64) + self.start[shard]) * 8, _mix(h + np.uint64(shard))

    def may_hold(self, h: np.ndarray, length: int) -> np.ndarray:
        """Places of the hashes that may belong to words of this length."""
        shard = min(length, LONGEST)
        if shard not in self.blocks:
            return np.zeros(0, np.int64)
        word, places = self.slots(h, shard)
        left = np.arange(len(h))
        for i in range(6):
            place = (places[left] >> np.uint64(9 * i)).astype(np.int64) & 511
            left = left[(self.bits[word[left] + (place >> 6)] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1]
        return left


def _filter_bits(batches: Iterator[pa.RecordBatch], empty: Filters) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        slots, bits = [], []
        for length, at in _by_length(words).items():
            h = (_codes([words[i] for i in at], length).astype(np.uint64) * _powers(BASE, length - 1)).sum(axis=1)
            word, places = empty.slots(h, min(length, LONGEST))
            for i in range(6):
                place = (places >> np.uint64(9 * i)).astype(np.int64) & 511
                slots.append(word + (place >> 6))
                bits.append(np.uint64(1) << (place & 63).astype(np.uint64))
        if slots:
            yield pa.RecordBatch.from_arrays([np.concatenate(slots), np.concatenate(bits).view(np.int64)], ["slot", "bits"])


def vocabulary_filters(words: DataFrame) -> Filters:
    """The filters of all words. Their size follows the number of words up to ``MAX_BLOCKS`` and not beyond."""
    shard = F.least(F.char_length("word"), F.lit(LONGEST))
    filters = Filters({r["shard"]: r["n"] for r in words.groupBy(shard.alias("shard")).agg(F.count("*").alias("n")).collect()})
    empty = Filters({})
    empty.blocks, empty.start = filters.blocks, filters.start
    parts = words.select("word").mapInArrow(lambda it: _filter_bits(it, empty), "slot long, bits long")
    told = parts.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    filters.bits[told.column("slot").to_numpy()] = told.column("bits").to_numpy().view(np.uint64)
    return filters


# --- neighbours ----------------------------------------------------------------------------------


def _edits(codes: np.ndarray, filters: Filters, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, position, new code point or 0 for a deletion) of the edits that may be words; ``codes`` holds words of one length."""
    n, length = codes.shape
    up = _powers(BASE, length)
    sums = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(codes.astype(np.uint64) * up[:length], axis=1)], axis=1)
    whole = sums[:, -1]
    for s in range(0, length, max(1, STEP // (n * len(ALPHABET)))):
        old = codes[:, s : s + max(1, STEP // (n * len(ALPHABET)))]
        width = old.shape[1]
        delta = (ALPHABET[None, None, :] - old[:, :, None]).astype(np.uint64) * up[None, s : s + width, None]
        later = np.flatnonzero((ALPHABET[None, None, :] > old[:, :, None]).ravel())
        hit = later[filters.may_hold((whole[:, None, None] + delta).ravel()[later], length)]
        row, rest = np.divmod(hit, width * len(ALPHABET))
        yield row, s + rest // len(ALPHABET), ALPHABET[rest % len(ALPHABET)]
    if length > least:
        shorter = sums[:, :-1] + (whole[:, None] - sums[:, 1:]) * np.uint64(INVERSE)
        new = np.ones((n, length), bool)  # of a run of one letter, only its first is deleted
        new[:, 1:] = codes[:, 1:] != codes[:, :-1]
        told = np.flatnonzero(new.ravel())
        hit = told[filters.may_hold(shorter.ravel()[told], length - 1)]
        yield hit // length, hit % length, np.zeros(len(hit), np.int64)


def _probe(batches: Iterator[pa.RecordBatch], filters, least: int) -> Iterator[pa.RecordBatch]:
    names = ["word", "n", "other"]
    for batch in batches:
        words, counts = (c.to_pylist() for c in batch.columns)
        for length, at in _by_length(words).items():
            rows = max(1, STEP // (length * len(ALPHABET)))
            for s in range(0, len(at), rows):
                some = at[s : s + rows]
                for row, place, code in _edits(_codes([words[i] for i in some], length), filters.value, least):
                    if not len(row):
                        continue
                    source = [some[r] for r in row]
                    others = [words[i][:p] + (chr(c) if c else "") + words[i][p + 1 :] for i, p, c in zip(source, place, code)]
                    yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in source], pa.string()), pa.array([counts[i] for i in source], pa.int64()), pa.array(others, pa.string())], names)


def near_pairs(words: DataFrame, least_length: int = 7) -> DataFrame:
    """word, n, other, other_n of words one insertion, deletion or replacement apart: each pair of words once."""
    filters = words.sparkSession.sparkContext.broadcast(vocabulary_filters(words))
    told = words.select("word", "n").mapInArrow(lambda it: _probe(it, filters, least_length), "word string, n long, other string")
    side = words.select(F.col("word").alias("v_word"), F.col("n").alias("other_n"))
    pairs = stored(attach(told, side, {"v_word": F.col("other")}, how="inner"), "near-words")
    filters.destroy()
    return pairs


def variant_forms(words: DataFrame, ratio: int = 10, least_length: int = 7) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of a vocabulary (word, n; distinct words).

    The form is the near word with most occurrences, the smallest in code-point order of equal ones, if it has ``ratio``
    times the word's own; the root is where the forms end, a word without a form being its own root. An empty vocabulary
    gives an empty table. A word may be as long as memory holds; no neighbour is left out, however many a word has.
    """
    words = stored(words.select("word", "n"), "vocabulary")
    pairs = near_pairs(words, least_length)
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy(F.col("word").alias("b_word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("least"), "other")).alias("best"))
    joined = attach(words, best, {"b_word": F.col("word")})
    strong = -F.col("best.least") >= ratio * F.col("n")
    found = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("best.other")).alias("form"), F.when(strong, -F.col("best.least")).alias("form_n"))
    found = stored(found, "forms")
    roots = _roots(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    out = attach(found, roots.withColumnRenamed("word", "r_word"), {"r_word": F.col("word")})
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """Each word's last form, by joining the links with themselves: a form has ``ratio`` times the occurrences, so chains are short."""
    now = links
    while True:
        ahead = now.select(F.col("word").alias("a_word"), F.col("root").alias("ahead"))
        now = stored(attach(now, ahead, {"a_word": F.col("root")}), "roots")
        moved = not now.where("ahead IS NOT NULL").isEmpty()
        now = now.select("word", F.coalesce("ahead", "root").alias("root"))
        if not moved:
            return now
