"""Similarity join of documents on the Jaccard similarity of their word n-grams, with adaptive multi-match prefixes.

A document is the set of its distinct 5-word shingles. One global order puts shingles that were seen often after rare
ones. Two sets with similarity of at least t share a shingle among the first n - ceil(t n) + 1 of each, and l of them
among l - 1 more. The longer a prefix, the more matches a pair needs before it is verified:

* the expected candidates of a prefix follow from the counts; a document whose prefix is costly takes a longer one;
* a pair is verified when the shared prefix shingles, with all that the prefixes leave open, can reach the threshold.

How often shingles occur is estimated from those that repeat within a task, in a table of fixed size (2^22 levels).
Any table gives the same result; a better one gives fewer candidates.

Only components are asked for, so a pair whose ends are connected already is not verified. First each document is
verified against one pivot of each group (documents sharing a prefix shingle, of a size within the same band): the one
with the fewest rare shingles, which is near the middle of a group of edited copies. Then every remaining pair between
components is, if enough shingles match, so no link that could join two components is lost. Documents of the same words are one class all along.

In a group of a frequent shingle, a pair that shares no rare prefix shingle has none of the pair's rare shingles in
common (they come first, so the prefixes hold them all); the rest bounds their similarity and rules most pairs out.

Before the sets of a pair are fetched, two to four bits for each shingle tell how much they can share at most: a bit
that only one set has stands for a shingle that only it has. Pairs that cannot reach the threshold end there.

Defined results: null texts and texts without words have no shingles, are linked with nothing, and are components of
their own; fewer than five words are one shingle, the whole sequence. Repeated rows of one id are one node. Rows
without an id are told apart by a hash of their texts; each has a row in the result, and its component is null unless
it reaches an id. Words split at the six ASCII white-space characters; A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from budgetloom.llm.common import likely, likely_marked, stored, tasks_for
from budgetloom.llm.components import components
from budgetloom.operators.lookup import attach

LEVEL_BITS = 22
UNNAMED = 1 << 62  # keys of rows without an id begin here
CHUNK = 3_000_000
BLOCK = 1 << 19
_ODD = np.random.default_rng(23).integers(0, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)


#: Random values of bytes, A-Z like a-z, and powers of an odd number and of its inverse modulo 2^64.
_BYTE = np.random.default_rng(29).integers(0, 1 << 63, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = int(_ODD[15])
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[i] = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))))
    return _POWERS


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash for each word of a text: a polynomial in its bytes, from differences of running sums."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    out, begin = [], 0
    while begin < len(raw):
        end = min(len(raw), begin + BLOCK)
        while end < len(raw) and not _SPACE[raw[end]]:  # a block ends between words
            end += 1
        out.append(_block_hashes(raw[begin:end]))
        begin = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _block_hashes(raw: np.ndarray) -> np.ndarray:
    power, inverse = _powers(len(raw) + 1)
    space = np.concatenate(([True], _SPACE[raw], [True]))
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[::2], edge[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * power[: len(raw)], dtype=np.uint64)))
    h = (sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * _ODD[14]
    h = (h ^ (h >> np.uint64(32))) * _ODD[13]
    return (h ^ (h >> np.uint64(29))) * _ODD[12]


def shingles(h: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of ``size`` words, given the words' hashes."""
    if len(h) == 0:
        return h
    width = min(size, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = (out ^ (out >> np.uint64(29))) * _ODD[8] + h[i : i + n] * _ODD[i]
    out = (out ^ (out >> np.uint64(32))) * _ODD[9]
    return np.unique(out ^ (out >> np.uint64(29)))


def bitmap(s: np.ndarray) -> bytes:
    """A bit for each shingle of a set, at the low bits of its hash; two to four bits a shingle, and 64 at least."""
    bits = np.zeros(1 << max(6, (2 * len(s)).bit_length()), bool)
    bits[s & np.uint64(len(bits) - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def most_shared(u: bytes, n: int, v: bytes, m: int) -> int:
    """The most shingles that sets of n and m with these bitmaps can share. The larger bitmap is folded to the smaller."""
    a, b = sorted((np.frombuffer(u, np.uint8), np.frombuffer(v, np.uint8)), key=len)
    sizes = (n, m) if len(u) <= len(v) else (m, n)
    b = np.bitwise_or.reduce(b.reshape(-1, len(a)), axis=0)
    return min(size - int(np.bitwise_count(x & ~y).sum()) for size, x, y in zip(sizes, (a, b), (b, a), strict=True))


def class_key(words: np.ndarray) -> int:
    return int.from_bytes(blake2b(words.tobytes(), digest_size=8).digest(), "little", signed=True)


def frequent(docs: DataFrame, text: str, repeats: int = 3, entries: int = 1 << 17) -> np.ndarray:
    """Level of each bucket of shingle hashes: 0, or the logarithm of how often its shingles were seen to repeat.

    The ``entries`` most frequent shingles count; one copy of each text in a task is looked at.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size, seen = [], 0, set()

        def flush() -> Iterator[pa.RecordBatch]:
            if kept:
                values, n = np.unique(np.concatenate(kept), return_counts=True)
                often = n >= repeats
                yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(n[often].astype(np.int64))], ["shingle", "n"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                words = word_hashes(t)
                key = class_key(words)
                if key in seen:
                    continue
                seen.add(key)
                for at in range(0, max(1, len(words)), CHUNK):
                    kept.append(shingles(words[at : at + CHUNK + 4]))
                    size += len(kept[-1])
                if size > CHUNK:
                    yield from flush()
                    kept, size, seen = [], 0, set()
        yield from flush()

    levels = np.zeros(1 << LEVEL_BITS, np.uint8)
    counted = docs.select(text).mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "shingle").limit(entries).toPandas()
    at = top["shingle"].to_numpy(np.int64).view(np.uint64) >> np.uint64(64 - LEVEL_BITS)
    np.maximum.at(levels, at, np.ceil(np.log2(top["n"].to_numpy(float) + 1)).astype(np.uint8))
    return levels


def least_overlap(n: Column, m: Column, per_cent: int) -> Column:
    """The least intersection that gives two sets of n and m elements the similarity."""
    return F.ceil((n + m) * per_cent / (100.0 + per_cent) - 1e-9)


def prefixes(docs: DataFrame, key: str, text: str, levels: np.ndarray, per_cent: int) -> DataFrame:
    """id, cid (class), n, rare (shingles of level 0), prefix (hashes), common (are they frequent), bits (bitmap of the set)."""
    sent = docs.sparkSession.sparkContext.broadcast(levels)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "cid", "n", "rare", "prefix", "common", "bits"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary()]
        table = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part, out = batch.slice(at, 128), []
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = word_hashes(t)
                    s = shingles(words)
                    n = len(s)
                    level = table[s >> np.uint64(64 - LEVEL_BITS)] if n else np.zeros(0, np.uint8)
                    order = np.argsort(level, kind="stable")  # the shingles are sorted
                    first = n - -(-n * per_cent // 100) + 1 if n else 0
                    cost = int((level[order[:first]] > 0).sum())
                    more = 0 if not cost else min(n - first, -(-n // 20) + cost // 2)  # costly prefixes are longer, and need more matches
                    chosen = order[: first + more]
                    out.append((i, class_key(words), n, int((level == 0).sum()), s[chosen].view(np.int64), level[chosen] > 0, bitmap(s)))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)], names)

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(cut, "id long, cid long, n long, rare long, prefix array<long>, common array<boolean>, bits binary")


def postings(table: DataFrame, per_cent: int) -> DataFrame:
    """Members of the groups of two classes or more: shingle, common, band, cid, n, rare, p, pivot, open.

    Rows are range-partitioned and sorted, so a frequent shingle's rows spread over tasks; each task streams over its
    rows and takes the first of a group as its pivot. What a task's edges leave open is marked, for the next step.
    Every shingle of every prefix travels, so its row is small: the band follows from n, and p is negative where the
    shingle is common.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / per_cent))).cast("int")
    rows = table.where("n > 0").select("cid", "n", "rare", F.size("prefix").alias("p"), F.explode(F.arrays_zip("prefix", "common")).alias("x"))
    rows = rows.select(F.col("x.prefix").alias("shingle"), "rare", "cid", "n", F.when(F.col("x.common"), -F.col("p")).otherwise(F.col("p")).alias("p"))
    dealt = rows.repartitionByRange(F.col("shingle"), band, F.col("rare"), F.col("cid"))
    dealt = dealt.select("shingle", (F.col("p") < 0).alias("common"), band.alias("band"), "rare", "cid", "n", F.abs("p").alias("p")).sortWithinPartitions("shingle", "band", "rare", "cid")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = cid = pivot_band = pivot = None
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            s, b, c = (batch.column(i).to_numpy() for i in (0, 2, 4))
            change = np.concatenate(([s[0] != shingle], s[1:] != s[:-1]))
            new_band = change | np.concatenate(([b[0] != pivot_band], b[1:] != b[:-1]))
            repeat = ~new_band & np.concatenate(([c[0] == cid], c[1:] == c[:-1]))
            begins = np.where(new_band, np.arange(len(s)), -1)
            lead = np.maximum.accumulate(begins)
            pivots = np.where(lead >= 0, c[np.maximum(lead, 0)], pivot if pivot is not None else 0)
            group = np.cumsum(change) - (1 if change[0] else 0)
            distinct = np.bincount(group[~repeat], minlength=group[-1] + 1)
            goes_on = np.zeros(group[-1] + 1, bool)
            goes_on[0] = first or not change[0]  # it may have begun in another task, or has in an earlier batch
            goes_on[-1] = True
            emit = (distinct[group] > 1) | goes_on[group]
            edge = np.zeros(len(s), bool)
            edge[0] = first
            keep = np.flatnonzero(emit & ~repeat)
            shingle, cid, pivot_band, pivot = s[-1], c[-1], b[-1], pivots[-1]
            first = False
            if len(keep):
                taken = batch.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(pivots[keep]), pa.array((group[keep] == 0) | (group[keep] == group[-1]))], [*taken.schema.names, "pivot", "open"])

    return dealt.select("shingle", "common", "band", "rare", "cid", "n", "p").mapInArrow(stream, "shingle long, common boolean, band int, rare long, cid long, n long, p int, pivot long, open boolean")


def possible(n: Column, m: Column, per_cent: int) -> Column:
    """Whether sets of these sizes can be similar."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * per_cent


def promising(pairs: DataFrame, owners: DataFrame, per_cent: int) -> DataFrame:
    """The pairs (a, b) of classes whose bitmaps leave the similarity possible. ``owners``: cid, n and bits."""
    sketch = F.struct("n", "bits")
    with_a = attach(pairs.select("a", "b"), owners.select(F.col("cid").alias("x"), sketch.alias("s_a")), {"x": F.col("a")}, how="inner")
    with_b = attach(with_a, owners.select(F.col("cid").alias("y"), sketch.alias("s_b")), {"y": F.col("b")}, how="inner")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, u, m, v = (batch.column(i).to_pylist() for i in range(2, 6))
            most = [most_shared(x, i, y, j) for x, i, y, j in zip(u, n, v, m, strict=True)]
            keep = [k for k, shared in enumerate(most) if 100 * shared >= per_cent * (n[k] + m[k] - shared)]
            if keep:
                yield batch.select([0, 1]).take(pa.array(keep))

    return with_b.select("a", "b", "s_a.n", "s_a.bits", F.col("s_b.n").alias("m"), F.col("s_b.bits").alias("v")).mapInArrow(bound, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, owners: DataFrame, key: str, text: str, per_cent: int, tasks: int | None = None) -> DataFrame:
    """The pairs (a, b) of classes whose shingle sets have the similarity. ``owners``: cid and the id of one document."""
    wanted = stored(pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct().join(owners.select("cid", "id"), "cid").select("id", "cid"), "wanted", tasks)
    texts = likely(docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")), F.col("id"), wanted, F.col("id"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                words = [word_hashes(t) for t in batch.slice(at, 128).column(1).to_pylist()]
                columns = [batch.slice(at, 128).column(0), pa.array([class_key(w) for w in words], pa.int64()), pa.array([shingles(w).tobytes() for w in words], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["i", "c", "s"])

    # Another row of the same id may hold another text, so rows are met by id and class.
    met = texts.mapInArrow(sets, "i long, c long, s binary").join(wanted, (F.col("i") == F.col("id")) & (F.col("c") == F.col("cid")))
    found = stored(met.select("cid", "s").dropDuplicates(["cid"]), "shingle-sets", tasks)
    with_a = attach(pairs.select("a", "b"), found.select(F.col("cid").alias("x"), F.col("s").alias("s_a")), {"x": F.col("b")}, how="inner")
    with_b = attach(with_a, found.select(F.col("cid").alias("y"), F.col("s").alias("s_b")), {"y": F.col("a")}, how="inner")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                u, v = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                both = np.concatenate((u, v))
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                if 100 * shared >= per_cent * (len(both) - shared):
                    keep.append(i)
            if keep:
                yield batch.select([0, 1]).take(pa.array(keep))

    return with_b.select("a", "b", "s_a", "s_b").mapInArrow(compare, "a long, b long")


def star_pairs(members: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a > b, of a document and a pivot of many of its prefix shingles; where a group spreads over
    tasks, of their pivots. Which pairs are taken only saves work: all others are looked at again among the open pairs."""
    often = members.where("cid != pivot").groupBy("cid", "pivot").agg(F.count("*").alias("shared"), F.min("p").alias("p")).where("4 * shared >= p")
    own = often.select(F.col("cid").alias("x"), F.col("pivot").alias("y"))
    heads = members.where("open").groupBy("shingle", "band").agg(F.min("pivot").alias("head"), F.max("pivot").alias("other")).where("head != other").select("shingle", "band", "head")
    bridges = attach(members.where("open and cid = pivot"), heads.withColumnsRenamed({"shingle": "s", "band": "t"}), {"s": F.col("shingle"), "t": F.col("band")}, how="inner").select(F.col("cid").alias("x"), F.col("head").alias("y"))
    return own.unionByName(bridges).where("x != y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def prefix_ends(table: DataFrame, side: str) -> DataFrame:
    """For each class: what its prefix leaves open, and where it ends in the global order (exactly, while it is rare)."""
    end = F.struct((F.col("n") - F.size("prefix")).alias("rest"), F.element_at("common", -1).alias("common"), F.shiftrightunsigned(F.element_at("prefix", -1), 1).alias("last"))
    return table.where("n > 0").groupBy(F.col("cid").alias(side)).agg(F.first(end).alias(f"end_{side}"))


def open_pairs(members: DataFrame, labels: DataFrame, table: DataFrame, per_cent: int, tasks: int | None = None) -> DataFrame:
    """Pairs (a, b), a > b, that share prefix shingles, lie in two components, and can still reach the similarity.

    All shingles that two sets share up to the end of the prefix that ends first are counted; beyond it, they share no
    more than that set has left. Where prefixes end among frequent shingles, the larger rest counts.
    """
    told = likely_marked(members.select("shingle", "common", "cid", "n", "rare"), F.col("cid"), labels, F.col("node"), "told")
    named = attach(told.where("told"), labels.withColumnRenamed("node", "m"), {"m": F.col("cid")})
    named = stored(named.select("shingle", "common", "cid", "n", "rare", F.coalesce("component", "cid").alias("comp")), "named", tasks)
    alone = told.where("not told").select("shingle", "common", "cid", "n", "rare", F.col("cid").alias("comp"))
    # A class without links is a component of its own, so its groups are never within one: only the others' are looked up.
    by_shingle = named.select("shingle", "comp").unionByName(alone.select("shingle", "comp")).groupBy("shingle")
    mixed = by_shingle.agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select(F.col("shingle").alias("s"))
    left = stored(attach(named, mixed, {"s": F.col("shingle")}, how="left_semi").unionByName(alone), "open-groups", tasks)
    a, b = left.alias("a"), left.alias("b")
    frequent_only = F.least(F.col("a.n") - F.col("a.rare"), F.col("b.n") - F.col("b.rare"))
    need = least_overlap(F.col("a.n"), F.col("b.n"), per_cent)
    # Equal shingles are equally common; named on both sides, the column lets one shuffle serve both.
    same = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.common") == F.col("b.common"))
    meets = same & (F.col("a.cid") > F.col("b.cid")) & (F.col("a.comp") != F.col("b.comp")) & possible(F.col("a.n"), F.col("b.n"), per_cent)
    rows = a.join(b, meets & (~F.col("a.common") | (frequent_only >= need)))
    counted = rows.groupBy(F.col("a.cid").alias("a"), F.col("b.cid").alias("b")).agg(
        F.count("*").alias("shared"),
        F.count_if(~F.col("a.common")).alias("shared_rare"),
        F.min(need).alias("need"),
        F.min(frequent_only >= need).alias("counted"),
    )
    for side in ("a", "b"):  # one class may stand in very many pairs
        counted = attach(counted, prefix_ends(table, side).withColumnRenamed(side, "c"), {"c": F.col(side)}, how="inner")
    exact = ~F.col("end_a.common") & ~F.col("end_b.common") & (F.col("end_a.last") != F.col("end_b.last"))
    first = F.when(F.col("end_a.last") < F.col("end_b.last"), F.col("end_a.rest")).otherwise(F.col("end_b.rest"))
    rest = F.when(exact, first).otherwise(F.greatest("end_a.rest", "end_b.rest"))
    # A pair whose frequent matches were left out above is not held to the number of matches.
    return counted.where((~F.col("counted") & (F.col("shared_rare") > 0)) | (F.col("shared") + rest >= F.col("need"))).select("a", "b")


def similar_components(docs: DataFrame, key: str = "doc_id", text: str = "text", per_cent: int = 80) -> DataFrame:
    """id, n_shingles, component_id: the smallest id that links reach.

    One row for each id, and one for each row without an id; the component of such a row is null if no id is reached.
    """
    own = F.col(key).cast("long")
    seen = docs.agg(F.max(own).alias("top"), F.count_if(own.isNull()).alias("unnamed")).first()
    if not seen["unnamed"]:
        return components_by_id(docs, key, text, per_cent)
    if (seen["top"] or 0) >= UNNAMED:
        raise ValueError("beside rows without an id, ids are below 2^62")
    hashed = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))), 2)
    keyed = docs.select(F.coalesce(own, F.lit(UNNAMED) + hashed).alias("key"), F.col(text).alias("text"))
    found = components_by_id(keyed, "key", "text", per_cent)
    each = attach(keyed.where(F.col("key") >= UNNAMED).select("key"), found.where(F.col("id") >= UNNAMED), {"id": F.col("key")}, how="inner").withColumnRenamed("key", "id")
    named = lambda c: F.when(F.col(c) < UNNAMED, F.col(c)).alias(c)
    return found.where(F.col("id") < UNNAMED).unionByName(each).select(named("id"), "n_shingles", named("component_id"))


def components_by_id(docs: DataFrame, key: str, text: str, per_cent: int) -> DataFrame:
    """What ``similar_components`` gives for rows with an id."""
    tasks = tasks_for(docs, text)
    table = stored(prefixes(docs, key, text, frequent(docs, text), per_cent).where("id is not null"), "prefixes", tasks)
    owners = stored(table.where("n > 0").groupBy("cid").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bits").alias("bits")), "owners", tasks)
    members = stored(postings(table, per_cent), "postings", tasks)
    first = stored(promising(star_pairs(members), owners, per_cent), "pairs", tasks)
    links = stored(verified(first, docs, owners, key, text, per_cent, tasks), "links", tasks)
    labels = stored(components(links, tasks=tasks), "labels", tasks)
    second = stored(promising(open_pairs(members, labels, table, per_cent, tasks).join(first, ["a", "b"], "left_anti"), owners, per_cent), "pairs", tasks)
    more = verified(second, docs, owners, key, text, per_cent, tasks)
    named = table.where("n > 0").select("id", "cid")
    several = named.groupBy("id").agg(F.min("cid").alias("b"), F.max("cid").alias("z")).where("b != z").select(F.col("id").alias("i"), "b")
    same_id = named.join(several, F.col("id") == F.col("i")).select(F.col("cid").alias("a"), "b")  # rows of one id with several texts
    by_class = components(links.unionByName(more).unionByName(same_id), tasks=tasks)
    merged = attach(named, by_class.withColumnRenamed("node", "m"), {"m": F.col("cid")}).select("id", F.coalesce("component", "cid").alias("component"))
    smallest = merged.groupBy("component").agg(F.min("id").alias("component_id")).withColumnRenamed("component", "c")
    found = attach(merged, smallest, {"c": F.col("component")}, how="inner").groupBy("id").agg(F.min("component_id").alias("component_id")).withColumnRenamed("id", "i")
    sizes_of = table.groupBy("id").agg(F.max("n").alias("n_shingles"))
    return attach(sizes_of, found, {"i": F.col("id")}).select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))

