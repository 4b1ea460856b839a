"""Removal of long byte strings that an earlier document holds, by a hash-compared suffix sort.

Every position of a text names the string of ``length`` bytes that starts there. All occurrences of a string choose the
same sample position inside it (the least hash of its short grams), so that suffixes need to be compared only with those
that share a sample. Grams found in one text only are dropped by a count over distinct grams of whole batches of texts;
around the others the suffixes are sorted: prefix polynomial hashes and a binary search give two suffixes' common
extension, a merge sort orders them by it, and neighbours that look equal are compared byte by byte.

Between the steps a batch of texts and a share of the grams exchange one packed row, not a row for each gram or sample:
that is what the disk holds, so grams go as gaps of sorted hashes, the bytes around samples compressed together, and
what a share answers in the order in which the batch asked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from budgetloom.operators.lookup import attach

#: Bytes of text of one batch, of one hashing step, rows of one sorting step, texts a task remembers, the number of
#: occurrences from which a gram's strings are told apart by all their bytes, how many of these a task holds at once, and
#: the bits by which grams are counted. None changes the result.
BATCH_BYTES, SEGMENT, SORT_ROWS, REMEMBERED, HOT, HELD_STRINGS, KEY_BITS = 8 << 20, 1 << 16, 1 << 13, 1 << 18, 1000, 1 << 20, 40

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_LOW = np.uint64((1 << 21) - 1)


def gram_size(length: int) -> int:
    """Bytes of a sample gram: the largest power of two up to two thirds of the string, or twice that, that leaves at most 63 places for it.

    The longer it is, the fewer grams texts share that have no string in common, however many texts there are.
    """
    if not 20 <= length <= 120:
        raise ValueError(f"length must be 20 to 120: {length}")
    k = 1 << (2 * length // 3).bit_length() - 1
    return k if length - k < 63 else 2 * k


# --- packed rows ---------------------------------------------------------------------------------


_ZSTD = pa.Codec("zstd", compression_level=3)


def _pack(*columns: np.ndarray) -> bytes:
    """Whole numbers of 64 bits: of each column all lowest bytes, then all next ones; zeros at the top are left out, and bytes are compressed where that is shorter."""
    out = []
    for values in columns:
        raw = np.ascontiguousarray(values).astype(np.uint64, copy=False)
        planes = -(-int(raw.max(initial=0)).bit_length() // 8)
        out.append(len(raw).to_bytes(4) + bytes([planes]))
        for plane in raw.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T[:planes]:
            plain = plane.tobytes()
            small = _ZSTD.compress(plain, asbytes=True)
            out += [min(len(small), len(plain)).to_bytes(4), small if len(small) < len(plain) else plain]
    return b"".join(out)


def _unpack(packed: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(packed):
        n, planes = int.from_bytes(packed[at : at + 4]), packed[at + 4]
        at += 5
        raw = np.zeros((n, 8), np.uint8)
        for k in range(planes):
            size = int.from_bytes(packed[at : at + 4])
            plane = packed[at + 4 : at + 4 + size]
            raw[:, k] = np.frombuffer(plane if size == n else _ZSTD.decompress(plane, n, asbytes=True), np.uint8)
            at += 4 + size
        out.append(raw.view("<u8").ravel().astype(np.uint64, copy=False))
    return out


def _gaps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


# --- sampling ------------------------------------------------------------------------------------


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of all k-grams by doubling, with their bits mixed."""
    g, n = data.astype(np.uint64) + np.uint64(1), 1
    while n < k:
        g, n = g[:-n] * np.uint64(pow(int(BASE), n, 1 << 64)) + g[n:], 2 * n
    g = (g ^ (g >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return g ^ (g >> np.uint64(32))


def sampled_runs(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of positions whose strings share a sample: 48 bits of the gram's hash, first position, number of positions, bytes before the sample.

    ``data`` holds texts one after another, ``ends`` where they end. The sample of a string is its gram of least hash, the
    first of equal ones; it depends on nothing outside of the string.
    """
    k = gram_size(length)
    w = length - k + 1
    fits = np.ones(len(data), bool)
    for back in range(1, length):
        at = ends - back
        fits[at[at >= 0]] = False
    found = []
    for s in range(0, len(data) - length + 1, SEGMENT):
        part = data[s : s + SEGMENT + length - 1]
        g = _gram_hashes(part, k)
        v, n = ((g >> np.uint64(21)) << np.uint64(21)) | np.arange(len(g), dtype=np.uint64), 1
        while 2 * n <= w:
            v, n = np.minimum(v[:-n], v[n:]), 2 * n
        if n < w:
            v = np.minimum(v[: n - w], v[w - n :])
        p = np.flatnonzero(fits[s : s + len(v)])
        if not len(p):
            continue
        a = (v[p] & _LOW).astype(np.int64)
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)])
        lo, at = p[first], a[first]
        found.append(((g[at] >> np.uint64(16)).view(np.int64), lo + s, np.diff(np.r_[first, len(p)]), at - lo))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    h, lo, n, lead = (np.concatenate(x) for x in zip(*found))
    return h, lo, n, lead


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Slices of ``data``, one after another."""
    offsets = np.r_[0, np.cumsum(sizes)]
    return data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]


def _string_keys(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Keys of 40 bits of the ``size`` bytes at each position."""
    view, up = np.lib.stride_tricks.sliding_window_view(data, size), _powers(size)[0]
    sums = [(view[at[i : i + SORT_ROWS]].astype(np.uint64) + np.uint64(1)) @ up for i in range(0, len(at), SORT_ROWS)]
    g = np.concatenate([np.zeros(0, np.uint64), *sums])
    return _mixed(g ^ (g >> np.uint64(32)))


# --- one batch of texts --------------------------------------------------------------------------


class _Batch:
    """The distinct texts of a batch in the order of their digests, with the least id of each."""

    def __init__(self, table: pa.Table, length: int):
        ids: dict[bytes, int] = {}
        texts: dict[bytes, bytes] = {}
        for digest, doc, text in zip(*(table.column(c).to_pylist() for c in ("digest", "id", "body"))):
            ids[digest] = min(doc, ids.get(digest, doc))
            if text is not None:
                texts[digest] = pa.decompress(text[4:], int.from_bytes(text[:4]), "zstd", asbytes=True)
        self.digests = sorted(texts)
        self.first = np.array([ids[d] for d in self.digests], np.int64)
        self.data = np.frombuffer(b"".join(texts[d] for d in self.digests), np.uint8)
        self.ends = np.cumsum([len(texts[d]) for d in self.digests], dtype=np.int64)
        self.hash, self.lo, self.n, self.lead = sampled_runs(self.data, self.ends, length)
        self.text = np.searchsorted(self.ends, self.lo, "right")

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of the runs' grams, ascending, the runs in their order, how many each key has, and whether they are of several texts."""
        key = _mixed(self.hash)
        order = np.argsort(key, kind="stable")  # runs come text by text
        key, text = key[order], self.text[order]
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        last = np.r_[head[1:], len(key)][: len(head)] - 1
        return key[head], order, last - head + 1, text[head] != text[last]

    def positions(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every position of the runs, and its number within its run."""
        n = self.n[runs]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(self.lo[runs], n) + place, place


def _same_strings(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, group) with equal strings of ``length`` bytes at neighbouring places of the order; groups count from 0."""
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    _, group = np.unique(np.ascontiguousarray(view[at]).view(f"V{length}").ravel(), return_inverse=True)
    order = np.argsort(group, kind="stable")
    return order, group[order]


def _mixed(h: np.ndarray) -> np.ndarray:
    """40 well-spread bits of hashes: least hashes are low ones."""
    return (h.view(np.uint64) * BASE) >> np.uint64(64 - KEY_BITS)


def _shares(key: np.ndarray, shares: int) -> np.ndarray:
    """Which of the shares, ranges of the keys, each key is in."""
    return ((key * np.uint64(shares)) >> np.uint64(KEY_BITS)).astype(np.int64)


def _bounds(share: np.ndarray, shares: int) -> Iterator[tuple[int, int, int]]:
    """Number, start and end of every share that ascending numbers have elements in."""
    edge = np.searchsorted(share, np.arange(shares + 1))
    return ((int(k), int(edge[k]), int(edge[k + 1])) for k in np.flatnonzero(edge[1:] > edge[:-1]))


_GRAMS = pa.schema([("share", pa.int32()), ("batch", pa.int32()), ("packed", pa.binary())])


def _grams(table: pa.Table, length: int, shares: int, hot: int) -> pa.Table:
    """Distinct grams of a batch, with the number of their runs and whether several texts hold them: a row for each share of the keys."""
    keys, _, runs, several = _Batch(table, length).grams()
    told = np.minimum(runs, hot + 1) * 2 + several
    out = [(k, _pack(_gaps(keys[a:b]), told[a:b])) for k, a, b in _bounds(_shares(keys, shares), shares)]
    batch = np.full(len(out), table.column("batch")[0].as_py(), np.int32)
    return pa.table([pa.array([k for k, _ in out], pa.int32()), batch, pa.array([x for _, x in out], pa.binary())], schema=_GRAMS)


def _shared(table: pa.Table, hot: int) -> pa.Table:
    """For the grams of a share, as each batch told them: 0 where one text holds the gram, 1 where several do, 2 if it has more than ``hot`` runs then."""
    told = [_unpack(x) for x in table.column("packed").to_pylist()]
    ends = np.cumsum([len(gaps) for gaps, _ in told])
    key, runs = np.concatenate([np.cumsum(gaps) for gaps, _ in told]), np.concatenate([x for _, x in told])
    told.clear()
    order = np.argsort(key)
    key, runs = key[order], runs[order]
    head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[head, len(key)])
    several = (size > 1) | (runs[head] & np.uint64(1) == 1)
    kind = several.astype(np.uint8) + (several & (np.add.reduceat(runs >> np.uint64(1), head) > hot))
    out = np.empty(len(key), np.uint8)
    out[order] = np.repeat(kind, size)
    packed = [_pack(x) for x in np.split(out, ends[:-1])]
    return pa.table([table.column("share"), table.column("batch"), pa.array(packed, pa.binary())], schema=_GRAMS)


_PLACES = pa.schema([("share", pa.int32()), ("batch", pa.int32()), ("hot", pa.bool_()), ("packed", pa.binary()), ("bytes", pa.binary())])


def _contexts(texts: pa.Table, shared: pa.Table, length: int, shares: int) -> pa.Table:
    """The bytes around the samples of shared grams, for each run, or for hot grams for each distinct string: a row for each share of the grams, or of the hot strings."""
    if not texts.num_rows or not shared.num_rows:
        return _PLACES.empty_table()
    b = _Batch(texts, length)
    number = texts.column("batch")[0].as_py()
    keys, order, size, _ = b.grams()
    flags = sorted(zip(shared.column("share").to_pylist(), shared.column("packed").to_pylist()))
    kind = np.zeros(len(b.hash), np.uint8)
    kind[order] = np.repeat(np.concatenate([_unpack(x)[0] for _, x in flags]), size)
    out = []

    def add(share, hot, columns, starts, sizes):
        by_share = np.argsort(share, kind="stable")
        for k, x, y in _bounds(share[by_share], shares):
            part = by_share[x:y]
            run, *rest = (c[part] for c in columns)
            data = _gather(b.data, starts[part], sizes[part])
            out.append((k, number, hot, _pack(_gaps(run), *rest), _ZSTD.compress(data, asbytes=True)))

    runs = np.flatnonzero(kind == 1)
    add(_shares(_mixed(b.hash[runs]), shares), False, (runs, b.n[runs], b.lead[runs], b.first[b.text[runs]]), b.lo[runs], b.n[runs] + length - 1)
    runs = np.flatnonzero(kind == 2)
    if len(runs):
        at, place = b.positions(runs)
        run = np.repeat(runs, b.n[runs])
        order, group = _same_strings(b.data, at, length)
        head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        least = np.minimum.reduceat(b.first[b.text[run[order]]], head)
        one = order[head]
        by_place = np.argsort(one)
        one, least = one[by_place], least[by_place]
        add(_shares(_string_keys(b.data, at[one], length), shares), True, (run[one], place[one], least), at[one], np.full(len(one), length))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _PLACES)], schema=_PLACES) if out else _PLACES.empty_table()


def _cut(texts: pa.Table, marks: pa.Table, length: int) -> pa.Table:
    """Removed spans of each text of a batch, and the hash of what is left."""
    b = _Batch(texts, length)
    gone = np.zeros(len(b.data) + 1, np.int8)
    none = (np.zeros(0, np.uint64),) * 2
    told = {True: [none], False: [none]}
    for hot, packed in zip(marks.column("hot").to_pylist(), marks.column("packed").to_pylist()):
        gaps, what = _unpack(packed)
        told[hot].append((np.cumsum(gaps), what))
    hit = []
    r, m = (np.concatenate(x) for x in zip(*told[False]))
    r = r.astype(np.int64)
    m ^= (np.uint64(1) << b.n[r].astype(np.uint64)) - np.uint64(1)
    for bit in range(int(b.n.max(initial=0))):
        hit.append(b.lo[r[(m >> np.uint64(bit)) & np.uint64(1) == 1]] + bit)
    run, place = (np.concatenate(x).astype(np.int64) for x in zip(*told[True]))
    if len(run):  # a hot string is told at one of its places in the batch, whether an earlier text of another batch has it or only texts of this one
        earlier_elsewhere, place = place & 1 == 1, place >> 1
        runs = np.flatnonzero(np.isin(b.hash, b.hash[run]))
        at, _ = b.positions(runs)
        first = b.first[np.repeat(b.text[runs], b.n[runs])]
        marked = np.isin(at, (b.lo[run] + place)[earlier_elsewhere])
        order, group = _same_strings(b.data, at, length)
        head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        least = np.minimum.reduceat(first[order], head)[group]
        earlier = np.logical_or.reduceat(marked[order], head)[group]
        hit.append(at[order[(first[order] > least) | earlier]])
    starts = np.zeros(len(b.data) + 1, bool)
    for at in hit:
        starts[at] = True
    where = np.flatnonzero(starts)
    gone[where] += 1
    gone[where + length] -= 1
    covered = np.cumsum(gone[:-1], dtype=np.int32) > 0
    out = {"digest": [], "n_removed": [], "kept_sha256": [], "removed": []}
    start = 0
    for digest, end in zip(b.digests, b.ends):
        c = covered[start:end]
        if c.any():
            edge = np.flatnonzero(np.diff(np.r_[0, c.view(np.int8), 0]))
            out["digest"].append(digest)
            out["n_removed"].append(int(c.sum()))
            out["kept_sha256"].append(hashlib.sha256(b.data[start:end][~c].tobytes()).hexdigest())
            out["removed"].append([{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)])
        start = end
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table(out, schema=pa.schema([("digest", pa.binary()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("removed", span)]))


# --- the sort ------------------------------------------------------------------------------------


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse; a process keeps as many as its largest buffer needed."""
    if n > len(_POWERS[0]):
        _POWERS[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, x)]) for x in (BASE, INVERSE)]
    return _POWERS[0][:n], _POWERS[1][:n]


class _Suffixes:
    """Suffixes of a byte buffer, compared over their first ``length`` bytes by prefix hashes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, n = data, length, len(data)
        up, self.down = _powers(max(n, 1))
        self.sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n])]
        self.whole = self.hashes(np.arange(max(n - length + 1, 0)), length)

    def hashes(self, x: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        """Hashes of the first ``size`` bytes, alike for equal bytes wherever they stand."""
        return (self.sums[x + size] - self.sums[x]) * self.down[x]

    def order(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1: where not all is equal, a binary search finds the common extension, and the byte after it decides."""
        out = np.zeros(len(x), np.int8)
        differ = np.flatnonzero(self.whole[x] != self.whole[y])
        x, y = x[differ], y[differ]
        x_sum, y_sum, x_down, y_down = self.sums[x], self.sums[y], self.down[x], self.down[y]
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.length - 1, np.int64)
        for _ in range((self.length - 1).bit_length()):
            middle = (low + high + 1) >> 1
            same = (self.sums[x + middle] - x_sum) * x_down == (self.sums[y + middle] - y_sum) * y_down
            low, high = np.where(same, middle, low), np.where(same, high, np.maximum(middle - 1, low))
        a, b = self.data[x + low], self.data[y + low]
        out[differ] = (a > b).astype(np.int8) - (a < b)
        return out

    def merge_sort(self, at: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Positions sorted within their classes; ``begin`` and ``size`` tell each element's class, which is contiguous."""
        at, place = at.copy(), np.arange(len(at)) - begin
        pair = np.flatnonzero((place % 2 == 0) & (place + 1 < size))  # runs of one element
        pair = pair[self.order(at[pair + 1], at[pair]) < 0]
        at[pair], at[pair + 1] = at[pair + 1], at[pair]
        width = 2
        live = np.flatnonzero(size > width)
        while len(live):
            own, first, total = place[live], begin[live], size[live]
            run = own // width
            left = run % 2 == 0
            other = np.where(left, run + 1, run - 1) * width
            count = np.clip(total - other, 0, width)
            low, high = np.zeros(len(live), np.int64), count.copy()
            for _ in range(width.bit_length()):
                open_ = np.flatnonzero(low < high)
                middle = (low[open_] + high[open_]) >> 1
                found = self.order(at[first[open_] + other[open_] + middle], at[live[open_]])
                before = np.where(left[open_], found < 0, found <= 0)
                low[open_], high[open_] = np.where(before, middle + 1, low[open_]), np.where(before, high[open_], middle)
            target = first + (run - run % 2) * width + own % width + low
            moved = at[live]
            at[target] = moved
            width *= 2
            live = live[total > width]
        return at

    def same_as_before(self, at: np.ndarray) -> np.ndarray:
        """Whether each position's string equals that of the position before, byte for byte."""
        out = np.zeros(len(at), bool)
        like = 1 + np.flatnonzero(self.whole[at[1:]] == self.whole[at[:-1]])
        words = np.ndarray(max(len(self.data) - 7, 0), "<u8", self.data.tobytes(), strides=(1,))  # eight bytes from every position on
        same = np.ones(len(like), bool)
        for step in [*range(0, self.length - 8, 8), self.length - 8] if len(like) else []:
            same &= words[at[like] + step] == words[at[like - 1] + step]
        out[like] = same
        if not same.all():
            raise HashCollision
        return out


class HashCollision(ArithmeticError):
    """Different strings with one hash stood side by side; they are sorted by their bytes then."""


def _sorted_classes(s: _Suffixes, at: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Positions sorted within their classes, which are contiguous and have ascending numbers from 0."""
    bits = np.uint64(max(1, int(number[-1]).bit_length()))
    key = (number.astype(np.uint64) << (np.uint64(64) - bits)) | (s.whole[at] * BASE >> bits)  # the class, then as much of the mixed hash as fits
    together = np.argsort(key)
    at, key = at[together], key[together]
    new = np.r_[True, key[1:] != key[:-1]]
    if (s.whole[at[1:]] != s.whole[at[:-1]])[~new[1:]].any():
        raise HashCollision
    start = np.flatnonzero(new)
    copies = np.diff(np.r_[start, len(at)])
    one, own = at[start], number[together[start]]
    head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    size = np.diff(np.r_[head, len(one)])
    where = np.zeros(len(s.data) + 1, np.int64)
    where[one] = np.arange(len(one))
    order = where[s.merge_sort(one, np.repeat(head, size), np.repeat(size, size))]
    copies = copies[order]
    return at[np.repeat(start[order] - (np.cumsum(copies) - copies), copies) + np.arange(len(at))]


def earlier_masks(h: np.ndarray, first: np.ndarray, lead: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """For each row, the bits of its strings that also occur in a row of the same gram with a smaller ``first``.

    Rows are sorted by gram. Only strings with their sample at the same place can be equal, so gram and place make the
    classes within which suffixes are sorted. Those of one hash are put together beforehand, and the merge sort orders one
    of each.
    """
    n = np.diff(offsets) - length + 1
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = offsets[:-1][row] + place
    kind = np.cumsum(np.r_[0, h[1:] != h[:-1]])[row] * 128 + (lead[row] - place)
    by_class = np.argsort(kind, kind="stable")
    sorted_kind = kind[by_class]
    new = np.r_[True, sorted_kind[1:] != sorted_kind[:-1]]
    back = np.zeros(len(data) + 1, np.int64)  # which row's string starts at a position: rows do not overlap
    back[at] = np.arange(len(at))
    s = _Suffixes(data, length)
    try:
        ordered = _sorted_classes(s, at[by_class], np.cumsum(new) - 1)
        same = s.same_as_before(ordered) & ~new
    except HashCollision:
        heads = np.flatnonzero(new)
        sizes = np.diff(np.r_[heads, len(by_class)])
        ordered = np.array([p for b, z in zip(heads, sizes) for p in sorted(at[by_class[b : b + z]], key=lambda p: data[p : p + length].tobytes())], np.int64)
        view = np.lib.stride_tricks.sliding_window_view(data, length)
        same = np.r_[False, (view[ordered[1:]] == view[ordered[:-1]]).all(axis=1)] & ~new
    who = back[ordered]
    group = np.flatnonzero(~same)
    least = np.repeat(np.minimum.reduceat(first[row[who]], group), np.diff(np.r_[group, len(who)]))
    bit = np.zeros(len(row), np.uint64)
    bit[who] = (least < first[row[who]]).astype(np.uint64) << place[who].astype(np.uint64)
    return np.add.reduceat(bit, np.cumsum(n) - n).view(np.int64)


_MARKS = pa.schema([("batch", pa.int32()), ("hot", pa.bool_()), ("packed", pa.binary())])


def _runs(packed: bytes) -> list[np.ndarray]:
    run, *rest = (x.view(np.int64) for x in _unpack(packed))
    return [np.cumsum(run), *rest]


def _masks(rows: list[tuple], length: int) -> Iterator[tuple]:
    """Masks of the runs of a share's grams, batch by batch; rows of one gram are judged together."""
    if not rows:
        return
    run, n, lead, first = (np.concatenate(x) for x in zip(*(_runs(packed) for _, packed, _ in rows)))
    ends = np.cumsum([int.from_bytes(packed[:4]) for _, packed, _ in rows])
    sizes = n + length - 1
    begin = np.cumsum(sizes) - sizes
    of_row = np.add.reduceat(sizes, np.r_[0, ends[:-1]])
    data = np.frombuffer(b"".join(_ZSTD.decompress(x, int(z), asbytes=True) for (_, _, x), z in zip(rows, of_row)), np.uint8)
    h = _string_keys(data, begin + lead, gram_size(length))
    order = np.argsort(h, kind="stable")
    new = np.flatnonzero(np.r_[True, np.diff(h[order]) != 0])
    mask = np.zeros(len(run), np.int64)
    start = 0
    while start < len(order):  # whole grams, of SORT_ROWS rows or more
        later = np.searchsorted(new, start + SORT_ROWS)
        stop = new[later] if later < len(new) else len(order)
        x = order[start:stop]
        mask[x] = earlier_masks(h[x], first[x], lead[x], _gather(data, begin[x], sizes[x]), np.r_[0, np.cumsum(sizes[x])], length)
        start = stop
    flipped = mask ^ ((1 << n) - 1)  # most runs are found whole
    for (batch, _, _), a, b in zip(rows, np.r_[0, ends[:-1]], ends):
        hit = a + np.flatnonzero(mask[a:b])
        if len(hit):
            yield batch, False, _pack(_gaps(run[hit]), flipped[hit])


def _common(rows: list[tuple], length: int) -> Iterator[tuple]:
    """The hot strings of a share, batch by batch: each one's place, and whether a batch has it in an earlier text."""
    if not rows:
        return
    told = [_runs(packed) for _, packed, _ in rows]
    total = sum(len(run) for run, _, _ in told)
    steps = np.uint64(1 + total // HELD_STRINGS)
    earlier = [np.zeros(len(run), np.int64) for run, _, _ in told]
    for step in range(int(steps)):  # so that many strings' bytes are held at a time
        data, who, first = [], [], []
        for k, ((_, _, x), (run, _, least)) in enumerate(zip(rows, told)):
            raw = np.frombuffer(_ZSTD.decompress(x, len(run) * length, asbytes=True), np.uint8)
            now = np.arange(len(run))
            if steps > 1:
                now = now[_string_keys(raw, now * length, length) % steps == step]
            data.append(raw.reshape(-1, length)[now])
            who.append(np.stack([np.full(len(now), k), now]))
            first.append(least[now])
        strings = np.concatenate(data).ravel()
        if not len(strings):
            continue
        (row, at), least = np.concatenate(who, axis=1), np.concatenate(first)
        order, group = _same_strings(strings, np.arange(len(row)) * length, length)
        head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        behind = order[np.minimum.reduceat(least[order], head)[group] < least[order]]
        for k in np.unique(row[behind]):
            earlier[k][at[behind[row[behind] == k]]] = 1
    for (batch, _, _), (run, place, _), x in zip(rows, told, earlier):
        yield batch, True, _pack(_gaps(run), place * 2 + x)


def _judged(table: pa.Table, length: int) -> pa.Table:
    rows = {True: [], False: []}
    for batch, hot, packed, data in zip(*(table.column(c).to_pylist() for c in ("batch", "hot", "packed", "bytes"))):
        rows[hot].append((batch, packed, data))
    out = [*_masks(rows[False], length), *_common(rows[True], length)]
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _MARKS)], schema=_MARKS) if out else _MARKS.empty_table()


# --- the job -------------------------------------------------------------------------------------


def _once_per_task(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Each text, compressed, at its first occurrence in the task, and the least id of those that came again."""
    schema = pa.schema([("batch", pa.int32()), ("digest", pa.binary()), ("id", pa.int64()), ("body", pa.binary())])
    least: dict[bytes, int] = {}
    again: set[bytes] = set()

    def told() -> pa.RecordBatch:
        keys = sorted(again)
        return pa.RecordBatch.from_arrays([pa.array([int.from_bytes(d[:7]) % parts for d in keys], pa.int32()), pa.array(keys, pa.binary()), pa.array([least[d] for d in keys], pa.int64()), pa.nulls(len(keys), pa.binary())], schema=schema)

    for batch in batches:
        out = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            digest = hashlib.sha256(text).digest()
            if digest in least:
                again.add(digest)
                least[digest] = min(doc, least[digest])
            else:
                least[digest] = doc
                out.append((int.from_bytes(digest[:7]) % parts, digest, doc, len(text).to_bytes(4) + pa.compress(text, "zstd", asbytes=True)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if len(least) > REMEMBERED:
            yield told()
            least.clear()
            again.clear()
    yield told()


def removed_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256 and ``removed``, the removed spans.

    A byte (of the text in UTF-8) is removed when it lies in a string of ``length`` bytes that also starts in a document
    with a smaller id; what is compared is the input, not what is left of it. ``removed`` holds start and end (exclusive)
    of maximal runs in order, and kept_sha256 hashes the bytes outside of them in lowercase hex.

    A null text is an empty one; texts shorter than ``length`` keep all. A null id is neither smaller nor larger than
    others: such rows keep all and take nothing from others. Rows of one id do not take from each other, whatever their
    texts; repeated rows are judged each like the first. A text of any length is hashed and compared whole, in steps; it
    must fit in memory. Other columns of ``docs`` are ignored, whatever their names. An empty table gives an empty one.
    """
    gram_size(length)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("id"), body.alias("body"))
    told = rows.select("id", F.unhex(F.sha2("body", 256)).alias("digest"), F.octet_length("body").cast("long").alias("n_bytes"))
    able = rows.where(F.col("id").isNotNull() & (F.octet_length("body") >= length))
    size = able.agg(F.sum(F.octet_length("body").cast("long"))).first()[0] or 0
    parts = 1 + size // BATCH_BYTES

    texts = able.mapInArrow(lambda it: _once_per_task(it, parts), "batch int, digest binary, id long, body binary").repartition("batch")
    shares, hot = min(parts, 64 + parts // 2), HOT
    grams = texts.groupBy("batch").applyInArrow(lambda t: _grams(t, length, shares, hot), "share int, batch int, packed binary")
    shared = grams.groupBy("share").applyInArrow(lambda t: _shared(t, hot), "share int, batch int, packed binary")
    places = texts.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(lambda t, s: _contexts(t, s, length, shares), "share int, batch int, hot boolean, packed binary, bytes binary")
    marks = places.groupBy("share").applyInArrow(lambda t: _judged(t, length), "batch int, hot boolean, packed binary")
    spans = "digest binary, n_removed long, kept_sha256 string, removed array<struct<start: long, end: long>>"
    cut = texts.groupBy("batch").cogroup(marks.groupBy("batch")).applyInArrow(lambda t, m: _cut(t, m, length) if t.num_rows else _cut_none(), spans)

    firsts = told.where(F.col("id").isNotNull() & (F.col("n_bytes") >= length)).groupBy("digest").agg(F.min("id").alias("first"))
    by_text = attach(firsts, cut.withColumnRenamed("digest", "cut_digest"), {"cut_digest": F.col("digest")}).withColumnRenamed("digest", "first_digest")
    found = attach(told, by_text, {"first_digest": F.col("digest")})
    return _rows(found)


def _cut_none() -> pa.Table:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.schema([("digest", pa.binary()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("removed", span)]).empty_table()


def _rows(found: DataFrame) -> DataFrame:
    whole = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    own = F.coalesce(F.col("id") == F.col("first"), F.lit(False)) & F.col("n_removed").isNotNull()

    def chosen(all_: Column, some: Column, none: Column) -> Column:
        return F.when(whole, all_).when(own, some).otherwise(none)

    nothing = F.expr("CAST(array() AS array<struct<start: long, end: long>>)")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return found.select(
        "id",
        "n_bytes",
        chosen(F.col("n_bytes"), F.col("n_removed"), F.lit(0).cast("long")).alias("n_removed"),
        chosen(F.lit(1), F.size("removed"), F.lit(0)).cast("long").alias("n_spans"),
        chosen(F.lit(hashlib.sha256(b"").hexdigest()), F.col("kept_sha256"), F.lower(F.hex("digest"))).alias("kept_sha256"),
        chosen(everything, F.col("removed"), nothing).alias("removed"),
    )
