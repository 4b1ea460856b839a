"""Suffix dedup, spelling variants and conversation repair against plain versions on small tables."""

import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from budgetloom.llm import conversation_repair as repair
from budgetloom.llm import queries, spelling, suffix_dedup
from checks.compare import duck_rows, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_suffix_dedup", "op12_spelling_variants"])
def test_query_matches_duckdb(spark, name):
    from budgetloom.llm.sql import ORACLES

    df = queries.OPERATORS[name](spark, SF)
    names, want = duck_rows(SF, ORACLES[name])
    assert names == sorted(df.columns)
    assert rows_of(df) == want


# --- suffix dedup --------------------------------------------------------------------------------


def plain_removal(rows, length=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            if d is not None:
                first[b[i : i + length]] = min(d, first.get(b[i : i + length], d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if d is not None and first[b[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len(spans), hashlib.sha256(kept).hexdigest(), spans))
    return sorted(out, key=repr)


def removal(spark, rows, length=50, parts=3):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, batch int, digest string").repartition(parts)
    found = suffix_dedup.removed_spans(df, length=length).collect()
    return sorted([(*r[:5], [tuple(s) for s in r["removed"]]) for r in found], key=repr)


def passages(seed, alphabet="abcdé ", n=150):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    common = [text(rng.choice([49, 50, 51, 70, 200])) for _ in range(10)]
    rows = []
    for i in range(n):
        t = "".join(rng.choice([rng.choice(common), text(rng.randint(0, 40))]) for _ in range(rng.randint(0, 8)))
        rows.append((rng.choice([None, i, i, i, i // 2]), rng.choice([None, t, t, t])))
    return rows


@pytest.mark.parametrize("hot, batch", [(1000, 8 << 20), (3, 3000)])
def test_bytes_that_an_earlier_document_holds_go(spark, monkeypatch, hot, batch):
    """Nulls, repeated ids, repeated rows, empty texts, texts of one letter, strings at either edge; hot grams and many batches."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    rows = passages(1)
    rows += [(1000 + i, "a" * n) for i, n in enumerate([49, 50, 300, 3000])] + [(7, rows[5][1])] * 3 + [(2000 + i, rows[9][1]) for i in range(40)]
    assert removal(spark, rows) == plain_removal(rows)


def test_other_lengths_and_an_empty_table(spark):
    rows = passages(2, n=60)
    assert removal(spark, rows, length=20) == plain_removal(rows, 20)
    assert removal(spark, rows, length=100) == plain_removal(rows, 100)
    assert removal(spark, []) == []
    with pytest.raises(ValueError):
        suffix_dedup.removed_spans(spark.createDataFrame([], "doc_id long, text string"), length=8)


def test_very_long_text_of_more_than_one_step(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(suffix_dedup.SEGMENT + 70_000))
    at = suffix_dedup.SEGMENT - 30  # a passage across two steps
    rows = [(1, long), (2, "x" * 60 + long[at : at + 120] + "y" * 60)]
    got = removal(spark, rows)
    assert [r[5] for r in got] == [[], [(60, 180)]]


def test_a_third_of_the_rows_is_one_text(spark):
    rows = [(i, "same text of some length, " * 4 if i % 3 == 0 else f"{i} " * 30) for i in range(300)]
    assert removal(spark, rows, parts=8) == plain_removal(rows)


def test_rows_whose_hashes_collide_are_sorted_by_their_bytes(monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    offsets, h = np.arange(0, 601, 60), np.zeros(10, np.int64)
    first, lead = np.arange(10)[::-1].copy(), np.full(10, 5)
    data[60:120] = data[300:360]
    want = suffix_dedup.earlier_masks(h, first, lead, data, offsets, 50)
    monkeypatch.setattr(suffix_dedup._Suffixes, "hashes", lambda self, x, size: np.zeros(len(x), np.uint64))
    assert suffix_dedup.earlier_masks(h, first, lead, data, offsets, 50).tolist() == want.tolist()
    assert want[1] == (1 << 11) - 1 and not want[[0, 2, 3, 4, 5]].any()


def test_equal_suffixes_are_compared_once(monkeypatch):
    """Copies of a few strings, alike but for their first or last bytes, cost the merge sort no more than one of each."""
    rng = np.random.default_rng(6)
    kinds = [bytes(rng.integers(97, 123, 4).astype(np.uint8)) + b"the same gram " * 4 for _ in range(5)] + [b"the same gram " * 4 + c for c in (b"aaaa", b"aaab", b"baaa")]
    rows = [kinds[k] for k in rng.integers(0, 8, 400)]
    data, offsets = np.frombuffer(b"".join(rows), np.uint8), np.arange(401) * 60
    first, lead, h = rng.permutation(400), np.full(400, 10), np.zeros(400, np.int64)
    compared = []
    order = suffix_dedup._Suffixes.order
    monkeypatch.setattr(suffix_dedup._Suffixes, "order", lambda self, x, y: compared.append(len(x)) or order(self, x, y))
    got = suffix_dedup.earlier_masks(h, first, lead, data, offsets, 50)
    least = {}
    for r, f in zip(rows, first):
        for p in range(11):
            least[p, r[p : p + 50]] = min(f, least.get((p, r[p : p + 50]), f))
    assert got.tolist() == [sum((least[p, r[p : p + 50]] < f) << p for p in range(11)) for r, f in zip(rows, first)]
    assert sum(compared) < 11 * 8 * 8


def test_suffixes_come_out_sorted():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    at = rng.permutation(4900)
    s = suffix_dedup._Suffixes(data, 50)
    got = s.merge_sort(at, np.zeros(len(at), np.int64), np.full(len(at), len(at)))
    texts = [data[p : p + 50].tobytes() for p in got]
    assert texts == sorted(texts) and sorted(got) == sorted(at)


def prose(seed, words=400, n=500):
    """Texts of few words, so that short strings recur by chance, every fifth of them with half of an earlier one."""
    rng = random.Random(seed)
    known = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(words)]
    texts = []
    for i in range(n):
        t = " ".join(rng.choice(known) for _ in range(500))
        texts.append(t if i % 5 else t[:1500] + rng.choice(texts or [""])[:1500])
    return list(enumerate(texts))


def test_what_the_steps_exchange_stays_small(spark, monkeypatch):
    """Disk: shuffle files of the whole job, per byte of text, with many batches."""
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 100_000)
    rows = prose(7)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).localCheckpoint()
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {p for d in manager.localDirs() for p in Path(d.getPath()).glob("*/shuffle_*.data")}
    before = files()
    found = suffix_dedup.removed_spans(df)
    assert sum(r["n_removed"] > 0 for r in found.collect()) >= 90
    written, size = sum(p.stat().st_size for p in files() - before), sum(len(t) for _, t in rows)
    assert written < 1.6 * size


def test_grams_shared_by_chance_are_few(spark):
    """A gram longer than half of the string: texts without a string in common share few, so that little is compared, whatever the number of texts."""
    rng = random.Random(8)
    known = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    seen = Counter()
    for _ in range(300):
        data = np.frombuffer(" ".join(rng.choice(known) for _ in range(500)).encode(), np.uint8)
        h, _, _, _ = suffix_dedup.sampled_runs(data, np.array([len(data)]), 50)
        seen.update(set(h.tolist()))
    assert sum(n for n in seen.values() if n > 1) < 0.05 * sum(seen.values())


def test_gram_sizes():
    for length in range(20, 121):
        k = suffix_dedup.gram_size(length)
        assert k & (k - 1) == 0 and 1 < length - k + 1 <= 63 and length <= 3 * k


def test_packed_columns_come_back():
    rng = np.random.default_rng(9)
    columns = [rng.integers(-(1 << 63), (1 << 63) - 1, 300), np.zeros(40, np.int64), np.zeros(0, np.int64), np.arange(70_000), np.array([1 << 32, 5], np.uint64)]
    back = suffix_dedup._unpack(suffix_dedup._pack(*columns))
    assert [x.view(np.int64).tolist() for x in back] == [c.tolist() for c in columns]
    assert [x.tolist() for x in suffix_dedup._runs(suffix_dedup._pack(suffix_dedup._gaps(columns[3]), columns[0]))] == [columns[3].tolist(), columns[0].tolist()]


def test_hot_strings_are_compared_in_steps_as_at_once(monkeypatch):
    rng = np.random.default_rng(10)
    kinds = rng.integers(97, 123, (30, 50)).astype(np.uint8)
    rows, want, least = [], [], {}
    told = [(batch, rng.permutation(30)[:20], rng.integers(0, 50, 20)) for batch in range(6)]
    for _, kind, first in told:
        for k, f in zip(kind, first):
            least[k] = min(f, least.get(k, f))
    for batch, kind, first in told:
        rows.append((batch, suffix_dedup._pack(suffix_dedup._gaps(np.arange(20)), np.arange(20) % 7, first), suffix_dedup._ZSTD.compress(kinds[kind].tobytes(), asbytes=True)))
        want.append([2 * (i % 7) + (least[k] < f) for i, (k, f) in enumerate(zip(kind, first))])
    for held in (1 << 20, 11):
        monkeypatch.setattr(suffix_dedup, "HELD_STRINGS", held)
        got = list(suffix_dedup._common(rows, 50))
        assert [g[:2] for g in got] == [(batch, True) for batch in range(6)]
        assert [suffix_dedup._runs(g[2])[1].tolist() for g in got] == want


# --- spelling ------------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(words):
    out, forms = [], {}
    for w, n in words.items():
        near = sorted((-m, v) for v, m in words.items() if one_edit(w, v))
        forms[w] = near[0][1] if near and -near[0][0] >= 10 * n else None
        out.append([w, forms[w], None, n, len(near), -near[0][0] if forms[w] else None])
    for r in out:
        r[2] = r[0]
        while forms[r[2]]:
            r[2] = forms[r[2]]
    return sorted(map(tuple, out), key=repr)


def vocabulary(seed, n=400):
    rng = random.Random(seed)
    words = {}
    for _ in range(n):
        w = "".join(rng.choice("abcé") for _ in range(rng.randint(7, 9)))
        for _ in range(4):
            words[w] = rng.choice([2, 3, 30, 300, 3000, 30000])
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcdÀÿ") + w[i:], w[:i] + rng.choice("abcdÀÿ") + w[i + 1 :]])
            if len(w) < 7:
                break
    return words


@pytest.mark.parametrize("blocks", [1 << 18, 2])
def test_words_one_edit_apart(spark, monkeypatch, blocks):
    """Also with filters so small that nearly every probe hits: the join removes what is no word."""
    monkeypatch.setattr(spelling, "MAX_BLOCKS", blocks)
    words = vocabulary(1)
    words.update({"a" * 64: 500, "a" * 65: 5, "a" * 66: 40, "b" * 300: 2, "b" * 299: 99})
    df = spark.createDataFrame(list(words.items()), "word string, n long").withColumn("v_word", F.lit("clash"))
    got = sorted([tuple(r) for r in spelling.variant_forms(df.repartition(3)).collect()], key=repr)
    assert got == plain_forms(words)


def test_words_of_texts(spark):
    """Nulls, empty texts, capitals that are lowered and those that are not, damaged runs."""
    texts = [(1, "Spelling SPELLING Über-spelling, spelling1spelling"), (2, None), (None, "spelling éééééééÉ naïveté×x"), (3, ""), (4, "x" * 20_000 + " short words"), (4, "spelling " * 50)]
    df = spark.createDataFrame([(*t, "c") for t in texts], "doc_id long, text string, word string")
    want = Counter()
    for d, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            want[w if h % 3 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    got = spelling.word_counts(df, damage=3, least_count=1)
    assert {r["word"]: r["n"] for r in got.collect()} == {w: n for w, n in want.items() if len(w) >= 7}
    assert spelling.variant_forms(spelling.word_counts(df.limit(0))).collect() == []


# --- conversation repair -------------------------------------------------------------------------


def plain_edits(symbols):
    """The least (cost, edits) over all edit sequences, by recursion on the rest."""

    @functools.cache
    def best(i, last, inserts):
        following = {"": "u", "s": "u", "u": "a", "a": "u"}[last]
        found = [(0, "")] if i == len(symbols) and last in ("", "a") else []
        if i < len(symbols):
            cost, edits = best(i + 1, last, 0)
            found.append((4 + cost, "D" + edits))
            if symbols[i] != repair.GONE:
                kind, extra = "suao"[symbols[i] >> 1], 3 * (symbols[i] & 1)
                if kind == following or (last == "" and kind == "s"):
                    cost, edits = best(i + 1, kind, 0)
                    found.append((extra + cost, "K" + edits))
                cost, edits = best(i + 1, following, 0)
                found.append((3 + extra + cost, "R" + edits))
        if inserts < 3:
            cost, edits = best(i, following, inserts + 1)
            found.append((3 + cost, "I" + edits))
        return min(found, default=(10**9, "~"))

    return best(0, "", 0)


def test_block_tables_find_the_least_edits():
    for n in range(4):
        for symbols in itertools.product(range(9), repeat=n):
            assert repair.repair_edits(bytes(symbols)) == plain_edits(symbols)
    rng = random.Random(1)
    for _ in range(800):
        symbols = tuple(rng.choice([0, 1, 2, 2, 2, 3, 4, 4, 4, 5, 6, 7, 8]) for _ in range(rng.randint(4, 15)))
        assert repair.repair_edits(bytes(symbols)) == plain_edits(symbols)


SPACES = "\t\n\x0b\x0c\r "


def plain_repair(rows, convs):
    """The contract, conversation by conversation."""
    after = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            after += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv in convs:
        mine = sorted([r[1:] for r in after if r[0] == conv], key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [r[0] for r in mine if r[0] is not None]
        seen, symbols, faults = set(), [], Counter()
        for _, role, text in mine:
            end = text.rstrip(SPACES)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            kind = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
            symbols.append(8 if fault in ("blank", "duplicate") else 2 * kind + (fault == "truncated"))
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = plain_edits(tuple(symbols))
        lines, last, left = [], "", iter(mine)
        for e in audit:
            if e == "I":
                last = "a" if last == "u" else "u"
                lines.append({"u": "user", "a": "assistant"}[last] + ":")
                continue
            _, role, text = next(left)
            if e == "R":
                last = "a" if last == "u" else "u"
                lines.append({"u": "user", "a": "assistant"}[last] + ":" + text)
            elif e == "K":
                last = role[0]
                lines.append(role + ":" + text)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_conversations_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.OPERATORS["op13_conversation_repair"](spark, SF)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == plain_repair(rows, {r[0] for r in rows})


def test_conversations_with_nulls_ties_and_a_long_one(spark):
    rng = random.Random(2)
    say = lambda: rng.choice(["Yes.", "No!", "cut", "Why? \n", " ", "", None, "Yes."])
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None]), say()) for c in [*range(60), None] for t in [*range(rng.randint(1, 9)), None]]
    rows += [(1000, t, "user" if t % 2 else "assistant", f"turn {t % 90}.") for t in range(0, 800, 2)] + [(1001, None, "user", "Hi.")]
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], SCHEMA + ", place int, audit string").repartition(5)
    got = repair.repair(repair.damaged(df), df)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == plain_repair(rows, {r[0] for r in rows})


def test_no_conversations_and_conversations_without_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair(none, none).collect() == []
    asked = spark.createDataFrame([(1,), (None,)], "conv_id long")
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted([tuple(r) for r in repair.repair(none, asked).collect()], key=repr) == [(1, 0, 0, 0, 0, 0, 0, "", empty), (None, 0, 0, 0, 0, 0, 0, "", empty)]


def test_repaired_turns_tell_their_edits(spark):
    rows = spark.createDataFrame([(1, 0, "system", "Rules."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Go on"), (1, 3, "user", "")], SCHEMA)
    told = repair.faults(rows)
    turns = repair.repaired_turns(told, repair.audits(told)).orderBy("position").collect()
    assert [r["edit"] for r in turns] == list(plain_edits((0, 4, 3, repair.GONE))[1].replace("D", ""))
    assert [r["position"] for r in turns] == list(range(len(turns))) and turns[0]["text"] == "Rules."
