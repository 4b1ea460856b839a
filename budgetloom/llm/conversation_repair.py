"""Least-cost repair of conversations whose turns are lost, emptied, cut, repeated or under a wrong role.

A repaired conversation is empty, or an optional system turn and then user and assistant turns in alternation. The cost
vector of a place in a conversation has the least cost of finishing from there for each of the four states it can be
reached in. Shifted to a least entry of 0, there are few such vectors, so the step over any block of ``BLOCK`` rows is
looked up in a table made beforehand (the Four-Russians method): a conversation takes one lookup for each block. The
lookups run from its end, since the trace then runs from its start: it expands one block after the other, from the stored
vector behind it, and takes at every row the ASCII-least of the cheapest edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from budgetloom.llm.common import stored
from budgetloom.operators.lookup import attach

#: Costs of the edits and of a truncated row that stays (fixed values).
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: Rows of one table lookup.
BLOCK = 4

#: States: nothing yet, after a system turn, after a user's, after an assistant's; the turn that must follow, and the state it leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT_STATE = (USER, USER, ASSISTANT, USER)
NEXT_ROLE = ("user", "user", "assistant", "user")

#: Symbols: 2 * role class (s, u, a, other) + truncated; rows that must go; no row.
GONE, NONE = 8, 9
FAR = 10**6


# --- tables --------------------------------------------------------------------------------------


def _with_inserts(v: list[int]) -> tuple[int, ...]:
    """Least costs once turns may be inserted ahead of what follows."""
    v[USER], v[ASSISTANT] = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
    return tuple(min(v[s], INSERT + v[NEXT_STATE[s]]) for s in range(4))


def _kept_state(state: int, symbol: int) -> int | None:
    """The state after keeping a row, None where its role may not follow."""
    kind = symbol >> 1
    if state == START and kind == 0:
        return SYSTEM
    return NEXT_STATE[state] if (kind == 1 and NEXT_STATE[state] == USER) or (kind == 2 and NEXT_STATE[state] == ASSISTANT) else None


def _before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs ahead of a row from those behind it."""
    if symbol == NONE:
        return after
    v = [DELETE + c for c in after]
    if symbol != GONE:
        extra = TRUNCATED * (symbol & 1)
        for s in range(4):
            kept = _kept_state(s, symbol)
            v[s] = min(v[s], REROLE + extra + after[NEXT_STATE[s]], FAR if kept is None else extra + after[kept])
    return _with_inserts(v)


class Tables:
    """All normalised cost vectors, and the steps over one symbol and over every block of symbols."""

    def __init__(self) -> None:
        self.end = _with_inserts([0, FAR, FAR, 0])  # its least entry is 0
        number, self.vectors, step, cost = {self.end: 0}, [self.end], [], []
        for v in self.vectors:  # grows until no new vector is found
            told = []
            for symbol in range(10):
                new = _before(v, symbol)
                low = min(new)
                new = tuple(c - low for c in new)
                if new not in number:
                    number[new] = len(self.vectors)
                    self.vectors.append(new)
                told.append((number[new], low))
            step.append([t[0] for t in told])
            cost.append([t[1] for t in told])
        self.step, self.cost = np.array(step, np.int32), np.array(cost, np.int32)
        code = np.arange(10**BLOCK)
        self.block_step = np.repeat(np.arange(len(step), dtype=np.int32)[:, None], len(code), axis=1)
        self.block_cost = np.zeros_like(self.block_step)
        for place in range(BLOCK):  # the last row of a block is its code's last digit
            symbol = code // 10**place % 10
            self.block_cost += self.cost[self.block_step, symbol]
            self.block_step = self.step[self.block_step, symbol]


tables = cache(Tables)


def repair_edits(symbols: bytes) -> tuple[int, str]:
    """Least cost and the ASCII-least of the cheapest edits, as initials: Delete, Insert, Keep, Rerole."""
    t = tables()
    padded = np.full(-(-len(symbols) // BLOCK) * BLOCK, NONE, np.int64)
    padded[: len(symbols)] = np.frombuffer(symbols, np.uint8)
    codes = padded.reshape(-1, BLOCK) @ (10 ** np.arange(BLOCK - 1, -1, -1))
    behind = np.zeros(len(codes) + 1, np.int32)  # vector behind each block, the last one behind all
    cost = 0
    for j in range(len(codes) - 1, -1, -1):
        now = behind[j + 1]
        cost += int(t.block_cost[now, codes[j]])
        behind[j] = t.block_step[now, codes[j]]
    cost += t.vectors[behind[0]][START]
    out, state = [], START
    for j in range(len(codes)):
        block = padded[j * BLOCK : (j + 1) * BLOCK].tolist()
        costs = [t.vectors[behind[j + 1]]]
        for symbol in reversed(block):
            costs.append(_before(costs[-1], symbol))
        costs.reverse()
        for i, symbol in enumerate(block):
            if symbol == NONE:
                break
            after = costs[i + 1]
            while True:
                left, kept, extra = costs[i][state], _kept_state(state, symbol), TRUNCATED * (symbol & 1)
                if DELETE + after[state] == left:
                    out.append("D")
                elif INSERT + costs[i][NEXT_STATE[state]] == left:
                    out.append("I")
                    state = NEXT_STATE[state]
                    continue
                elif symbol != GONE and kept is not None and extra + after[kept] == left:
                    out.append("K")
                    state = kept
                else:
                    out.append("R")
                    state = NEXT_STATE[state]
                break
    while state in (SYSTEM, USER):
        out.append("I")
        state = NEXT_STATE[state]
    return cost, "".join(out)


# --- rows ----------------------------------------------------------------------------------------

_SPACE = "\t\n\x0b\x0c\r "


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults planted by crc32(conv_id:turn) % 20, a null of any of the four being one space.

    0 drops a row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes it the user's.
    """

    def told(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(told("text"), "[.!?]", "")).otherwise(told("text"))
    role = F.when(fate == 4, "user").otherwise(told("role"))
    copies = F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where(fate != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """The rows in a stored table with ``place`` (what orders them after their turn), ``fault`` and ``symbol``.

    Rows of a conversation are taken by turn, null first; those of one turn by role, then by a hash of the text, equal rows
    in any order. A null conversation is one of its own; a null role or text is one space. The fault is the first of
    blank, duplicate and truncated. Duplicates are found by an aggregation and a join on conversation, role and text, so
    that neither a long conversation nor a turn that is repeated very often comes together in one task.
    """
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    told = rows.select(conv.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"))
    place = F.struct("role", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("id"))
    told = stored(told.withColumns({"place": place, "said": F.unhex(F.sha2(F.concat(F.sha2("role", 256), "text"), 256))}), "turns")
    order = F.struct("turn", "place.id")  # a null turn is the least
    same = {"f_none": F.col("conv_id").isNull(), "f_conv": F.coalesce("conv_id", F.lit(0).cast("long")), "f_said": F.col("said")}
    first = told.groupBy(*[v.alias(k) for k, v in same.items()]).agg(F.min(order).alias("first"))
    end = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    rows_ = attach(told, first, same)
    fault = F.when(end == "", "blank").when(order != F.col("first"), "duplicate").when(~end.isin(".", "!", "?"), "truncated")
    kind = F.coalesce(F.array_position(F.array(F.lit("s"), F.lit("u"), F.lit("a")), F.left("role", F.lit(1))) - 1, F.lit(3))
    kind = F.when(kind < 0, 3).otherwise(kind)
    rows_ = rows_.withColumn("fault", fault)
    lost = F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False))
    symbol = F.when(lost, GONE).otherwise(2 * kind + F.when(F.col("fault") == "truncated", 1).otherwise(0))
    return rows_.select("conv_id", "turn", "place", "role", "text", "fault", symbol.cast("int").alias("symbol"), kind.cast("int").alias("kind"))


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Rows of a conversation side by side in one task, in order; a task reads them as a stream and holds none of the texts."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "place")


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])
    legal = {(0, 1), (1, 2), (2, 1)}
    open_, symbols, kinds = False, bytearray(), bytearray()
    now, done = None, []

    def close() -> None:
        cost, audit = repair_edits(bytes(symbols))
        illegal = sum(pair not in legal for pair in zip(kinds, kinds[1:]))
        done.append((now, illegal, cost, audit))

    for batch in batches:
        for conv, symbol, kind in zip(*(c.to_pylist() for c in batch.columns)):
            if open_ and conv != now:
                close()
                symbols, kinds = bytearray(), bytearray()
            open_, now = True, conv
            symbols.append(symbol)
            kinds.append(kind)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
            done.clear()
    if open_:
        close()
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, illegal, cost, audit for the conversations of ``faults`` rows. Of a conversation, a task holds two bytes for each row."""
    told = _in_order(rows.select("conv_id", "turn", "place", "symbol", "kind")).select("conv_id", "symbol", "kind")
    return told.mapInArrow(_audit, "conv_id long, illegal long, cost long, audit string")


_TURNS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns from rows that come in order behind their conversation's audit."""
    state, edits, position = START, iter(()), 0
    out: list[tuple] = []

    def add(conv, edit: str, role: str, text: str) -> None:
        nonlocal position
        out.append((conv, position, edit, role, text))
        position += 1

    def inserted(conv) -> str | None:
        """Pass the insertions that come next; the edit of the row behind them."""
        nonlocal state
        for e in edits:
            if e != "I":
                return e
            add(conv, "I", NEXT_ROLE[state], "")
            state = NEXT_STATE[state]
        return None

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _TURNS)], schema=_TURNS)
        out.clear()
        return batch

    now = None
    for batch in batches:
        size = 0
        for conv, audit, role, text, symbol in zip(*(c.to_pylist() for c in batch.columns)):
            if audit is not None:
                inserted(now)
                state, edits, position, now = START, iter(audit), 0, conv
                continue
            edit = inserted(conv)
            if edit == "K":
                state = _kept_state(state, symbol)
                add(conv, "K", role, text)
            elif edit == "R":
                add(conv, "R", NEXT_ROLE[state], text)
                state = NEXT_STATE[state]
        if out:
            yield flush()
    inserted(now)
    if out:
        yield flush()


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, position (from 0), edit, role, text of the repaired conversations, in order within each task."""
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast(rows.schema["place"].dataType).alias("place"), "audit", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(NONE).alias("symbol"))
    body = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "place", F.lit(None).cast("string").alias("audit"), "role", "text", "symbol")
    told = _in_order(heads.unionByName(body), "kind").select("conv_id", "audit", "role", "text", "symbol")
    return told.mapInArrow(_apply, "conv_id long, position long, edit string, role string, text string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    now, digest, done = None, None, []
    for batch in batches:
        for conv, position, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if position == 0:
                if digest:
                    done.append((now, digest.hexdigest()))
                now, digest = conv, hashlib.sha256()
            digest.update(f"{chr(10) if position else ''}{role}:{text}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
            done.clear()
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest.hexdigest()], pa.string())], schema=schema)


def text_digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the ``role:text`` lines of ``repaired_turns``, which come in order: no shuffle."""
    return turns.select("conv_id", "position", "role", "text").mapInArrow(_digest, "conv_id long, repaired_sha256 string")


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per id in ``conversations`` (conv_id): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` holds conv_id, turn, role and text of any number of rows of a conversation; others columns are ignored, as are
    conversations that are not asked for. One without rows has zeros, an empty audit and the hash of the empty text; an
    empty table of conversations gives an empty one. Null values are described at ``faults``. Conversations and texts of
    any length are read as a stream by one task, which holds a conversation's symbols and audit but not its texts.
    """
    rows = stored(faults(rows), "faults")
    found = stored(audits(rows), "audits")
    digests = text_digests(repaired_turns(rows, found))
    count = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counted = rows.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *count)
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (counted, found, digests):
        side = part.select(F.col("conv_id").isNull().alias("j_none"), F.coalesce("conv_id", F.lit(0).cast("long")).alias("j_conv"), *[c for c in part.columns if c != "conv_id"])
        out = attach(out, side, {"j_none": F.col("conv_id").isNull(), "j_conv": F.coalesce("conv_id", F.lit(0).cast("long"))})
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
