"""Chat formatting over a prefix tree: turns that conversations share are emitted once.

A node of the tree is a turn together with all turns before it. Its path has 16 hexadecimal digits for each turn, a
hash chained over the turns so far, so sorting by path is depth-first order: a parent comes before its children, and a
subtree is contiguous. Nodes are tokenised once and laid end to end in that order over the whole forest. Each node has
its place in this stream, the position id of its first token (what its ancestors hold), and the intervals of its
ancestors, which with its own causal triangle are all it attends to.

A turn reads ``<|turn|>role<|text|>text<|end|>`` and a line feed. In roles and texts, control strings get a backslash
after their first character and backslashes are doubled, so none survives inside a text and reading back is exact.

Defined results: null roles and texts are empty. Turns are ordered by turn number, then role, then text (nulls first);
repeated rows are turns of their own. A null conversation id is one conversation. A conversation must fit one task, as
its digest does; shared first turns and repeated conversations may be of any number.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from budgetloom.llm.common import likely, stored
from budgetloom.operators.lookup import attach

STEP = 16
TURN, TEXT, CLOSE = "<|turn|>", "<|text|>", "<|end|>\n"
#: The control strings of this and of other common templates.
CONTROL = re.compile(r"\\|<\||</?s>|\[/?INST\]|<</?SYS>>")
READ = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(CLOSE), re.DOTALL)
ESCAPED = re.compile(r"\\(\\?)")
_STATE: dict = {}


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


def encoding(path: str, pattern: str):
    """The byte-level tokenizer of a rank file, one for each worker process."""
    if _STATE.get("path") != path:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _STATE.update(path=path, own=tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))
    return _STATE["own"]


def turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """A row for each turn of each conversation: conv, n_turns, last, path, depth, role, text."""
    gathered = rows.select(F.col(conv).cast("long").alias("conv"), F.struct(F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text")).alias("t")).groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "n_turns", "last", "path", "depth", "role", "text"]
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int32(), pa.string(), pa.string()]
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, out = batch.slice(at, 64), []
                for c, all_turns in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    path, key = "", b""
                    for i, t in enumerate(all_turns):
                        who, said = t["role"] or "", t["text"] or ""
                        key = blake2b(key + f"{len(who)}:{who}{said}".encode("utf-8", "surrogatepass"), digest_size=STEP // 2).digest()
                        path += key.hex()
                        out.append((c, len(all_turns), i + 1 == len(all_turns), path, i, who, said))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), types, strict=True)], names)

    return gathered.mapInArrow(walk, "conv long, n_turns long, last boolean, path string, depth int, role string, text string")


def tree(turn_rows: DataFrame, tokenizer: str, pattern: str, loss_role: str = "assistant") -> DataFrame:
    """Nodes in depth-first order: path, root, depth, start (in the stream), n_tokens, position, ids, loss_start and
    loss_end (tokens of the node under the loss mask), ancestors (array of intervals of the stream, from the root)."""
    distinct = turn_rows.groupBy("path").agg(F.first("depth").alias("depth"), F.first("role").alias("role"), F.first("text").alias("text"))
    # Range-partitioned before the encoding, as Spark runs twice what it samples for the ranges.
    ranged = distinct.select("path", "depth", "role", "text").repartitionByRange("path").withColumn("part", F.spark_partition_id())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(tokenizer, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for who, said in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    head, body = own.encode_ordinary(f"{TURN}{escape(who)}{TEXT}"), own.encode_ordinary(escape(said))
                    end = len(head) + len(body)
                    out.append((head + body + own.encode_ordinary(CLOSE), len(head) if who == loss_role else end, end))
                ids = pa.array([x[0] for x in out], pa.list_(pa.int32()))
                columns = [part.column(0), part.column(1), part.column(4), ids, pa.array([len(x[0]) for x in out], pa.int64()), *[pa.array([x[i] for x in out], pa.int32()) for i in (1, 2)]]
                yield pa.RecordBatch.from_arrays(columns, ["path", "depth", "part", "ids", "n_tokens", "loss_start", "loss_end"])

    nodes = stored(ranged.mapInArrow(encode, "path string, depth int, part int, ids array<int>, n_tokens long, loss_start int, loss_end int"), "chat-nodes")
    before = nodes.groupBy("part").agg(F.sum("n_tokens").alias("total")).select("part", (F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")).alias("before"))
    within = Window.partitionBy("part").orderBy("path").rowsBetween(Window.unboundedPreceding, 0)
    placed = nodes.withColumn("until", F.sum("n_tokens").over(within)).join(before, "part").withColumn("end", F.col("before") + F.col("until"))
    places = stored(placed.select("part", "path", "depth", (F.col("end") - F.col("n_tokens")).alias("start"), "end", "ids", "n_tokens", "loss_start", "loss_end"), "chat-places")
    return with_ancestors(places)


def with_ancestors(places: DataFrame) -> DataFrame:
    """Positions and ancestor intervals, from one pass over each range of paths with the nodes above the last one at hand.

    What lies above a range's first path is in earlier ranges; these few nodes are looked up and go before the range.
    """
    heads = places.groupBy("part").agg(F.min("path").alias("head")).where(F.length("head") > STEP)
    levels = F.explode(F.sequence(F.lit(1), (F.length("head") / STEP - 1).cast("int"))).alias("n")
    wanted = stored(heads.select(F.col("part").alias("range"), "head", levels).select("range", F.expr(f"substring(head, 1, n * {STEP})").alias("above")), "chat-heads")
    held = likely(places.select("path", "depth", "start", "end"), F.col("path"), wanted, F.col("above"))
    earlier = held.join(wanted, F.col("path") == F.col("above")).select(F.col("range").alias("part"), "path", "depth", "start", "end", F.lit(False).alias("own"))
    rows = places.withColumn("own", F.lit(True)).unionByName(earlier, allowMissingColumns=True)
    ordered = rows.repartition("part").sortWithinPartitions("part", "path").select("own", "part", "depth", "start", "end", "path", "n_tokens", "ids", "loss_start", "loss_end")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, above = None, []  # of the node before: start, end and position of each node down to it
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, keep, positions, starts, ends, cuts = batch.slice(at, 256), [], [], [], [], [0]
                for i, (own, of, depth, start, end) in enumerate(zip(*(part.column(c).to_pylist() for c in range(5)), strict=True)):
                    if of != now:
                        now, above = of, []
                    del above[depth:]
                    if len(above) != depth:
                        raise ValueError("a node comes before its parent")
                    position = above[-1][2] + above[-1][1] - above[-1][0] if above else 0
                    if own:
                        keep.append(i)
                        positions.append(position)
                        starts.extend(x[0] for x in above)
                        ends.extend(x[1] for x in above)
                        cuts.append(len(starts))
                    above.append((start, end, position))
                intervals = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["start", "end"])
                taken = part.select(["path", "depth", "start", "n_tokens", "ids", "loss_start", "loss_end"]).take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(positions, pa.int64()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), intervals)], [*taken.schema.names, "position", "ancestors"])

    kinds = "path string, depth int, start long, n_tokens long, ids array<int>, loss_start int, loss_end int, position long, ancestors array<struct<start:long,end:long>>"
    return ordered.mapInArrow(walk, kinds).select("path", F.substring("path", 1, STEP).alias("root"), "depth", "start", "n_tokens", "position", "ids", "loss_start", "loss_end", "ancestors")


def format_chats(rows: DataFrame, tokenizer: str, pattern: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The tree, and conv, n_turns, path: the node where each conversation ends."""
    turn_rows = stored(turns(rows, conv, turn, role, text), "chat-turns")
    return stored(tree(turn_rows, tokenizer, pattern), "chat-tree"), turn_rows.where("last").select("conv", "n_turns", "path")


def read_back(nodes: DataFrame, ends: DataFrame, tokenizer: str, pattern: str) -> DataFrame:
    """What each conversation reads in the emitted stream: its last node's ancestors and itself, decoded.

    conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    """
    leaves = ends.select("path").distinct().join(nodes.select("path", "start", "ancestors"), "path")
    places = leaves.select("path", F.explode(F.concat(F.transform("ancestors", lambda x: x["start"]), F.array("start"))).alias("at"))
    pieces = attach(places, nodes.select("start", "ids", "loss_start", "loss_end"), {"start": F.col("at")}, how="inner")
    whole = pieces.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", "ids", "loss_start", "loss_end"))).alias("nodes"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(tokenizer, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, out = batch.slice(at, 64), []
                for nodes_of in part.column(1).to_pylist():
                    text = own.decode_bytes([i for n in nodes_of for i in n["ids"]]).decode("utf-8", "surrogatepass")
                    told = "".join(f"{unescape(m[1])}\n{unescape(m[2])}\n" for m in READ.finditer(text))
                    loss = "".join(unescape(own.decode_bytes(n["ids"][n["loss_start"] : n["loss_end"]]).decode("utf-8", "surrogatepass")) for n in nodes_of)
                    out.append((len(READ.findall(text)), *(sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (told, loss)), len(loss), len(text)))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]], ["path", "n_turns", "turns_sha256", "loss_sha256", "loss_chars", "formatted_chars"])

    read = whole.mapInArrow(decode, "path string, n_turns long, turns_sha256 string, loss_sha256 string, loss_chars long, formatted_chars long")
    return attach(ends.select("conv", F.col("path").alias("end")), read, {"path": F.col("end")}, how="inner").select("conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
