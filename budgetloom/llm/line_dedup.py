"""Line dedup by a deletion-neighbourhood join, with built-in functions only.

A line is the sequence of its words (white space between words does not count). Two lines are near when they are the
same sequence, or if both have at least ``min_words`` words and one word edit (substitution, insertion or deletion)
makes them the same. A line is dropped when an earlier line, by document id and then by line number, is near it; whether that one
was dropped itself does not matter.

Variants are hashed from sums of word hashes, so that each costs one subtraction: a substitution leaves equal sums of
(word, place) hashes after the place's own is taken away, and the place is part of the key; a deletion leaves the sum
of word hashes of the shorter line. Lines with one word edit also share their first or last half, whatever the edit,
so four keys for each line first find those lines that can have a partner, and only these emit a variant for each word.
Equal substitution variants are all near each other and join with the earliest of them only, so a template that many
lines fill in makes no pairs. All pairs are verified word by word before a line is dropped.

Defined results: null texts are empty texts. Lines without words are kept. Null document ids come first. Repeated rows
of one id are one document: equal lines at the same place are one line. Order of equal lines: the earliest stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from budgetloom.llm.common import likely, stored, tasks_for, with_row_key
from budgetloom.operators.lookup import attach

def spaced(text: Column) -> Column:
    """``text`` with a space for each other white space character within lines: a split at one character needs no pattern."""
    for other in "\t\x0b\x0c\r":
        text = F.replace(text, F.lit(other), F.lit(" "))
    return text


def words_of(line: Column) -> Column:
    """Words of a spaced line."""
    return F.array_remove(F.split(line, " "), "")


def halves(words: Column, n: Column) -> Column:
    """Keys that a line shares with any line one word edit away: as the shorter line, and as the longer one."""
    keys = []
    for short in (n, n - 1):
        half = F.floor(short / 2).cast("int")
        keys += [F.xxhash64(F.lit(1), short, F.slice(words, F.lit(1), half)), F.xxhash64(F.lit(2), short, F.slice(words, n - (short - half) + 1, short - half))]
    return F.array(*keys)


def total(words: Column, place: bool) -> Column:
    """Sum of the words' hashes, with their places in them or without; it wraps around."""
    hashed = F.transform(words, lambda w, i: F.xxhash64(w, i) if place else F.xxhash64(w))
    return F.aggregate(hashed, F.lit(0).cast("long"), lambda a, h: wrapped_sum(a, h))


def wrapped_sum(a: Column, b: Column) -> Column:
    """a + b modulo 2^61, for sums that must not overflow."""
    return F.pmod(a + F.pmod(b, F.lit(1 << 61)), F.lit(1 << 61))


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc, line (from 0), words, of the lines that have words."""
    split = docs.select(F.col(key).alias("doc"), F.posexplode(F.split(spaced(F.coalesce(F.col(text).cast("string"), F.lit(""))), "\n")).alias("line", "body"))
    return split.where(F.trim("body") != "").select("doc", "line", words_of(F.col("body")).alias("words"))


def identity(words: Column) -> list[Column]:
    return [F.xxhash64(words).alias("h1"), F.xxhash64(F.lit(7), words).alias("h2")]


def near_pairs(survivors: DataFrame) -> DataFrame:
    """survivors: h1, h2, first, words, and placed and bag, their totals. a (later line), b (earlier line): structs of first, h1, h2; verified."""
    own = F.struct("first", "h1", "h2")
    n = F.size("words")
    rows = survivors.select(own.alias("own"), n.alias("n"), "words", "placed", "bag")
    each = rows.select("own", "n", "placed", "bag", F.posexplode("words").alias("p", "w"))
    minus = lambda s, h: F.pmod(F.col(s) - F.pmod(h, F.lit(1 << 61)), F.lit(1 << 61))
    masked = each.select("own", F.xxhash64("n", "p", minus("placed", F.xxhash64("w", "p"))).alias("key"))
    earliest = masked.groupBy("key").agg(F.min("own").alias("b"), F.max("own").alias("z")).where("b != z").select("key", "b")
    substituted = attach(masked, earliest, {"key": F.col("key")}, how="inner").where(F.col("own") != F.col("b")).select(F.col("own").alias("a"), "b")
    deleted = each.select(F.col("own").alias("long"), F.xxhash64(F.col("n") - 1, minus("bag", F.xxhash64("w"))).alias("key"))
    whole = rows.select(F.col("own").alias("short"), F.xxhash64("n", "bag").alias("whole"))
    inserted = attach(deleted, whole, {"whole": F.col("key")}, how="inner").select(F.greatest("long", "short").alias("a"), F.least("long", "short").alias("b"))
    pairs = substituted.unionByName(inserted).distinct()
    texts = survivors.select(F.col("h1"), F.col("h2"), "words")
    with_a = pairs.join(texts.withColumnRenamed("words", "u"), (F.col("a.h1") == F.col("h1")) & (F.col("a.h2") == F.col("h2"))).select("a", "b", "u")
    with_b = attach(with_a, texts.withColumnRenamed("words", "v"), {"h1": F.col("b.h1"), "h2": F.col("b.h2")}, how="inner")
    return with_b.where(one_edit(F.col("u"), F.col("v"))).select("a", "b")


def one_edit(u: Column, v: Column) -> Column:
    """Whether one word edit, or none, makes two word sequences the same: what their common start leaves, but for one word, ends alike."""
    n, m = F.size(u), F.size(v)
    differ = F.filter(F.sequence(F.lit(0), F.least(n, m)), lambda i: ~F.get(u, i).eqNullSafe(F.get(v, i)))
    at = F.coalesce(F.array_min(F.slice(differ, 1, 1)), F.least(n, m))
    rest = lambda w, size, skip: F.slice(w, at + 1 + skip, F.greatest(size - at - skip, F.lit(0)))
    return F.when(n == m, rest(u, n, 1) == rest(v, m, 1)).when(n == m + 1, rest(u, n, 1) == rest(v, m, 0)).when(m == n + 1, rest(u, n, 0) == rest(v, m, 1)).otherwise(False)


def dropped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 8) -> tuple[DataFrame, DataFrame]:
    """All lines with words (doc, line, h1, h2), and those to drop: doc, line, kept_doc, kept_line, exact."""
    if min_words < 2:
        raise ValueError("min_words is at least 2")
    n, tasks = F.size("words"), tasks_for(docs, text)
    lines = stored(lines_of(docs, key, text).select("doc", "line", *identity(F.col("words")), F.when(n >= min_words, halves(F.col("words"), n)).alias("keys")), "lines", tasks)
    least = lines.groupBy("h1", "h2").agg(F.min(F.struct("doc", "line", "keys")).alias("m"), F.count("*").alias("n"))
    firsts = stored(least.select("h1", "h2", F.struct("m.doc", "m.line").alias("first"), F.col("m.keys").alias("keys"), "n"), "first-lines", tasks)
    keys = firsts.where("keys is not null").select("h1", "h2", F.explode("keys").alias("k"))
    shared = keys.groupBy("k").agg(F.count("*").alias("lines")).where("lines > 1").select("k")
    able = attach(keys, shared, {"k": F.col("k")}, how="left_semi").select("h1", "h2").distinct()
    where = stored(able.join(firsts.select("h1", "h2", "first"), ["h1", "h2"]).groupBy(F.col("first.doc").alias("d")).agg(F.collect_list(F.struct("first", "h1", "h2")).alias("wanted")), "able-places", tasks)
    texts = docs.select(F.col(key).alias("doc"), spaced(F.col(text).cast("string")).alias("body"))
    held = likely(texts, F.col("doc"), where, F.col("d")).join(where, F.col("doc").eqNullSafe(F.col("d")))
    taken = held.select(F.split("body", "\n").alias("all"), F.explode("wanted").alias("x")).select("x.*", words_of(F.get("all", F.col("x.first.line"))).alias("words"))
    found = taken.where((F.xxhash64("words") == F.col("h1")) & (F.xxhash64(F.lit(7), "words") == F.col("h2"))).dropDuplicates(["h1", "h2"])
    survivors = stored(found.select("*", total(F.col("words"), True).alias("placed"), total(F.col("words"), False).alias("bag")), "able-lines", tasks)
    near = near_pairs(survivors).groupBy(F.col("a.h1").alias("h1"), F.col("a.h2").alias("h2")).agg(F.min("b.first").alias("near"))
    decided = stored(firsts.select("h1", "h2", "first", "n").join(near, ["h1", "h2"], "left").where("n > 1 or near is not null").drop("n"), "decided-lines", tasks)
    places = lines.select("doc", "line", "h1", "h2")
    line_hash = F.xxhash64("h1", "h2")
    occurrences = attach(likely(places, line_hash, decided, line_hash), decided, {"h1": F.col("h1"), "h2": F.col("h2")}, how="inner")
    place = F.struct("doc", "line")
    kept = F.least(F.col("near"), F.when(F.col("first") != place, F.col("first")))
    drops = occurrences.select("doc", "line", kept.alias("kept"), (F.col("first") != place).alias("exact")).where("kept is not null")
    return places, drops.select("doc", "line", F.col("kept.doc").alias("kept_doc"), F.col("kept.line").alias("kept_line"), "exact")


def line_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 8) -> DataFrame:
    """key, n_lines (with words), n_exact and n_near (dropped), dropped (their numbers and what stays instead)."""
    lines, drops = dropped_lines(docs, key, text, min_words)
    every = docs.select(F.col(key).alias("doc"), F.lit(None).cast("int").alias("line"))
    counted = lines.select("doc", "line").distinct().unionByName(every).groupBy("doc").agg(F.count("line").alias("n_lines"))
    one = F.struct("line", "kept_doc", "kept_line", "exact")
    by_doc = drops.distinct().groupBy(F.col("doc").alias("d")).agg(F.count_if("exact").alias("n_exact"), F.count_if(~F.col("exact")).alias("n_near"), F.array_sort(F.collect_list(one)).alias("dropped"))
    joined = counted.join(by_doc, F.col("doc").eqNullSafe(F.col("d")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(F.col("doc").alias(key), "n_lines", F.coalesce("n_exact", zero).alias("n_exact"), F.coalesce("n_near", zero).alias("n_near"), F.coalesce("dropped", F.array().cast(by_doc.schema["dropped"].dataType)).alias("dropped"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 8, drop_empty: bool = False) -> DataFrame:
    """``docs`` with the dropped lines taken out of their texts. ``drop_empty`` also leaves out documents that had lines
    with words and lost all of them. Rows with equal id and text are one document here; other rows of one id, or without
    one, are documents of their own, those of one id in the order of their texts' hashes."""
    columns, docs = docs.columns, with_row_key(docs, key, text, "_row")
    _, drops = dropped_lines(docs, "_row", text, min_words)
    gone = drops.groupBy(F.col("doc").alias("_d")).agg(F.collect_set("line").alias("_gone"))
    joined = docs.join(gone, F.col("_row").eqNullSafe(F.col("_d")), "left")
    left = F.filter(F.split(F.col(text).cast("string"), "\n"), lambda _, i: ~F.array_contains("_gone", i))
    cleaned = joined.withColumn("_text", F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(left, "\n")))
    if drop_empty:
        cleaned = cleaned.where(F.col("_gone").isNull() | F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
    return cleaned.select(*[F.col("_text").alias(c) if c == text else F.col(c) for c in columns])
