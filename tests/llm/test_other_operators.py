"""Chat formatting, packing, vector search and language-model scoring against plain Python; the pipeline; the queries."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from budgetloom.llm import chat_format, lm_scoring, sequence_packing, vector_search
from budgetloom.llm.queries import END_ID, OPERATORS, WORD_BPE
from checks.compare import duck_rows, rows_of

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN

CHATS = [
    (1, 0, "system", "be <|end|>\n kind"), (1, 1, "user", "a\\b <\\ [INST] \\\\"), (1, 2, "assistant", "<s>ok</s>"),
    (2, 0, "system", "be <|end|>\n kind"), (2, 1, "user", "other"), (2, 2, "assistant", None), (2, 3, "user", ""),
    (3, 0, "system", "be <|end|>\n kind"), (4, None, None, None), (4, 0, "assistant", "😀<|turn|>x"), (5, 0, "user", "twin"), (6, 0, "user", "twin"),
    (None, 0, "user", "no id"), (7, 1, "assistant", "same"), (7, 1, "assistant", "same"),
]
CHAT_SCHEMA = "conv_id long, turn long, role string, text string"


def told(rows):
    out = {}
    for c, t, r, x in sorted(rows, key=lambda q: (q[0] is not None, q[0], q[1] is not None, q[1], q[2] is not None, q[2], q[3] is not None, q[3])):
        out.setdefault(c, []).append((r or "", x or ""))
    return out


def test_chats_read_back_exactly(spark):
    nodes, ends = chat_format.format_chats(spark.createDataFrame(CHATS, CHAT_SCHEMA), RANKS, PATTERN)
    got = {r.conv: r for r in chat_format.read_back(nodes, ends, RANKS, PATTERN).collect()}
    want = told(CHATS)
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_shared_turns_are_emitted_once_and_attention_covers_ancestors(spark):
    nodes, _ = chat_format.format_chats(spark.createDataFrame(CHATS, CHAT_SCHEMA), RANKS, PATTERN)
    rows = sorted(nodes.collect(), key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at and len(r.ids) == r.n_tokens
        at += r.n_tokens
    assert [r.path for r in rows] == sorted(r.path for r in rows)
    by_path = {r.path: r for r in rows}
    assert len(by_path) == len(rows) == 12
    for r in rows:
        above = [by_path[r.path[: 16 * k]] for k in range(1, r.depth + 1)]
        assert [tuple(x) for x in r.ancestors] == [(a.start, a.start + a.n_tokens) for a in above]
        assert r.position == sum(a.n_tokens for a in above)


def test_ancestors_are_found_across_ranges_of_paths(spark):
    rows = [(c, t, "user", f"turn {t}" if t < 3 * c else f"own {c} {t}") for c in range(12) for t in range(40)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        nodes, _ = chat_format.format_chats(spark.createDataFrame(rows, CHAT_SCHEMA), RANKS, PATTERN)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    by_path = {r.path: r for r in nodes.collect()}
    assert len(by_path) == 33 + sum(40 - 3 * c for c in range(12))
    for r in by_path.values():
        above = [by_path[r.path[: 16 * k]] for k in range(1, r.depth + 1)]
        assert [tuple(x) for x in r.ancestors] == [(a.start, a.start + a.n_tokens) for a in above]
        assert r.position == sum(a.n_tokens for a in above)


@pytest.mark.parametrize("text", ["", "\\", "<\\|", "</s>", "[INST]\\[/INST]", "\\\\<|x|>", "<<SYS>>", "<" * 5 + "|", "<s<s>>"])
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    escaped = chat_format.escape(text)
    assert chat_format.unescape(escaped) == text
    assert not any(c in escaped for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_no_conversations(spark):
    nodes, ends = chat_format.format_chats(spark.createDataFrame([], CHAT_SCHEMA), RANKS, PATTERN)
    assert nodes.count() == 0 and chat_format.read_back(nodes, ends, RANKS, PATTERN).count() == 0


TEXTS = ["", None, "Hello, World's 12 ½ things!", "ΣΊΣΥΦΟΣ İstanbul é  x", "<|endoftext|> a", "don't'll 'S \x1c y", "wörd " * 3000, "ŁÓDŹ ſtraße ŉ µ ª", "a\tb\x0bc d", "word " * 9000, "日本語 text"]


def test_word_cache_gives_the_tokenizers_ids():
    path = public_tokenizers.path(WORD_BPE)
    cache = sequence_packing.WordCache(path)
    for _ in range(2):
        for t, got in zip(TEXTS, cache.encode_all(TEXTS), strict=True):
            assert np.frombuffer(got, "<u2").tolist() == cache.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_plain_texts_need_no_pass_of_the_whole_tokenizer():
    cache = sequence_packing.WordCache(public_tokenizers.path(WORD_BPE))
    texts = ["Hello, World's 12 things! ŁÓDŹ µ ª", "wörd " * 50, "new-word's ß"]
    want = [cache.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    cache.tokenizer = None
    assert [np.frombuffer(i, "<u2").tolist() for i in cache.encode_all(texts)] == want


def test_packing_keeps_every_id_once(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(None, "x y"), (2, TEXTS[2])], "doc_id long, text string")
    path = public_tokenizers.path(WORD_BPE)
    rows = sequence_packing.pack(docs, "doc_id", "text", path, END_ID, 256).collect()
    tokenizer = sequence_packing.WordCache(path).tokenizer
    want = Counter()
    for r in docs.collect():
        want[r.doc_id, tuple([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, END_ID])] += 1
    streams, sequences = {}, {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
        if r.start == 0:
            streams.setdefault(r.id, []).append([])
        streams[r.id][-1] += ids
    assert Counter((d, tuple(s)) for d, several in streams.items() for s in several) == want
    assert sorted(sequences) == list(range(len(sequences))) and all(n == 256 for s, n in sequences.items() if s < len(sequences) - 1)
    assert sequence_packing.pack(docs.limit(0), "doc_id", "text", path, END_ID).count() == 0


def test_hilbert_keys_visit_neighbours():
    side = 8
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = sequence_packing.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(side**3))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def brute_top(rows, is_query, k):
    out = {}
    for q, v in rows:
        if is_query(q):
            out[q] = sorted(((-sum(a * b for a, b in zip(v, w)), c) for c, w in rows if c != q))[:k]
    return {(q, i + 1): (c, -s) for q, best in out.items() for i, (s, c) in enumerate(best)}


@pytest.mark.parametrize(("dims", "high", "block"), [(4, 2, 16), (12, 30, 64)])
def test_top_k_matches_brute_force(spark, dims, high, block):
    rng = np.random.default_rng(dims)
    rows = [(i, rng.integers(-high, high, dims).tolist()) for i in range(200)]
    rows[20:40] = [(i, rows[0][1]) for i in range(20, 40)]
    odd = [(400, None), (420, []), (440, [None] * dims), (None, rows[1][1]), (460, [1] * (dims + 1))]
    df = spark.createDataFrame(rows + odd, "vec_id long, v array<long>").where(vector_search.usable(F.col("v")))
    got = vector_search.top_k(df, F.col("vec_id") % 20 == 0, "vec_id", "v", k=7, pivots=6, sample=50, block=block, query_block=4)
    named = rows + [(10**9, rows[1][1])]  # the row without an id, behind all others in ties
    expected = {at: (None if c == 10**9 else c, s) for at, (c, s) in brute_top(named, lambda q: q % 20 == 0 and q < 10**9, 7).items()}
    found = {(r.query_id, r["rank"]): (r.id, r.score) for r in got.collect()}
    assert found.pop((460, 1), None) is None  # nothing else has its dimension
    assert found == expected


def test_top_k_of_other_dimensions_repeated_rows_and_large_scores(spark):
    rng = np.random.default_rng(5)
    small = [(i, rng.integers(-9, 9, 3).tolist()) for i in range(1, 60)]
    large = [(i, rng.integers(-(2**31), 2**31, 5).tolist()) for i in range(60, 120)]
    df = spark.createDataFrame([(0, [1]), *small, *small, *large], "vec_id long, v array<long>")
    got = vector_search.top_k(df, F.col("vec_id") % 20 == 0, "vec_id", "v", k=20, pivots=5, sample=30, block=16, query_block=2, run=3)
    expected = {**brute_top(small, lambda q: q % 20 == 0, 20), **brute_top(large, lambda q: q % 20 == 0, 20)}
    assert {(r.query_id, r["rank"]): (r.id, r.score) for r in got.collect()} == expected
    beyond = spark.createDataFrame([(0, [2**40]), (1, [2**40])], "vec_id long, v array<long>")
    with pytest.raises(Exception, match="beyond the range of a long"):
        vector_search.top_k(beyond, F.col("vec_id") == 0, "vec_id", "v").collect()


def test_top_k_sends_queries_only_to_homes_that_can_hold_a_result(spark):
    rng = np.random.default_rng(9)
    far = [(i, ((i % 4 + 1) * np.array([1000, -500]) * (-1) ** i + rng.integers(-5, 5, 2)).tolist()) for i in range(400)]
    df = spark.createDataFrame(far, "vec_id long, v array<long>")
    got = vector_search.top_k(df, F.col("vec_id") % 20 == 0, "vec_id", "v", k=5, pivots=4, sample=50, block=32, run=8)
    assert {(r.query_id, r["rank"]): (r.id, r.score) for r in got.collect()} == brute_top(far, lambda q: q % 20 == 0, 5)


def test_top_k_of_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, [3, 4])], "vec_id long, v array<long>")
    assert [tuple(r) for r in vector_search.top_k(df, F.col("vec_id") == 0, "vec_id", "v").collect()] == [(0, 1, 1, 11)]
    assert vector_search.top_k(df.limit(0), F.lit(True), "vec_id", "v").count() == 0
    assert vector_search.top_k(df, F.lit(False), "vec_id", "v").count() == 0


def lm_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(80)
    return docs.union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "Never Seen"), (-3, "Never Seen")], "doc_id long, text string"))


@pytest.mark.parametrize("common", [60, 1 << 17])
def test_lm_base_scores_match_plain_counts(spark, common):
    docs = lm_rows(spark)
    train = docs.where("doc_id % 5 != 1")
    got = lm_scoring.score(docs, train, model_words=40, common_words=common).collect()
    texts = [(r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect()]
    counts = Counter(t for d, words in texts if math.fmod(d, 5) != 1 for t in [*words, b""])
    total, kinds = sum(counts.values()), len(counts)
    want = sorted((d, len(w) + 1, sum(counts[t] > 0 for t in [*w, b""]), sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in [*w, b""])) for d, w in texts)
    assert [(r.doc_id, r.n_tokens, r.n_known) for r in sorted(got, key=lambda r: r.doc_id)] == [w[:3] for w in want]
    assert all(abs(r.base_score - w[3]) < 1e-6 for r, w in zip(sorted(got, key=lambda r: r.doc_id), want, strict=True))
    assert {r.train_tokens for r in got} == {total}


def test_lm_probabilities_sum_to_one_and_beat_the_base(spark):
    rng = np.random.default_rng(0)
    counts = rng.integers(1, 50, 30).astype(float)
    model = lm_scoring.train_log_bilinear([rng.integers(0, 30, 200).astype(np.uint16)], counts, 0, dims=4, epochs=1, noise=20)
    sums = [sum(10 ** model.log10_probability(np.array([a, b, c]), 0)[2] for c in range(30)) for a in (0, 7) for b in (0, 29)]
    assert np.allclose(sums, 1, atol=1e-4)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    scored = lm_scoring.score(docs, docs.where("doc_id % 5 != 1"), model_words=300).where("doc_id % 5 = 1")
    base, own = scored.agg(F.sum("base_score"), F.sum("score")).first()
    assert own > base


def test_lm_without_training_rows(spark):
    docs = lm_rows(spark)
    rows = lm_scoring.score(docs, docs.limit(0)).collect()
    assert len(rows) == docs.count() and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in rows)
    assert lm_scoring.score(docs.limit(0), docs).count() == 0


def test_lm_learns_what_stands_after_the_first_million_tokens(spark):
    """A pair of words that only the tail of a long text has, and a text after it."""
    long = "a " * 1_600_000 + "b c " * 20_000
    train = spark.createDataFrame([(1, long), (2, "d e " * 5_000)], "doc_id long, text string")
    docs = spark.createDataFrame([(3, "b c " * 10), (4, "d e " * 10)], "doc_id long, text string")
    got = lm_scoring.score(docs, train).collect()
    assert all(r.score > r.base_score + 5 for r in got), got


def test_lm_learns_texts_among_many_nulls(spark):
    train = spark.createDataFrame([(i, None) for i in range(4000)] + [(i, "b c " * 20) for i in range(4000, 5000)], "doc_id long, text string")
    got = lm_scoring.score(spark.createDataFrame([(1, "b c " * 20)], "doc_id long, text string"), train).first()
    assert got.score > got.base_score + 5


def test_every_operator_has_one_query():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert names == list(OPERATORS) and [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))


@pytest.mark.parametrize("name", [n for n in entry_points.oracle_sql() if n.startswith("op")])
def test_operator_query_matches_duckdb(spark, name):
    df = OPERATORS[name](spark, SF)
    names, want = duck_rows(SF, entry_points.oracle_sql()[name])
    assert names == sorted(df.columns) and rows_of(df) == want


def test_held_out_flags(spark):
    got = OPERATORS["op3_language_id"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_pipeline_keeps_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(-5, "1234 !!", None, "x", 7), (-6, None, None, None, None)], docs.schema)
    now = docs.union(extra)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = now
        now = stage(spark, before, SF)
        assert now.columns == docs.columns, name
        left = {r.doc_id for r in now.select("doc_id").collect()}
        assert left <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "language_id":
            assert -5 not in left and -6 not in left and len(left) >= 0.97 * docs.count()
        if name == "decontamination":
            assert len(left) < before.count()
        now = spark.createDataFrame(now.collect(), now.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert packed.select("doc_id").distinct().count() == now.count()


def test_pipeline_stages_tell_rows_without_ids_and_with_repeated_ids_apart(spark):
    words = lambda tag, n=60: " ".join(f"{tag}{i}" for i in range(n))
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    table = lambda rows: spark.createDataFrame([(i, t, None, None, None) for i, t in rows], schema)
    texts = lambda df: sorted((r.doc_id is not None, r.doc_id or 0, r.text) for r in df.collect())
    want = lambda rows: sorted((i is not None, i or 0, t) for i, t in rows)
    stages = dict(corpus_pipeline.STAGES)
    line, own = words("a", 12), words("b", 12)
    rows = [(None, f"{line}\n{words('c', 9)}"), (None, f"{own}\n{line}"), (7, f"{line}\n{words('d', 9)}"), (7, words("e", 12))]
    got = texts(stages["line_dedup"](spark, table(rows), SF))
    assert sum(line in t for _, _, t in got) == 1
    assert all(any(x in t for _, _, t in got) for x in (own, words("c", 9), words("d", 9), words("e", 12)))
    rows = [(None, words("a")), (None, words("a") + " more"), (None, words("b")), (7, words("c")), (7, words("d")), (8, words("c"))]
    got = texts(stages["ngram_jaccard"](spark, table(rows), SF))
    assert len(got) == 4 and set(want([rows[2], rows[3], rows[4]])) < set(got)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.length("text").desc()).first().text
    rows = [(None, f"x {item} y"), (None, words("a")), (7, f"x {item} z"), (7, words("b"))]
    assert texts(stages["decontamination"](spark, table(rows), SF)) == want([rows[1], rows[3]])
