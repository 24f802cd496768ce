"""The prefix tree, token counts and whitening against brute force, and on odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cairn.llm import queries, tokens, trie, whitening

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
NONE = hashlib.sha256().hexdigest()

# 11 ---------------------------------------------------------------------------------------------------------------------


def plain_trie(rows):
    """Every node of the uncompressed tree, with its members listed."""
    turns, built, members, ends, kids = defaultdict(list), {}, defaultdict(list), defaultdict(list), defaultdict(set)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append(((t is not None, t or 0, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()), r, x))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in turns.items()}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    for c, v in built.items():
        ends[tuple(v)].append(c)
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
            if d:
                kids[tuple(v[: d - 1])].add(tuple(v[:d]))
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0)
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), len(kids[k]), leaves[k], saved[k], digest(ends.get(k, []))) for k, m in members.items())


def built_trie(df, **more):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in trie.conversation_trie(df, **more).collect())


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("segment", [256, 2, 3])
def test_trie_against_the_uncompressed_tree(spark, segment):
    """Hot first turns, nested, equal and turnless conversations, ties and nulls, over more partitions than runs."""
    rng = random.Random(segment)
    rows = [
        (c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None]), rng.choice(["a", "a", "a", "a", "bb", None, "é"]))
        for c in rng.sample(range(-20, 300), 120) for t in range(rng.choice([1, 2, 3, 4, 5, 8, 12, 20]))
    ]
    rows += [(c, t, "user", "a") for c in (400, 405, 410, 411) for t in range(40)] + [(None, 0, "user", "a")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert built_trie(spark.createDataFrame(rows, TURNS).repartition(7), segment=segment) == plain_trie(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie_of_one_long_conversation_and_copies(spark):
    long = [(5, t, "user", str(t % 7)) for t in range(700)]
    copies = [(c, t, "user", f"x{t}") for c in range(1000, 1400, 5) for t in range(3)]
    assert built_trie(spark.createDataFrame(long + copies, TURNS)) == plain_trie(long + copies)


def test_trie_of_odd_tables(spark):
    rows = [(1, 0, "user", "a", 9), (1, 0, "user", "a", 9), (2, None, None, None, 9)]
    df = spark.createDataFrame(rows, f"{TURNS}, pos long")
    assert built_trie(df) == plain_trie([r[:4] for r in rows])
    assert trie.conversation_trie(df.limit(0)).collect() == []


def test_ids_of_a_node_that_spans_tasks(spark, monkeypatch):
    ids = list(range(3000))
    df = spark.createDataFrame([("k", c) for c in ids] + [("a", 7), ("z", 1), ("z", -2)], "key string, conv_id long").repartition(5)
    got = {r.key: r.ends_sha256 for r in trie.end_digests(df).collect()}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in (("k", ",".join(map(str, ids))), ("a", "7"), ("z", "-2,1"))}


# 12 ---------------------------------------------------------------------------------------------------------------------

MODELS = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a\nb", "\n", "▁", "x▁y", "<s> </s> <unk>", "é①Ａ　x", "\x00", "a\r\nb;\r", "1234 5", "\U0001f600\U0001f600", "word " * 5000, "z" * 20_000]


def test_pretokens_have_the_tokens_of_whole_texts():
    pieces, none = tokens.Pieces(MODEL), (pa.array([], pa.large_binary()), np.zeros(0, np.int64))
    assert pieces.splits
    texts = [t for t in ODD if t]
    assert tokens._token_counts(pa.array(texts, pa.large_string()), pieces, *none).tolist() == [len(x) for x in MODELS.encode(texts)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n\t\r▁é;1中.\x00<s>"), min_size=1), min_size=1, max_size=5))
def test_any_texts_have_the_tokens_of_the_library(texts):
    pieces, table = tokens.Pieces.at(MODEL), (pa.array([b" a", b"a", b"\n"], pa.large_binary()), np.array([1, 1, 1]))
    assert tokens._token_counts(pa.array(texts, pa.large_string()), pieces, *table).tolist() == [len(x) for x in MODELS.encode(texts)]


def test_token_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 50)
    pieces = tokens.Pieces(MODEL)
    words = [f" w{i}".encode() for i in range(500)] + [b" " + b"q" * 100]
    for _ in range(2):
        for i in range(0, len(words), 20):
            part = words[i : i + 20]
            assert pieces.counts(part) == [len(x) for x in MODELS.encode([w.decode()[1:] for w in part])]
    assert len(pieces.cache) <= 50 and all(len(p) <= tokens.SHORT for p in pieces.cache)


def test_texts_that_cannot_be_split_are_encoded_whole(monkeypatch):
    monkeypatch.setattr(tokens.Pieces, "_keeps", lambda self: False)
    pieces = tokens.Pieces(MODEL)
    assert not pieces.splits
    assert tokens._token_counts(pa.array(["a  b", "c"]), pieces, None, None).tolist() == [len(x) for x in MODELS.encode(["a  b", "c"])]


def test_token_query_against_the_library(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op12_token_counts(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        n = len(MODELS.encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)


def test_token_counts_of_odd_tables(spark):
    rows = [(i, t, 5, 6) for i, t in enumerate([*ODD, None, "a", "a"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, tokens int")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.tokens) for r in tokens.count_tokens(df, "text", MODEL).collect()}
    assert got == {i: (len((t or "").encode()), len(MODELS.encode(t or "")), 6) for i, t, _, _ in rows}
    assert tokens.count_tokens(df.limit(0), "text", MODEL).collect() == []


# 13 ---------------------------------------------------------------------------------------------------------------------


def plain_whitening(vectors):
    """Of the kept vectors: n, deviations, components by the eigenvectors of the covariance, eigenvalues."""
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums) / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, turn = values[order], turn[:, order]
    return n, ((x * n - sums) ** 2).sum(axis=1), ((x * n - sums) / n) @ turn[:, :16] / np.sqrt(values[:16]), values


def test_whitening_query_against_eigenvectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviations, whitened, values = plain_whitening([r.embedding for r in rows])
    got = queries.op13_whitening(spark, SF).orderBy("vec_id", "component").collect()
    assert len(got) == 16 * len(rows)
    mine = np.array([r.whitened for r in got]).reshape(-1, 16)
    sign = np.sign((mine * whitened).sum(axis=0))
    assert np.abs(mine * sign - whitened).max() < 1e-8
    assert [r.deviation for r in got[::16]] == deviations.tolist() and {r.n for r in got} == {n}
    assert np.allclose([r.explained for r in got[:16]], values[:16] / values.sum(), rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


@pytest.mark.parametrize("shape", [(50, 1), (40, 2), (200, 7), (30, 8), (3, 6)])
def test_rotations_find_the_singular_values(shape):
    a = np.random.default_rng(1).normal(size=shape) * np.logspace(0, -6, shape[1])
    sizes, v = whitening.jacobi(a)
    assert np.allclose(sizes[: min(shape)], np.linalg.svd(a)[1], rtol=1e-10, atol=1e-14)
    assert np.allclose(v.T @ v, np.eye(shape[1]), atol=1e-12)
    assert np.allclose(np.linalg.norm(a @ v, axis=0), sizes, atol=1e-12)


def test_small_deviations_keep_their_digits(spark):
    """Deviations of 2**30 and 1 side by side: a covariance would have lost the small one."""
    rng = np.random.default_rng(2)
    vectors = np.c_[rng.integers(-(2**30), 2**30, 400), rng.integers(-20, 20, 400) / 64, rng.integers(-3, 3, 400)].astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, v array<double>").repartition(40)
    row = whitening.whiten(df, "v").first()
    x = np.floor(vectors * 64) - np.floor(vectors * 64).mean(axis=0)
    values = np.linalg.svd(x)[1] ** 2 / len(x)
    assert np.allclose(row.explained, values / values.sum(), rtol=1e-8) and row.identity_error < 1e-4


def test_whitening_of_copies_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [v.tolist() for v in rng.normal(size=(60, 3))]
    rows = [(i, v, 1) for i, v in enumerate(good + [good[0]] * 200)] + [(900, None, 1), (901, [1.0, None, 2.0], 1), (902, [math.nan, 0.0, 0.0], 1), (903, [math.inf, 0.0, 0.0], 1), (904, [1.0], 1), (905, [], 1), (906, [1e300, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, n int").repartition(70)
    got = {r.vec_id: r for r in whitening.whiten(df, "v").collect()}
    assert sorted(got) == list(range(260)) and got[0].n == 60 and got[0].whitened == got[200].whitened
    assert got[5].deviation == plain_whitening(good)[1][5]
    flat = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0])], "vec_id long, v array<double>")
    assert [r.whitened[1] for r in whitening.whiten(flat, "v").collect()] == [None, None]
    one = whitening.whiten(flat.limit(1), "v").first()
    assert one.whitened == [None, None] and one.deviation == 0 and one.identity_error is None
    assert whitening.whiten(flat.limit(0), "v").collect() == []


def test_exact_deviations_beyond_64_bits():
    block, n = np.array([[2**40, 0], [0, 3]]), 2**30
    sums = np.array([5, 7], object)
    assert whitening._deviations(block, n, sums) == [(2**40 * n - 5) ** 2 + 49, 25 + (3 * n - 7) ** 2]
