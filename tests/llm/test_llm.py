"""The operators against brute force, and on odd tables: nulls, empty and long texts, ties, repeated rows, no rows, clashing columns."""

from __future__ import annotations

import hashlib
import importlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from cairn.llm import chat, decontam, langid, minhash, mixing, quality, queries, sharding, simhash, suffixes, toxicity, urlfilter
from cairn.llm.components import components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, language string, copies int, size long, hits string, fingerprint long, verdict string, listed_url string, prior string"
LONG = "the quick brown fox and the lazy dog of an old town " * 40


def row(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text), 0.5, "x", 7, 1, "h", 9, "v", "u", "p")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [row(1, LONG), row(1, LONG), row(2, LONG), row(3, ""), row(4, None), row(None, LONG), row(5, "!!! 123"), row(6, "der die das und nicht ein " * 30, "de", None), row(7, "word " * 50_000), row(8, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def components_of(n, linked):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# 6 ----------------------------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    w = text.encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def test_simhash_query_against_all_pairs(spark, documents):
    got = {r.doc_id: r for r in queries.op6_simhash(spark, SF).collect()}
    docs = documents.select("doc_id", "text").collect()
    fps = [plain_fingerprint(d.text) for d in docs]
    assert all(got[d.doc_id].fingerprint == f"{f:016x}" for d, f in zip(docs, fps, strict=True))
    roots = components_of(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    least = defaultdict(list)
    for d, r in zip(docs, roots, strict=True):
        least[r].append(d.doc_id)
    assert all(got[d.doc_id].component_id == min(least[r]) for d, r in zip(docs, roots, strict=True))


def test_fingerprint_is_sparks_xxhash64(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] == simhash.fingerprint("A b\tc")


def test_vantage_point_shards_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 300, dtype=np.int64)
    points = list({int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centres for a, b in rng.integers(0, 62, (8, 2))})
    monkeypatch.setattr(simhash, "SHARD", 64)
    monkeypatch.setattr(simhash, "LEAF", 16)
    found = simhash.links(spark.createDataFrame([(p,) for p in points], "point long"), "point", 2)
    place = {p: i for i, p in enumerate(points)}
    got = components_of(len(points), [(place[r.a], place[r.b]) for r in found.collect()])
    want = components_of(len(points), [(i, j) for i in range(len(points)) for j in range(i) if (points[i] ^ points[j]).bit_count() <= 2])
    assert got == want


@pytest.mark.parametrize("few", [1 << 20, 0])
def test_components_of_a_long_chain(spark, monkeypatch, few):
    monkeypatch.setattr(importlib.import_module("cairn.llm.components"), "FEW", few)
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(edges, "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_simhash_odd_rows(spark, odd):
    got = simhash.near_duplicates(odd, "doc_id", "text").collect()
    assert len(got) == 10 and {r.component_id for r in got if r.doc_id in (1, 2, None)} == {1}
    kept = simhash.keep_one(odd, "doc_id", "text")
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6, 7]
    assert simhash.keep_one(odd.limit(0), "doc_id", "text").count() == 0


def plain_keep(docs):
    """The least id of each component of documents whose sets of five-word shingles have a similarity of 0.8 or more."""
    sets = []
    for _, text in docs:
        w = text.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)})
    similar = [(i, j) for i in range(len(docs)) for j in range(i) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8]
    least = {}
    for (i, _), r in zip(docs, components_of(len(docs), similar), strict=True):
        least[r] = min(i, least.get(r, i))
    return sorted(least.values()), len(similar)


@pytest.mark.parametrize(("family", "points", "shingles"), [(8192, 2048, 1 << 20), (4, 16, 1 << 20), (8192, 2048, 2000)])
def test_pipeline_drops_near_copies_of_similarity_0_8(spark, documents, monkeypatch, family, points, shingles):
    """Planted copies with more and more words changed, on both sides of the threshold, in chains and in one large group."""
    monkeypatch.setattr(minhash, "FAMILY", family)
    monkeypatch.setattr(minhash, "POINTS", points)
    monkeypatch.setattr(minhash, "FAMILY_SHINGLES", 4 * shingles)
    monkeypatch.setattr(minhash, "POINTS_SHINGLES", shingles)
    rng = np.random.default_rng(6)
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    def changed(text, n):
        w = text.split()
        for at in rng.choice(len(w), n, replace=False):
            w[at] = f"new{rng.integers(1 << 30)}"
        return " ".join(w)
    long = [t for _, t in docs if 100 <= len(t.split()) <= 400][:40]
    planted = [changed(t, max(1, round(len(t.split()) * k / 200))) for t in long for k in range(1, 8)]
    for t in long[:5]:
        for _ in range(4):
            planted.append(t := changed(t, len(t.split()) // 60))
    planted += [changed(long[0], 1) for _ in range(150)]
    docs += [(10**6 + i, t) for i, t in enumerate(planted)]
    want, similar = plain_keep(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, df, SF).collect())
    assert similar > 1000 and got == want
    old = simhash.keep_one(df, "doc_id", "text").count()
    assert len(want) < old


@pytest.mark.parametrize("rows", [1 << 18, 40])
def test_near_copies_come_from_the_vantage_point_tree(spark, documents, monkeypatch, rows):
    """The tree's pairs connect exactly what pairs within both radii connect; shards dealt to blocks give some of these and change no row that stays."""
    monkeypatch.setattr(simhash, "SHARD", 64)
    monkeypatch.setattr(minhash, "SHARD_ROWS", rows)
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    long = [(i, t.split()) for i, t in docs if 200 <= len(t.split())][:30]
    docs += [(10**6 + i, " ".join([*w[:-1], f"new{k}"])) for k, (i, w) in enumerate(long)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    marked = df.select(minhash.marks(F.col("text"), 5).alias("m")).select("m.*").dropDuplicates(["point"]).cache()
    points = marked.collect()
    place = {bytes(p.point): i for i, p in enumerate(points)}
    bits = lambda x, y: ((x ^ y) & (2**64 - 1)).bit_count()
    fits = lambda p, q: bits(p.by_words, q.by_words) <= 4 and bits(p.by_shingles, q.by_shingles) <= 20 and min(p.n, q.n) >= 0.8 * max(p.n, q.n)
    got = [(place[bytes(r.a)], place[bytes(r.b)]) for r in minhash.in_shards(marked, 0.8).collect()]
    assert got and all(fits(points[a], points[b]) for a, b in got)
    if rows > 40:
        want = components_of(len(points), [(i, j) for i in range(len(points)) for j in range(i) if fits(points[i], points[j])])
        assert components_of(len(points), got) == want
        of = {i: place[minhash.point_of(minhash.shingle_set(t, 5))] for i, t in docs}
        assert all(want[of[i]] == want[of[10**6 + i]] for i, _ in long)
    assert sorted(r.doc_id for r in minhash.keep_one(df, "doc_id", "text").collect()) == plain_keep(docs)[0]


def test_near_copies_odd_rows(spark, odd):
    kept = minhash.keep_one(odd, "doc_id", "text")
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6, 7]
    assert minhash.keep_one(odd.limit(0), "doc_id", "text").count() == 0


# 5 ----------------------------------------------------------------------------------------------------------------------


def plain_removal(docs):
    seen, out = set(), []
    for i, b in sorted(docs):
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(b[p : p + 100])
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("hot", "suffixes_"), [(2, 1 << 15), (1 << 16, 50), (40, 200)])
def test_suffixes_against_brute_force(spark, documents, monkeypatch, hot, suffixes_):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "SUFFIXES", suffixes_)
    monkeypatch.setattr(suffixes, "WINDOWS", 1000)
    monkeypatch.setattr(suffixes, "BUCKETS", 16)
    want = plain_removal([(r.doc_id, r.text.encode()) for r in documents.select("doc_id", "text").collect()])
    assert sorted(map(tuple, queries.op5_suffix_dedup(spark, SF).collect())) == want


def test_suffixes_of_periodic_text_and_edges(spark):
    texts = ["a" * 300, "ab" * 200, "x" * 99, "y" * 100, "y" * 100, "a" * 150 + "z", "é" * 120]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffixes.remove_repeats(df, "doc_id", "text").select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got)) == plain_removal([(i, t.encode()) for i, t in enumerate(texts)])


def test_long_texts_are_anchored_in_pieces(monkeypatch):
    text = np.random.default_rng(2).integers(97, 123, 4000, dtype=np.uint8).tobytes()
    whole = suffixes.anchors(text)
    monkeypatch.setattr(suffixes, "PIECE", (1 << 9) - 1)
    parts = suffixes.anchors(text)
    cover = lambda found: {p: a for a, f, l in zip(found[1], found[2], found[3], strict=True) for p in range(f, l + 1)}  # noqa: E731, E741
    assert sorted(cover(whole)) == sorted(cover(parts)) == list(range(3901))


@settings(deadline=None, max_examples=50)
@given(st.lists(st.binary(max_size=40), max_size=60), st.sampled_from([1, 4, 256]))
def test_multikey_order_sorts(keys, small):
    before, suffixes.SMALL = suffixes.SMALL, small
    try:
        words = suffixes.as_words(keys, 40)
        padded = [k.ljust(40, b"\0") for k in keys]
        order = suffixes.multikey_order(words)
        assert [padded[i] for i in order] == sorted(padded)
        shared = [next((k for k in range(40) if a[k] != b[k]), 40) for a, b in zip(sorted(padded), sorted(padded)[1:], strict=False)]
        assert suffixes.common_prefix(words, order).tolist()[1:] == shared
    finally:
        suffixes.SMALL = before


def test_suffixes_odd_rows(spark, odd):
    got = suffixes.remove_repeats(odd, "doc_id", "text").collect()
    assert len(got) == 10
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert by[2][0].n_removed == by[2][0].n_bytes and by[1][0].n_removed == by[1][1].n_removed == len(LONG)  # the null id comes first
    assert suffixes.remove_repeats(odd.limit(0), "doc_id", "text").count() == 0


# 1 ----------------------------------------------------------------------------------------------------------------------


def test_wand_finds_what_exhaustive_scoring_finds(documents, spark):
    items = decontam.question_and_answer(spark.read.parquet(f"{SF}/benchmark.parquet"), "text")
    (index,) = decontam.indexes(items, "item_id", "question", "answer", 0.3)
    for d in documents.limit(60).collect():
        ids = np.array([index.terms.get(w, -1) for w in decontam.words(d.text)], np.int64)
        found = index.live(ids)
        for w in range(max(1, -(-len(ids) // 64))):
            terms = {int(t) for t in ids[w * 64 : w * 64 + 128] if t >= 0}
            want = defaultdict(float)
            for t in terms:
                for doc, x in zip(index.docs[t], index.impacts[t], strict=True):
                    want[doc] += x
            want = {k: pytest.approx(v) for k, v in want.items() if v >= 0.3}
            assert dict(index.search(*found[w]) if w in found else []) == want


def test_decontamination_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "the quick brown fox and the lazy", "dog of an old town"), (1, "the quick brown fox and the lazy", "dog of an old town"), (2, "alpha beta gamma delta epsilon zeta", "eta"), (3, None, None), (4, "", "")], "item_id long, question string, answer string")
    found = decontam.contaminated(odd, "doc_id", "text", items, "item_id", "question", "answer").collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == [("1", 1), ("1", 1), ("2", 1), ("None", 1)]
    assert decontam.clean(odd, "text", items, "item_id", "question", "answer").count() == 6
    assert decontam.clean(odd, "text", items.limit(0), "item_id", "question", "answer").columns == odd.columns
    assert decontam.clean(odd.limit(0), "text", items, "item_id", "question", "answer").count() == 0


def test_items_with_a_short_rest_are_indexed_whole(spark):
    """Items of one passage and a few words more: their copies are found, also one of the rest's passage alone with a new start."""
    items = [(n, " ".join(f"w{n}x{i}" for i in range(n - 6)), " ".join(f"a{n}x{i}" for i in range(6))) for n in (6, 64, 65, 70, 80, 81, 129, 144, 145)]
    texts = [(n, f"{q}. {a}") for n, q, a in items] + [(1000 + n, f"before it {q} {a} and after it") for n, q, a in items] + [(1, "w70x0 w80x0 a70x5 a80x5")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = decontam.contaminated(df, "doc_id", "text", spark.createDataFrame(items, "item_id long, question string, answer string"), "item_id", "question", "answer").collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == sorted([(n, n) for n, _, _ in items] + [(1000 + n, n) for n, _, _ in items])
    index = decontam.Index(items, defaultdict(lambda: 1.0), 64.0, 0.5)
    assert all(index.docs)


# 2 ----------------------------------------------------------------------------------------------------------------------


def test_toxicity_odd_rows(spark, odd):
    labelled = odd.select("text", F.lit(None).cast("int").alias("toxic"))
    got = toxicity.toxicity(odd, "text", labelled, "toxic").collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    taught = odd.select("text", (F.col("doc_id") == 2).cast("int").alias("toxic"))
    assert toxicity.toxicity(odd.withColumn("voted", F.lit(1)), "text", taught, "toxic").columns[-3:] == ["score", "predicted", "votes"]
    assert toxicity.toxicity(odd.limit(0), "text", labelled.limit(0), "toxic").count() == 0


# 3, 4 -------------------------------------------------------------------------------------------------------------------


def test_bloom_filter_has_no_false_answers(spark):
    urls = spark.range(2000).select(F.concat(F.lit("http://h"), F.col("id") % 50, F.lit(".org/p/"), "id").alias("url"))
    listed = urls.where("right(url, 1) = '3'").select(urlfilter.canonical(F.col("url")))
    got = urlfilter.filter_urls(urls, "url", listed, [])
    assert got.where((F.col("verdict") == "block") != F.col("url").endswith("3")).count() == 0 and got.count() == 2000


def test_url_odd_rows(spark, odd):
    df = odd.withColumn("url", F.when(F.col("doc_id") == 1, "HTTP://EN.Example.com:80/en/x/?utm_source=1#f").when(F.col("doc_id") == 2, "no address"))
    got = urlfilter.filter_urls(df, "url", spark.createDataFrame([(None,), ("x",)], "u string"), queries.URL_RULES).collect()
    assert len(got) == 10 and {r.host for r in got} == {"", "en.example.com:80"} and all(r.listed_url == "u" for r in got)
    (a, _) = [r for r in got if r.doc_id == 1]
    assert (a.canonical_url, a.verdict) == ("en.example.com/en/x", "allow")


def test_url_edges(spark):
    df = spark.createDataFrame([(1, "http://h.org/" + "a" * 100_000 + "?ref=1"), (2, "http://h.org/x"), (2, "http://h.org/x")], "page_id long, url string")
    got = urlfilter.filter_urls(df, "url", df.select(urlfilter.canonical(F.col("url"))), [])
    assert [r.verdict for r in got.collect()] == ["block"] * 3 and max(len(r.canonical_url) for r in got.collect()) == 100_006
    assert urlfilter.filter_urls(df.limit(0), "url", df.select("url"), []).count() == 0 and urlfilter.filter_urls(df, "url", df.select("url").limit(0), []).where("listed").count() == 0


def test_chat_edges(spark):
    """Repeated rows are messages of their own, null turns come first, extra columns of any name stay out, a long conversation is one."""
    rows = [(1, None, "user", "a", "x"), (1, 0, "user", "b", "x"), (1, 0, "user", "b", "x"), (None, 1, None, None, "x")] + [(2, i, "assistant", f"t{i}", "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").withColumn("event", F.lit("delete"))
    out = {r.conv_id: r for r in chat.render(chat.fold_events(chat.messages_as_events(df))).select("conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()}
    assert [t.text for t in out[1].t] == ["a", "b", "b"] and [(t.role, t.text) for t in out[None].t] == [("", "")] and [t.text for t in out[2].t] == [f"t{i}" for i in range(3000)]
    assert chat.fold_events(chat.messages_as_events(df.limit(0))).count() == 0


def test_query_of_event_logs_folds_like_messages(spark):
    """The conversations of the query, told as deltas, edits and regenerations, fold to the same messages."""
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    log = queries.conversation_log(rows)
    assert {r.event for r in log.select("event").distinct().collect()} >= {"message", "delta", "edit", "regenerate", "delete"}
    want = sorted(tuple(r) for r in chat.fold_events(chat.messages_as_events(rows)).collect())
    assert sorted(tuple(r) for r in chat.fold_events(log.repartition(5)).collect()) == want


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_one_source_with_nine_tenths_of_the_rows(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("s"), F.col("id") % 300)).otherwise("hot").alias("source"), (F.col("id") % 97 + 1).alias("size"))
    rows = mixing.systematic_mix(df, "id", "source", "size").collect()
    assert len(rows) == 4000
    taken = defaultdict(int)
    for r in rows:
        taken[r.source] += r.copies * r.size
    assert all(abs(taken[r.source] - r.target) <= 97 for r in rows)


def test_taken_words_come_within_one_document_of_the_target(spark):
    for sf in ("0.001", "0.01"):
        rows = queries.op9_mixing(spark, f"/root/testdata/sf{sf}").join(spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").select("doc_id", "source"), "doc_id").collect()
        taken, largest = defaultdict(int), defaultdict(int)
        for r in rows:
            taken[r.source] += r.taken
            largest[r.source] = max(largest[r.source], r.size)
        assert all(abs(taken[r.source] - r.target) <= largest[r.source] for r in rows)


def test_emitted_copies(spark):
    df = spark.createDataFrame([(1, 2), (2, 0), (3, None), (4, 1), (4, 1)], "id int, copies int").withColumn("times", F.lit("t"))
    out = mixing.emit_copies(df)
    assert out.columns == ["id", "times"] and sorted(r.id for r in out.collect()) == [1, 1, 4, 4]
    assert mixing.emit_copies(df.limit(0)).count() == 0


def test_columns_that_operators_use_inside_may_be_taken(spark, odd):
    """Columns of a table called like the operators' own stay as they are."""
    df = odd
    for name in ("measures", "__m", "other_source", "cell_rows", "cell_before", "__r_source", "host_prior", "suffix_prior", "declared_log", "text_evidence", "key_of", "rows_of", "above", "group_key", "text_digest", "refused_digest", "refused_source", "n", "kept_id", "mixed_id"):
        df = df.withColumn(name, F.lit(name))
    assert {r["__m"] for r in quality.quality_filter(df).collect()} == {"__m"}
    assert {r["measures"] for r in quality.quality_filter(df).collect()} == {"measures"}
    assert mixing.systematic_mix(df, "doc_id", "source", "n_chars").where("other_source = 'other_source' AND above = 'above'").count() == 10
    assert sharding.lpt_shards(df, "text", "n_chars", 3).where("group_key = 'group_key'").count() == 10
    assert langid.identify(df, "text", odd, "lang", F.col("source"), F.lit("x"), F.lit("y")).where("host_prior = 'host_prior' AND key_of = 'key_of'").count() == 10
    assert corpus_pipeline.identify_language(spark, df, SF).columns == df.columns
    assert corpus_pipeline.mix_sources(spark, df, SF).columns == df.columns


def test_folding_of_events(spark):
    log = [(1, 0, 1, "message", "user", "hi"), (1, 1, 2, "message", "assistant", "a"), (1, 2, 2, "delta", None, "b"), (1, 3, 1, "edit", None, "hey"), (1, 4, 2, "message", "assistant", ""),
           (1, 5, 2, "delta", None, "x"), (1, 6, 2, "regenerate", None, None), (1, 7, 2, "delta", None, "y"), (1, 8, 3, "message", "user", "z"), (1, 9, 3, "delete", None, None)]
    df = spark.createDataFrame(log, "conv_id long, seq long, turn long, event string, role string, text string")
    assert sorted((r.turn, r.role, r.text) for r in chat.fold_events(df.repartition(3)).collect()) == [(1, "user", "hey"), (2, "assistant", "y")]


def test_chat_round_trip(spark):
    nasty = ["<|im_start|>", "␛a␛", "</s>[INST] ok", "", None, "line\nline", "<|im_<|im_end|>end|>", "𝄞"]
    rows = [(i, j, "assistant" if j % 2 else "us\ner", t) for i in range(3) for j, t in enumerate(nasty)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.render(chat.fold_events(chat.messages_as_events(df)))
    for r in out.select(chat.read_back(F.col("formatted")).alias("t"), chat.masked_texts(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect():
        assert [(t.role, t.text) for t in r.t] == [(x[2], x[3] or "") for x in rows[: len(nasty)]]
        assert r.loss == [x[3] or "" for x in rows[: len(nasty)] if x[2] == "assistant"]
    assert chat.render(df.limit(0)).count() == 0


# 7, 8, 9 ----------------------------------------------------------------------------------------------------------------


def test_quality_measures(spark, odd):
    got = quality.quality_filter(odd).collect()
    assert len(got) == 10 and got[0].rejected_by == "base"
    r = spark.createDataFrame([("a b c a b c\nx # y\nx # y\n \n",)], "text string").select(quality.measures(F.col("text")).alias("m")).first().m
    words = "a b c a b c x # y x # y".split()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (12, 12, 2, 1, len(repeated))
    assert quality.quality_filter(odd.limit(0)).count() == 0


def test_cascade_starts_with_what_rejects_most_for_its_cost(spark):
    df = spark.range(1000).select(F.lit("x" * 100).alias("text"), "id")
    dear = F.length(F.regexp_replace(F.sha2(F.concat("text", "id"), 512), "[a-f]+", "")) + F.col("id") < 900
    rules = [quality.Rule("dear", dear), quality.Rule("cheap", F.col("id") < 500), quality.Rule("never", F.lit(False))]
    assert [r.name for r in quality.cascade(df, rules)] == ["cheap", "dear", "never"]
    cost = dict(zip("dcn", quality.costs(df, rules), strict=True))
    assert cost["d"] > 8 * cost["c"] and all(math.log2(c) % 1 == 0 for c in cost.values())
    assert quality.costs(df.limit(0), rules) == [1.0] * 3


def test_lpt_places_like_a_heap():
    import heapq

    sizes = sorted(np.random.default_rng(4).integers(1, 40, 500).tolist(), reverse=True)
    heap = [(0, s) for s in range(7)]
    for size in sizes:
        load, shard = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, shard))
    mine = [(0, s) for s in range(7)]
    for size in sorted(set(sizes), reverse=True):
        sharding.place(mine, size, sizes.count(size))
    assert sorted(x for x, _ in mine) == sorted(x for x, _ in heap)


def test_sharding_query(spark):
    rows = queries.op8_sharding(spark, "/root/testdata/sf0.01").collect()
    loads, slots, groups = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
        groups[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(g) == 1 for g in groups.values())
    assert set(loads) == set(range(24)) and max(loads.values()) <= 1.02 * min(loads.values())


def test_sharding_and_mixing_odd_rows(spark, odd):
    out = sharding.lpt_shards(odd, "text", "n_chars", 3, order=("doc_id",))
    assert out.count() == 10 and sharding.lpt_shards(odd.limit(0), "text", "n_chars", 3).count() == 0
    mixed = mixing.systematic_mix(odd, "doc_id", "source", "n_chars")
    assert mixed.count() == 10 and mixed.where("copies not between 0 and 2").count() == 0
    assert mixing.systematic_mix(odd.limit(0), "doc_id", "source", "n_chars").count() == 0


def test_targets_reshare_what_is_over(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 5)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert (got["a"], got[None]) == (20, 10) and sum(got.values()) == pytest.approx(2015 * 1.5) and got["b"] == pytest.approx(2 * got["c"])


# 10 ---------------------------------------------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = queries.op10_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where(queries.held_out("doc_id")).collect()
    assert sum(r.language == r.lang for r in rows) >= 0.99 * len(rows) and all(r.accepted for r in rows)


def test_language_evidence(spark, odd, documents):
    got = langid.identify(odd, "text", documents, "lang", F.col("source"))
    rows = got.collect()
    assert len(rows) == 10 and got.columns == [*[c for c in odd.columns if c != "language"], "language", "confidence", "accepted"]
    assert all(r.language is None and not r.accepted for r in rows if r.doc_id in (3, 4, 5, 8))
    # Host and markup move the posterior of one and the same text.
    rows = [("de " * 30 + "und der die das nicht", "h1", "de")] * 40 + [("les des une que la pour " * 9, "h2", "fr")] * 40 + [("on", "h1", "de"), ("on", "h2", "fr")]
    mixed = spark.createDataFrame(rows, "text string, host string, declared string")
    found = langid.identify(mixed, "text", documents, "lang", F.col("host"), F.lit("x"), F.col("declared"), strength=5.0)
    german, french = found.where("text = 'on'").orderBy("host").collect()
    assert french.language == "fr" and (german.language != "fr" or german.confidence < french.confidence)
    assert langid.identify(odd.limit(0), "text", documents, "lang").count() == 0
    assert langid.identify(odd, "text", documents.limit(0), "lang").where("accepted").count() == 0


def test_every_label_is_a_language(spark):
    """Forty labels, one of them rare: each language's own words are told, the rare one's too."""
    rng = np.random.default_rng(8)
    vocabulary = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(30)] for _ in range(40)]
    rows = [(f"l{k:02}", " ".join(rng.choice(vocabulary[k], 40))) for k in range(40) for _ in range(3 if k == 39 else 60)]
    labelled = spark.createDataFrame(rows, "lang string, text string")
    asked = spark.createDataFrame([(f"l{k:02}", " ".join(rng.choice(vocabulary[k], 40))) for k in range(40)], "want string, text string")
    got = langid.identify(asked, "text", labelled, "lang", max_rows=400).collect()
    assert len(got) == 40 and all(r.language == r.want and r.accepted for r in got)


def test_sample_shares_by_label():
    assert langid.shares({"a": 10, "b": 1000, "c": 100_000}, 3000) == {"a": 1.0, "b": 1.0, "c": 1990 / 100_000}
    assert langid.shares({"a": 5, "b": 10_000}, 20)["b"] == langid.LEAST_ROWS / 10_000


# Pipeline ---------------------------------------------------------------------------------------------------------------


def test_pipeline_stages_keep_the_columns_and_take_effect(spark, documents):
    docs, counts = documents, [documents.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        assert name == "sharding" or out.columns == documents.columns
        docs, counts = out, [*counts, out.count()]
    assert counts[0] >= counts[1] > counts[2] >= counts[3] and counts[4] == counts[5]
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, again.select("doc_id", "shard", "slot").collect())) == sorted(map(tuple, docs.select("doc_id", "shard", "slot").collect()))


@pytest.mark.parametrize("k", range(5))
def test_pipeline_stages_on_odd_rows(spark, odd, k):
    name, stage = corpus_pipeline.STAGES[k]
    for docs in (odd, odd.limit(0)):
        out = stage(spark, docs, SF)
        out.collect()
        assert name == "sharding" or out.columns == odd.columns


@pytest.mark.parametrize("most", [200_000, 0])
def test_url_filter_with_one_address_on_nine_of_ten_rows(spark, monkeypatch, most):
    """A listed and an unlisted address with many rows each, in both ways of probing; the list has false positives' neighbours, repeats and a null."""
    monkeypatch.setattr(urlfilter, "BROADCAST_BLOCKS", most)
    urls = ["http://hot.org/x"] * 5000 + ["http://cold.org/y?b=1&a=2"] * 3000 + [f"http://h{i}.org/p/{i % 7}" for i in range(500)] + [None, "no scheme", ""]
    df = spark.createDataFrame([(i, u, "k", 1) for i, u in enumerate(urls)], "page_id int, url string, known_url string, bloom_hit int").repartition(6)
    canon = {u: r[0] for u in set(urls) for r in [spark.range(1).select(urlfilter.canonical(F.lit(u).cast("string"))).first()]} if most == 0 else None
    listed = spark.createDataFrame([("hot.org/x",), ("hot.org/x",), (None,), *[(f"h{i}.org/p/{i % 7}",) for i in range(0, 500, 3)], *[(f"other{i}",) for i in range(3000)]], "u string")
    got = urlfilter.filter_urls(df, "url", listed, [("allow", "h3.org/")]).collect()
    assert len(got) == len(urls) and {r.known_url for r in got} == {"k"}
    for r in got:
        want = r.url == "http://hot.org/x" or (r.url or "").startswith("http://h") and r.page_id >= 8000 and (r.page_id - 8000) % 3 == 0
        assert r.listed == want and r.verdict == ("allow" if r.host == "h3.org" or not want else "block")
    assert canon is None or canon["http://hot.org/x"] == "hot.org/x"


@pytest.mark.parametrize("most", [1 << 15, 0])
def test_many_indexes_find_what_one_finds(spark, monkeypatch, documents, odd, most):
    """Five indexes of eight items or so: the same hits, with repeated, null and clashing rows, whether the texts found are broadcast or shuffled."""
    items = decontam.question_and_answer(spark.read.parquet(f"{SF}/benchmark.parquet"), "text")
    leaks = items.select((F.col("item_id") + 10**6).alias("doc_id"), F.concat(F.lit("x "), "text", F.lit(" y")).alias("text"))
    docs = documents.select("doc_id", "text").unionByName(leaks).unionByName(leaks).unionByName(odd.select("doc_id", "text")).withColumn("digest", F.lit("d"))
    found = lambda: sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, round(r.question_overlap, 9), round(r.answer_overlap, 9)) for r in decontam.contaminated(docs, "doc_id", "text", items, "item_id", "question", "answer").collect())
    one = found()
    kept = decontam.clean(docs, "text", items, "item_id", "question", "answer").count()
    monkeypatch.setattr(decontam, "ITEMS", 8)
    monkeypatch.setattr(decontam, "BROADCAST_TEXTS", most)
    assert len(list(decontam.indexes(items, "item_id", "question", "answer", 0.5))) > 3
    assert found() == one and len(one) >= 80
    again = decontam.clean(docs, "text", items, "item_id", "question", "answer")
    assert again.count() == kept and again.columns == docs.columns
