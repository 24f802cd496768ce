"""Plain Python versions of what SQL cannot say: the label model, language evidence, scheduling, the whole pipeline."""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cairn.llm import decontam, langid, queries, sharding, toxicity
from test_llm import plain_keep

SF = "/root/testdata/sf0.001"


# 2 ----------------------------------------------------------------------------------------------------------------------


def plain_words(text):
    return {w.lower() for w in re.findall(r"[^\W\d_]+", text or "")}


def plain_features(text):
    words, out = plain_words(text), set()
    stems = {w[:k] for w in words for k in range(3, 10) if k <= len(w)}
    for p in stems:
        n = sum(w.startswith(p) for w in words)
        out |= {p} | ({p + "*"} if n > 1 else set()) | ({p + "%"} if n > 1 and 64 * n >= len(words) else set())
    return out | {w + "$" for w in words}


def test_mining_against_plain_counts(spark):
    rng = np.random.default_rng(5)
    common = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(60)]
    bad = ["vilest", "grobst", "grobian", "grobheit"]
    rows = []
    for i in range(300):
        words = list(rng.choice(common, 25))
        if i % 6 == 0:
            words += list(rng.choice(bad, 3))
        rows.append((" ".join(words), int(i % 6 == 0)))
    rows += [("", 0), ("", 1)]
    sizes = Counter(y for _, y in rows)
    base = sizes[1] / len(rows)
    got = toxicity.mine(spark.createDataFrame(rows, "text string, toxic int"), sizes, base)
    seen = {y: Counter(f for t, z in rows if z == y for f in plain_features(t)) for y in (0, 1)}
    candidates = [f for f, n in seen[1].items() if n >= 3]
    want = {}
    for f in candidates:
        n, m = seen[1][f], seen[0][f]
        cells = ((n, (n + m) * base), (m, (n + m) * (1 - base)), (sizes[1] - n, (len(rows) - n - m) * base), (sizes[0] - m, (len(rows) - n - m) * (1 - base)))
        ratio = sum(x * math.log(x / e) for x, e in cells if x > 0)
        if ratio > math.log(100 * len(candidates)) and n / sizes[1] * base >= 0.6 * (n / sizes[1] * base + m / sizes[0] * (1 - base)):
            want[f] = ratio
    assert want and got == {f: pytest.approx(r) for f, r in want.items()}
    terms = toxicity.best_of_chains(got)
    for kind in ("", "*", "%"):
        stems = [t.rstrip("$*%") for t in terms if (t[-1] if t[-1] in "*%" else "") == kind]
        assert not [(a, b) for a in stems for b in stems if a != b and a.startswith(b)]
        for f in got:
            if (f[-1] if f[-1] in "*%" else "") == kind:
                stem = f.rstrip("$*%")
                assert any(stem.startswith(s) or s.startswith(stem) for s in stems)


def test_votes_against_their_definitions():
    voting = toxicity.Voting(["vile$", "grob", "gross*", "dumm%"])
    names = lambda t: {voting.names[i] for i in voting(t)}
    assert names("A VILE thing, vilest") == {"vile$"} and names("grobian") == {"grob"}
    assert "gross*" not in names("grosser") and "gross*" in names("grosser GROSSE")
    filler = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(126))
    assert "dumm%" in names(f"dummer dumme {filler}") and "dumm%" not in names(f"dummer dumme {filler} onemore")
    assert {"stupidity", "silencing"} <= names("You IDIOT, shut up") and "vulgarity" in names("scheiße")
    assert {"shouting", "exclaiming"} <= names("THIS IS ALL LOUD!!") and "stretching" in names("sooooo") and "masking" in names("f**k that")
    assert "plain" in names(filler) and names(None) == names("") == set()
    assert {"courtesy", "reference"} <= names("thank you, see https://x")


def plain_label_model(sets, names):
    """The model of `label_model`, voter by voter and set by set."""
    v = len(names)
    prior = [[b, a] for a, b in [toxicity.PRIOR_CLEAN if n in toxicity.CLEAN else toxicity.PRIOR for n in names]]
    leans = [-1] * v
    vote = {(c, s, j): prior[j][c] for c in (0, 1) for s in (0, 1) for j in range(v)}
    share = 0.05

    def weights(votes, label, n):
        if label is not None:
            return [n * (1 - label), n * label]
        logs = []
        for c in (0, 1):
            z = math.log(share if c else 1 - share)
            for j in range(v):
                p = vote[c, int(leans[j] >= 0 and leans[j] in votes), j]
                z += math.log(p if j in votes else 1 - p)
            logs.append(z)
        post = 1 / (1 + math.exp(logs[0] - logs[1]))
        return [n * (1 - post), n * post]

    def maximise():
        nonlocal vote, share
        for _ in range(toxicity.ROUNDS):
            mass, seen, told = [0.0, 0.0], defaultdict(float), defaultdict(float)
            for votes, label, n in sets:
                for c, w in enumerate(weights(votes, label, n)):
                    mass[c] += w
                    for j in range(v):
                        s = int(leans[j] >= 0 and leans[j] in votes)
                        seen[c, s, j] += w
                        told[c, s, j] += w * (j in votes)
            new = {}
            for c in (0, 1):
                for j in range(v):
                    k = toxicity.PRIOR_TEXTS
                    a = (told[c, 0, j] + k * prior[j][c]) / (seen[c, 0, j] + k)
                    b = (told[c, 1, j] + k * a) / (seen[c, 1, j] + k)
                    new[c, 0, j], new[c, 1, j] = (min(1 - 1e-7, max(1e-7, x)) for x in (a, b))
            change = max(abs(new[k] - vote[k]) for k in new)
            vote, share = new, min(1 - 1e-6, max(1e-6, (mass[1] + 1) / (sum(mass) + 20)))
            if change < toxicity.CLOSE:
                break

    maximise()
    info, related = defaultdict(float), defaultdict(float)
    table = [[defaultdict(float), 0.0] for _ in range(2)]
    for votes, label, n in sets:
        for c, w in enumerate(weights(votes, label, n)):
            table[c][1] += w
            for i in range(v):
                for j in range(i + 1):
                    table[c][0][i, j, i in votes, j in votes] += w
    for cells, mass in table:
        for i in range(v):
            for j in range(i):
                p = {ab: cells[(i, j, *ab)] / mass for ab in ((0, 0), (0, 1), (1, 0), (1, 1))}
                pi, pj = p[1, 0] + p[1, 1], p[0, 1] + p[1, 1]
                sd = math.sqrt(max(1e-12, pi * (1 - pi))) * math.sqrt(max(1e-12, pj * (1 - pj)))
                related[i, j] = max(related[i, j], abs(p[1, 1] - pi * pj) / sd)
                for (a, b), x in p.items():
                    x = max(1e-12, x)
                    info[i, j] += mass * x * math.log(x / max(1e-12, (pi if a else 1 - pi) * (pj if b else 1 - pj)))
    group, edges = list(range(v)), []
    for i, j in sorted(info, key=lambda k: -info[k]):
        if related[i, j] >= 0.05 and info[i, j] > 0 and group[i] != group[j]:
            old = group[i]
            group = [group[j] if g == old else g for g in group]
            edges.append({i, j})
    done = set()
    for start in range(v):
        todo = [] if start in done else [(start, -1)]
        while todo:
            i, above = todo.pop()
            leans[i] = above
            done.add(i)
            todo += [(j, i) for e in edges if i in e for j in e - {i} if j not in done]
    maximise()
    return leans, vote, share


def test_label_model_against_plain_expectation_maximisation(spark):
    rng = np.random.default_rng(3)
    names = ["a$", "b$", "c$", "d", "courtesy", "plain"]
    y = rng.random(3000) < 0.15
    fire = lambda p, q: np.where(y, rng.random(3000) < p, rng.random(3000) < q)
    votes = [fire(0.7, 0.01), fire(0.5, 0.02), fire(0.4, 0.01)]
    votes += [votes[1] & (rng.random(3000) < 0.9), fire(0.02, 0.2), fire(0.3, 0.8)]
    counted = Counter((tuple(j for j in range(6) if votes[j][i]), int(y[i]) if i < 100 else None) for i in range(3000))
    rows = [(list(v), label, float(n)) for (v, label), n in counted.items()]
    sets = spark.createDataFrame(rows, "votes array<int>, label int, n double").repartition(3)
    model = toxicity.label_model(sets, names)
    leans, vote, share = plain_label_model([(set(v), label, n) for v, label, n in rows], names)
    assert model.leans.tolist() == leans and 1 in (leans[3], *[j for j in range(6) if leans[j] == 3]) and model.share == pytest.approx(share)
    assert all(model.vote[k] == pytest.approx(p, abs=1e-7) for k, p in vote.items())
    # The classifier is where its loss has no slope.
    w, bias = toxicity.classifier(sets, model)
    # Gathered, the vote sets give the same model, and their own fit the same classifier.
    held = toxicity.label_model(sets.toPandas(), names)
    assert held.leans.tolist() == leans and np.abs(held.vote - model.vote).max() < 1e-9 and held.share == pytest.approx(model.share)
    here, here_bias = toxicity.classifier(sets.toPandas(), held)
    assert np.abs(np.array(here) - w).max() < 2e-2 and abs(here_bias - bias) < 2e-2
    x = toxicity.spread([v for v, _, _ in rows], 6)
    post = model.posterior(x)
    n = np.array([r[2] if r[1] is None else 0.0 for r in rows])
    slope_here = (n * (1 / (1 + np.exp(-(x @ here + here_bias))) - post)) @ np.column_stack([x, np.ones(len(x))]) / n.sum()
    assert np.abs(slope_here + 1e-5 * np.append(here, 0)).max() < 1e-9
    slope = (n * (1 / (1 + np.exp(-(x @ w + bias))) - post)) @ np.column_stack([x, np.ones(len(x))]) / n.sum()
    assert np.abs(slope + 1e-5 * np.append(w, 0)).max() < 1e-4
    guess = {tuple(v): p >= 0.5 for (v, _, _), p in zip(rows, post, strict=True)}
    assert np.mean([guess[tuple(j for j in range(6) if votes[j][i])] == y[i] for i in range(3000)]) > 0.95


@pytest.mark.parametrize(("sf", "least"), [("0.1", 0.93), ("0.01", 0.64), ("0.001", 0.63)])
def test_toxicity_on_held_out_labels(spark, sf, least):
    """At the smallest sizes, where few rows are held out, all labelled ones count."""
    path = f"/root/testdata/sf{sf}"
    labels = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op2_toxicity(spark, path).where("held_out" if sf == "0.1" else "true").join(labels, "doc_id").select("doc_id", "held_out", "toxic", "predicted").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in rows)
    caught = [r.predicted for r in rows if r.toxic == 1]
    assert sum(caught) >= least * len(caught)
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.02 * len(rows)


# 8 ----------------------------------------------------------------------------------------------------------------------


def plain_lpt(sizes, n):
    """Each shard's group sizes, in the order in which they came."""
    heap, out = [(0, s) for s in range(n)], [[] for _ in range(n)]
    for size in sorted(sizes, reverse=True):
        load, shard = heapq.heappop(heap)
        out[shard].append(size)
        heapq.heappush(heap, (load + size, shard))
    return out


def test_sharding_query_against_a_heap(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    groups = Counter()
    for d in docs:
        groups[d.text or ""] += len((d.text or "").encode()) + 8
    rows = queries.op8_sharding(spark, "/root/testdata/sf0.01").collect()
    got, of = defaultdict(Counter), {d.doc_id: d.text or "" for d in docs}
    for r in rows:
        got[r.shard][of[r.doc_id]] += r.size
        assert r.text_crc32 == zlib.crc32(of[r.doc_id].encode()) and r.size == len(of[r.doc_id].encode()) + 8
    want = plain_lpt(groups.values(), 24)
    assert max(groups.values()) >= sharding.EXACT or [sorted(got[s].values()) for s in range(24)] == [sorted(w) for w in want]
    loads, plain = sorted(sum(g.values()) for g in got.values()), sorted(map(sum, want))
    assert all(abs(a - b) <= 0.001 * b + 8 for a, b in zip(loads, plain, strict=True))
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows))) for s in range(24))
    assert sum(map(len, got.values())) == len(groups)


def test_sharding_of_groups_above_64_kib(spark):
    rng = np.random.default_rng(9)
    sizes = [*rng.integers(1, 200, 300).tolist(), *(sharding.EXACT * rng.integers(1, 40, 60) + rng.integers(0, 9999, 60)).tolist(), *[sharding.EXACT] * 90]
    df = spark.createDataFrame(list(enumerate(sizes)), "g long, size long")
    loads = Counter()
    for r in sharding.lpt_shards(df, "g", "size", 7).collect():
        loads[r.shard] += r.size
    want = sorted(map(sum, plain_lpt(sizes, 7)))
    assert all(abs(a - b) <= 0.003 * b for a, b in zip(sorted(loads.values()), want, strict=True))


def test_one_group_with_nine_tenths_of_the_rows(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(-1)).alias("g"), F.lit(3).alias("size"), "id")
    rows = sharding.lpt_shards(df, "g", "size", 4, order=("id",)).collect()
    assert len({r.shard for r in rows if r.g == -1}) == 1 and len(rows) == 5000
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


# 10 ---------------------------------------------------------------------------------------------------------------------


def plain_grams(text):
    clean = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in text.lower().encode())
    framed = b" " + clean + b"   "
    grams = [framed[i : i + 4] for i in range(len(framed) - 3)]
    return [(int.from_bytes(g, "little") * 2654435761 % 2**32) >> 16 for g in grams if g != b"    "]


def plain_languages(rows, labelled, weight=24, strength=50.0):
    """(language, confidence) of rows (text, host, suffix, declared)."""
    names = sorted({lang for _, lang in labelled})
    logs = []
    for name in names:
        counts = Counter(g for t, lang in labelled if lang == name for g in plain_grams(t))
        total = sum(counts.values()) + 0.1 * langid.BUCKETS
        logs.append(lambda g, counts=counts, total=total: math.log((counts[g] + 0.1) / total))
    logs.append(lambda g: -math.log(langid.BUCKETS))
    names.append(langid.NONE)
    n = len(names)

    def softmax(z):
        e = [math.exp(x - max(z)) for x in z]
        return [x / sum(e) for x in e]

    evidence = []
    for text, *_ in rows:
        g = plain_grams(text) if text and any(map(str.isalpha, text)) else []
        evidence.append([sum(map(f, g)) * min(len(g), weight) / len(g) for f in logs] if g else None)
    shown = [(r, softmax(e)) for r, e in zip(rows, evidence, strict=True) if e]
    sums = [sum(p[i] for _, p in shown) for i in range(n)]
    root = [s / len(shown) * 0.99 + 0.01 / n for s in sums]

    def smoothed(place, above):
        out = {}
        for key in {r[place] for r, _ in shown} - {None}:
            mine = [(r, p) for r, p in shown if r[place] == key]
            out[key] = [(sum(p[i] for _, p in mine) + strength * above(mine[0][0])[i]) / (len(mine) + strength) for i in range(n)]
        return out

    by_suffix = smoothed(2, lambda r: root)
    by_host = smoothed(1, lambda r: by_suffix.get(r[2], root))
    said = {d: [math.log((sum(p[i] for r, p in shown if r[3] == d) + 0.5) / (sums[i] + 1)) for i in range(n)] for d in {r[3] for r, _ in shown} - {None}}
    out = []
    for r, e in zip(rows, evidence, strict=True):
        if e is None:
            out.append((None, 0.0))
            continue
        prior = by_host.get(r[1], by_suffix.get(r[2], root))
        post = softmax([x + math.log(p) + d for x, p, d in zip(e, prior, said.get(r[3], [0.0] * n), strict=True)])
        out.append((names[post.index(max(post))], max(post)))
    return out


@pytest.mark.parametrize("broadcast", [20_000, 1])
def test_language_against_plain_evidence(spark, monkeypatch, broadcast):
    monkeypatch.setattr(langid, "BROADCAST_HOSTS", broadcast)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang").collect()
    labelled = [(d.text[:300], d.lang) for d in docs[:120]]
    hosts = ["h0.de", "h1.de", "h2.fr", "h3.org"]
    rows = [(d.text[: 5 + 7 * (i % 9)], hosts[i % 4], hosts[i % 4].split(".")[1], d.lang if i % 3 == 0 else None) for i, d in enumerate(docs[120:])]
    rows += [("", "h0.de", "de", None), (None, None, None, "en"), ("123 !", "h9.xx", "xx", None), ("the", None, None, None), ("und", "h7.org", "org", "fr")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, text string, host string, suffix string, declared string")
    known = spark.createDataFrame(labelled, "text string, lang string")
    got = langid.identify(df, "text", known, "lang", F.col("host"), F.col("suffix"), F.col("declared"), keep_text=False)
    assert got.columns == ["i", "host", "suffix", "declared", "language", "confidence", "accepted"]
    want = plain_languages(rows, labelled)
    for r in got.collect():
        language, confidence = want[r.i]
        assert r.confidence == pytest.approx(confidence, abs=2e-4)
        assert r.language == language or confidence < 0.51
        assert r.accepted == (language not in (None, langid.NONE) and confidence >= 0.5) or abs(confidence - 0.5) < 1e-3


# Pipeline ---------------------------------------------------------------------------------------------------------------


def plain_contaminated(text, items):
    words = decontam.words(text)
    for q, a in items:
        share = []
        for part in (decontam.words(q), decontam.words(a)):
            k = min(5, len(part))
            own = {tuple(part[i : i + k]) for i in range(len(part) - k + 1)} if part else set()
            theirs = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
            share.append(len(own & theirs) / len(own) if own else 1.0)
        if min(share) >= 0.8 and (decontam.words(q) or decontam.words(a)):
            return True
    return False


def plain_mix(docs):
    """How often each of (doc_id, source, words) is taken, as a list of doc_ids."""
    sizes = Counter()
    for _, s, n in docs:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(w for s, w in weight.items() if s not in capped)
        share = (1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)) / left if left else 0
        more = {s for s in order if s not in capped and weight[s] * share >= 2 * sizes[s]}
        if not more:
            break
        capped |= more
    out = []
    for s in order:
        target = 2 * sizes[s] if s in capped else weight[s] * share
        each = target / sizes[s] if sizes[s] else 0.0
        offset = int(hashlib.md5(f"{s or ''}:mix".encode()).hexdigest()[:8], 16) / 2**32
        mine = sorted((-(len(str(n)) * 100 + int((str(n) + "0")[:2])), hashlib.md5(str(i).encode()).hexdigest(), n, i) for i, t, n in docs if t == s)
        for k, (*_, i) in enumerate(mine):
            out += [i] * (math.floor((k + 1) * each + offset) - math.floor(k * each + offset))
    return out


def test_pipeline_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = decontam.question_and_answer(spark.read.parquet(f"{SF}/benchmark.parquet"), "text").select("question", "answer").collect()
    told = plain_languages([(d.text, d.source, None, None) for d in docs], [(d.text, d.lang) for d in docs if d.text is not None and d.lang is not None])
    kept = [d for d, (language, p) in zip(docs, told, strict=True) if language not in (None, langid.NONE) and p >= 0.5]
    first = set(plain_keep([(d.doc_id, d.text) for d in kept])[0])
    clean = [d for d in kept if d.doc_id in first and not plain_contaminated(d.text, items)]
    assert len(docs) > len(first) > len(clean)
    taken = Counter(plain_mix([(d.doc_id, d.source, len(re.findall(r"[^\x20\x09-\x0D]+", d.text))) for d in clean]))
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in got) == taken
    groups, size = Counter(), {d.doc_id: len(d.text.encode()) + 8 for d in docs}
    text = {d.doc_id: d.text for d in docs}
    for i, n in taken.items():
        groups[text[i]] += n * size[i]
    loads = Counter()
    for r in got:
        loads[r.shard] += r.size
        assert r.size == size[r.doc_id]
    want = [sum(x) for x in plain_lpt(groups.values(), 24)]
    assert max(groups.values()) >= sharding.EXACT or [loads[s] for s in range(24)] == want
    assert len({(r.doc_id, r.shard) for r in got}) == len(taken)
    for s in range(24):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
