"""Benchmark decontamination: a BM25 inverted index of test items, searched with block-max WAND.

The items are the indexed documents, cut into passages of at most PASSAGE words; the
training texts are the queries, cut into windows of two passages that overlap by one, so
that every passage-long stretch of a text lies in a window. An impact is a term's BM25
score in a passage over the passage's score against itself: 1 is a passage all of whose
terms are in the window, and one threshold serves all passages. Posting lists have
block maxima over blocks of BLOCK passages. All (window, block) pairs whose maxima stay
below the threshold are ruled out at once, by array operations; in the rest WAND walks
the lists from pivot to pivot. What it retrieves is verified on the text itself:
question and answer must each overlap enough in word shingles.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize

PASSAGE, BLOCK, K1, B = 64, 2, 1.2, 0.75
#: Items and words of one index, about. More make more indexes, each broadcast on its own and searched in turn.
ITEMS, INDEX_WORDS = 8192, 1 << 20
#: Distinct texts with hits that are broadcast to meet their rows; more are joined by shuffle.
BROADCAST_TEXTS = 1 << 15
WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(ids: list[int], n: int) -> set[tuple[int, ...]]:
    return set(zip(*(ids[i:] for i in range(n)), strict=False))


@dataclass
class Item:
    id: object
    question: list[int]
    answer: list[int]

    def overlap(self, part: list[int], text: dict[int, set], ids: list[int], n: int) -> float:
        """Share of the part's shingles of n words that the text has; a shorter part is one shingle, an empty one overlaps wholly."""
        if not part:
            return 1.0
        n = min(n, len(part))
        if n not in text:
            text[n] = shingles(ids, n)
        own = shingles(part, n)
        return len(own & text[n]) / len(own)


class Index:
    """Posting lists of passages with block maxima; the statistics (idf, mean length) are those of all items."""

    def __init__(self, items: list[tuple], idf: dict[str, float], mean: float, theta: float):
        self.terms: dict[str, int] = {}
        self.items: list[Item] = []
        self.theta, self.owner = theta, []
        postings: dict[int, list[tuple[int, float]]] = {}
        for item, question, answer in sorted(items, key=lambda x: (str(x[0]), str(x[1:]))):
            q, a = words(question), words(answer)
            code = lambda ws: [self.terms.setdefault(w, len(self.terms)) for w in ws]
            self.items.append(Item(item, code(q), code(a)))
            whole = q + a
            for i in range(0, len(whole), PASSAGE):
                if 0 < i >= len(whole) - PASSAGE // 4:  # a short rest is the end of a whole passage
                    i = len(whole) - PASSAGE
                passage = whole[i : i + PASSAGE]
                norm = K1 * (1 - B + B * len(passage) / mean)
                impact = {w: idf[w] * passage.count(w) * (K1 + 1) / (passage.count(w) + norm) for w in set(passage)}
                own = sum(impact.values())
                for w in sorted(impact):
                    postings.setdefault(self.terms[w], []).append((len(self.owner), impact[w] / own))
                self.owner.append(len(self.items) - 1)
        self.blocks = -(-len(self.owner) // BLOCK)
        self.docs = [[d for d, _ in postings.get(t, [])] for t in range(len(self.terms))]
        self.impacts = [[x for _, x in postings.get(t, [])] for t in range(len(self.terms))]
        self.most = [max(x, default=0.0) for x in self.impacts]
        self.block_most: list[dict[int, float]] = []
        for t in range(len(self.terms)):
            top: dict[int, float] = {}
            for d, x in postings.get(t, []):
                top[d // BLOCK] = max(x, top.get(d // BLOCK, 0.0))
            self.block_most.append(top)
        # The block maxima once more, term after term, for the array form.
        self.first = np.concatenate([[0], np.cumsum([len(b) for b in self.block_most])]).astype(np.int64)
        self.flat_block = np.array([b for top in self.block_most for b in top], np.int64)
        self.flat_most = np.array([x for top in self.block_most for x in top.values()])

    def live(self, ids: np.ndarray) -> dict[int, tuple[list[int], set[int]]]:
        """By window: its terms, and the blocks whose maxima reach the threshold."""
        known = np.flatnonzero(ids >= 0)
        if not len(known):
            return {}
        last = max(0, (len(ids) - 1) // PASSAGE)
        half = known // PASSAGE
        pairs = np.concatenate([half * len(self.terms) + ids[known], np.maximum(half - 1, 0) * len(self.terms) + ids[known]])
        pairs = np.unique(pairs)
        window, term = pairs // len(self.terms), pairs % len(self.terms)
        n = self.first[term + 1] - self.first[term]
        place = np.repeat(self.first[term] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        cell, sums = np.repeat(window, n) * self.blocks + self.flat_block[place], self.flat_most[place]
        if (last + 1) * self.blocks > 4 * len(cell):
            cells, at = np.unique(cell, return_inverse=True)
            bound = np.bincount(at, sums)
        else:
            cells, bound = np.arange((last + 1) * self.blocks), np.bincount(cell, sums, (last + 1) * self.blocks)
        out: dict[int, tuple[list[int], set[int]]] = {}
        for c in cells[bound >= self.theta - 1e-9].tolist():
            w, b = divmod(c, self.blocks)
            if w not in out:
                lo, hi = np.searchsorted(window, [w, w + 1])
                out[w] = term[lo:hi].tolist(), set()
            out[w][1].add(b)
        return out

    def search(self, terms: list[int], live: set[int]) -> list[tuple[int, float]]:
        """Every passage, in a live block, that scores the threshold or more, by block-max WAND."""
        at = {t: 0 for t in terms}
        docs, theta, out = self.docs, self.theta - 1e-9, []
        order = sorted((t for t in terms if docs[t]), key=lambda t: docs[t][0])
        while order:
            bound, pivot = 0.0, -1
            for i, t in enumerate(order):
                bound += self.most[t]
                if bound >= theta:
                    pivot = i
                    break
            if pivot < 0:
                break
            doc = docs[order[pivot]][at[order[pivot]]]
            while pivot + 1 < len(order) and docs[order[pivot + 1]][at[order[pivot + 1]]] == doc:
                pivot += 1
            block = doc // BLOCK
            if block in live and sum(self.block_most[t].get(block, 0.0) for t in order[: pivot + 1]) >= theta:
                here = [t for t in order[: pivot + 1] if docs[t][at[t]] == doc]
                if len(here) == pivot + 1:
                    score = sum(self.impacts[t][at[t]] for t in here)
                    if score >= theta:
                        out.append((doc, score))
                    goal = doc + 1
                else:
                    goal = doc
            else:  # nothing before the end of the block or the next list can reach the threshold
                goal = (block + 1) * BLOCK
                if pivot + 1 < len(order):
                    goal = min(goal, docs[order[pivot + 1]][at[order[pivot + 1]]])
            for t in order[: pivot + 1]:
                if docs[t][at[t]] < goal:
                    at[t] = bisect_left(docs[t], goal, at[t])
            order = sorted((t for t in order if at[t] < len(docs[t])), key=lambda t: docs[t][at[t]])
        return out

    def hits(self, text: str | None, shingle: int, overlap: float) -> list[dict]:
        get = self.terms.get
        ids = [get(w, -1) for w in words(text)]
        best: dict[int, float] = {}
        for terms, live in self.live(np.array(ids, np.int64)).values():
            for passage, score in self.search(terms, live):
                best[self.owner[passage]] = max(score, best.get(self.owner[passage], 0.0))
        out, seen = [], {}
        for i in sorted(best):
            item = self.items[i]
            q = item.overlap(item.question, seen, ids, shingle)
            a = item.overlap(item.answer, seen, ids, shingle)
            if q >= overlap and a >= overlap:
                out.append({"item": item.id, "score": best[i], "question_overlap": q, "answer_overlap": a})
        return out


def indexes(items: DataFrame, item_id: str, question: str, answer: str, theta: float):
    """The indexes of all items, ITEMS or so in each; each reaches the driver alone."""
    items = items.select(F.col(item_id).alias("id"), F.coalesce(question, F.lit("")).alias("q"), F.coalesce(answer, F.lit("")).alias("a")).distinct()

    @F.pandas_udf("array<string>")
    def tokens(q: pd.Series, a: pd.Series) -> pd.Series:
        return pd.Series([words(x) + words(y) for x, y in zip(q, a, strict=True)], dtype=object)

    tokenized = items.withColumn("w", tokens("q", "a")).where(F.size("w") > 0)
    total = tokenized.agg(F.count("*").alias("n"), F.sum(F.size("w")).alias("words"), F.avg(F.least(F.size("w"), F.lit(PASSAGE))).alias("mean")).first()
    parts = max(-(-total["n"] // ITEMS), -(-(total["words"] or 0) // INDEX_WORDS))
    frequency = tokenized.select(F.explode(F.array_distinct("w")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    part = F.pmod(F.xxhash64("id"), F.lit(max(1, parts)))
    for k in range(parts):
        mine = tokenized.where(part == k)
        known = mine.select(F.explode("w").alias("word")).distinct().join(frequency, "word").collect()
        idf = {r["word"]: float(np.log(1 + (total["n"] - r["df"] + 0.5) / (r["df"] + 0.5))) for r in known}
        rows = [(r["id"], r["q"], r["a"]) for r in mine.select("id", "q", "a").collect()]
        if rows:
            yield Index(rows, idf, total["mean"], theta)


def _search(shared, schema: str, shingle: int, overlap: float):
    @F.pandas_udf(schema)
    def search(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.hits(t, shingle, overlap) for t in texts], dtype=object)

    return search


def with_hits(df: DataFrame, text: str, items: DataFrame, item_id: str, question: str, answer: str, to: str = "hits", theta: float = 0.5, shingle: int = 5, overlap: float = 0.8) -> DataFrame:
    """Add `to`: the items found in each text, as an array of (item, score, question_overlap, answer_overlap).

    An item is found if one of its passages scores `theta` or more in a window and the
    text has `overlap` of the shingles of `shingle` words of its question, and of its
    answer (shorter ones count as one shingle; a null or empty answer overlaps wholly).
    Words are runs of letters and digits, lower-cased. Items without words are never
    found; repeated items count once; items of one id but different texts are judged
    apart. Null and empty texts have no hits. A column called `to` is replaced.

    Where the items make more than one index, the texts are read once for each, so that driver and workers
    hold one index at a time; what is written of each pass are the hits, by the digest of their text, and these
    are joined to the rows in the end. Equal texts have equal hits.
    """
    kind = items.select(item_id).schema[0].dataType.simpleString()
    schema = f"array<struct<item:{kind},score:double,question_overlap:double,answer_overlap:double>>"
    df, none = df.drop(to), F.array().cast(schema)
    built, sc = indexes(items, item_id, question, answer, theta), df.sparkSession.sparkContext
    searched = lambda index: _search(index, schema, shingle, overlap)(F.col(text))
    first, second = next(built, None), next(built, None)
    if second is None:
        return df.withColumn(to, none if first is None else searched(sc.broadcast(first)))
    digest = free_name(df, "text_digest")
    texts, parts = df.select(F.col(text), F.unhex(F.sha2(F.col(text).cast("binary"), 256)).alias("digest")).where(F.col(text).isNotNull()), []
    for index in chain((first, second), built):
        shared = sc.broadcast(index)
        parts.append(materialize(texts.select("digest", searched(shared).alias("found")).where(F.size("found") > 0).dropDuplicates(["digest"])))
        shared.unpersist()
    found = reduce(DataFrame.unionByName, parts).groupBy(F.col("digest").alias(digest)).agg(F.array_sort(F.flatten(F.collect_list("found"))).alias(to))  # an array an index
    found = materialize(found)
    found = F.broadcast(found) if found.count() <= BROADCAST_TEXTS else found
    joined = df.join(found, F.unhex(F.sha2(F.col(text).cast("binary"), 256)) == F.col(digest), "left").drop(digest)
    return joined.withColumn(to, F.coalesce(to, none))


def contaminated(df: DataFrame, id_col: str, text: str, items: DataFrame, item_id: str, question: str, answer: str, **params) -> DataFrame:
    """(id_col, item_id, score, question_overlap, answer_overlap): a row for each item found in each row of `df`. See `with_hits`."""
    hits = with_hits(df.select(F.col(id_col), F.col(text)), text, items, item_id, question, answer, "hits", **params)
    exploded = hits.select(F.col(id_col), F.explode("hits").alias("hit"))
    return exploded.select(id_col, F.col("hit.item").alias(item_id), "hit.score", "hit.question_overlap", "hit.answer_overlap")


def clean(df: DataFrame, text: str, items: DataFrame, item_id: str, question: str, answer: str, **params) -> DataFrame:
    """The rows of `df` in which no item is found, by the rules of `with_hits`: null and empty texts stay, repeated rows share their fate, an empty table stays empty."""
    hits = free_name(df, "hits")
    return with_hits(df, text, items, item_id, question, answer, hits, **params).where(F.size(hits) == 0).drop(hits)


def question_and_answer(items: DataFrame, text: str) -> DataFrame:
    """Add `question` and `answer` to items that hold both in one text: the last sentence is the answer, what stands before it the question.

    A text of one sentence, or null, has an empty answer.
    """
    parts = "(?s)^(.*[.?!])\\s+(\\S.*)$"
    whole = F.coalesce(F.col(text), F.lit(""))
    answer = F.regexp_extract(whole, parts, 2)
    question = F.when(answer == "", whole).otherwise(F.regexp_extract(whole, parts, 1))
    return items.withColumns({"question": question, "answer": answer})
