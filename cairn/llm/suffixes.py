"""Removal of byte strings that occur earlier, by sampled, range-partitioned, sorted suffixes.

A window is a string of WIDTH bytes; it is a repeat if an equal one starts earlier. All
windows of a corpus are too many suffixes to move, so each window is led to an anchor:
the least, by a hash, of the grams of GRAM bytes in it. Equal windows have equal anchors
at equal places, and neighbouring windows mostly share theirs: there is about one anchor
for every (WIDTH - GRAM) / 2 bytes. An anchor stands for its windows; what they cover
together is its span.

1. Grams that anchor only one place cannot lie in a repeated window: a count over all
   anchors rules most of them out.
2. The spans of the rest, with the suffix from the anchor on, are range-partitioned by
   the leading bytes of the suffix, between splitters from a bounded sample of anchors.
   Equal leading bytes are never parted, so no two suffixes that share a gram lie on two
   sides of a boundary, and none needs to be compared across it.
3. Each bucket sorts its suffixes by multikey quicksort and reads off the common prefixes of
   neighbours: those that share their gram are a run. Within a run, sorted spans tell whole
   repeats from their neighbours; the windows of the spans left are sorted by their place
   before the anchor and their bytes, and again neighbours without a difference are repeats.
4. Grams of more than HOT places could overfill a bucket: their spans are made distinct
   by a pre-aggregated grouping, and the windows of these are grouped by their bytes over
   the whole cluster.

Copies of whole texts are told by their SHA-256 beforehand: only the first goes through this.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, materialize

WIDTH, GRAM = 100, 20
GRAMS = WIDTH - GRAM + 1
#: Places of a gram beyond which its windows are compared by the whole cluster: a bucket must hold all spans of a gram, some 180 bytes each.
HOT = 1 << 16
#: Leading bytes that splitters look at; suffixes a bucket, about; the most buckets, beyond which each is dealt further by gram; sampled anchors a bucket.
LEAD, SUFFIXES, BUCKETS, SAMPLED = 16, 1 << 15, 1 << 16, 16
#: Rows that a quicksort leaves to a plain sort; windows that are sorted at once.
SMALL, WINDOWS = 256, 1 << 17
#: Rows of a gram with more than one of so many of all shared anchors are dealt to so many tasks.
SALTS = 64
#: Low bits of a packed hash that hold a place; longer texts are anchored piece by piece.
PLACE_BITS = 20
PIECE = (1 << PLACE_BITS) - 1
ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every gram of the bytes."""
    with np.errstate(over="ignore"):
        level, factor, width, total = b.astype(np.uint64) + np.uint64(1), ODD, 1, None
        rest, covered = GRAM, 0
        while rest:
            if rest & 1:
                if total is None:
                    total, covered = level, width
                else:
                    n = len(level) - covered
                    total, covered = total[:n] * factor + level[covered : covered + n], covered + width
            rest >>= 1
            if rest:
                n = len(level) - width
                level, factor, width = level[:n] * factor + level[width:], factor * factor, 2 * width
        h = total[: len(b) - GRAM + 1]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, place, first window, last window) of each anchor of a text; none for one shorter than a window."""
    n = len(text) - WIDTH + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 4
    b, parts = np.frombuffer(text, np.uint8), []
    for start in range(0, n, PIECE - WIDTH):
        h = gram_hashes(b[start : start + PIECE])
        least = (h & ~np.uint64(PIECE)) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= GRAMS:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if width < GRAMS:
            least = np.minimum(least[: width - GRAMS], least[GRAMS - width :])
        place = (least & np.uint64(PIECE)).astype(np.int64)[: PIECE - WIDTH]
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:], [len(place)]]) - 1
        parts.append((h[place[first]].view(np.int64), place[first] + start, first + start, last + start))
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def as_words(keys: list[bytes], width: int) -> np.ndarray:
    """Byte strings as rows of big-endian words, cut or padded with zeros to `width` bytes, a multiple of eight."""
    return np.frombuffer(b"".join(k[:width].ljust(width, b"\0") for k in keys), ">u8").reshape(len(keys), width // 8).astype(np.uint64)


def multikey_order(words: np.ndarray) -> np.ndarray:
    """The order of rows of words, by multikey quicksort: rows are parted by one word against a pivot; equal ones go on with the next word."""
    order, todo = np.arange(len(words)), [(0, len(words), 0)]
    while todo:
        low, high, depth = todo.pop()
        if high - low < 2 or depth == words.shape[1]:
            continue
        rows = order[low:high]
        if high - low <= SMALL:
            order[low:high] = rows[np.lexsort(words[rows, depth:].T[::-1])]
            continue
        word = words[rows, depth]
        pivot = np.sort(word[:: max(1, len(word) // 9)])[len(word[:: max(1, len(word) // 9)]) // 2]
        less, more = word < pivot, word > pivot
        parts = rows[less], rows[~(less | more)], rows[more]
        first, second = low + len(parts[0]), high - len(parts[2])
        order[low:high] = np.concatenate(parts)
        todo += [(low, first, depth), (first, second, depth + 1), (second, high, depth)]
    return order


def common_prefix(words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many bytes each row, in the order, has in common with the one before it; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    if len(order) > 1:
        other = words[order[1:]] ^ words[order[:-1]]
        at = (other != 0).argmax(axis=1)
        word = other[np.arange(len(other)), at]
        byte = (word.astype(">u8").view(np.uint8).reshape(-1, 8) != 0).argmax(axis=1)
        out[1:] = np.where(word == 0, words.shape[1] * 8, at * 8 + byte)
    return out


def later_ones(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which rows equal one of a lower rank: sorted, equal rows are neighbours without a difference."""
    out = np.zeros(len(words), bool)
    if len(words):
        order = multikey_order(words)
        first = np.flatnonzero(common_prefix(words, order) < words.shape[1] * 8)
        least = np.minimum.reduceat(rank[order], first)
        out[order] = rank[order] > np.repeat(least, np.diff(np.append(first, len(order))))
    return out


def repeats_in(docs: np.ndarray, ties: np.ndarray, firsts: np.ndarray, places: np.ndarray, spans: list[bytes]) -> pd.DataFrame:
    """Runs (doc, tie, first, last) of the windows of a bucket that an earlier row has. `places`: where in its span each row's anchor is."""
    out = {"doc": [docs[:0]], "tie": [ties[:0]], "first": [firsts[:0]], "last": [firsts[:0]]}

    def emit(rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        for name, part in zip(out, (docs[rows], ties[rows], firsts[rows] + first, firsts[rows] + last), strict=True):
            out[name].append(part)

    words = as_words([s[a:] for s, a in zip(spans, places.tolist(), strict=True)], -(-WIDTH // 8) * 8)
    order = multikey_order(words)
    run = np.empty(len(spans), np.int64)
    run[order] = np.cumsum(common_prefix(words, order) < GRAM)
    rank = np.empty(len(spans), np.int64)
    rank[np.lexsort((firsts, ties, docs))] = np.arange(len(spans))
    lengths = np.array(list(map(len, spans)))
    rows = np.flatnonzero(np.bincount(run)[run] > 1)
    # Spans that equal an earlier one at the same place of the anchor are repeats as a whole.
    whole = as_words([spans[i] for i in rows.tolist()], -(-(WIDTH + GRAMS) // 8) * 8)
    whole = np.column_stack([(run[rows] << 20 | places[rows] << 10 | lengths[rows]).astype(np.uint64), whole])
    again = later_ones(whole, rank[rows])
    emit(rows[again], np.zeros(again.sum(), np.int64), lengths[rows[again]] - WIDTH)
    rows = rows[~again]
    rows = rows[np.bincount(run[rows], minlength=1)[run[rows]] > 1] if len(rows) else rows
    if not len(rows):
        return pd.DataFrame({k: np.concatenate(v) for k, v in out.items()})
    # All windows of the spans left, by run and by how far they start before the anchor.
    n = lengths[rows] - WIDTH + 1
    row, at = np.repeat(np.arange(len(rows)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    key = run[rows[row]] << 8 | (places[rows[row]] - at)
    by_key = np.argsort(key, kind="stable")
    starts = np.cumsum(lengths[rows]) - lengths[rows]
    views = np.lib.stride_tricks.sliding_window_view(np.frombuffer(b"".join(spans[i] for i in rows.tolist()), np.uint8), WIDTH)
    repeated, begin = np.zeros(len(key), bool), 0
    while begin < len(key):
        end = min(len(key), begin + WINDOWS)
        if end < len(key):  # windows of one key stay together
            end = int(np.searchsorted(key[by_key], key[by_key[end - 1]], "right"))
        some = by_key[begin:end]
        padded = np.zeros((len(some), -(-WIDTH // 8) * 8), np.uint8)
        padded[:, :WIDTH] = views[starts[row[some]] + at[some]]
        words = np.column_stack([key[some].astype(np.uint64), padded.view(">u8").astype(np.uint64)])
        repeated[some] = later_ones(words, rank[rows[row[some]]])
        begin = end
    begins = repeated & ~(np.concatenate([[False], repeated[:-1]]) & (at > 0))
    ends = repeated & ~np.concatenate([repeated[1:] & (at[1:] > 0), [False]])
    emit(rows[row[begins]], at[begins], at[ends])
    return pd.DataFrame({k: np.concatenate(v) for k, v in out.items()})


def _compare(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bucket, whole."""
    return repeats_in(*[pdf[c].to_numpy(np.int64) for c in ("doc", "tie", "first", "anchor")], pdf["span"].tolist())


def _windows(batches):
    for pdf in batches:
        for doc, tie, first, span in zip(pdf["doc"], pdf["tie"], pdf["first"], pdf["span"], strict=True):
            n = len(span) - WIDTH + 1
            yield pd.DataFrame({"doc": doc, "tie": tie, "first": first + np.arange(n), "window": [span[i : i + WIDTH] for i in range(n)]})


def splitters(texts: DataFrame, suffixes: int) -> np.ndarray:
    """The sorted leading bytes, at most BUCKETS - 1, that part `suffixes` suffixes evenly, from about SAMPLED anchors a bucket; these reach the driver.

    Texts are sampled, and their anchors, all along the texts.
    """
    buckets = max(1, min(BUCKETS, -(-suffixes // SUFFIXES)))
    if buckets == 1:
        return np.zeros(0, f"S{LEAD}")
    n, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()
    share = min(1.0, 64 * buckets / max(1, n))
    each = min(1.0, 2 * SAMPLED * buckets / max(1.0, size * share * 2 / (WIDTH - GRAM)))

    def leads(batches):
        rng = np.random.default_rng(5)
        for pdf in batches:
            found = []
            for b in pdf["bytes"]:
                place = anchors(b)[1]
                found += [b[a : a + LEAD] for a in place[rng.random(len(place)) < each].tolist()]
            yield pd.DataFrame({"lead": pd.Series(found, dtype=object)})

    sample = texts.sample(fraction=share, seed=3).mapInPandas(leads, "lead binary").toPandas()["lead"]
    sample = np.sort(np.array([bytes(x).ljust(LEAD, b"\0") for x in sample], f"S{LEAD}"))
    return np.unique(sample[np.arange(1, buckets) * len(sample) // buckets]) if len(sample) else sample


def union(runs: list) -> list[tuple[int, int]]:
    """The maximal byte ranges [start, end) that runs (first, last) of windows cover."""
    out: list[list[int]] = []
    for first, last in sorted(map(tuple, runs)):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + WIDTH)
        else:
            out.append([first, last + WIDTH])
    return [tuple(x) for x in out]


RUN = "doc long, tie long, first long, last long"


def hot_runs_of(spans: DataFrame) -> DataFrame:
    """Runs (doc, tie, first, last) of the windows of hot grams' spans that start earlier too, grouped by the cluster: equal spans are one row from here on, the others of a span repeats as a whole."""
    at = F.struct("doc", "tie", "first")
    hot = spans.select(at.alias("at"), "span")
    distinct = hot.groupBy("span").agg(F.min("at").alias("earliest"))
    repeats = hot.join(distinct.withColumnRenamed("span", "same"), F.col("span") == F.col("same")).where("at != earliest")
    whole_runs = repeats.select("at.doc", "at.tie", "at.first", (F.col("at.first") + F.length("span") - WIDTH).alias("last"))

    windows = distinct.select("earliest.doc", "earliest.tie", "earliest.first", "span")
    windows = windows.mapInPandas(_windows, "doc long, tie long, first long, window binary").select(at.alias("at"), "window")
    earliest = windows.groupBy(F.col("window").alias("same")).agg(F.min("at").alias("earliest"))
    later = windows.join(earliest, F.col("window") == F.col("same")).where("at != earliest")
    return whole_runs.unionByName(later.select("at.doc", "at.tie", "at.first", F.col("at.first").alias("last")))


def remove_repeats(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, removed array of [start, end) byte ranges, kept binary), a row for each row of `df`.

    Every byte of a 100-byte string that also starts earlier is removed: in a smaller id
    (null before all), or in the same text at a smaller place. Strings are judged on the
    input. Null texts are empty; texts under 100 bytes stay whole. Rows of one id and
    equal texts are one document: none is earlier than the other. Rows of one id and
    different texts are ordered by a hash of the text. An empty table gives an empty
    result; extra columns are left out.
    """
    spark = df.sparkSession
    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    docs = df.select(F.col(id_col).alias("id"), order.alias("doc"), F.xxhash64(whole).alias("tie"), whole.alias("bytes"))
    # One shuffle of the texts serves all joins below: the plan repeats it, Spark runs it once.
    placed = docs.repartition("doc", "tie")

    def anchor(batches):
        for pdf in batches:
            parts = [np.unique(anchors(b)[0], return_counts=True) for b in pdf["bytes"]]
            n = [len(g) for g, _ in parts]
            grams, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            yield pd.DataFrame({"doc": np.repeat(pdf["doc"], n), "tie": np.repeat(pdf["tie"], n), "gram": grams, "c": counts})

    long = docs.where(F.length("bytes") >= WIDTH).select("doc", "tie", "bytes")
    found = long.mapInPandas(anchor, "doc long, tie long, gram long, c long")
    counts = materialize(found.groupBy(F.col("gram").alias("counted")).agg(F.sum("c").alias("n")).where("n > 1"))
    total = counts.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("n") <= HOT, F.col("n"))).alias("cold")).first()
    # The rows of common grams, 4096 at most, are dealt to SALTS tasks each.
    common = counts.where(F.col("n") > (total["all"] or 0) * HOT_SHARE).select(F.col("counted").alias("common"))
    salts = F.when(F.col("common").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = counts.join(F.broadcast(common), F.col("counted") == F.col("common"), "left").select("counted", "n", F.explode(salts).alias("copy"))
    salt = F.when(F.col("common").isNotNull(), F.pmod(F.xxhash64("doc", "tie"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    dealt = found.join(F.broadcast(common), F.col("gram") == F.col("common"), "left").select("doc", "tie", "gram", salt.alias("salt"))
    shared = dealt.join(salted, (F.col("gram") == F.col("counted")) & (F.col("salt") == F.col("copy")))
    # Copies of a whole text repeat throughout: only the first of each text is looked into.
    texts = docs.where(F.length("bytes") >= WIDTH).select("doc", "tie", F.unhex(F.sha2("bytes", 256)).alias("sha"), F.length("bytes").alias("n"))
    firsts = texts.groupBy("sha").agg(F.min("doc").alias("of"), F.min("tie").alias("of_tie")).withColumnRenamed("sha", "of_sha")
    copies = texts.join(firsts, F.col("sha") == F.col("of_sha")).where("doc != of").distinct()
    copy_runs = copies.select("doc", "tie", F.lit(0).cast("long").alias("first"), (F.col("n") - WIDTH).cast("long").alias("last"))
    marked = F.struct("gram", (F.col("n") > HOT).alias("hot"))
    wanted = shared.groupBy("doc", "tie").agg(F.collect_set(marked).alias("grams"))
    wanted = wanted.join(firsts.select(F.col("of").alias("doc"), F.col("of_tie").alias("tie")), ["doc", "tie"], "left_semi")
    subs = max(1, -(-(total["cold"] or 0) // (BUCKETS * SUFFIXES)))

    def spans(hot: bool) -> DataFrame:
        def of(batches):
            for pdf in batches:
                out = []
                for doc, tie, b, grams in zip(pdf["doc"], pdf["tie"], pdf["bytes"], pdf["grams"], strict=True):
                    gram, place, first, last = anchors(b)
                    own = np.searchsorted(cuts.value[1], gram)
                    for i in np.flatnonzero(np.isin(gram, grams)).tolist():
                        f, a = int(first[i]), int(place[i])
                        bucket = int(np.searchsorted(cuts.value[0], b[a : a + LEAD].ljust(LEAD, b"\0"), "right")) * subs + int(gram[i]) % subs
                        if own[i] < len(cuts.value[1]) and cuts.value[1][own[i]] == gram[i]:
                            bucket = -1 - int(own[i])
                        out.append((doc, tie, bucket, f, a - f, b[f : int(last[i]) + WIDTH]))
                if out:
                    yield pd.DataFrame(out, columns=["doc", "tie", "bucket", "first", "anchor", "span"])

        mine = F.transform(F.filter("grams", lambda g: g["hot"] == hot), lambda g: g["gram"])
        # With the id, which nothing here reads, the shuffle of texts is the same as that of the last join.
        rows = placed.join(wanted.withColumn("grams", mine).where(F.size("grams") > 0), ["doc", "tie"])
        return rows.select("doc", "tie", "bytes", "grams", "id").mapInPandas(of, "doc long, tie long, bucket long, first long, anchor int, span binary")

    # A common gram has a bucket of its own, cut out of the range that its bytes lie in.
    cuts = spark.sparkContext.broadcast((splitters(long, total["cold"] or 0), np.sort(np.array([r[0] for r in common.collect()], np.int64))))
    cold_runs = spans(False).groupBy("bucket").applyInPandas(_compare, RUN)
    runs = cold_runs.unionByName(copy_runs)
    if total["all"] != total["cold"]:  # else no gram is hot
        runs = runs.unionByName(hot_runs_of(spans(True)))
    runs = runs.groupBy("doc", "tie").agg(F.collect_list(F.struct("first", "last")).alias("runs"))

    @F.pandas_udf("struct<n_removed:long,n_spans:long,removed:array<array<int>>,kept:binary>")
    def cut(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        out = []
        for b, r in zip(texts, runs, strict=True):
            removed = union([] if r is None else [(x["first"], x["last"]) for x in r])
            kept, end = [], 0
            for start, stop in removed:
                kept.append(b[end:start])
                end = stop
            kept.append(b[end:])
            out.append((sum(y - x for x, y in removed), len(removed), [list(x) for x in removed], b"".join(kept)))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "removed", "kept"])

    joined = placed.join(runs, ["doc", "tie"], "left").withColumn("cut", cut("bytes", "runs"))
    return joined.select(F.col("id").alias(id_col), F.length("bytes").cast("long").alias("n_bytes"), "cut.n_removed", "cut.n_spans", "cut.removed", "cut.kept")
