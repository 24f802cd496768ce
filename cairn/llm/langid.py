"""Language identification by Bayesian evidence fusion.

Evidence on a row: its text, as likelihoods of hashed byte 4-grams; the language that
its markup declares, as a likelihood that the declarations of the corpus show; and a
prior for its host. Host priors are smoothed along a chain: all rows, the address
suffix, the host. Each level counts the text-only posteriors of its rows by a grouped
aggregation over all rows and takes its parent's distribution as pseudo-counts. One more
class, `und`, has a uniform likelihood: what fits no language better goes there.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, free_name, materialize

GRAM, BUCKETS, NONE = 4, 1 << 16, "und"
#: Of each label so many rows, or all, are sampled at least.
LEAST_ROWS = 100
#: Characters that are scored at once; a text longer than that is cut into pieces that overlap by a gram.
CHUNK = 1 << 20
#: ASCII bytes but letters count as spaces.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
BLANK = int.from_bytes(b" " * GRAM)
#: A broadcast of host priors has at most so many rows; beyond it the priors are joined by shuffle.
BROADCAST_HOSTS = 20_000


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte 4-gram of the lower-cased texts, each framed by spaces, and the grams of each text; blank grams are left out."""
    raw = [b" " + t.lower().encode("utf-8", "surrogatepass").translate(LETTERS) + b" " * (GRAM - 1) if t else b"" for t in texts]
    lengths = np.array([len(b) for b in raw], np.int64)
    b = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    if len(b) < GRAM:
        return np.zeros(0, np.uint16), np.zeros(len(texts), np.int64)
    words = b[:-3].copy()
    for k in range(1, GRAM):
        words |= b[k : len(b) - 3 + k] << np.uint32(8 * k)
    blank = words == BLANK
    words *= np.uint32(2654435761)
    words >>= np.uint32(16)
    buckets = words.astype(np.uint16)
    ends = np.cumsum(lengths)
    inside = np.ones(len(b), bool)
    for back in range(1, GRAM):
        inside[ends[lengths >= back] - back] = False
    inside = inside[: len(buckets)] & ~blank
    before = np.concatenate([[0], np.cumsum(inside), [inside.sum()] * (GRAM - 1)])
    return buckets[inside], before[ends] - before[ends - lengths]


def chunks(texts: pd.Series):
    """Slices of the series of about CHUNK characters each."""
    start, size = 0, 0
    values = texts.tolist()
    for i, t in enumerate(values):
        size += len(t or "")
        if size >= CHUNK:
            yield values[start : i + 1]
            start, size = i + 1, 0
    yield values[start:]


def shares(found: dict[str, int], max_rows: int) -> dict[str, float]:
    """The share of each label's rows to sample: `max_rows` dealt evenly, what small labels leave going to others, but LEAST_ROWS or all of a label's rows at least."""
    out, left = {}, max_rows
    for i, (name, n) in enumerate(sorted(found.items(), key=lambda x: (x[1], x[0]))):
        quota = min(n, max(LEAST_ROWS, left // (len(found) - i)))
        out[name], left = quota / n, max(0, left - quota)
    return out


def train(df: DataFrame, text: str, label: str, max_rows: int) -> tuple[list[str], np.ndarray]:
    """(languages, log likelihood of each bucket in each, a row a language) of every label, from about `max_rows` labelled rows, sampled by label.

    A row of BUCKETS floats for each label reaches the driver.
    """
    df = df.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    found = {r[0]: r["count"] for r in df.groupBy(label).count().collect()}
    names = sorted(found)
    if not names:
        return [], np.zeros((0, BUCKETS), np.float32)
    sample = df.select(F.col(text).alias("text"), F.col(label).alias("label")).sampleBy("label", shares(found, max_rows), seed=5)

    def count(batches):
        totals = {}
        for pdf in batches:
            for name, part in pdf.groupby("label")["text"]:
                for texts in chunks(part):
                    totals[name] = totals.get(name, 0) + np.bincount(grams(texts)[0], minlength=BUCKETS)
        for name, n in totals.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"label": name, "bucket": at.astype(np.int32), "n": n[at]})

    def logs(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.full(BUCKETS, 0.1)
        counts[pdf["bucket"]] += pdf["n"]
        return pd.DataFrame({"label": pdf["label"].iloc[:1], "logs": [np.log(counts / counts.sum()).astype(np.float32).tobytes()]})

    counted = sample.mapInPandas(count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    fitted = {r["label"]: np.frombuffer(r["logs"], np.float32) for r in counted.groupBy("label").applyInPandas(logs, "label string, logs binary").collect()}
    none = np.full(BUCKETS, -np.log(BUCKETS), np.float32)  # a label whose texts have no grams
    return names, np.stack([fitted.get(name, none) for name in names])


def text_scores(text: Column, table: np.ndarray, weight: int, spark) -> Column:
    """Log likelihood of the text in each language and in `und`: the mean over its grams, times at most `weight`; null without letters.

    Grams overlap and repeat, so a text counts as `weight` independent ones at most.
    """
    shared = spark.sparkContext.broadcast(np.vstack([table, np.full(BUCKETS, -np.log(BUCKETS), np.float32)]))

    @F.pandas_udf("array<float>")
    def score(texts: pd.Series) -> pd.Series:
        out = []
        for values in chunks(texts):
            buckets, sizes = grams(values)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            sums = np.zeros((len(values), len(shared.value)))
            full = np.flatnonzero(sizes)
            if len(full):
                for k in range(sums.shape[1]):
                    sums[full, k] = np.add.reduceat(shared.value[k][buckets].astype(np.float64), starts[full])
            sums *= (np.minimum(sizes, weight) / np.maximum(sizes, 1))[:, None]
            out += [s.astype(np.float32) if t and any(map(str.isalpha, t)) else None for s, t in zip(sums, values, strict=True)]
        return pd.Series(out, dtype=object)

    return score(text)


def softmax(logs: Column) -> Column:
    shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, y: a + y))


def smoothed(rows: DataFrame, key: str, parent: str, n: int, strength: float, to: str) -> DataFrame:
    """(key_of, rows_of, `to`): the distribution of `p` among the rows of each key, with `strength` pseudo-counts of its parent's distribution, and how many rows the key has."""
    sums = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key_of")).agg(F.first(parent).alias("above"), F.count("*").alias("rows_of"), *[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(n)])
    mixed = [(F.col(f"s{i}") + strength * F.col("above")[i]) / (F.col("rows_of") + strength) for i in range(n)]
    return sums.select("key_of", "rows_of", F.array(*mixed).alias(to))


def identify(
    df: DataFrame, text: str, labelled: DataFrame, label: str, host: Column | None = None, suffix: Column | None = None, declared: Column | None = None,
    labelled_text: str = "text", max_rows: int = 20_000, weight: int = 24, strength: float = 50.0, min_confidence: float = 0.5, keep_text: bool = True,
) -> DataFrame:
    """Add `language`, `confidence` (its posterior) and `accepted`; every column of `df` stays, the text only if `keep_text`.

    `labelled` has texts with a known language (`label`, null: unknown): the text model is
    fitted on every label, on about `max_rows` of its rows, sampled by label. host, suffix and declared are columns
    over `df`; null is no evidence. Null and empty texts and texts without a letter have
    no text evidence: language null, confidence 0, not accepted. Otherwise a row is
    accepted if its language isn't `und` and the confidence is `min_confidence` or more.
    Without labelled rows nothing is accepted. Repeated rows count each; an empty table
    gives an empty result; columns with the added names are replaced.

    Texts are scored once: what they show is written beside the row, and all that follows
    reads that. A caller that can do without the text saves writing it.
    """
    df = df.drop("language", "confidence", "accepted")
    rest = [c for c in df.columns if keep_text or c != text]
    names, table = train(labelled, labelled_text, label, max_rows)
    if not names:
        return df.select(*rest).withColumns({"language": F.lit(None).cast("string"), "confidence": F.lit(0.0), "accepted": F.lit(False)})
    names, n, spark = [*names, NONE], len(names) + 1, df.sparkSession
    none = F.lit(None).cast("string")
    evidence, h, s, d, post, prior, above, told = (
        free_name(df, x) for x in ("text_evidence", "host_key", "suffix_key", "declared_key", "text_posterior", "host_prior", "suffix_prior", "declared_log")
    )
    scored = df.withColumns({
        evidence: text_scores(F.col(text), table, weight, spark).cast("array<double>"),
        h: none if host is None else host.cast("string"),
        s: none if suffix is None else suffix.cast("string"),
        d: none if declared is None else declared.cast("string"),
    })
    scored = materialize(scored.select(*rest, evidence, h, s, d))
    # The narrow table: what every row shows.
    shown = scored.select(F.col(h).alias("host"), F.col(s).alias("suffix"), F.col(d).alias("declared"), softmax(F.col(evidence)).alias("p")).where("p is not null")
    total = shown.agg(F.count("*").alias("n"), *[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(n)]).first()
    root = F.array(*[F.lit((total[f"s{i}"] or 0.0) / max(1, total["n"]) * 0.99 + 0.01 / n) for i in range(n)])
    by_suffix = materialize(smoothed(shown.withColumn("root", root), "suffix", "root", n, strength, above))
    rows = attach(shown, by_suffix, "suffix", [above], total["n"])
    by_host = materialize(smoothed(rows.withColumn("parent", F.coalesce(above, root)), "host", "parent", n, strength, prior))
    # What a page declares, given its language: smoothed shares of the declarations.
    said = shown.where("declared is not null").groupBy(F.col("declared").alias("key_of")).agg(F.count("*").alias("rows_of"), *[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(n)])
    said = said.select("key_of", "rows_of", F.array(*[F.log((F.col(f"s{i}") + 0.5) / F.lit((total[f"s{i}"] or 0.0) + 1.0)) for i in range(n)]).alias(told))
    out = attach(scored, by_suffix, s, [above], total["n"])
    out = attach(attach(out, by_host, h, [prior], total["n"]), materialize(said), d, [told], total["n"])
    fused = F.transform(
        F.arrays_zip(F.col(evidence).alias("t"), F.coalesce(prior, above, root).alias("r"), F.coalesce(told, F.array_repeat(F.lit(0.0), n)).alias("d")),
        lambda x: x["t"] + F.log(x["r"]) + x["d"],
    )
    out = out.withColumn(post, F.when(F.col(evidence).isNotNull(), fused)).withColumn(post, softmax(F.col(post)))
    best = F.array_max(F.col(post))
    language = F.element_at(F.array(*map(F.lit, names)), F.array_position(F.col(post), best).cast("int"))
    out = out.withColumns({"language": F.when(best.isNotNull(), language), "confidence": F.coalesce(best, F.lit(0.0))})
    accepted = F.coalesce((F.col("language") != NONE) & (F.col("confidence") >= min_confidence), F.lit(False))
    return out.withColumn("accepted", accepted).select(*rest, "language", "confidence", "accepted")


def attach(rows: DataFrame, side: DataFrame, key: str, columns: list[str], total: int) -> DataFrame:
    """Left join with one row a key (key_of, rows_of, columns): by broadcast where the side is small, counted first.

    Of a larger side the hot keys, 4096 at most, are broadcast, so the rows of a hot host
    stay where they are, as do those without a key; the rows of other keys are shuffled.
    """
    of = free_name(rows, "key_of")
    on = F.col(key) == F.col(of)
    side = side.withColumnRenamed("key_of", of)
    if side.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS:
        return rows.join(F.broadcast(side.drop("rows_of")), on, "left").drop(of)
    bound = total * HOT_SHARE
    hot, rest = side.where(F.col("rows_of") > bound).drop("rows_of"), side.where(F.col("rows_of") <= bound).drop("rows_of")
    first = rows.join(F.broadcast(hot), on, "left")
    still = first.where(F.col(of).isNull() & F.col(key).isNotNull()).drop(of, *columns).join(rest, on, "left")
    return first.where(F.col(of).isNotNull() | F.col(key).isNull()).unionByName(still).drop(of)
