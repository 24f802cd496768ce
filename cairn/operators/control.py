"""Rules that steer a collection run: seeds, choices among fetched bodies, suspension, caches, budgets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import free_name, global_rank

#: Seconds of a ban after a failure, and the most a ban lasts by default.
BAN, MOST_BAN = 5, 120
#: What a second search adds to the name of a concept with few documents.
SECOND_PASS = ("百科", "介绍")


def first_good_tier(candidates: DataFrame, fetched: DataFrame, key: str = "id") -> DataFrame:
    """(key, url, sha256): the best tier of each candidate that was fetched and verified.

    `candidates` has (key, tiers), best first; `fetched` has (url, sha256, ok), one row an
    address. Candidates without a good tier give none.
    """
    tiers = candidates.select(key, F.posexplode("tiers").alias("at", "url")).where(F.col("url").rlike("^https?://"))
    good = fetched.where("ok").select("url", "sha256")
    best = tiers.join(good, "url").groupBy(key).agg(F.min_by(F.struct("url", "sha256"), "at").alias("best"))
    return best.select(key, "best.*")


def fallback_body(sources: list[tuple[str, Column]]) -> Column:
    """(body, label) of the first source whose text isn't blank; nulls where all are."""
    out = F.lit(None).cast("struct<body:string,label:string>")
    for label, text in reversed(sources):
        out = F.when(F.coalesce(F.trim(text), F.lit("")) != "", F.struct(text.alias("body"), F.lit(label).alias("label"))).otherwise(out)
    return out


def judged(pick: Column, candidates: Column) -> Column:
    """What a judge's pick means: `accepted` if it is a candidate whatever the case, `rejected` if null, `failed` (not to be kept) otherwise."""
    known = F.exists(candidates, lambda c: F.lower(c) == F.lower(pick))
    return F.when(pick.isNull(), "rejected").when(F.coalesce(known, F.lit(False)), "accepted").otherwise("failed")


def instance_seeds(concepts: DataFrame, cache: DataFrame) -> DataFrame:
    """(name, query, lang, judge): the name itself, and its Latin alias where the cache has one.

    `cache` has (name, alias), alias null for those judged and rejected; `judge` marks names
    that the cache lacks: not judged yet, which is neither accepted nor rejected.
    """
    known = cache.select("name", "alias", F.lit(True).alias("_seen"))
    joined = concepts.select("name").join(known, "name", "left")
    own = F.struct(F.col("name").alias("query"), F.lit("zh").alias("lang"))
    latin = F.when(F.col("alias").isNotNull(), F.struct(F.col("alias").alias("query"), F.lit("latin").alias("lang")))
    return joined.select("name", F.col("_seen").isNull().alias("judge"), F.explode(F.array_compact(F.array(own, latin))).alias("s")).select("name", "s.*", "judge")


def second_pass(coverage: DataFrame, least: int = 2, hint: int = 2) -> DataFrame:
    """Further searches (name, query, lang, top_n_hint) for concepts (name, n) with fewer than `least` documents."""
    words = F.explode(F.array(*map(F.lit, SECOND_PASS))).alias("_word")
    rows = coverage.where(F.coalesce("n", F.lit(0)) < least).select("name", words)
    return rows.select("name", F.concat_ws(" ", "name", "_word").alias("query"), F.lit("zh").alias("lang"), F.lit(hint).alias("top_n_hint"))


def planned_sources(picked: Column, known: tuple[str, ...], fallback: tuple[str, ...]) -> Column:
    """The picked sources that are known, in order, each once; the fallback where none is."""
    kept = F.array_intersect(F.coalesce(picked, F.array().cast("array<string>")), F.array(*map(F.lit, known)))
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(*map(F.lit, fallback)))


def branch_of(path: Column, depth: int = 2, sep: str = "/") -> Column:
    """The ancestor of a taxonomy path at most `depth` levels below the root."""
    return F.array_join(F.slice(F.split(path, sep), 1, depth + 1), sep)


def branch_samples(placed: DataFrame, name: str, branch: str, position: str, most: int = 12) -> DataFrame:
    """(branch, samples): the first names of each branch, after each name has gone to the branch of its first place.

    Each task keeps at most `most` names of a branch, so a branch may hold any share of the rows.
    """
    from .relational import first_wins, top_n_per_key

    once = first_wins(placed.select(name, branch, position), [name], [position])
    few = top_n_per_key(once, [branch], [position, name], most)
    rows = F.array_sort(F.collect_list(F.struct(position, name)))
    return few.groupBy(branch).agg(F.transform(rows, lambda r: r[name]).alias("samples"))


def rate_share(rate: Column, concurrency: Column, shards: Column) -> Column:
    """(rate, concurrency) of one of `shards` equal workers: at least 0.1 and 1."""
    return F.struct(F.greatest(F.lit(0.1), rate / shards).alias("rate"), F.greatest(F.lit(1), F.floor(concurrency / shards).cast("int")).alias("concurrency"))


def cleanup_eligible(blobs: DataFrame, now: Column, most: int, age: int = 86_400) -> DataFrame:
    """The blobs (sha256, published_at, verified, deleted) that may go: verified, older than `age` seconds, not deleted; the first `most` by digest."""
    old = now.cast("timestamp").cast("double") - F.col("published_at").cast("timestamp").cast("double") > age
    return blobs.where(F.col("verified") & ~F.col("deleted") & old).orderBy("sha256").limit(most)


def suspensions(events: DataFrame, engine: str, at: str, ok: str, ban: Column | None = None) -> DataFrame:
    """Where each engine stands after a log of calls: (engine, errors, until).

    `errors` counts the failures since the last success, `until` (epoch seconds) is the
    end of the ban that the last failure set, null where there are none. The log is only
    ever aggregated, so a busy engine costs no task more than another.
    """
    seconds = F.col(at).cast("timestamp").cast("double")
    length = F.least(F.lit(BAN), F.lit(MOST_BAN)) if ban is None else F.coalesce(ban, F.least(F.lit(BAN), F.lit(MOST_BAN)))
    calls = events.select(F.col(engine).alias("engine"), seconds.alias("_at"), F.col(ok).alias("_ok"), (seconds + length).alias("_until"))
    resumed = calls.groupBy("engine").agg(F.max(F.when(F.col("_ok"), F.col("_at"))).alias("_resumed"))
    failing = ~F.col("_ok") & (F.col("_resumed").isNull() | (F.col("_at") > F.col("_resumed")))
    joined = calls.join(resumed, "engine")
    return joined.groupBy("engine").agg(F.count_if(failing).alias("errors"), F.max_by(F.when(failing, F.col("_until")), F.when(failing, F.col("_at"))).alias("until"))


def live(cache: DataFrame, context: str, now: Column) -> DataFrame:
    """The entries (context, key, value, stored_at, expire_at) of a context that have not expired; of equal keys the last stored."""
    fresh = cache.where((F.col("context") == context) & (F.col("expire_at") > now))
    return fresh.groupBy("key").agg(F.max_by("value", F.struct("stored_at", "value")).alias("value"))


def retry_until_covered(collect: Callable[[DataFrame], None], coverage: Callable[[], DataFrame], wanted: DataFrame, passes: int) -> int:
    """Run `collect` on the concepts (name, quota) that `coverage()` (name, n) leaves short, at most `passes` times; the number of runs.

    Only a count reaches the driver between passes.
    """
    for done in range(passes):
        short = wanted.join(coverage(), "name", "left").where(F.coalesce("n", F.lit(0)) < F.col("quota")).select(*wanted.columns)
        if short.isEmpty():
            return done
        collect(short)
    return passes


def _drawn(key: str, seed: int) -> Column:
    """What decides a row's place for a seed: a digest that any engine gives alike."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed))))


def seeded_order(df: DataFrame, key: str, seed: int, to: str) -> DataFrame:
    """Add `to`: each row's place in an order that only key and seed decide."""
    drawn = free_name(df, "drawn")
    return global_rank(df.withColumn(drawn, _drawn(key, seed)), drawn, [key], to).drop(drawn)


def seeded_sample(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """The first n rows in that order; each task keeps n at most, and no row is ranked."""
    drawn = free_name(df, "drawn")
    return df.withColumn(drawn, _drawn(key, seed)).orderBy(drawn, key).limit(n).drop(drawn)
