"""URL filters: host and path rules, then a list behind a blocked Bloom filter; built-in functions alone.

The filter is a table of blocks: eight 64-bit words, in each of which a listed URL
sets one bit. All bits of a URL lie in one block, so a probe is one join on the block
number. URLs whose bits are all set are possible hits; they alone go to the exact
hash join with the list, which removes the false positives.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, free_name, materialize

WORDS, WORD_BITS, BITS_A_URL = 8, 64, 16
#: Blocks have 80 bytes in a broadcast; a filter of at most so many is broadcast, a larger one joined by shuffle.
BROADCAST_BLOCKS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = "(?s)^.*?://([^/?#]*)([^?#]*)"
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def host_of(url: Column) -> Column:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for null."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def canonical(url: Column) -> Column:
    """Host without default port, path without closing slashes, query without tracking parameters and sorted; no scheme or fragment. Null without `://`."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^[^#?]*\\?([^#]*)", 1)
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    host = F.regexp_replace(host_of(url), ":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    text = F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(F.lit("")))
    return F.when(F.coalesce(url, F.lit("")).contains("://"), text)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null. A rule `h/p` fits h and its subdomains where the path starts with `/p`.

    Rules are a short list written into the query: the expression grows with them.
    """
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0] != "block")):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(slash + p)
        then = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, then) if out is None else out.when(fits, then)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _bit(url: Column, word: int) -> Column:
    """The bit that a URL sets in a word."""
    place = F.shiftright(F.xxhash64(url, F.lit("bits")), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def build_filter(listed: DataFrame, url: str, n_listed: int) -> tuple[DataFrame, int]:
    """The blocks (block, w0 … w7) for `n_listed` URLs, and their number."""
    blocks = max(1, math.ceil(n_listed * BITS_A_URL / (WORDS * WORD_BITS)))
    words = [F.bit_or(_bit(F.col(url), i)).alias(f"w{i}") for i in range(WORDS)]
    return listed.groupBy(_block(F.col(url), blocks).alias("block")).agg(*words), blocks


def _probed(df: DataFrame, blocks: DataFrame, n: int, hit: str) -> DataFrame:
    """Add `hit`: whether the filter of `n` blocks may hold the row's `canonical_url`."""
    block = free_name(df, "bloom_block")
    words = blocks.withColumnsRenamed({"block": f"{block}_"} | {f"w{i}": f"{block}_{i}" for i in range(WORDS)})
    out, every = df.withColumn(block, _block(F.col("canonical_url"), n)).join(words, F.col(block) == F.col(f"{block}_"), "left"), F.lit(True)
    for i in range(WORDS):
        bit = _bit(F.col("canonical_url"), i)
        every = every & (F.col(f"{block}_{i}").bitwiseAND(bit) == bit)
    return out.withColumn(hit, F.coalesce(every, F.lit(False)) & F.col("canonical_url").isNotNull()).drop(block, *words.columns)


def filter_urls(df: DataFrame, url: str, listed: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Add host, path, canonical_url, rule, listed (boolean) and verdict (allow or block).

    `listed` has one column, canonical URLs; nulls, repeats and an empty list are allowed.
    The verdict is the rule's where one fits, else block for listed URLs and allow for the
    rest. Possible hits are counted by address before they meet the list, so each address meets it
    once; listed addresses with many rows are broadcast, and only the rows of the others are shuffled. Where
    the filter is too large to broadcast, addresses are probed, not rows. Null URLs and those without `://` have empty host and path and are allowed. Rows
    repeat independently; an empty table gives an empty result; columns with the added
    names are replaced.
    """
    df = df.drop("host", "path", "canonical_url", "rule", "listed", "verdict")
    key = free_name(df, "listed_url")
    listed = materialize(listed.toDF(key).where(F.col(key).isNotNull()).distinct())
    blocks, n = build_filter(listed, key, listed.count())
    taken = df.select("*", host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), canonical(F.col(url)).alias("canonical_url"))
    found, hit, hot, known, rows = (free_name(taken, x) for x in ("bloom_rule", "bloom_hit", "hot_url", "known_url", "url_rows"))
    taken = taken.withColumn(found, rule_for(F.col("host"), F.col("path"), rules))
    small = n <= BROADCAST_BLOCKS
    taken = _probed(taken, F.broadcast(blocks), n, hit) if small else taken.withColumn(hit, F.col("canonical_url").isNotNull())

    urls = taken.where(hit).groupBy("canonical_url").agg(F.count("*").alias(rows))
    urls = urls if small else _probed(urls, blocks, n, hit).where(hit)
    exact = materialize(urls.join(listed, F.col("canonical_url") == F.col(key)).select(F.col(key).alias(known), rows))
    bound = (exact.agg(F.sum(rows)).first()[0] or 0) * HOT_SHARE
    heavy = F.broadcast(exact.where(F.col(rows) > bound).select(F.col(known).alias(hot)))  # 4096 at most
    light = exact.where(F.col(rows) <= bound).select(known)
    taken = taken.join(heavy, F.col("canonical_url") == F.col(hot), "left").withColumn(hot, F.col(hot).isNotNull())
    open_ = F.col(hit) & ~F.col(hot)
    checked = taken.where(open_).join(light, F.col("canonical_url") == F.col(known), "left").withColumn("listed", F.col(known).isNotNull()).drop(known)
    out = checked.unionByName(taken.where(~open_).withColumn("listed", F.col(hot)))
    verdict = F.coalesce(F.col(found)["verdict"], F.when(F.col("listed"), "block").otherwise("allow"))
    out = out.withColumns({"rule": F.col(found)["rule"], "verdict": verdict})
    return out.select(*df.columns, "host", "path", "canonical_url", "rule", "listed", "verdict")
