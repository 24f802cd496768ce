"""Sharding by longest-processing-time scheduling (LPT).

Groups that must stay together, sorted by size, go to the least-loaded shard
through a heap. Groups of one size are interchangeable, so the heap runs over
the histogram of group sizes: sizes below EXACT have a class each, larger ones
share a class within STEP of each other. The histogram has at most
EXACT + log(2**63 / EXACT) / log(1 + STEP) rows however large the input is;
that alone reaches the driver.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, join_hot, materialize, ranks

EXACT, STEP = 1 << 16, 0.001
#: Rows or groups are numbered within cells of about so many.
CELL = 1 << 16


def place(loads: list[tuple[int, int]], size: int, count: int) -> list[int]:
    """How many of `count` groups of `size` each shard gets; `loads`, a heap of (load, shard), is updated.

    Every group goes to the shard that is least loaded at that moment, ties to the
    smaller shard. A long run of equal groups takes the `count` smallest values of
    load + i * size, so its bulk is found by bisection on the level they stay below.
    """
    n = len(loads)
    got = [0] * n
    if size <= 0:
        got[min(loads)[1]] = count
        return got
    if count > 4 * n:
        low, high = loads[0][0], max(x for x, _ in loads) + size * count
        below = lambda level: sum(-(-(level - x) // size) for x, _ in loads if level > x)
        while low < high:
            middle = (low + high + 1) // 2
            if below(middle) <= count:
                low = middle
            else:
                high = middle - 1
        for i, (x, shard) in enumerate(loads):
            got[shard] = max(0, -(-(low - x) // size))
            loads[i] = (x + got[shard] * size, shard)
        heapq.heapify(loads)
    for _ in range(count - sum(got)):
        x, shard = loads[0]
        got[shard] += 1
        heapq.heapreplace(loads, (x + size, shard))
    return got


def schedule(histogram: list[tuple[int, int, int]], n_shards: int) -> pd.DataFrame:
    """For each (class, groups, bytes), from the largest class down: `ends`, the rank in the class at which each shard's groups end."""
    loads = [(0, s) for s in range(n_shards)]
    rows = []
    for size_class, count, total in sorted(histogram, reverse=True):
        ends, at = [], 0
        for k in place(loads, max(1, round(total / count)), count):
            at += k
            ends.append(at)
        rows.append((size_class, ends))
    return pd.DataFrame(rows, columns=["size_class", "ends"])


def size_class(size: Column) -> Column:
    large = F.floor(F.log(size / F.lit(float(EXACT))) / math.log(1 + STEP)) + EXACT
    return F.when(size < EXACT, size).otherwise(large).cast("long")


def lpt_shards(df: DataFrame, group: str, size: str, n_shards: int, order: tuple[str, ...] = ()) -> DataFrame:
    """Add `shard` (int) and `slot` (long, gapless from 0 in each shard) to rows whose equal `group` values stay together.

    `size` is a row's non-negative load; null counts as 0. Null groups are one group.
    Repeated rows get slots of their own. An empty table gives an empty result. Columns
    already called shard or slot are replaced. A group larger than a fair share makes
    its shard that large: it must stay whole. Rows of a shard are numbered by a hash of
    `group` and `order`, then by these.
    """
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    gsize, cls, cell, rank, ends, rows = (free_name(df, n) for n in ("group_size", "size_class", "cell", "rank", "ends", "group_rows"))
    key, gkey = F.col(group), free_name(df, "group_key")
    groups = df.groupBy(key.alias(gkey)).agg(F.sum(F.coalesce(F.col(size), F.lit(0))).alias(gsize), F.count("*").alias(rows))
    groups = materialize(groups.withColumn(cls, size_class(F.col(gsize))))
    histogram = groups.groupBy(cls).agg(F.count("*"), F.sum(gsize), F.sum(rows)).collect()
    plan = schedule([tuple(r)[:3] for r in histogram], n_shards)
    plan = spark.createDataFrame(plan, f"{cls} long, {ends} array<long>") if len(plan) else spark.createDataFrame([], f"{cls} long, {ends} array<long>")
    in_cells = lambda n, *by: F.pmod(F.xxhash64(*by), F.lit(max(64, -(-n // CELL))))
    groups = groups.withColumn(cell, in_cells(sum(r[1] for r in histogram), gkey))
    placed = ranks(groups, [cls], [cell], [F.col(gkey)], rank).join(F.broadcast(plan), cls)
    shard = F.size(F.filter(F.col(ends), lambda e: e <= F.col(rank))).cast("int")
    placed = placed.select(F.col(gkey), F.col(rows), shard.alias("shard"))
    total = sum(r[3] for r in histogram)
    out = join_hot(df, placed, [(group, gkey)], rows, total).drop(gkey, rows)
    out = out.withColumn(cell, in_cells(-(-total // n_shards), group, *order))
    return ranks(out, ["shard"], [cell], [F.col(group), *[F.col(c) for c in order]], "slot").drop(cell)
