"""Mixing sources to target weights by systematic sampling.

Each document of a source expects as many copies as the source's target has words
for each of its words. The expected copies are summed over the source's documents
in a fixed order (by size class, then by a hash of the id), one offset is added,
and the document is emitted once for each integer that its stretch of the sum
crosses. Ordering by size spreads every size evenly, so the words taken come
within about one document of the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import free_name, materialize, ranks


def numbered(sources: DataFrame, to: str) -> DataFrame:
    """Add `to`: the 0-based place of each source in code point order, null last.

    The sources, one row each, are range-partitioned and sorted within the partitions; the sizes of the
    partitions before, one number each, are added.
    """
    key = [F.col("source").isNull(), F.col("source")]
    part = materialize(sources.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("part", F.spark_partition_id()))
    within = F.row_number().over(W.Window.partitionBy("part").orderBy(*key)) - 1
    before, starts = 0, {}
    for r in part.groupBy("part").count().orderBy("part").collect():
        starts[r["part"]], before = before, before + r["count"]
    start = F.element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("part")) if starts else F.lit(0)
    return part.withColumn(to, within + start).drop("part")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), ratio: float = 1.5, cap: int = 2) -> DataFrame:
    """From rows (source, source_size), one a source, to (source, source_size, target).

    Sources in code point order, null last, take the weights in turn. The targets share
    `ratio` times all sizes by weight; none exceeds `cap` times its source's size, and
    what is over goes to the others by weight until none is above. Every round caps the
    sources that the open share lifts over their cap and shares out what these leave: sums
    over all sources, never their list, so there may be as many as hosts.
    """
    place = numbered(sizes, "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    t = materialize(place.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * cap).alias("full")))
    total = t.agg(F.sum("source_size")).first()[0] or 0
    share, capped = 0.0, -1
    while True:
        open_ = (F.col("weight") * F.lit(share) < F.col("full")) if capped >= 0 else F.lit(True)
        sums = t.agg(F.sum(F.when(~open_, F.col("full"))).alias("full"), F.sum(F.when(open_, F.col("weight"))).alias("weight"), F.count_if(~open_).alias("capped")).first()
        if sums["capped"] == capped or not sums["weight"]:
            break
        capped = sums["capped"]
        share = (total * ratio - (sums["full"] or 0)) / sums["weight"]
    shared = F.col("weight") * F.lit(share)
    return t.select("source", "source_size", F.when(shared < F.col("full"), shared).otherwise(F.col("full")).cast("double").alias("target"))


def systematic_mix(
    df: DataFrame, id_col: str, source: str, size: str, weights: tuple[int, ...] = (5, 2, 1), ratio: float = 1.5, cap: int = 2, seed: str = "mix"
) -> DataFrame:
    """Add `source_size` (long), `target` (double) and `copies` (int: times the mix takes the row).

    `size` is a row's words, null as 0. Rows of equal source, size class and id hash are
    interchangeable, repeated rows included; each has its own place in the sum. A source
    without words has target 0 and copies 0. Null is a source like any other. Reruns
    agree: order and offset depend on ids, sizes, sources and `seed` alone. An empty
    table gives an empty result; columns with the added names are replaced.
    """
    df = df.drop("source_size", "target", "copies")
    cls, cell, order, rank, key = (free_name(df, n) for n in ("size_class", "cell", "order", "rank", "source_key"))
    words = F.coalesce(F.col(size), F.lit(0)).cast("long")
    sizes = df.groupBy(F.col(source).alias("source")).agg(F.sum(words).alias("source_size"))
    targets = source_targets(sizes, weights, ratio, cap).withColumnsRenamed({"source": key})
    digits = words.cast("string")
    hashed = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    df = df.withColumns({
        cls: (-(F.length(digits) * 100 + F.substring(F.concat(digits, F.lit("0")), 1, 2).cast("int"))).cast("int"),
        cell: F.substring(hashed, 1, 2),
        order: hashed,
    })
    df = ranks(df, [source], [cls, cell], [F.col(order), words], rank)
    df = df.join(targets, F.col(source).eqNullSafe(F.col(key)), "inner")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(source), F.lit("")), F.lit(f":{seed}")).cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0
    sum_to = lambda k: F.floor(k.cast("double") * each + offset)
    copies = (sum_to(F.col(rank) + 1) - sum_to(F.col(rank))).cast("int")
    return df.withColumn("copies", copies).drop(cls, cell, order, rank, key)


def emit_copies(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Each row as often as `copies` says, without that column; a row whose count is null or below 1 is left out."""
    times = free_name(df, "times")
    more = F.explode(F.array_repeat(F.lit(0), F.col(copies))).alias(times)
    return df.select(*[F.col(c) for c in df.columns if c != copies], more).drop(times)
