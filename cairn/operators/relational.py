"""Relational operators: deduplication, quotas, ranks, joins and reconciliation, as functions of DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def first_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key, by `order`. Unlike dropDuplicates the choice does not depend on partitioning.

    The row travels as one struct through a grouped minimum, so copies of a hot key are
    merged before the shuffle; a window would bring them all to one task.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [F.expr(o) if isinstance(o, str) else o for o in order]
    best = F.min(F.struct(*[o.alias(f"_{i}") for i, o in enumerate(ordered)], F.struct(*rest).alias("row"))).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, "best.row.*").select(*df.columns)


def top_n_per_key(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each key. Spark cuts each task's share to n rows a key before it shuffles (window group limit)."""
    rank, place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)), free_name(df, "place")
    return df.withColumn(place, rank).where(F.col(place) <= n).drop(place)


def append_new(existing: DataFrame, batch: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The rows that an idempotent sink appends: the first of each key in `batch` that `existing` lacks; null keys are refused."""
    known = batch.dropna(subset=keys)
    return first_wins(known, keys, order).join(existing.select(*keys).distinct(), keys, "left_anti")


def global_rank(df: DataFrame, order: str, ties: list[str], to: str, buckets: int = 64) -> DataFrame:
    """Add the 0-based rank of each row in the order of a column and `ties`, null first, without bringing all rows to one task.

    Keys of a sample, 64 a bucket, drawn in one pass over the keys, cut the rows into buckets by all of these columns, so rows of one
    common value are parted too; rows are numbered within each bucket, and the sizes of
    the buckets before it are added. Only those sizes are ordered as a whole.
    """
    keys = [order, *[t for t in ties if t != order]]
    kinds = {f.name: f.dataType for f in df.select(*keys).schema}
    sample = df.select(F.struct(*keys).alias("k")).orderBy(F.rand(7)).limit(64 * buckets).orderBy("k").collect()
    cuts = [sample[i * len(sample) // buckets]["k"] for i in range(1, buckets)] if len(sample) > 1 else []
    cuts, step = list(dict.fromkeys(cuts)), 8
    listed = lambda some: F.array(*[F.struct(*[F.lit(c[k]).cast(kinds[k]).alias(k) for k in keys]) for c in some])
    below = lambda some: F.size(F.filter(some, lambda c: c < F.struct(*keys)))
    bucket = F.lit(0)
    if cuts:  # every eighth cut tells which eight to look among
        runs = F.array(*[listed(cuts[i : i + step]) for i in range(0, len(cuts), step)])
        run = below(listed(cuts[step::step])) if len(cuts) > step else F.lit(0)
        bucket = run * step + below(F.get(runs, run))
    of, n, earlier, place = (free_name(df, x) for x in ("bucket", "bucket_rows", "bucket_before", "bucket_place"))
    df = df.withColumn(of, bucket)
    sizes = df.groupBy(of).agg(F.count("*").alias(n))
    before = Window.orderBy(of).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(of, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(earlier))
    within = F.row_number().over(Window.partitionBy(of).orderBy(*keys)) - 1
    ranked = df.withColumn(place, within).join(F.broadcast(offsets), of)  # at most `buckets` rows
    return ranked.withColumn(to, (F.col(place) + F.col(earlier)).cast("long")).drop(of, place, earlier)


def stride_shard(df: DataFrame, rank: str, shard: int, shards: int, offset: int = 0, limit: int | None = None, before: bool = False) -> DataFrame:
    """Every `shards`-th row from `shard` on, by a 0-based rank.

    With `before` the offset is taken before the stride, else after it; the limit comes last.
    """
    place = F.col(rank) - offset if before else F.col(rank)
    df = df.where((place >= 0) & (place % shards == shard))
    position = F.floor(place / shards)
    if not before and offset:
        df, position = df.where(position >= offset), position - offset
    return df if limit is None else df.where(position < limit)


def batches(df: DataFrame, rank: str, size: int, values: str) -> DataFrame:
    """(batch, items): runs of `size` rows by rank, their values in order; size <= 0 makes batches of one."""
    size = max(1, size)
    grouped = df.groupBy(F.floor(F.col(rank) / size).alias("batch")).agg(F.array_sort(F.collect_list(F.struct(rank, values))).alias("x"))
    return grouped.select("batch", F.transform("x", lambda v: v[values]).alias("items"))


def index_percentiles(df: DataFrame, value: str, ties: list[str], shares: dict[str, float]) -> DataFrame:
    """One row: for each name the value at 0-based position floor(n * share) of the sorted rows."""
    ranked = global_rank(df.where(F.col(value).isNotNull()), value, ties, "_r")
    n = ranked.count()
    at = {name: min(n - 1, int(n * p)) for name, p in shares.items()}
    return ranked.where(F.col("_r").isin(list(at.values()))).agg(*[F.max(F.when(F.col("_r") == r, F.col(value))).alias(name) for name, r in at.items()])


def decile(rank: Column, n: int) -> Column:
    """floor(10 * rank / n), at most 9; differs from ntile for uneven n."""
    return F.least(F.floor(rank * 10 / n), F.lit(9)).cast("int")


def reconcile(ledger: DataFrame, inventory: DataFrame, key: str, size: str, small: int, large: int) -> DataFrame:
    """(key, status) of a ledger against an inventory: missing, size_mismatch, small, large, orphan or ok, in that precedence."""
    a = ledger.select(key, F.col(size).alias("_told"), F.lit(True).alias("_a"))
    b = inventory.select(key, F.col(size).alias("_found"), F.lit(True).alias("_b"))
    status = (
        F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "orphan").when(F.col("_told") != F.col("_found"), "size_mismatch")
        .when(F.col("_found") < small, "small").when(F.col("_found") > large, "large").otherwise("ok")
    )
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def prefix_route(paths: DataFrame, path: str, nodes: list[tuple[str, str]]) -> DataFrame:
    """Add `node` and `target` of the longest node that is a prefix of the path or of which the path is a prefix.

    The node list is a registry, written into the plan: a CASE from the longest node down,
    so no join is needed however many paths there are.
    """
    out = F.lit(None).cast("struct<node:string,target:string>")
    for node, target in sorted(nodes, key=lambda x: (len(x[0]), x[0])):
        fits = F.col(path).startswith(node) | F.lit(node).startswith(F.col(path))
        out = F.when(fits, F.struct(F.lit(node).alias("node"), F.lit(target).alias("target"))).otherwise(out)
    route = free_name(paths, "route")
    return paths.withColumn(route, out).withColumns({"node": F.col(route)["node"], "target": F.col(route)["target"]}).drop(route)


def rank_best_then_quota(edges: DataFrame, key: str, item: str, priority: Column, tie: list[str], keep: list[str], quota: int) -> DataFrame:
    """One row for each (key, item), that of the best priority, ties by `tie`; then the first `quota` items of each key, by item."""
    best = edges.groupBy(key, item).agg(F.min_by(F.struct(*keep), F.struct(priority.alias("_p"), *tie)).alias("_b"))
    return top_n_per_key(best.select(key, item, "_b.*"), [key], [item], quota)


def group_to_list(edges: DataFrame, item: str, order: list[str], pair: Column, first: str, *more: Column) -> DataFrame:
    """(item, first, pairs, more): the pairs of an item joined with commas in order, the value `first` of its first row, and further aggregates."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(first).alias("_first"), pair.alias("_pair"))))
    grouped = edges.groupBy(item).agg(rows.alias("_rows"), *more)
    return grouped.select(item, F.col("_rows")[0]["_first"].alias(first), F.array_join(F.transform("_rows", lambda r: r["_pair"]), ",").alias("pairs"), *grouped.columns[2:])
