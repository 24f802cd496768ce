"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

#: Words are runs of anything but ASCII white space.
SPACE = "[\\x20\\x09-\\x0D]+"
#: A key is hot if it holds more than this share of the rows: at most 4096 keys are.
HOT_SHARE = 1 / 4096
#: Rows that go to a Python worker at once while a table is written: texts may be long.
BATCH_ROWS, BATCH_CONF = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` once and read it from then on, so that lost executors cost no recomputation.

    The files go to the folder in spark.checkpoint.dir. Where that is unset, a local
    session gets a temporary folder; on a cluster, where executors share none, it is an error.
    Python workers get small batches meanwhile.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="cairn-checkpoint-"))
    conf = df.sparkSession.conf
    before = conf.get(BATCH_CONF)
    conf.set(BATCH_CONF, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        return df.checkpoint(eager=True)
    finally:
        conf.set(BATCH_CONF, before)


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once a row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def all_equal(pairs: list[tuple[str, str]]) -> Column:
    """Whether each pair of columns is equal; nulls are equal to one another."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in pairs])


def join_hot(df: DataFrame, side: DataFrame, keys: list[tuple[str, str]], rows: str, total: int) -> DataFrame:
    """Inner join of `df` with `side`, which has one row a key and in `rows` how many rows of `df` the key has, of `total` in all.

    Keys that hold more than HOT_SHARE of the rows are 4096 at most: they are broadcast, so
    their rows stay where they are. The rows of the others are shuffled.
    """
    bound = total * HOT_SHARE
    on = all_equal(keys)
    hot, rest = F.broadcast(side.where(F.col(rows) > bound)), side.where(F.col(rows) <= bound)
    return df.join(hot, on).unionByName(df.join(hot, on, "left_anti").join(rest, on))


def ranks(df: DataFrame, group: list[str], coarse: list[str], fine: list, name: str) -> DataFrame:
    """Add `name`: each row's 0-based rank in its `group`, ordered by `coarse`, then `fine`.

    A group may hold any share of the rows. Its rows are numbered within small
    (group, coarse) cells, each a window partition, and the rows of the cells before them
    are added, column by column of `coarse`: no window holds more than the distinct values
    of one of these columns. Null keys count as equal.
    """
    cell = [*group, *coarse]
    count, before = free_name(df, "cell_rows"), free_name(df, "cell_before")
    other = {c: free_name(df, f"other_{c}") for c in cell}
    right = df.groupBy(*[F.col(c).alias(other[c]) for c in cell]).agg(F.count("*").alias(count))
    within = [other[c] for c in group]
    offsets: DataFrame | None = None
    for c in coarse:
        level = right.groupBy(*within, other[c]).agg(F.sum(count).alias(count))
        order = W.Window.partitionBy(*within).orderBy(other[c]).rowsBetween(W.Window.unboundedPreceding, -1)
        level = level.select(*within, other[c], F.coalesce(F.sum(count).over(order), F.lit(0)).alias(before))
        if offsets is not None:
            above = {w: f"above_{w}" for w in within}
            outer = offsets.withColumnsRenamed(above | {before: "above"})
            level = level.join(outer, all_equal([(w, above[w]) for w in within])).withColumn(before, F.col(before) + F.col("above")).drop("above", *above.values())
        offsets, within = level, [*within, other[c]]
    numbered = df.withColumn(name, F.row_number().over(W.Window.partitionBy(*cell).orderBy(*fine)) - 1)
    joined = numbered.join(offsets, all_equal([(c, other[c]) for c in cell]), "inner")
    return joined.withColumn(name, (F.col(name) + F.col(before)).cast("long")).drop(before, *other.values())
