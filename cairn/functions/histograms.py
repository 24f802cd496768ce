"""Histograms of fixed width and size: states that merge, and what is read from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def bucket(value: Column, width: float, size: int) -> Column:
    """The bucket of a value: cut to a whole number of widths, at least 0, at most the last."""
    return F.greatest(F.lit(0), F.least(F.lit(size - 1), (value / width).cast("long"))).cast("int")


def histograms(df: DataFrame, keys: list[str], value: str, width: float, size: int) -> DataFrame:
    """(keys, bucket, n, total): how many values of each key fall in each bucket, and their sum. Null values are not observed.

    A key has `size` rows at most, however many values; partial states of parts of a table are the same table, put together.
    """
    seen = df.where(F.col(value).isNotNull())
    return seen.groupBy(*keys, bucket(F.col(value), width, size).alias("bucket")).agg(F.count("*").alias("n"), F.sum(F.col(value).cast("double")).alias("total"))


def merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """Partial states united, without the rows they came from."""
    return states.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def quantiles(states: DataFrame, keys: list[str], width: float, percents: dict[str, float]) -> DataFrame:
    """(keys, count, average, and each named percent): the lower bound of the first bucket up to which that share of the values lies."""
    order = Window.partitionBy(*keys).orderBy("bucket")  # a key's buckets, a bounded number
    whole = Window.partitionBy(*keys)
    cumulated = merged(states, keys).select("*", F.sum("n").over(order).alias("_up"), F.sum("n").over(whole).alias("_all"))
    reached = lambda p: F.min(F.when(F.col("_up") * 100 >= F.col("_all") * p, F.col("bucket"))) * width
    # below one value the first bucket reaches 0 percent, empty or not
    named = [(F.lit(0.0) if p <= 0 else reached(p)).cast("double").alias(name) for name, p in percents.items()]
    return cumulated.groupBy(*keys).agg(F.sum("n").alias("count"), (F.sum("total") / F.sum("n")).alias("average"), *named)


def shares(states: DataFrame, keys: list[str], width: float) -> DataFrame:
    """(keys, at, percent): the whole percents of the values in each bucket that has one or more, `at` its lower bound."""
    whole = Window.partitionBy(*keys)
    part = F.floor(F.col("n") * 100 / F.sum("n").over(whole)).cast("int")
    return merged(states, keys).select(*keys, (F.col("bucket") * width).cast("double").alias("at"), part.alias("percent")).where("percent > 0")
