"""Figures of a run and what in them sets off an alert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shares of errors and of shells that set off an alert, and the calls from which an error rate counts.
ERROR_RATE, SHELL_RATE, LEAST_ATTEMPTS = 0.3, 0.4, 10


def failing(error_rate: Column, attempts: Column) -> Column:
    """Whether an engine's errors set off an alert."""
    return F.coalesce((error_rate > ERROR_RATE) & (attempts >= LEAST_ATTEMPTS), F.lit(False))


def patrol_stats(docs: DataFrame) -> DataFrame:
    """One row on documents (n_passages, n_images): how many, the share of shells, which have one passage or none, the mean of images, and whether the share sets off an alert."""
    shells = F.round(F.count_if(F.coalesce("n_passages", F.lit(0)) <= 1) / F.count("*"), 2)
    return docs.agg(F.count("*").alias("sampled"), shells.alias("shell_rate"), F.round(F.avg("n_images"), 1).alias("avg_images")).withColumn("alert", F.coalesce(F.col("shell_rate") > SHELL_RATE, F.lit(False)))


def trend(lives: DataFrame) -> DataFrame:
    """The row that a run adds to the trend of its sources (see `gates.source_lives`)."""
    return lives.agg(
        F.count("*").alias("enabled"), F.count_if(F.col("w24") > 0).alias("effective_24h"), F.count_if(F.col("w1") > 0).alias("effective_1h"), F.count_if(F.col("rows") == 0).cast("int").alias("dead_candidates")
    )
