"""Structured Streaming: incremental merge, budgets, windows, alerts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from cairn.operators.relational import append_new
from cairn.sources.sinks import ledger_or_empty, recover_table, replace_table


def merge_stream(stream: DataFrame, path: str, keys: list[str], order: list[str], checkpoint: str, batches: bool = False):
    """Append each micro-batch's new keys to a Parquet ledger; starts the query.

    Keys are held against the ledger itself, so a lost checkpoint or a rotated file repeats nothing.
    The query ends with what its source has now; with `batches` it goes on, a micro-batch after the other as the source bounds them, until it is stopped.
    """

    def append(batch: DataFrame, _: int) -> None:
        existing = ledger_or_empty(batch, path)
        append_new(existing, batch, keys, order).write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(**({"processingTime": "0 seconds"} if batches else {"availableNow": True})).start()


def budget(stream: DataFrame, key: str, item: str, most: int) -> DataFrame:
    """The first `most` items of each key over the life of the stream: batch after batch, within a batch by number.

    The state of a key is how many it has had. Of a batch only the least `most` of a key
    are held, whatever it brings.
    """

    def admit(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (taken,) = state.get if state.exists else (0,)
        least = pd.Series([], dtype="int64")
        for pdf in batches:
            least = pd.concat([least, pdf[item].astype("int64")]).nsmallest(max(0, most - taken))
        state.update((taken + len(least),))
        yield pd.DataFrame({"key": [str(k[0])] * len(least), "item": least.to_numpy()})

    return stream.groupBy(key).applyInPandasWithState(admit, "key string, item long", "taken long", "append", GroupStateTimeout.NoTimeout)


def tumbling(events: DataFrame, minutes: int, late: str = "1 hour") -> DataFrame:
    """Rows and sums of each type in windows of event time; works on streams and tables."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", f"{minutes} minutes"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over all that its source has, into Parquet files."""
    stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stalls(samples: DataFrame, host: str, at: str, rows: str, restarts: str) -> DataFrame:
    """Samples with `stalled` (no growth since the last) and `restarted` (over 3 restarts more)."""
    w = Window.partitionBy(host).orderBy(at)
    return samples.withColumns({
        "stalled": F.coalesce(F.col(rows) - F.lag(rows).over(w) <= 0, F.lit(False)), "restarted": F.coalesce(F.col(restarts) - F.lag(restarts).over(w) > 3, F.lit(False)),
    })


def cycle(source: DataFrame, ledger: str, keys: list[str], order: list[str], table: str, by: list[str], offsets: str, step: Callable[[str], None] = lambda _: None) -> None:
    """One round of a recurring run: new rows of a source go to a ledger, new rows of the ledger into a table of counts by `by`; both streams take what there is and end.

    Each has its own offsets under `offsets`. The ledger takes a key once. The table keeps in `batch` the last batch that
    it has in it and is replaced as a whole, so a batch that is replayed changes nothing. A round
    that breaks off anywhere is made good by the next. `step` is called with the name of each step that is done.
    """
    spark = source.sparkSession
    merge_stream(source, ledger, keys, order, f"{offsets}/ledger").awaitTermination()
    step("ledger")

    def count(batch: DataFrame, n: int) -> None:
        recover_table(spark, table)
        new = batch.groupBy(*by).agg(F.count("*").alias("n"))
        old = ledger_or_empty(new.withColumn("batch", F.lit(n).cast("long")), table)
        if (old.agg(F.max("batch")).first()[0] if not old.isEmpty() else -1) >= n:
            return
        step("counting")
        replace_table(old.drop("batch").unionByName(new).groupBy(*by).agg(F.sum("n").alias("n")).withColumn("batch", F.lit(n).cast("long")), table)
        step("counted")

    rows = spark.readStream.schema(spark.read.parquet(ledger).schema).parquet(ledger)
    rows.writeStream.foreachBatch(count).option("checkpointLocation", f"{offsets}/table").trigger(availableNow=True).start().awaitTermination()
    step("table")


def memory_breach(committed: Column, total: Column, free_mb: Column) -> Column:
    """Whether a host is short of memory: over 1.2 of it promised, or under 500 MB free."""
    return F.coalesce((total > 0) & (committed / total > 1.2), F.lit(False)) | F.coalesce(free_mb < 500, F.lit(False))
