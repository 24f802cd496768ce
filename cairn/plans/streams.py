"""Streaming queries, drained over the events table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import text
from cairn.sources import sinks
from cairn.sources.tail import PART, TailSource
from cairn.streaming import cache, streams

from .catalogue import folder, query, table


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*").withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """What a stream leaves that ran until its source was read."""
    spark, path = stream.sparkSession, folder(stream.sparkSession, name)
    streams.drain(stream, path, folder(spark, "offsets"), mode)
    return spark.read.schema(stream.schema).parquet(path)


#: What the watermark of an hour has passed when the stream ends.
_CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@query(f"SELECT start, event_type, n FROM (SELECT time_bucket(INTERVAL 15 MINUTE, ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2) WHERE start + INTERVAL 15 MINUTE <= {_CLOSED}")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that a stream closed by the end of its source."""
    out = streams.tumbling(_events(spark, sf_dir), 15).select(F.col("window.start").alias("start"), "event_type", "n")
    return _drained(out, "windows")


@query(f"""
    SELECT user_id, start, n FROM (SELECT user_id, min(ts)::TIMESTAMP AS start, max(ts) AS last, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM
        (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s) WHERE last + INTERVAL 2 HOUR <= {_CLOSED}""")
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions that a stream closed by the end of its source."""
    out = streams.sessions(_events(spark, sf_dir), "2 hours").select("user_id", F.col("session_window.start").alias("start"), "n")
    return _drained(out, "sessions")


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger that an incremental merge of the events leaves: the first of each key."""
    path = folder(spark, "ledger")
    rows = _events(spark, sf_dir).select("user_id", "event_type", "event_id")
    streams.merge_stream(rows, path, ["user_id", "event_type"], ["event_id"], folder(spark, "offsets")).awaitTermination()
    return spark.read.parquet(path)


@query("SELECT event_type AS key, event_id AS item FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 5")
def stream_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A budget of five rows a key (the feature), kept over micro-batches; the first by number are admitted, as one batch brings them."""
    return _drained(streams.budget(_events(spark, sf_dir).select("event_type", "event_id"), "event_type", "event_id", 5), "admitted")


#: Micro-batches that a log is read in, about, and the least bytes of one: each holds its keys against the whole ledger, so their number must not grow with the log.
BATCHES, LEAST_BATCH = 16, 1 << 16


@query("SELECT event_id, event_type, user_id FROM events")
def tail_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger that a tail leaves of a growing file of JSON lines, in sixteen micro-batches or fewer of 64 KB or more: every other event, then, after another file took its place, the rest and some again."""
    spark.dataSource.register(TailSource)
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    logs, path, offsets = folder(spark, "log"), folder(spark, "ledger"), folder(spark, "offsets")
    local = text.local_path(logs)
    for keep in ("event_id % 2 = 0", "event_id % 2 = 1 OR event_id % 10 = 0"):
        events.where(keep).select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(f"{logs}/new")  # a log is one file
        sinks.put_in_place(spark, f"{logs}/new", f"{logs}/log.jsonl")
        batch = max(LEAST_BATCH, -(-os.path.getsize(f"{local}/log.jsonl") // BATCHES))
        source = spark.readStream.format("cairn_tail").option("path", f"{local}/log.jsonl").option("batchBytes", batch).option("partBytes", min(PART, batch // 4)).option("position", f"{local}/position.json").load()
        rows = source.select(F.from_json("line", "event_id long, event_type string, user_id long").alias("r")).select("r.*")
        following = streams.merge_stream(rows, path, ["event_id"], ["event_id"], offsets, batches=True)
        following.processAllAvailable()
        following.stop()
    return spark.read.parquet(path)


@query("""
    WITH o AS (SELECT event_id, least(2, epoch_ms(ts - lo) // 864000000) AS batch, event_type AS context, ts, CASE WHEN event_id % 3 = 0 THEN 'get' ELSE 'set' END AS op, (user_id % 20)::VARCHAR AS key, event_id::VARCHAR AS value,
        (event_id % 5 + 1) * 86400 AS ttl FROM events, (SELECT min(ts) AS lo FROM events))
    SELECT g.event_id AS id, g.context, g.key, arg_max_null(CASE WHEN epoch_ms(s.ts) + s.ttl * 1000 > epoch_ms(g.ts) THEN s.value END, (epoch_ms(s.ts), s.value)) AS value
    FROM o g LEFT JOIN o s ON g.context = s.context AND g.key = s.key AND s.op = 'set' AND s.batch <= g.batch WHERE g.op = 'get' GROUP BY ALL""")
def stream_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a cache by event type answers to every third event over three batches: entries live for one to five days, and null stands for none."""
    events = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    low = events.agg(F.min("at")).first()[0]
    rows = events.select(
        F.col("event_type").alias("context"), "at", F.when(F.col("event_id") % 3 == 0, "get").otherwise("set").alias("op"), F.col("event_id").alias("id"), (F.col("user_id") % 20).cast("string").alias("key"),
        F.col("event_id").cast("string").alias("value"), ((F.col("event_id") % 5 + 1) * 86_400).alias("ttl"), F.least(F.lit(2), F.floor((F.unix_millis("at") - F.unix_millis(F.lit(low))) / 864_000_000)).alias("batch"),
    )
    path = folder(spark, "asked")
    for k in range(3):
        rows.where(F.col("batch") == k).coalesce(1).write.mode("append").parquet(path)  # a file a batch
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path).withWatermark("at", "1 day")
    return _drained(cache.cached(stream), "answers")


@query("SELECT event_type, user_id % 10 AS part, count(DISTINCT event_id) AS n FROM events GROUP BY 1, 2")
def hourly_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that three rounds leave, the second broken off in each of its steps and run again; every round brings new files and some rows again."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("user_id") % 10).alias("part"))
    source, ledger, counts, offsets = (folder(spark, name) for name in ("source", "ledger", "counts", "offsets"))
    rows.limit(0).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)

    class Broken(Exception):
        pass

    for k in range(3):
        rows.where(f"event_id % 3 = {k} OR event_id % 50 = 0").write.mode("append").parquet(source)
        for at in ("ledger", "counting", "counted", None) if k == 1 else (None,):

            def step(name: str, at=at) -> None:
                if name == at:
                    raise Broken(name)

            try:
                streams.cycle(stream, ledger, ["event_id"], ["event_id"], counts, ["event_type", "part"], offsets, step)
            except Exception as e:
                if "Broken" not in repr(e) and "Broken" not in str(e):
                    raise
    return spark.read.parquet(counts).drop("batch")
