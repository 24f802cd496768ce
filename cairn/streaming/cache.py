"""A cache that a stream fills and asks: state by context, entries with a time to live."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .timers import STORE


#: Parts of a context's keys, each with a state of its own.
PARTS = 16


def packed(asked: pd.DataFrame) -> bytes:
    sink = io.BytesIO()
    asked.reset_index(drop=True).to_feather(sink)
    return sink.getvalue()


class ContextCache(StatefulProcessor):
    """The entries of a part of a context's keys. Of a batch all entries are stored before any is asked for; questions wait in the state meanwhile, packed as they came, not in memory. Timers sweep out what has lapsed.

    The state is asked once for each key of a bundle of rows, however many of them have it.
    """

    def __init__(self, sweep: float):
        self.sweep = max(1, int(sweep * 1000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entries = handle.getMapState("entries", "key string", "value string, stored long, expire long")
        self.asked = handle.getListState("asked", "questions binary")

    def entry(self, k: str) -> tuple | None:
        return self.entries.getValue((k,)) if self.entries.containsKey((k,)) else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for pdf in rows:
            sets = pdf[pdf["op"] == "set"].sort_values(["at", "value"], kind="stable").drop_duplicates("key", keep="last")
            wake = set()
            for k, value, at, expire in zip(sets["key"], sets["value"], sets["at"], sets["expire"], strict=True):
                old, new = self.entry(k), (value, int(at), int(expire))
                if old is None or (old[1], old[0]) <= (new[1], new[0]):
                    self.entries.updateValue((k,), new)
                    wake.add((new[2] // self.sweep + 1) * self.sweep)
            for at in wake:
                self.handle.registerTimer(at)
            gets = pdf.loc[pdf["op"] == "get", ["key", "id", "at"]]
            if len(gets):
                self.asked.appendValue((packed(gets),))
        for (bundle,) in self.asked.get() if self.asked.exists() else ():
            gets = pd.read_feather(io.BytesIO(bundle))
            found = {k: e for k in gets["key"].unique() if (e := self.entry(k)) is not None}
            expire = gets["key"].map({k: e[2] for k, e in found.items()})
            value = gets["key"].map({k: e[0] for k, e in found.items()}).astype(object)
            yield pd.DataFrame({"context": str(key[0]), "id": gets["id"], "key": gets["key"], "value": value.where(expire > gets["at"], None)})
        self.asked.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = expiredTimerInfo.getExpiryTimeInMs()
        for gone in [k for k, entry in self.entries.iterator() if entry[2] <= now]:
            self.entries.removeKey(gone)
        return iter(())

    def close(self) -> None:
        pass


def cached(stream: DataFrame, sweep: float = 3600.0) -> DataFrame:
    """The answers (context, id, key, value) to the questions in a stream (context, at, op, id, key, value, ttl) with a watermark on `at`; value null where the cache has none.

    `op` is `set`, which keeps a value for `ttl` seconds from `at` on, or `get`. A question gets what is stored up to the end of its
    batch unless that has lapsed at the question's time; of two entries of one key the later stands. Every `sweep` seconds of event time what has lapsed leaves the state.
    """
    for name, value in STORE.items():
        stream.sparkSession.conf.set(name, value)
    at = F.unix_millis("at")
    rows = stream.select("context", F.col("at").alias("seen"), at.alias("at"), "op", F.coalesce("id", F.lit(-1)).cast("long").alias("id"), "key", "value", (at + F.coalesce("ttl", F.lit(0)) * 1000).cast("long").alias("expire"))
    rows = rows.where("context IS NOT NULL AND key IS NOT NULL AND seen IS NOT NULL")
    part = F.pmod(F.xxhash64("key"), F.lit(PARTS)).cast("int")
    return rows.withColumn("part", part).groupBy("context", "part").transformWithStateInPandas(ContextCache(sweep), "context string, id long, key string, value string", "append", "EventTime")
