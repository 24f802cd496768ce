"""Rules that follow each key's calls in the order of their time, however they come: timers in event time move the state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class InOrder(StatefulProcessor):
    """Hands the calls (at, flag) of a key to `call` in order of time.

    A call waits in its slot of event time until the watermark has passed the slot's end, or a time
    that `call` asked to be woken at; then a timer takes what is due. Of a busy key only one slot is ever held at once, and
    the state is one tuple. Calls behind the watermark are dropped, as Spark does.
    """

    #: The state's columns, what it is at first, and the columns of a row put out after the key and the time.
    STATE, FIRST, OUT = "", (), ()

    def __init__(self, slot: float):
        self.slot = max(1, int(slot * 1000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "slot long", "calls binary")
        self.state = handle.getValueState("state", self.STATE)

    def call(self, state: tuple, at: int, flag: bool, out: list) -> tuple:
        raise NotImplementedError

    def settle(self, state: tuple, now: int, out: list) -> tuple[tuple, int | None]:
        """What has become of the state by `now`, with no call since, and when it is to be looked at next."""
        return state, None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            calls = np.stack([pdf["at"].to_numpy(np.int64), pdf["flag"].to_numpy(np.int64)], axis=1)
            calls = calls[calls[:, 0] > mark]
            calls = calls[np.argsort(calls[:, 0] // self.slot, kind="stable")]
            slots, starts = np.unique(calls[:, 0] // self.slot, return_index=True)
            for slot, own in zip(slots.tolist(), np.split(calls, starts[1:]), strict=True):
                before = bytes(self.waiting.getValue((slot,))[0]) if self.waiting.containsKey((slot,)) else b""
                self.waiting.updateValue((slot,), (before + own.tobytes(),))
                if not before:
                    self.handle.registerTimer((slot + 1) * self.slot)
        return iter(())

    def _take(self, slot: int, now: int, state: tuple, out: list) -> tuple:
        """Apply the calls before `now` that wait in a slot."""
        if not self.waiting.containsKey((slot,)):
            return state
        calls = np.frombuffer(bytes(self.waiting.getValue((slot,))[0]), np.int64).reshape(-1, 2)
        due = calls[:, 0] < now
        for at, flag in calls[due][np.lexsort(calls[due].T[::-1])].tolist():
            state = self.call(state, at, bool(flag), out)
        if due.all():
            self.waiting.removeKey((slot,))
        else:
            self.waiting.updateValue((slot,), (calls[~due].tobytes(),))
        return state

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """Go on to the timer's time, and from there to each time that the state asks for, as far as the watermark is: Spark looks at timers set here only in the next batch."""
        now, mark, out = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs(), []
        state, slot = (self.state.get() if self.state.exists() else self.FIRST), (now - 1) // self.slot
        while True:
            for s in range(slot, (now - 1) // self.slot + 1):
                state = self._take(s, now, state, out)
            state, again = self.settle(state, now, out)
            if again is None or again > mark:
                break
            slot, now = (now - 1) // self.slot, again
        if again is not None:
            self.handle.registerTimer(again)
        self.state.update(state)
        if out:
            rows = pd.DataFrame(out, columns=["at", *self.OUT])
            rows.insert(0, "key", str(key[0]))
            yield rows

    def close(self) -> None:
        pass


class Suspension(InOrder):
    """A failure adds to the errors in a row and bans for a while from then on; a success ends both; a ban that nothing ends lapses by its timer."""

    STATE, FIRST, OUT = "errors long, until long", (0, 0), ("errors", "until", "event")

    def __init__(self, slot: float, ban: float):
        super().__init__(slot)
        self.ban = int(ban * 1000)

    def call(self, state, at, flag, out):
        (errors, until), _ = self.settle(state, at, out)
        errors, until = (0, 0) if flag else (errors + 1, at + self.ban)
        out.append((at, errors, until, "ok" if flag else "fail"))
        return errors, until

    def settle(self, state, now, out):
        errors, until = state
        if until and until < now:  # at its last moment a ban still holds
            out.append((until, errors, until, "over"))
            return (errors, 0), None
        return state, until + 1 if until else None


class Cooldown(InOrder):
    """Lets a flagged call act if the last that acted is longer ago than a while."""

    STATE, FIRST, OUT = "last long, acted boolean", (0, False), ()

    def __init__(self, slot: float, seconds: float):
        super().__init__(slot)
        self.seconds = seconds * 1000

    def call(self, state, at, flag, out):
        last, acted = state
        if not flag or (acted and at - last <= self.seconds):
            return state
        out.append((at,))
        return at, True


#: Timers need a state store with column families.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _followed(stream: DataFrame, key: str, at: str, flag: str, processor: InOrder, extra: str) -> DataFrame:
    for name, value in STORE.items():
        stream.sparkSession.conf.set(name, value)
    calls = stream.select(F.col(key).cast("string").alias("key"), F.col(at).alias("seen"), F.unix_millis(F.col(at)).alias("at"), F.coalesce(F.col(flag), F.lit(False)).alias("flag")).where("seen IS NOT NULL")
    return calls.groupBy("key").transformWithStateInPandas(processor, f"key string, at long{extra}", "append", "EventTime")


def suspension_log(stream: DataFrame, engine: str, at: str, ok: str, ban: float, slot: float = 60.0) -> DataFrame:
    """Rows (engine, at, errors, until, event): each call of a stream with a watermark on the time `at`, `ok` or `fail`, and `over` where a ban of `ban` seconds lapses.

    `errors` counts the failures in a row, `until` (null without a ban) is when the ban ends, in milliseconds. Of calls at one time failures
    come first. `slot` (seconds of event time) bounds the calls that are held at once.
    """
    out = _followed(stream, engine, at, ok, Suspension(slot, ban), ", errors long, until long, event string")
    return out.select(F.col("key").alias("engine"), F.timestamp_millis("at").alias("at"), "errors", F.timestamp_millis(F.nullif("until", F.lit(0))).alias("until"), "event")


def cooldown(stream: DataFrame, key: str, at: str, breach: str, seconds: float, slot: float = 60.0) -> DataFrame:
    """The breaches (key, at) of a stream with a watermark on `at` that set an action off: one only if the last action of the key is more than `seconds` ago."""
    return _followed(stream, key, at, breach, Cooldown(slot, seconds), "").select("key", F.timestamp_millis("at").alias("at"))
