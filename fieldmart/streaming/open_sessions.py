"""Session pairs as they end, for users who cannot wait until the day is over.

The state of a user and day is the starts since the last stop, and the events that the watermark has not passed, since
an earlier one may still come. A timer at the newest of them takes them in order. Starts that no stop of their day
follows are given with a null stop when the day is over (a timer at its end). Events behind the watermark would change what was given already; they are not paired,
and come out as rows of their own, with ``late`` set, for a side output.

The users of a day are kept in buckets, by a hash, with the user in each row. Every call of the state goes from Python to
the store and back, so a bucket adds the events of a batch in one call, and reads and writes what it holds once for each timer.

Over all timers the pairs are those of ``operators.sequence.pair_sessions`` for each user and day. State is in the RocksDB
store, with checkpoints, so a restarted stream goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "user string, day date, started timestamp_ntz, stopped timestamp_ntz, late boolean"
DAY_MS = 86_400_000


def _processor(stop: str) -> StatefulProcessor:
    class Pairing(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.open = handle.getListState("open", "user string, at_us long")
            self.held = handle.getListState("held", "user string, at_us long, tie long, is_stop boolean")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            passed, newest, late = timerValues.getCurrentWatermarkInMs(), None, []
            for part in rows:
                held = []
                for user, at_us, tie, event in zip(*(part[c].tolist() for c in ("user", "at_us", "tie", "event")), strict=True):
                    if at_us // 1000 < passed:
                        late.append((user, None, at_us) if event == stop else (user, at_us, None))
                    else:
                        held.append((user, at_us, tie, event == stop))
                        newest = max(at_us, newest or 0)
                if held:
                    self.held.appendList(held)
            if newest is not None:  # no earlier event is to come once the watermark is behind it
                self.handle.registerTimer(newest // 1000 + 1)
                self.handle.registerTimer((key[0] + 1) * DAY_MS)
            if late:
                yield self.rows_of(key, late, True)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            until, over = expiredTimerInfo.getExpiryTimeInMs(), expiredTimerInfo.getExpiryTimeInMs() == (key[0] + 1) * DAY_MS
            held = {row[:3]: row[3] for row in map(tuple, self.held.get())}  # of events alike but for their kind the last counts
            due = sorted((k for k in held if k[1] // 1000 < until), key=lambda k: k[1:])
            if not (due or over):
                return
            waiting, found = {}, []
            for user, at_us in self.open.get():
                waiting.setdefault(user, []).append(at_us)
            for k in due:
                user, at_us, _ = k
                if not held.pop(k):
                    waiting.setdefault(user, []).append(at_us)
                elif user in waiting:
                    found.append((user, waiting.pop(user)[0], at_us))
            if over:
                found += [(user, at_us, None) for user, starts in waiting.items() for at_us in starts]
                waiting = {}
            self.store(self.held, [(*k, is_stop) for k, is_stop in held.items()])
            self.store(self.open, [(user, at_us) for user, starts in waiting.items() for at_us in starts])
            if found:
                yield self.rows_of(key, found, False)

        def store(self, state, rows) -> None:
            if rows:
                state.put(rows)
            else:
                state.clear()

        def rows_of(self, key, pairs, late) -> pd.DataFrame:
            started, stopped = (pd.Series([None if p[i] is None else pd.Timestamp(p[i], unit="us") for p in pairs], dtype="datetime64[us]") for i in (1, 2))
            day = (pd.Timestamp(0) + pd.Timedelta(days=key[0])).date()
            return pd.DataFrame({"user": [p[0] for p in pairs], "day": [day] * len(pairs), "started": started, "stopped": stopped, "late": late})

        def close(self) -> None:
            pass

    return Pairing()


def session_stream(events: DataFrame, user: str, ts: str, event: str, tie: str, delay: str = "1 hour",
                   start: str = "LOGIN", stop: str = "LOGOUT", buckets: int = 64) -> DataFrame:
    """``user, day, started, stopped, late`` of a stream of events, in append mode.

    ``tie`` is a whole number that tells events of one time and user apart. Events without a user, a time or a tie, and
    other events, are left out. ``late`` rows have the time of the event alone, under ``started`` or ``stopped``; split
    the stream by it. ``buckets`` is the number of groups of a day; one holds its users' waiting events in memory at a timer,
    and the number stays with a checkpoint. Sets the session's state store to RocksDB, which this operator needs.
    """
    events.sparkSession.conf.set(PROVIDER, ROCKSDB)
    rows = events.filter(F.col(event).isin(start, stop) & F.col(user).isNotNull() & F.col(tie).isNotNull())
    rows = rows.withColumn("_at", F.col(ts).cast("timestamp_ntz").cast("timestamp")).filter("_at IS NOT NULL").withWatermark("_at", delay)
    # Without the watermark's own column, late rows reach the operator, which sets them apart.
    rows = rows.select(F.col(user).cast("string").alias("user"), F.unix_date(F.col("_at").cast("date")).alias("day_no"),
                       F.unix_micros("_at").alias("at_us"), F.col(tie).cast("long").alias("tie"), F.col(event).alias("event"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("user"), F.lit(buckets)))
    return rows.groupBy("day_no", "bucket").transformWithStateInPandas(_processor(stop), OUT, "append", "eventTime")
