"""Pairs that are given as sessions end, against the daily report."""

import datetime as dt
import random
from types import SimpleNamespace

import pandas as pd
import pytest

from fieldmart.operators.sequence import pair_sessions
from fieldmart.streaming import open_sessions

START = dt.datetime(2025, 3, 1)
EVENT = "who string, at timestamp_ntz, id long, what string"


def events():
    rng = random.Random(8)
    return [(rng.choice(["hot", "hot", "a", "b"]), START + dt.timedelta(minutes=11 * n), n, rng.choice(["LOGIN", "LOGIN", "LOGOUT", "VIEW"])) for n in range(260)]


@pytest.fixture
def store(spark):
    yield spark
    spark.conf.unset(open_sessions.PROVIDER)


def run(spark, folder, out, checkpoint):
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(folder)
    found = open_sessions.session_stream(stream, "who", "at", "what", "id")
    query = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def test_pairs_equal_the_daily_report(store, tmp_path, rows):
    """In batches that overlap in time, with a restart between them, an event far behind, and days that end."""
    spark, folder, out, checkpoint = store, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")
    every = events()
    parts = [every[n * 65:(n + 1) * 65] for n in range(4)]
    for n in range(3):  # neighbours within the delay change places
        parts[n][-2:], parts[n + 1][:2] = parts[n + 1][:2], parts[n][-2:]
    parts[2].append(("hot", START + dt.timedelta(minutes=1), 999, "LOGOUT"))  # a day late
    for n, part in enumerate(parts[:2]):
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(folder)
    run(spark, folder, out, checkpoint)
    early = rows(spark.read.parquet(out))
    for part in [*parts[2:], [("z", START + dt.timedelta(days=9), 1000, "VIEW"), ("z", START + dt.timedelta(days=9), 1001, "LOGIN")]]:
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(folder)
        run(spark, folder, out, checkpoint)  # a restart for each
    run(spark, folder, out, checkpoint)
    found = spark.read.parquet(out)
    assert early and set(early) <= set(rows(found))
    expected = []
    for day in sorted({e[1].date() for e in every}):
        mine = spark.createDataFrame([e for e in every if e[1].date() == day], EVENT)
        expected += [(r[0], day, r[1], r[2]) for r in rows(pair_sessions(mine, "who", "at", "what", "id"))]
    assert any(e[3] is None for e in expected)
    assert rows(found.filter("NOT late").drop("late")) == sorted(expected, key=repr)
    late = found.filter("late").collect()
    assert [(r["user"], r["started"], r["stopped"]) for r in late] == [("hot", None, START + dt.timedelta(minutes=1))]


class Store:
    """A list state that counts its calls."""

    def __init__(self):
        self.rows, self.calls, self.timers = [], 0, set()

    def getListState(self, name, schema):
        return self.__dict__.setdefault(name, Store())

    def registerTimer(self, at):
        self.timers.add(at)

    def get(self):
        self.calls += 1
        return iter(self.rows)

    def appendList(self, rows):
        self.put(self.rows + rows)

    def put(self, rows):
        self.calls, self.rows = self.calls + 1, list(rows)

    def clear(self):
        self.put([])


def test_calls_of_the_store_do_not_grow_with_the_users():
    def calls(users):
        handle, pairing = Store(), open_sessions._processor("LOGOUT")
        pairing.init(handle)
        batch = [(f"u{n}", minute * 60_000_000 + n, n, event) for n in range(users) for minute, event in ((1, "LOGIN"), (5, "LOGIN"), (9, "LOGOUT"), (12, "LOGIN"))]
        clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
        out = list(pairing.handleInputRows((0, 3), iter([pd.DataFrame(batch, columns=["user", "at_us", "tie", "event"])]), clock))
        for at in sorted(handle.timers):
            out += pairing.handleExpiredTimer((0, 3), clock, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at))
        found = pd.concat(out)
        assert (len(found), found["stopped"].isna().sum(), found["user"].nunique(), found["late"].any()) == (2 * users, users, users, False)
        assert not (handle.open.rows or handle.held.rows)
        return handle.open.calls + handle.held.calls

    assert calls(1) == calls(400)
