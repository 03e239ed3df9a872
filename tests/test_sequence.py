import datetime as dt
import random

import pytest

from fieldmart.operators.sequence import missing_dates, pair_sessions

START = dt.datetime(2025, 3, 1)


def walk(events):
    """Loop model: (user, ts, id, kind) to (user, start, stop)."""
    out = []
    for user in {e[0] for e in events}:
        mine = sorted((e for e in events if e[0] == user), key=lambda e: (e[1], e[2]))
        place = 0
        while place < len(mine):
            if mine[place][3] == "LOGIN":
                end = next((k for k in range(place + 1, len(mine)) if mine[k][3] == "LOGOUT"), None)
                out.append((user, mine[place][1], mine[end][1] if end is not None else None))
                place = place if end is None else end
            place += 1
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("minutes", [1, 60, 100_000])
def test_pairs_equal_the_loop(spark, rows, seed, minutes):
    rng = random.Random(seed)
    users = ["hot"] * 6 + ["b", "c", "d"]
    events = [(rng.choice(users), START + dt.timedelta(minutes=rng.randint(0, 300)), n,
               rng.choice(["LOGIN", "LOGIN", "LOGOUT", "VIEW"])) for n in range(150)]
    df = spark.createDataFrame(events, "who string, at timestamp_ntz, id int, what string")
    assert rows(pair_sessions(df, "who", "at", "what", "id", slice_minutes=minutes)) == walk(events)


def test_pair_rules(spark, rows):
    kinds = ["LOGOUT", "LOGIN", "LOGIN", "VIEW", "LOGOUT", "LOGIN", "LOGIN"]
    at = [START + dt.timedelta(hours=n) for n in range(len(kinds))]
    df = spark.createDataFrame([("u", at[n], n, k) for n, k in enumerate(kinds)],
                               "who string, at timestamp_ntz, id int, what string")
    assert rows(pair_sessions(df, "who", "at", "what", "id")) == sorted(
        [("u", at[1], at[4]), ("u", at[5], None), ("u", at[6], None)], key=repr)


def test_one_shuffle_of_the_events(spark):
    df = spark.createDataFrame([("u", START, 1, "LOGIN")], "who string, at timestamp_ntz, id int, what string")
    pairs = pair_sessions(df, "who", "at", "what", "id")
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1 and plan.count("REPARTITION_BY_COL") <= 2


@pytest.mark.parametrize("newest,expected", [
    ("2025-01-28", ["2025-01-29", "2025-01-30"]), ("2025-01-30", []), ("2025-02-15", []), (None, 29),
])
def test_missing_dates(spark, newest, expected):
    calendar = spark.createDataFrame([(dt.date.fromisoformat(newest),)] if newest else [], "Data date")
    got = [str(r[0]) for r in missing_dates(calendar, "Data", "2025-01-30").orderBy("Data").collect()]
    if isinstance(expected, int):
        assert len(got) == expected and got[0] == "2025-01-02"
    else:
        assert got == expected
