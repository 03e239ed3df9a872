"""Stored distinct counts against counts over all rows."""

import random

from pyspark.sql import functions as F

from fieldmart.operators import bitmaps

KIND = "day int, cls string, id string"


def test_counts_of_stored_days_equal_the_direct_count(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.randrange(10), rng.choice("abc"), f"é{rng.randrange(90_000)}") for _ in range(20_000)] + [(3, "a", None), (3, None, "é1")] * 3
    path, stored = str(tmp_path / "n"), []
    for run in range(10):  # a day at a time, one of them twice
        mine = spark.createDataFrame([r for r in rows if r[0] == run], KIND)
        for _ in range(2 if run == 4 else 1):
            numbering = bitmaps.number_ids(spark, path, mine, "id", str(run))
        out = str(tmp_path / f"d{run}")
        bitmaps.day_bitmaps(mine, ["day", "cls"], "id", numbering).write.parquet(out)
        stored.append(out)
    numbers = [r["number"] for r in bitmaps.read_numbering(spark, path).collect()]
    assert sorted(numbers) == list(range(len({r[2] for r in rows if r[2]})))  # each id once, no gaps
    days = spark.read.parquet(*stored)
    assert days.select("bucket").distinct().count() > 0 and days.agg(F.max(F.length("bits"))).first()[0] == 4096
    for low, high in ((0, 10), (2, 5), (7, 8)):
        got = {r["cls"]: r["quantidade"] for r in bitmaps.united_counts(days.filter(f"day >= {low} AND day < {high}"), ["cls"]).collect()}
        expected = {}
        for day, cls, item in rows:
            if low <= day < high and item is not None:
                expected.setdefault(cls, set()).add(item)
        assert got == {k: len(v) for k, v in expected.items()}
    assert bitmaps.united_counts(days, []).first()["quantidade"] == len(numbers)


def test_nothing_to_number(spark, tmp_path):
    none = spark.createDataFrame([], KIND)
    numbering = bitmaps.number_ids(spark, str(tmp_path / "n"), none, "id", "x")
    assert numbering.count() == 0 and bitmaps.day_bitmaps(none, ["day"], "id", numbering).count() == 0
