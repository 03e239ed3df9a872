import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldmart.operators import aggregates, filters, joins, quality


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_first_per_key(spark, rows):
    df = frame(spark, "k string, o int, v string", ("a", 2, "x"), ("a", 1, "y"), ("b", 1, None), (None, 5, "n"))
    assert rows(joins.first_per_key(df, ["k"], ["o"])) == sorted(
        [("a", 1, "y"), ("b", 1, None), (None, 5, "n")], key=repr)


def test_first_per_key_combines_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS o")
    plan = joins.first_per_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_anti_join_keeps_batch_repeats(spark, rows):
    new = frame(spark, "a int, b string", (1, "x"), (1, "x"), (2, "y"), (None, "z"))
    known = frame(spark, "a int, b string", (2, "y"), (2, "y"), (None, "z"))
    assert rows(joins.anti_join(new, known, ["a", "b"])) == sorted([(1, "x"), (1, "x"), (None, "z")], key=repr)
    assert joins.anti_join(new, known, ["a", "b"], dedupe_batch=True).count() == 2


def test_null_safe_anti(spark, rows):
    new = frame(spark, "k string, v int", ("a", 1), (None, 2), ("b", 3))
    with_null, without = frame(spark, "k string", ("a",), (None,)), frame(spark, "k string", ("a",))
    assert rows(joins.null_safe_anti(new, with_null, "k")) == [("b", 3)]
    assert rows(joins.null_safe_anti(new, without, "k")) == sorted([("b", 3), (None, 2)], key=repr)


@pytest.mark.parametrize("small_left", [True, False])
def test_reconcile_outcomes(spark, small_left):
    left = frame(spark, "k string, l string", ("1", "A"), ("2", "A"), ("3", "A"), ("4", "A"), ("1", "B"))
    right = frame(spark, "k string, r string, o int", ("1", "A", 2), ("1", "Z", 3), ("2", "B", 1), ("3", None, 1), ("9", "A", 1))
    got = joins.reconcile(left, right, "k", "l", "r", ["o"], small_left)
    assert {(r["k"], r["l"]): (r["r"], r["outcome"]) for r in got.collect()} == {
        ("1", "A"): ("A", "equal"), ("1", "B"): ("A", "diverges"), ("2", "A"): ("B", "diverges"),
        ("3", "A"): (None, "diverges"), ("4", "A"): (None, "missing")}
    assert aggregates.outcome_counts(got, ["diverges", "missing"]).first() == (5, 3, 1)


def test_lookup_first(spark, rows):
    ids = frame(spark, "k string", ("1",), ("7",))
    data = frame(spark, "k string, o int", ("1", 5), ("1", 4), ("2", 1))
    found, absent = joins.lookup_first(ids, data, "k", ["o"])
    assert rows(found) == [("1", 4)] and rows(absent) == [("7",)]


def test_mark_keys_touches_all_rows_of_an_open_key(spark, rows):
    table = frame(spark, "k string, s string", ("a", "Open"), ("a", None), ("a", "Done"), ("b", None), ("c", "Open"), (None, "Open"))
    keys = frame(spark, "k string", ("a",), ("b",), (None,))
    assert rows(joins.mark_keys(table, keys, "k", "s", "Done")) == sorted(
        [("a", "Done")] * 3 + [("b", None), ("c", "Open"), (None, "Open")], key=repr)
    again = joins.mark_keys(joins.mark_keys(table, keys, "k", "s", "Done"), keys, "k", "s", "Done")
    assert rows(again) == rows(joins.mark_keys(table, keys, "k", "s", "Done"))


def test_upsert_and_insert_if_absent(spark, rows):
    target = frame(spark, "k int, a int, b string", (1, 10, "x"), (2, 20, "y"))
    source = frame(spark, "k int, a int", (2, 21), (3, 30))
    merged = joins.upsert(target, source, "k")
    assert rows(merged) == sorted([(1, 10, "x"), (2, 21, "y"), (3, 30, None)], key=repr)
    assert rows(joins.upsert(merged, source, "k")) == rows(merged)
    assert rows(joins.insert_if_absent(target, source, "k")) == [(3, 30)]


def test_replace_window_drops_days_without_new_rows(spark, rows):
    day = dt.date(2025, 1, 1)
    target = frame(spark, "d date, n int", *[(day + dt.timedelta(days=n), n) for n in range(4)])
    fresh = frame(spark, "d date, n int", (day + dt.timedelta(days=3), 99))
    got = joins.replace_window(target, fresh, "d", day + dt.timedelta(days=2))
    assert [r[1] for r in rows(got)] == [0, 1, 99]


def test_predicates_drop_nulls(spark):
    df = frame(spark, "s string, n int", ("a", 1), (None, 2), ("", 3), ("B", None))
    assert df.filter(filters.not_listed("s", ["a"])).count() == 2
    assert df.filter(filters.not_ignored("s", ["b"])).count() == 2
    assert df.filter(filters.filled("s", "n")).count() == 1
    high, low = filters.at_least(df, "n", 2)
    assert (high.count(), low.count()) == (2, 1)


def test_sets_and_columns(spark, rows):
    a, b = frame(spark, "x int, y int", (1, 2)), frame(spark, "x int, z int", (3, 4))
    assert rows(filters.union_all([a, b])) == sorted([(1, 2, None), (3, None, 4)], key=repr)
    assert filters.select_existing(a, ["y", "q"]).columns == ["y"]
    assert filters.drop_existing(a, ["y", "q"]).columns == ["x"]
    assert filters.union_distinct(a, a).count() == 1


def test_labelled_counts_with_hidden_key(spark, rows):
    df = frame(spark, "k string, d int, s string", ("a", 1, "o"), ("a", 2, "o"), ("a", 2, "c"), ("b", None, "o"))
    got = aggregates.labelled_counts(df, ["k"], {"open": F.col("s") == "o", "all": F.lit(True)}, {"open": F.col("d")})
    assert rows(got) == sorted([("a", "open", 1), ("a", "open", 1), ("a", "all", 3), ("b", "open", 1), ("b", "all", 1)], key=repr)


def test_distinct_counts_without_expand(spark):
    df = frame(spark, "i string, s string", ("1", "A"), ("1", "A"), ("2", "A"), (None, "A"), ("1", "B"), ("9", "C"))
    classes = {"a": F.col("s") == "A", "b": F.col("s") == "B", "none": F.col("s") == "Z"}
    counted = aggregates.distinct_counts(df, "i", classes)
    assert tuple(counted.first()) == (2, 1, 0)
    assert "Expand" not in counted._jdf.queryExecution().executedPlan().toString()
    assert tuple(aggregates.approx_distinct_counts(df, "i", classes).first()) == (2, 1, 0)


def test_top_counts_and_listing(spark, rows):
    df = frame(spark, "c string", ("b",), ("a",), ("b",), (None,), (None,), (None,), ("c",))
    assert [tuple(r) for r in aggregates.top_counts(df, "c", 2).collect()] == [("b", 2), ("a", 1)]
    ids = frame(spark, "i string", ("5",), ("12",), ("11",), ("12",), ("x",), ("007",), ("7",), ("1" * 40,), ("1" * 39 + "2",), ("0012",), (None,))
    assert rows(aggregates.id_listing(ids, "i", 1)) == [
        ("001?", "0012"), ("00?", "007"), ("1" * 39 + "?", f"{'1' * 40}, {'1' * 39}2"), ("1?", "11, 12"), ("?", "5, 7, x")]


def test_quality(spark, rows):
    pages = frame(spark, "page int, total_pages int, total int, data array<int>", (1, 4, 5, [1, 2]), (3, 4, 5, [3]), (3, 4, 5, [4]))
    assert rows(quality.missing_pages(pages)) == [(2,), (4,)]
    assert quality.row_total(pages).first() == (5, 4)
    with pytest.raises(quality.IncompleteData, match="missing pages"):
        quality.require_complete(pages, "feed")
    whole = frame(spark, "page int, total_pages int, total int, data array<int>", (1, 1, 2, [1]))
    assert quality.require_complete(whole, "feed").count() == 1
    with pytest.raises(quality.IncompleteData, match="1 of 2"):
        quality.require_complete(whole, "feed", strict_total=True)
    with pytest.raises(quality.IncompleteData):
        quality.require_rows(pages.filter("page > 9"), "feed")


def test_missing_pages_over_many_blocks(spark):
    pages = spark.range(1, 25_001).filter("id % 7 <> 0").selectExpr("id AS page", "25000 AS total_pages")
    assert quality.missing_pages(pages).count() == 25_000 // 7


def test_freshness(spark):
    df = frame(spark, "t string", ("2025-01-01",), ("2025-01-03",)).select(F.col("t").cast("timestamp").alias("t"))
    assert tuple(aggregates.freshness(df, "t", "2025-01-05").first()) == (dt.date(2025, 1, 3), 2, True)
    assert tuple(aggregates.freshness(df, "t", "2025-01-04").first())[1:] == (1, False)
