"""Several micro-batches give what one batch gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldmart.operators import joins
from fieldmart.operators.sequence import pair_sessions
from fieldmart.plans.reconciliation import compare_status, document_orders
from fieldmart.sources import schemas
from fieldmart.streaming import created, once, reconciliation, sessions

START = dt.datetime(2025, 3, 1)
EVENT = "who string, at timestamp_ntz, id long, what string"


@pytest.fixture(scope="module")
def events():
    rng = random.Random(5)
    return [(rng.choice(["hot", "hot", "a", "b"]), START + dt.timedelta(minutes=17 * n), n,
             rng.choice(["LOGIN", "LOGOUT", "VIEW"])) for n in range(400)]


def stream_of(spark, folder, rows, schema, parts=4):
    """A file stream that takes the rows in ``parts`` micro-batches."""
    size = -(-len(rows) // parts)
    for n in range(parts):
        spark.createDataFrame(rows[n * size:(n + 1) * size], schema).coalesce(1).write.mode("append").parquet(folder)
    loaded = spark.read.parquet(folder).schema
    return spark.readStream.schema(loaded).option("maxFilesPerTrigger", 1).parquet(folder)


def run(writer, checkpoint):
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_sessions_equal_the_daily_report(spark, tmp_path, rows, events):
    stream = stream_of(spark, str(tmp_path / "in"), events, EVENT)
    inbox, report = str(tmp_path / "inbox"), str(tmp_path / "report")
    sink = sessions.session_sink(inbox, report, "who", "at", "what", "id")
    run(stream.writeStream.foreachBatch(sink), str(tmp_path / "c"))
    got = spark.read.parquet(report)
    assert got.select("batch_no").distinct().count() > 1
    days = sorted({e[1].date() for e in events})[:-1]
    expected = []
    for day in days:
        mine = spark.createDataFrame([e for e in events if e[1].date() == day], EVENT)
        expected += [(r[0], day, r[1], r[2]) for r in rows(pair_sessions(mine, "who", "at", "what", "id"))]
    assert rows(got.select("user", "day", "started", "stopped")) == sorted(expected, key=repr)


def test_repeated_session_batch_changes_nothing(spark, tmp_path, rows, events):
    inbox, report = str(tmp_path / "inbox"), str(tmp_path / "report")
    sink = sessions.session_sink(inbox, report, "who", "at", "what", "id")
    halves = [spark.createDataFrame(part, EVENT) for part in (events[:200], events[200:])]
    sink(halves[0], 0)
    sink(halves[1], 1)
    first = rows(spark.read.parquet(report))
    sink(halves[1], 1)
    assert rows(spark.read.parquet(report)) == first


def test_alert_once(spark, tmp_path, rows):
    keys = [("a", 1), ("b", 2), ("a", 1), ("c", 3), ("b", 2), ("b", 3), ("a", 1), ("c", 3)]
    stream = stream_of(spark, str(tmp_path / "in"), keys, "k string, n int")
    ledger = str(tmp_path / "ledger")
    run(stream.writeStream.foreachBatch(once.once_sink(ledger, ["k", "n"])), str(tmp_path / "c"))
    schema = spark.createDataFrame([], "k string, n int").schema
    assert rows(once.read_ledger(spark, ledger, schema)) == sorted(set(keys), key=repr)
    again = spark.createDataFrame(keys, "k string, n int")
    for _ in range(2):
        once.once_sink(ledger, ["k", "n"])(again.union(spark.createDataFrame([("z", 9)], "k string, n int")), 99)
    keys.append(("z", 9))
    assert rows(once.read_ledger(spark, ledger, schema)) == sorted(set(keys), key=repr)


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.is_dir())


def test_a_ledger_of_many_batches_stays_in_few_files(spark, tmp_path, rows):
    """Batches that repeat, and one whose first try stopped half-way, before and after the merges."""
    ledger, schema = str(tmp_path / "ledger"), "k int, n int"
    sink = once.once_sink(ledger, ["k"], every=5)
    wanted, files = {}, []
    for number in range(40):
        batch = [(k % 97, number) for k in range(number * 7, number * 7 + 12)]
        frame = spark.createDataFrame(batch, schema).coalesce(1).dropDuplicates(["k"])
        if number % 6 == 1:  # a first try that did not finish
            broken = tmp_path / "ledger" / f"batch_no={number}"
            frame.withColumn(once.HASH, F.xxhash64("k")).write.parquet(str(broken))
            (broken / "_SUCCESS").unlink()
        sink(frame, number)
        if number % 4 == 0:
            sink(frame, number)
        for k, n in batch:
            wanted.setdefault(k, n)
        files.append(sum(1 for _ in (tmp_path / "ledger").rglob("part-*.parquet")))
    stored = once.read_ledger(spark, ledger, spark.createDataFrame([], schema).schema)
    assert rows(stored) == sorted(wanted.items(), key=repr)
    assert max(files[20:]) <= max(files[:20]) and max(files) <= 16
    assert len(folders(tmp_path / "ledger")) <= 7


def test_merged_counts_are_the_newest(spark, tmp_path):
    sink = created.created_sink(str(tmp_path / "c"), ["what"], every=4)
    for number in range(11):
        frame = spark.createDataFrame([(START.date(), "a", 10 + number), (START.date() + dt.timedelta(days=number), "b", number)], "dia date, what string, quantidade long")
        sink(frame, number)
    got = {(r["dia"], r["what"]): r["quantidade"] for r in created.latest_counts(created.written_counts(spark, str(tmp_path / "c")), ["what"]).collect()}
    assert got == {(START.date(), "a"): 20, **{(START.date() + dt.timedelta(days=n), "b"): n for n in range(11)}}
    assert len(folders(tmp_path / "c")) <= 5


def rows_scanned(frame):
    """Rows that the scans of a frame gave when it was collected."""
    plan, total = frame._jdf.queryExecution().executedPlan(), 0
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            waiting.append(node.plan())
        elif name == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        else:
            children = node.children()
            waiting += [children.apply(i) for i in range(children.size())]
    return total


def test_few_keys_read_little_of_a_large_table(spark, tmp_path):
    path = str(tmp_path / "warehouse")
    whole = spark.range(200_000).selectExpr("cast(id as string) AS number", "id AS v").repartitionByRange(8, "number").sortWithinPartitions("number")
    whole.write.option("parquet.block.size", 65536).option("parquet.page.size", 4096).parquet(path)
    table = spark.read.parquet(path)
    read = []
    for n in (1, 8, 400):
        wanted = spark.range(n).selectExpr("cast(id * 487 + 11 as string) AS number")
        few = joins.only_keys(table, "number", wanted)
        assert sorted(r["v"] for r in few.collect()) == sorted(k * 487 + 11 for k in range(n))
        read.append(rows_scanned(few))
        assert {r["v"] for r in joins.only_keys(table, "number", wanted, pushed=0).collect()} == {k * 487 + 11 for k in range(n)}
    assert read[0] < 200_000 / 5 and read[0] <= read[1] <= read[2] <= 200_000
    assert joins.only_keys(table, "number", table.limit(0)).count() == 0
    assert joins.only_keys(table, "v", spark.createDataFrame([("7",), (None,)], "k string"), "k").count() == 1  # other type: a semi join


def test_reconciliation_stream(spark, tmp_path, rows):
    documents = [{"createdAt": START, "services": [{"serviceOrder": {"number": str(n), "status": "A"}}]} for n in range(9)]
    warehouse = spark.createDataFrame([(str(n), "A" if n % 2 else "B") for n in range(7)],
                                      "service_order_number string, service_order_status string")
    stream = stream_of(spark, str(tmp_path / "in"), documents, schemas.TICKET, 3)
    out = str(tmp_path / "out")
    run(stream.writeStream.foreachBatch(reconciliation.reconcile_sink(lambda: warehouse, out)), str(tmp_path / "c"))
    batch = compare_status(document_orders(spark.createDataFrame(documents, schemas.TICKET)), warehouse)
    assert rows(spark.read.parquet(out).drop("batch_no")) == rows(batch)


def test_created_per_day(spark, tmp_path, rows, events):
    stream = stream_of(spark, str(tmp_path / "in"), events, EVENT)
    out = str(tmp_path / "out")
    counted = created.created_per_day(stream, "at", ["what"], "1 hour")
    run(counted.writeStream.outputMode("append").format("parquet").option("path", out), str(tmp_path / "c"))
    days = {}
    for _, at, _, what in events:
        days[(at.date(), what)] = days.get((at.date(), what), 0) + 1
    last = max(d for d, _ in days)
    assert rows(spark.read.parquet(out)) == sorted([(*k, n) for k, n in days.items() if k[0] < last], key=repr)


def test_once_within_horizon(spark, tmp_path):
    data = [("a", START), ("a", START + dt.timedelta(hours=1)), ("b", START)]
    stream = stream_of(spark, str(tmp_path / "in"), data, "k string, at timestamp", 1)
    out = str(tmp_path / "out")
    run(once.once_within(stream, ["k"], "at", "1 day").writeStream.format("parquet").option("path", out), str(tmp_path / "c"))
    assert sorted(r["k"] for r in spark.read.parquet(out).select(F.col("k")).collect()) == ["a", "b"]
