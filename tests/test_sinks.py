import datetime as dt
from pathlib import Path

import pytest

from fieldmart.plans import demand_alerts
from fieldmart.catalog.scratch import work_folder
from fieldmart.sinks import reports, tables

DAY = dt.date(2025, 3, 1)


def part_files(path):
    return [p.read_bytes() for p in sorted(Path(path).glob("part-*"))]  # in the order of the file names


@pytest.fixture
def table(spark):
    made = []

    def make(name, df, base):
        made.append(name)
        tables.switch_table(spark, name, df, base)
        return name

    yield make
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_csv_report_with_mark(spark, tmp_path):
    df = spark.createDataFrame([("a;b", None), ('say "x"', "ç")], "n string, v string").coalesce(1)
    reports.csv_report(df, str(tmp_path / "r"))
    text = part_files(tmp_path / "r")[0].decode("utf-8-sig")
    assert part_files(tmp_path / "r")[0].startswith(b"\xef\xbb\xbf")
    assert text.splitlines() == ["n;v", '"a;b";', '"say ""x""";ç']
    reports.csv_report(df, str(tmp_path / "c"), sep=",", bom=False)
    assert part_files(tmp_path / "c")[0].startswith(b"n,v")


def test_a_report_of_many_parts_has_one_header(spark, tmp_path, rows):
    data = [(str(n), None if n % 3 else 'x;"y"\nz', f"ç{n}") for n in range(40)]
    df = spark.createDataFrame(data, "`a b` string, v string, w string").repartition(5)
    for bom in (True, False):
        path = str(tmp_path / f"r{bom}")
        reports.csv_report(df, path, bom=bom)
        parts = part_files(path)
        whole = b"".join(parts).decode("utf-8")
        assert len(parts) > 3 and whole.startswith(reports.BOM * bom + "a b;v;w\n") and whole.count("a b;v;w") == 1
        assert whole.count(reports.BOM) == bom and parts[0].decode("utf-8").startswith(reports.BOM * bom + "a b")
        import csv
        import io
        got = list(csv.reader(io.StringIO(whole.lstrip(reports.BOM)), delimiter=";"))
        assert sorted(got[1:]) == sorted([a, v or "", w] for a, v, w in data)
    back = reports.read_csv_report(spark, str(tmp_path / "rTrue"), ["a b", "v", "w"]).filter("v IS NULL")
    assert rows(back) == sorted([r for r in data if r[1] is None], key=repr)
    reports.csv_report(df.limit(0), str(tmp_path / "none"))
    assert b"".join(part_files(tmp_path / "none")).decode("utf-8-sig") == "a b;v;w\n"


def test_text_reports(spark, tmp_path):
    df = spark.createDataFrame([("12",), ("7",)], "number string").coalesce(1)
    reports.titled_list(df.repartition(3, "number"), "number", "Not found:", str(tmp_path / "t"))
    lines = [line for part in part_files(tmp_path / "t") for line in part.decode().splitlines()]
    assert lines[0] == "Not found:" and sorted(lines[1:]) == ["12", "7"]
    reports.text_report(df, str(tmp_path / "l"))
    assert part_files(tmp_path / "l")[0].decode().splitlines() == ["12", "7"]


def test_jdbc_write_options():
    options = tables.jdbc_write_options("jdbc:sqlserver://h", {"user": "u"}, "t", 1000, {"phone": "NVARCHAR(15)"})
    assert (options["truncate"], options["batchsize"], options["createTableColumnTypes"]) == ("true", "1000", "`phone` NVARCHAR(15)")


def test_replace_append_and_days(spark, tmp_path, rows):
    path = str(tmp_path / "x")
    df = spark.createDataFrame([(1, DAY), (2, DAY + dt.timedelta(days=1))], "n int, d date")
    tables.replace(df, path)
    tables.append(df.filter("n = 1"), path)
    assert spark.read.parquet(path).count() == 3
    days = str(tmp_path / "days")
    tables.replace_days(df, days, "d")
    tables.replace_days(df.filter("n = 2").selectExpr("9 AS n", "d"), days, "d")
    assert [r["n"] for r in spark.read.parquet(days).orderBy("n").collect()] == [1, 9]


def test_switch_reads_what_it_replaces(spark, table, tmp_path, rows):
    base = str(tmp_path / "metrics")
    start = spark.createDataFrame([(DAY + dt.timedelta(days=n), n) for n in range(4)], "data date, n int")
    name = table("metrics_t", start, base)
    fresh = spark.createDataFrame([(DAY + dt.timedelta(days=3), 99)], "data date, n int")
    for _ in range(2):
        tables.replace_trailing(spark, name, fresh, "data", DAY + dt.timedelta(days=2), base)
        assert [r["n"] for r in spark.table(name).orderBy("data").collect()] == [0, 1, 99]


def test_upsert_and_append_absent(spark, table, tmp_path, rows):
    base = str(tmp_path / "fx")
    name = table("fx_t", spark.createDataFrame([(1, 1.0, "x")], "k int, v double, note string"), base)
    changed = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, v double")
    for _ in range(2):
        tables.upsert_table(spark, name, changed, "k", base)
        tables.append_absent(spark, name, spark.createDataFrame([(2, 9.0), (3, 4.0)], "k int, v double"), "k")
        assert rows(spark.table(name)) == sorted([(1, 2.0, "x"), (2, 3.0, None), (3, 4.0, None)], key=repr)


def test_commit_alerts_is_safe_to_repeat(spark, table, tmp_path, rows):
    ledger = table("ledger_t", spark.createDataFrame(
        [], "ibge string, nome_cidade string, calculo_prevencao string, nivel_alerta int, data_alerta string"), str(tmp_path / "ledger"))
    columns = ("ibge string, regiao string, uf string, nome_cidade string, fase string, curva string, "
               "new_agendados_semana_anterior long, new_agendados_semana_atual long, variacao_agendamentos_semana double, "
               "porcentagem_de_risco_semana_anterior double, porcentagem_de_risco_semana_atual double, "
               "calculo_prevencao string, nivel_calculo_prevencao int")
    due = spark.createDataFrame([("1", "N", "PE", "C1", "1", "Crescente", 1, 90, 8.0, 0.1, 0.6, "Alerta - Amarelo", 2)], columns)
    batch, runs = str(tmp_path / "batch"), str(tmp_path / "runs")
    for turn in range(2):
        new = demand_alerts.anti_join(due, spark.table(ledger), demand_alerts.LEDGER_KEY)
        tables.commit_alerts(spark, new, ledger, list(demand_alerts.LEDGER_KEY), batch, runs, demand_alerts.alert_batch,
                             lambda df: demand_alerts.ledger_rows(df, "2025-03-10"),
                             lambda df: demand_alerts.run_record(df, "2025-03-10"), f"r{turn}", str(tmp_path / "work"))
        assert list((tmp_path / "work").iterdir()) == []
        assert spark.read.parquet(batch).count() == 1 - turn
        assert (spark.table(ledger).count(), spark.read.parquet(runs).count()) == (1, 1)


def test_work_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_folder(spark, "a"), work_folder(spark, "a")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    if named:
        assert first.startswith(named.rstrip("/") + "/a-")


def files(path):
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_ino) for p in Path(path).rglob("part-*")}


def test_upsert_touches_only_the_partitions_of_its_keys(spark, tmp_path, rows):
    base, name = str(tmp_path / "fx"), "fx_parts"
    start = spark.createDataFrame([(n, float(n), "x", n // 10) for n in range(50)], "k int, v double, note string, part int")
    tables.create_partitioned(spark, name, start, "part", f"{base}/table")
    try:
        before = files(f"{base}/table")
        assert len({f.rsplit("/", 2)[1] for f in before}) == 5
        changed = spark.createDataFrame([(12, -1.0, 1), (13, None, 1), (99, 9.0, 9)], "k int, v double, part int")
        own = spark.table(name).filter("k = 15").selectExpr("k", "v * 100 AS v", "part")  # reads what it replaces
        for _ in range(2):
            tables.upsert_table(spark, name, changed.union(own), "k", base)
            own = spark.createDataFrame([], own.schema)
        after = files(f"{base}/table")
        assert {f for f in before if "part=1/" not in f} == {f for f in after if "part=1/" not in f and "part=9/" not in f}
        assert all(after[f] == before[f] for f in before if "part=1/" not in f)
        got = {r["k"]: (r["v"], r["note"], r["part"]) for r in spark.table(name).collect()}
        assert got == {**{n: (float(n), "x", n // 10) for n in range(50)}, 12: (-1.0, "x", 1), 15: (1500.0, "x", 1), 99: (9.0, None, 9)}
        tables.upsert_table(spark, name, changed.limit(0), "k", base)
        assert files(f"{base}/table") == after and sorted(p.name for p in Path(base).iterdir()) == ["table"]
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_trailing_days_leave_history_alone(spark, tmp_path, rows):
    base, name = str(tmp_path / "days"), "metric_days"
    stored = spark.createDataFrame([(n, DAY + dt.timedelta(days=n)) for n in (0, 1, 2, 3, 5)] + [(77, DAY)], "n int, data date")
    tables.create_partitioned(spark, name, stored, "data", f"{base}/table")
    try:
        before = files(base)
        start = DAY + dt.timedelta(days=2)
        fresh = spark.createDataFrame([(30, DAY + dt.timedelta(days=3)), (60, DAY + dt.timedelta(days=6))], "n int, data date")
        expected = rows(tables.replace_window(stored, fresh, "data", start))
        for _ in range(2):
            tables.replace_trailing(spark, name, fresh, "data", start, base)
            assert rows(spark.table(name)) == expected
            assert before.items() <= files(base).items()  # not one old file was written again
            assert tables.partition_values(spark, name) == [str(DAY + dt.timedelta(days=n)) for n in (0, 1, 3, 6)]
        own = spark.table(name).filter("n = 60").selectExpr("n + 1 AS n", "data")
        tables.replace_trailing(spark, name, own, "data", start, base)
        assert [r["n"] for r in spark.table(name).orderBy("n").collect()] == [0, 1, 61, 77]
        tables.replace_trailing(spark, name, fresh.limit(0), "data", DAY, base)
        assert spark.table(name).isEmpty()
    finally:
        spark.sql(f"DROP TABLE {name}")
