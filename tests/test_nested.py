import datetime as dt
import json
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldmart.catalog import travel_inputs
from fieldmart.catalog.travel_inputs import land_pages
from fieldmart.operators import nested
from fieldmart.operators.quality import IncompleteData
from fieldmart.plans import call_log, travel
from fieldmart.sources import pages, schemas, tables


def write_pages(folder, *bodies):
    folder.mkdir(parents=True, exist_ok=True)
    for n, body in enumerate(bodies):
        (folder / f"page-{n}.json").write_text(json.dumps(body), encoding="utf-8")
    return str(folder)


def numbered(page, total, *data):
    return {"data": list(data), "meta": {"pagination": {"current_page": page, "total_pages": total, "total": len(data)}}}


@pytest.mark.parametrize("feed,width", [("colaboradores", 45), ("centro_custo", 9), ("grupo", 6), ("despesa", 39),
                                        ("automovel", 67), ("aereo", 83), ("onibus", 86), ("hotel", 83)])
def test_feed_width(spark, feed, width):
    columns = travel.travel_table(feed, spark.createDataFrame([], travel.record_schema(feed))).columns
    assert len(columns) == len(set(columns)) == width


def test_travel_tables_from_landed_pages(spark, tmp_path, rows):
    expense = {"id": 1, "protocol": "#9#", "amount": 1250, "afterUpdateBlueValue": "x", "receipts": ["a", "b"],
               "tagsIds": [1, None], "isReimbursable": True, "category": {"id": 4}}
    sparse = {"id": 2, "amount": None, "receipts": None}
    folder = write_pages(tmp_path / "expense", numbered(1, 2, expense), numbered(2, 2, sparse))
    group = write_pages(tmp_path / "group", numbered(1, 1, {"id": 1, "employeesIds": [7, 8]}, {"id": 2}, {"id": 3, "employeesIds": []}))
    out = travel.travel_tables(spark, {"despesa": folder, "grupo": group})
    got = {r["id"]: r for r in out["despesa"].collect()}
    assert (got["1"]["protocol"], got["1"]["amount"], got["1"]["afterUpdateBlueValue"]) == ("9", 12.5, None)
    assert (got["1"]["receipts"], got["1"]["tagsIds"], got["1"]["category"]) == ("a, b", "1, None", '{"id": 4}')
    assert (got["2"]["protocol"], got["2"]["amount"], got["2"]["receipts"]) == (None, None, "")
    assert rows(out["grupo"].select("id", "employeesIds")) == sorted(
        [("1", "7"), ("1", "8"), ("2", None), ("3", None)], key=repr)


def test_landing_joins_records_to_pages_where_they_are(spark, tmp_path):
    """Pages hold neighbouring records of one task, full but for its last one: no record is shuffled."""
    rows = spark.range(0, 2000, 1, 2).select("id", F.when(F.col("id") % 2 == 0, F.concat(F.lit('"%d\n'), F.col("id").cast("string"))).alias("note"))
    for style, listed in (("offset", "data"), ("numbered", "data"), ("content", "content")):
        for name, frame, sizes in (("all", rows, [400, 400, 200] * 2), ("none", rows.filter("id < 0"), [0])):
            path = str(tmp_path / f"{style}-{name}")
            land_pages(frame, path, style, per_page=400)
            found = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
            found.sort(key=lambda page: page[listed][0]["id"] if page[listed] else 0)
            assert [len(page[listed]) for page in found] == sizes
            assert [r["id"] for page in found for r in page[listed]] == list(range(sum(sizes)))
            assert all(r.get("note") == (f'"%d\n{r["id"]}' if r["id"] % 2 == 0 else None) for page in found for r in page[listed])
            numbers = list(range(1, len(sizes) + 1))
            if style == "numbered":
                assert [page["meta"]["pagination"] for page in found] == [{"current_page": k, "total_pages": len(sizes), "total": sum(sizes)} for k in numbers]
            elif style == "content":
                assert [(page["pagina"], page["totalPaginas"]) for page in found] == [(k, len(sizes)) for k in numbers]
            assert not (tmp_path / f"{style}-{name}-staged").exists()


@pytest.mark.parametrize("feed", ["aereo", "automovel", "despesa", "hotel", "onibus"])
def test_pages_of_a_feed_wait_in_small_groups(spark, tmp_path, monkeypatch, feed):
    """A reader takes up to a whole row group into memory, so the pages of a task do not stand in one. Numbers are right
    when a task's pages are read by several."""
    monkeypatch.setattr(travel_inputs, "remove", lambda *_: None)
    day = F.to_timestamp(F.lit("2024-01-02"))
    orders = spark.range(0, 400, 1, 1).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("P").alias("o_orderstatus"),
        F.lit(12.5).alias("o_totalprice"), day.alias("o_orderdate"))
    lines = spark.range(0, 400, 1, 1).select(
        F.col("id").alias("l_orderkey"), *[F.lit(3).cast("long").alias(f"l_{c}") for c in ("partkey", "suppkey", "linenumber")],
        *[F.lit(2.5).alias(f"l_{c}") for c in ("quantity", "extendedprice", "tax")],
        *[F.lit("F").alias(f"l_{c}") for c in ("returnflag", "linestatus")])
    path = str(tmp_path / feed)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        land_pages(travel_inputs.feed_records(SimpleNamespace(orders=orders, lineitem=lines), feed), path, "numbered", per_page=10)
        files = [pq.ParquetFile(f).metadata for f in (tmp_path / f"{feed}-staged").glob("*.parquet")]
        assert sum(f.num_rows for f in files) == 40
        assert max(f.row_group(k).num_rows for f in files for k in range(f.num_row_groups)) <= 8
        assert len(list((tmp_path / feed).glob("part-*"))) > 1
        found = sorted((json.loads(r["value"]) for r in spark.read.text(path).collect()), key=lambda p: p["meta"]["pagination"]["current_page"])
        assert [p["meta"]["pagination"]["current_page"] for p in found] == list(range(1, 41))
        assert [int(r["id"]) for p in found for r in p["data"]] == list(range(400))
        table = travel.travel_tables(spark, {feed: path}, one_per_line=True)[feed]
        assert sorted(int(r["id"]) for r in table.collect()) == list(range(400))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_incomplete_or_empty_feeds_are_refused(spark, tmp_path):
    gap = write_pages(tmp_path / "gap", numbered(1, 3, {"id": 1}), numbered(3, 3, {"id": 2}))
    with pytest.raises(IncompleteData, match=r"1 missing pages, first \[2\]"):
        travel.travel_tables(spark, {"centro_custo": gap})
    empty = write_pages(tmp_path / "empty", numbered(1, 1))
    with pytest.raises(IncompleteData, match="no rows"):
        travel.travel_tables(spark, {"centro_custo": empty})


def test_people_lists_and_history(spark, tmp_path):
    hotel = {"id": 1, "guests": {"data": [{"name": "A", "userId": 5}, {"name": None}]}, "tags": None,
             "approvalFlowHistory": {"data": [{"actionLabel": "ok", "date": "d1"}, {}]},
             "client": {"data": {"name": "C"}}, "address": {"region": "R"}, "bestPrice": "990"}
    folder = write_pages(tmp_path / "hotel", numbered(1, 1, hotel))
    row = travel.travel_tables(spark, {"hotel": folder})["hotel"].first()
    assert (row["guests_nomes"], row["guests_userIds"], row["tags_nomes"]) == ("A; ", "5; ", "")
    assert (row["approvalFlowHistory"], row["client_name"], row["address_region"], row["bestPrice"]) == ("ok(d1); ()", "C", "R", 9.9)


def test_invoices_and_credits(spark, rows):
    invoice = spark.createDataFrame([("1", "500", "d", "c", [(1, None)])], T.StructType([
        T.StructField(n, T.StringType()) for n in ("id", "amount", "description", "invoicedCompany")] + [
        T.StructField("details", T.ArrayType(schemas.struct(line=T.LongType(), note=T.StringType())))]))
    assert tuple(travel.invoices(invoice).first()) == ("1", 5.0, '[{"line":1,"note":null}]')
    credit = ("struct<data: array<struct<id: string, totalAmount: double, description: string, user: string, "
              "data: array<struct<kind: string>>>>>")
    df = spark.sql(f"""SELECT '1' AS id, 'n' AS name, from_json('{{"data": [{{"id": "a", "totalAmount": 2.5,
        "user": "u", "data": [{{"kind": "x"}}, {{"kind": "y"}}]}}, {{"id": "b"}}]}}', '{credit}') AS credits
        UNION ALL SELECT '2', 'm', NULL""")
    assert rows(travel.credits(df)) == sorted([
        ("1", "n", "a", 2.5, None, "u"), ("1", "n", "a", 2.5, None, "u"), ("1", "n", "b", None, None, None),
        ("2", "m", None, None, None, None)], key=repr)
    assert travel.credits(df.select("id", "name")).columns == ["id", "name"]


def test_expand_struct(spark):
    df = spark.sql("SELECT 1 AS id, 'x' AS a, named_struct('id', 5, 'b', 2, 'deep', named_struct('c', 3)) AS crm")
    assert nested.expand_struct(df, "crm", ["id"]).columns == ["a", "b", "deep.c"]
    with pytest.raises(ValueError, match="twice"):
        nested.expand_struct(df, "crm")
    assert nested.expand_struct(df, "absent").columns == ["id", "a", "crm"]
    assert nested.expand_struct(df.withColumn("crm", F.lit("text")), "crm").columns == ["id", "a"]


def test_item_helpers(spark):
    df = spark.sql("SELECT array(1, 2, 3) AS a, CAST(NULL AS array<int>) AS n, CAST(array() AS array<int>) AS e")
    got = df.select(nested.any_item("a", lambda x: x > 2).alias("p"), nested.any_item("n", lambda x: x > 2).alias("q"),
                    nested.first_item("a", lambda x: x > 1).alias("r"), nested.first_item("e").alias("s"),
                    nested.joined("n").alias("t")).first()
    assert tuple(got) == (True, False, 2, None, "")
    assert nested.explode_items(df, "e").count() == 0 and nested.explode_ids(df, "e").count() == 1


def test_plain_cells(spark):
    df = spark.sql("SELECT array(1, NULL) AS a, named_struct('x', CAST(NULL AS int)) AS s, double('NaN') AS d, map('k', 1) AS m")
    assert tuple(nested.to_plain_cells(df).first()) == ("[1,null]", '{"x":null}', None, '{"k":1}')


def test_page_styles(spark, tmp_path, rows):
    record = schemas.CAMPAIGN
    offset = write_pages(tmp_path / "offset", {"data": [{"phone": "1", "unknown": 2}, {"city": "X"}]}, {"data": []})
    got = pages.records(pages.read_pages(spark, offset, record))
    assert got.columns == record.fieldNames() and got.count() == 2
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text('{"data": [{"phone": "1"}]}\n{"data": [{"phone": "2"}, {"phone": "3"}]}\n')
    lines = pages.read_pages(spark, str(tmp_path / "lines"), record, one_per_line=True)
    assert [r[0] for r in rows(pages.records(lines).select("phone"))] == ["1", "2", "3"]
    content = write_pages(tmp_path / "content", {"totalPaginas": 2, "pagina": 1, "content": [{"id": "1", "atendimento": []}]})
    read = pages.read_pages(spark, content, schemas.CALL, "content")
    assert (read.first()["total_pages"], pages.records(read).first()["id"]) == (2, "1")


def test_metrics_and_quotes(spark, tmp_path, rows):
    body = {"resource": {"items": [{"intervalStart": "2025-01-02T00:00:00.000Z", "count": 4}]}}
    folder = write_pages(tmp_path / "metric", body)
    series = pages.metric_series(spark.read.schema(pages.METRIC).json(folder), "ativos")
    assert rows(series) == [(dt.date(2025, 1, 2), 4)]
    folder = write_pages(tmp_path / "quote", {p: {"bid": b, "ask": "9"} for p, b in
                                              (("USDBRL", "5.1"), ("EURBRL", "6.2"), ("GBPBRL", "7.3"))})
    assert rows(pages.latest_quotes(spark.read.schema(pages.QUOTES).json(folder))) == [(5.1, 6.2, 7.3)]


def test_parameter_list(spark, rows):
    assert rows(tables.parameter_list(spark, "['OS-1', '22']")) == [("1",), ("22",)]
    assert rows(tables.parameter_list(spark, ["7"])) == [("7",)]
    for bad in ("[1", "[]"):
        with pytest.raises(ValueError):
            tables.parameter_list(spark, bad)


def test_jdbc_options():
    options = tables.jdbc_options("jdbc:sqlserver://host;databaseName=d", {"user": "u"}, query="SELECT 1 AS x")
    assert options["query"] == "SELECT 1 AS x" and options["driver"].endswith("SQLServerDriver")
    split = {"column": "id", "lower": 1, "upper": 9, "partitions": 4}
    options = tables.jdbc_options("jdbc:postgresql://host/d", {}, query="SELECT 1 AS id", split=split)
    assert options["dbtable"] == "(SELECT 1 AS id) AS q" and options["numPartitions"] == "4"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:postgresql://host/d", {}, table="t", query="q")


RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("ok", T.BooleanType())])
WHOLE = {"offset": '{{"data":[{0}]}}', "numbered": '{{"data":[{0}],"meta":{{"pagination":{{"current_page":1,"total_pages":1,"total":2}}}}}}',
         "content": '{{"pagina":1,"content":[{0}],"totalPaginas":1}}'}
TWO = '{"id":1,"ok":true},{"id":2,"ok":"odd"}'


@pytest.mark.parametrize("style", list(WHOLE))
@pytest.mark.parametrize("form", ["files", "lines", "cells"])
def test_no_record_of_a_damaged_page_is_lost_without_a_word(spark, tmp_path, style, form):
    """Cut off, no JSON, no list: an error that names the page, or a row with its whole text in the quarantine."""
    whole = WHOLE[style].format(TWO)
    bad = [whole[:-15] if style == "content" else whole[: whole.index(',{"id":2') + 5], "<html>busy</html>", WHOLE[style].format("5"),
           WHOLE[style].replace("[{0}]", '"oops"').format(""), '{"data":']
    texts = [whole, *bad, WHOLE[style].format("")]
    if form == "cells":
        lines = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
        read = pages.parse_pages(lines, "t", RECORD, style, F.lit("cells"))
    elif form == "lines":
        (tmp_path / "all").write_text("\n".join(texts))
        read = pages.read_pages(spark, str(tmp_path), RECORD, style, one_per_line=True)
    else:
        for n, t in enumerate(texts):
            (tmp_path / f"{n}.json").write_text(t)
        read = pages.read_pages(spark, str(tmp_path), RECORD, style)
    assert sorted(r["text"] for r in pages.damaged_pages(read).collect()) == sorted(bad)
    assert all(r["file"] for r in pages.damaged_pages(read).collect())
    assert sorted(tuple(r) for r in pages.records(read, refuse=False).collect()) == [(1, True), (2, None)]
    with pytest.raises(Exception, match="damaged page in"):
        pages.records(read).collect()


def test_schema_of_open_feeds_comes_from_all_pages(spark, tmp_path):
    for n, records in enumerate((
            '{"id":1,"amount":12.5,"who":{"a b":1,"more":[1]},"none":null,"big":1,"list":[{"x":1}]}',
            '{"id":2,"amount":"n/a","who":{"a b":"t"},"late":true,"big":123456789012345678901,"list":[{"y":"z"}]}',
            '{"id":2.5,"amount":{"v":1,"w":[2]},"empty":{}}', "")):
        (tmp_path / f"{n}.json").write_text('{"data":[' + records + "]}")
    (tmp_path / "cut.json").write_text('{"data":[{"id":')
    read = pages.open_pages(spark, str(tmp_path))
    assert [r["text"] for r in pages.damaged_pages(read).collect()] == ['{"data":[{"id":']
    got = pages.records(read, refuse=False)
    assert dict(got.dtypes) == {"id": "double", "amount": "string", "who": "struct<a b:string,more:array<bigint>>", "none": "string", "big": "decimal(21,0)",
                                "list": "array<struct<x:bigint,y:string>>", "late": "boolean", "empty": "string"}
    assert {r["id"]: r["amount"] for r in got.collect()} == {1.0: "12.5", 2.0: "n/a", 2.5: '{"v":1,"w":[2]}'}
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "0.json").write_text('{"data":[]}')
    assert pages.records(pages.open_pages(spark, str(tmp_path / "none"))).columns == []


def test_calls_need_all_declared_pages(spark, tmp_path):
    page = '{"pagina":%d,"content":[{"id":"c%d","midia":"voz"}],"totalPaginas":3}'
    for n in (1, 3):
        (tmp_path / f"{n}.json").write_text(page % (n, n))
    with pytest.raises(IncompleteData, match="1 missing pages"):
        call_log.call_records(spark, str(tmp_path))
    (tmp_path / "2.json").write_text(page % (2, 2))
    assert sorted(r["id"] for r in call_log.call_records(spark, str(tmp_path)).collect()) == ["c1", "c2", "c3"]
