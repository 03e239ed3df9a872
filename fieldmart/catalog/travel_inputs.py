"""Records of the travel feeds, made from the benchmark tables, and JSON pages of records. Arrays come from the row itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import travel
from ..session import remove
from ..sources.schemas import travel_type
from .inputs import Tables, text


def nest(**fields) -> Column:
    """A struct from keyword columns; dicts become structs, lists arrays."""
    return F.struct(*[_value(v).alias(k) for k, v in fields.items()])


def _value(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, dict):
        return nest(**v)
    if isinstance(v, list):
        return F.array(*[_value(x) for x in v])
    return F.col(v) if isinstance(v, str) else F.lit(v)


def none() -> Column:
    return F.lit(None).cast("string")


def as_records(rows: DataFrame, **fields) -> DataFrame:
    return rows.select(*[_value(v).alias(k) for k, v in fields.items()])


def _bodies(records: DataFrame, per_page: int) -> DataFrame:
    """The JSON texts of one column joined to bodies of pages, task by task: nothing is shuffled. ``part`` and ``place``
    tell the pages apart, as long as the frame is computed once."""
    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, place, held = TaskContext.get().partitionId(), 0, []

        def page():
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([place], pa.int64()), pa.array([len(held)], pa.int64()),
                                               pa.array([",".join(held)], pa.string())], ["part", "place", "size", "body"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(text)
                if len(held) == per_page:
                    yield page()
                    place, held = place + 1, []
        if held:
            yield page()

    return records.mapInArrow(cut, "part int, place long, size long, body string")


#: How pages wait for their numbers: a row group has few of them, since a reader takes up to a whole group into memory as one batch.
STAGED = {"compression": "zstd", "parquet.block.row.count.limit": 8}


def land_pages(rows: DataFrame, path: str, style: str, per_page: int = 500) -> None:
    """Writes records as JSON pages of the given style, one page per line, of ``per_page`` records each, the last one of
    each task of fewer. Without any record there is one empty page.

    How many pages there are is known when all are made, so they are written once compressed, and then with their numbers.
    A task holds a few pages at a time, however many it writes or reads."""
    spark, staged = rows.sparkSession, f"{path}-staged"
    record = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    _bodies(rows.select(F.to_json(record).alias("record")), per_page).write.options(**STAGED).parquet(staged)
    made = spark.read.parquet(staged)
    before, n, total = {}, 0, 0
    for part, pages, records in made.groupBy("part").agg(F.count("*"), F.sum("size")).orderBy("part").collect():  # a row for each task
        before[part] = n
        n, total = n + pages, total + records
    if n:
        skipped = F.lit([before.get(part, 0) for part in range(max(before) + 1)])
        made = made.select((F.get(skipped, F.col("part")) + F.col("place") + 1).alias("page"), "body")
    else:
        n, made = 1, spark.range(1, 2, 1, 1).select(F.col("id").alias("page"), F.lit("").alias("body"))
    if style == "content":
        form, cells = f'{{"pagina":%d,"content":[%s],"totalPaginas":{n}}}', ("page", "body")
    elif style == "numbered":
        form, cells = f'{{"data":[%s],"meta":{{"pagination":{{"current_page":%d,"total_pages":{n},"total":{total}}}}}}}', ("body", "page")
    else:
        form, cells = '{"data":[%s]}', ("body",)
    made.select(F.format_string(form, *cells).alias("value")).write.text(path)
    remove(spark, staged)


def either(number: str, kinds: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """A value whose JSON kind differs from record to record: the first kind whose condition on the number holds."""
    value = F.to_json(F.struct(otherwise.alias("v")))
    for holds, kind in reversed(kinds):
        value = F.when(holds, F.to_json(F.struct(kind.alias("v")))).otherwise(value)
    return F.when(F.col(number).isNotNull(), F.variant_get(F.parse_json(value), "$.v", "variant"))


def _person(tag: str, **more) -> list:
    return [{"name": F.concat(F.lit(f"{tag} "), text("o_custkey")), "email": none(), "document": F.lit("D1"),
             "userId": F.col("o_custkey"), **more},
            {"name": F.lit("Guest"), "email": F.lit("g@example.com"), "document": none(),
             "userId": F.lit(7).cast("bigint"), **more}]


def _leaves(feed: str) -> list[tuple[str, str]]:
    """(flat column, path in the record) of the single fields of a described feed, in table order; lists have no path."""
    found = []
    for f in travel.FEEDS[feed]:
        if isinstance(f, travel.Plain):
            found += [(n, n) for n in f.names.split()]
        elif isinstance(f, travel.Inside):
            found += [(f"{f.prefix or f.path}_{n}", f"{f.path}.{n}") for n in f.names.split()]
        else:
            found.append((f.name if isinstance(f, travel.Ids) else f.alias, ""))
    return found


def filled(rows: DataFrame, feed: str, key: str, lists: dict[str, Column], **given) -> DataFrame:
    """Records of a feed with a value in every field in every fourth row: the field's number and the row's key.

    ``given`` has other values by flat column, ``lists`` the lists by their path."""
    money = set(travel.CENTS.get(feed, "").split())
    tree: dict = {}
    for number, (name, path) in enumerate(_leaves(feed)):
        if not path:
            continue
        if name in given:
            value = _value(given[name])
        else:
            last = path.rsplit(".", 1)[-1]
            if isinstance(travel_type(last), T.BooleanType):
                value = F.col(key) % 8 < 4
            elif name in money:
                value = F.col(key) % 977 + number
            else:
                value = F.concat(F.lit(f"{number}/"), text(key))
            value = F.when((F.col(key) + number) % 4 == 0, value)
        _put(tree, path, value)
    for path, value in lists.items():
        _put(tree, path, value)
    return as_records(rows, **tree)


def mostly(key: str) -> Column:
    """An amount in cents that is no number in every third row."""
    return F.when(F.col(key) % 3 == 0, "n/a").otherwise(text(F.col(key) % 50))


def _put(tree: dict, path: str, value: Column) -> None:
    *parents, last = path.split(".")
    for part in parents:
        tree = tree.setdefault(part, {})
    tree[last] = value


def feed_records(t: Tables, feed: str) -> DataFrame:
    if feed == "colaboradores":
        return filled(
            t.customer, feed, "c_custkey", {"allDocuments.data": _value([{"label": "c_name", "type": {"label": F.lit("RG")}},
                                                                          {"label": none(), "type": {"label": F.col("c_mktsegment")}}])},
            id="c_custkey", name="c_name", email=F.when(F.col("c_acctbal") > 0, F.concat(F.lower("c_name"), F.lit("@example.com"))),
            position_id="c_nationkey", position_label="c_mktsegment", active=F.col("c_acctbal") > 0, hasApp=F.col("c_acctbal") > 5000)
    if feed == "centro_custo":
        return filled(t.nation, feed, "n_nationkey", {}, id="n_nationkey", v3Id="n_regionkey", name="n_name")
    if feed == "grupo":
        members = F.when(F.col("p_type") != "PROMO", F.split("p_name", " ")).otherwise(F.array().cast("array<string>"))
        return filled(t.part, feed, "p_partkey", {"employeesIds": members}, id="p_partkey", name="p_brand", amountEmployees="p_size")
    if feed == "despesa":
        return filled(
            t.lineitem.withColumn("line", F.col("l_orderkey") * 8 + F.col("l_linenumber")), feed, "line",
            {"receipts": _value(["l_returnflag", "l_linestatus"]), "tagsIds": _value(["l_partkey", "l_suppkey"])},
            id="l_orderkey", protocol=F.concat(F.lit("#"), text("l_orderkey"), F.lit("#")), amount="l_extendedprice",
            isReimbursable=F.col("l_tax") > 0.045, afterUpdateBlueValue=mostly("line"), beforeUpdateBlueValue="l_quantity", quantity="l_linenumber")
    if feed in ("automovel", "aereo", "onibus", "hotel"):
        order = dict(id=text("o_orderkey"), protocol=F.concat(F.lit("#"), text("o_orderkey")), amount="o_totalprice", refunds=mostly("o_orderkey"),
                     createdAt=F.date_format("o_orderdate", "yyyy-MM-dd"))
        lists = {"tagsIds": _value(["o_custkey", "o_orderkey"])}
        if feed == "automovel":
            lists["drivers.data"] = _value(_person("Driver"))
        elif feed == "aereo":
            lists |= {"ticketOutbound": _value([{"ticket": text("o_orderkey")}, {"ticket": none()}]), "ticketInbound": _value([{"ticket": text("o_custkey")}]),
                      "travellers.data": _value(_person("Traveller", bestPrice=F.lit(100), nationality=F.lit("BR")))}
        elif feed == "onibus":
            order |= dict(outbound_price="o_totalprice", inbound_insurancePrice=mostly("o_orderkey"))
        else:
            order |= dict(isRefundable=F.col("o_orderstatus") == "P", dailyAmount="o_totalprice")
            lists |= {"tags.data": _value([{"name": F.lit("a")}, {"name": none()}, {"name": F.col("o_orderstatus")}]),
                      "nextApprovalUsers.data": _value([{"name": F.lit("Boss"), "email": F.lit("b@example.com")}]),
                      "approvalFlowHistory.data": _value([{"actionLabel": F.lit("Asked"), "date": F.date_format("o_orderdate", "yyyy-MM-dd")},
                                                          {"actionLabel": none(), "date": none()}]),
                      "guests.data": _value(_person("Guest", nationality=F.lit("BR")))}
        return filled(t.orders, feed, "o_orderkey", lists, **order)
    if feed == "fatura":  # fields of unlike kinds, and one that few records have
        def every(n: int) -> Column:
            return F.col("o_orderkey") % n == 0

        return as_records(
            t.orders, id="o_orderkey", description=F.lit("d"), invoicedCompany=F.lit("c"),
            amount=either("o_orderkey", [(every(7), F.lit("n/a")), (every(3), text("o_totalprice"))], F.col("o_totalprice")),
            closed=either("o_orderkey", [(every(5), F.col("o_orderstatus"))], F.col("o_orderstatus") == "F"),
            rare=F.when(every(13), F.struct(F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("note"))),
            details=[{"line": "o_orderkey", "note": either("o_orderkey", [(every(11), F.col("o_custkey"))], F.col("o_orderpriority"))},
                     {"line": F.lit(2).cast("bigint"), "note": F.lit(None).cast("variant")}])
    if feed == "creditos":
        moves = [{"kind": F.lit("in")}, {"kind": F.lit("out")}]
        third = F.col("s_suppkey") % 3 == 0
        amount = either("s_suppkey", [(third, F.concat(F.lit("R$ "), text("s_acctbal")))], F.col("s_acctbal"))
        user = either("s_suppkey", [(third, F.struct(F.col("s_name").alias("name"), F.col("s_nationkey").alias("team")))], F.col("s_name"))
        credit = F.array(
            nest(id=text("s_suppkey"), totalAmount=amount, description=F.lit("first"), user=user,
                 data=F.array(*[_value(m) for m in moves])),
            nest(id=F.concat(F.lit("b"), text("s_suppkey")), totalAmount=amount, description=none(), user=user,
                 data=F.array(*[_value(m) for m in moves[:1]])))
        return as_records(t.supplier, id="s_suppkey", name="s_name", createdAt=F.lit("2024-01-01"), updatedAt=F.lit("2024-01-02"),
                        credits={"data": F.when(F.col("s_acctbal") > 0, credit)})
    raise KeyError(feed)
