"""The registered queries: every one runs the library over whole benchmark tables."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, casts, risk, text
from ..operators import aggregates, bitmaps, filters, joins, matching, nested, quality, sequence
from ..plans import (call_log, campaigns, capacity, channels, chatbot, demand_alerts, duplicate_orders,
                     exchange_rates, indicators, login_report, maintenance, order_export, pending_orders,
                     phase_status, reconciliation, travel)
from ..session import tune
from ..sinks import reports, tables
from ..sources import pages
from ..sources.tables import parameter_rows, read_parquet
from ..streaming import created, once, open_sessions, sessions
from ..streaming import reconciliation as streamed
from . import inputs as i
from .scratch import work_folder
from .travel_inputs import feed_records, land_pages

Query = Callable[[SparkSession, str], DataFrame]
RUNS: dict[str, Query] = {}


def query(run: Callable[[i.Tables], DataFrame]) -> Callable[[i.Tables], DataFrame]:
    def call(spark: SparkSession, folder: str) -> DataFrame:
        return run(i.Tables(tune(spark), folder))

    RUNS[run.__name__] = call
    return run


def text_rows(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that results do not depend on a client's time zone."""
    return df.select(*[F.date_format(f"`{n}`", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(n) if k.startswith("timestamp")
                       else F.col(f"`{n}`") for n, k in df.dtypes])


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(*[F.round(f"`{n}`", digits).alias(n) if k == "double" else F.col(f"`{n}`") for n, k in df.dtypes])


# --- city demand alerts -------------------------------------------------------------------------

@query
def kpi_conditional_sums(t):
    return demand_alerts.city_counts(i.tickets(t), i.SHIP_AS_OF).drop("_booked_now")


@query
def campaign_curves(t):
    return demand_alerts.campaign_curves(i.city_campaigns(t), i.SHIP_AS_OF)


def _indicators(t) -> DataFrame:
    return demand_alerts.city_indicators(i.tickets(t), i.cities(t), i.family_counts(t), i.city_campaigns(t), i.SHIP_AS_OF)


def _alerts(t) -> DataFrame:
    return demand_alerts.demand_alerts(i.tickets(t), i.cities(t), i.family_counts(t), i.city_campaigns(t),
                                       i.city_ledger(t), i.SHIP_AS_OF)


@query
def dim_left_chain(t):
    return _indicators(t)


@query
def risk_and_alert(t):
    wide = demand_alerts.with_risk(_indicators(t), fix_declining=True)
    return rounded(wide.drop("regiao", "uf", "fase"))


@query
def demand_alert_batch(t):
    return rounded(demand_alerts.alert_batch(_alerts(t)))


@query
def demand_alert_ledger(t):
    return demand_alerts.ledger_rows(_alerts(t), i.SHIP_AS_OF)


@query
def demand_alert_run(t):
    return text_rows(demand_alerts.run_record(_alerts(t), i.SHIP_AS_OF))


# --- indicator history --------------------------------------------------------------------------

@query
def kpi_union_snapshot(t):
    return indicators.indicator_history(i.phase_tickets(t), i.SHIP_AS_OF)[0]


@query
def kpi_distinct_by_status(t):
    return indicators.indicator_history(i.phase_tickets(t), i.SHIP_AS_OF)[1]


@query
def kpi_distinct_sketch(t):
    """Whether the sketch of each distinct count is within a tenth of it."""
    exact, sketch = (indicators.status_counts(i.phase_tickets(t), approximate=a) for a in (False, True))
    both = exact.select([F.col(c).alias(f"{c}_exact") for c in exact.columns]).withColumn("one", F.lit(1)).join(sketch.withColumn("one", F.lit(1)), "one")
    return both.select([(F.abs(F.col(c) - F.col(f"{c}_exact")) <= 0.1 * F.col(f"{c}_exact")).alias(c) for c in sketch.columns])


@query
def kpi_distinct_over_days(t):
    """Distinct tickets by status over three ranges of days, from bitmaps that were stored for every day in two runs."""
    path, rows = work_folder(t.spark, "bitmaps"), i.phase_tickets(t).select("IDdoticket", "Status", F.col("Horadacriação").alias("dia"))
    for run, part in (("a", rows.filter("dia < DATE '2000-06-01'")), ("b", rows.filter("dia >= DATE '2000-06-01'"))):
        numbering = bitmaps.number_ids(t.spark, f"{path}/numbering", part, "IDdoticket", run)
        bitmaps.day_bitmaps(part, ["dia", "Status"], "IDdoticket", numbering).write.parquet(f"{path}/days/run={run}")
    stored = t.spark.read.parquet(f"{path}/days")
    found = [bitmaps.united_counts(stored.filter(F.col("dia") >= F.lit(first).cast("date")), ["Status"]).select(F.lit(first).alias("desde"), "*")
             for first in ("1990-01-01", "1999-01-01", "2001-01-01")]
    return functools.reduce(DataFrame.unionByName, found)


# --- duplicates ---------------------------------------------------------------------------------

def _pairs(t) -> DataFrame:
    return duplicate_orders.duplicate_orders(i.legacy_tickets(t), i.crm_orders(t), i.installer_groups(t), i.cities(t),
                                             i.postal_codes(t), order_prefix="199")


@query
def duplicate_order_pairs(t):
    return _pairs(t)


@query
def new_duplicate_pairs(t):
    return duplicate_orders.new_duplicates(_pairs(t), i.pair_ledger(t))


@query
def pair_once_capped(t):
    return duplicate_orders.new_duplicates(_pairs(t), i.pair_ledger(t), n=11)


@query
def crowded_people(t):
    """Person ids with more than eight pairs."""
    return duplicate_orders.crowded_people(i.legacy_tickets(t), i.crm_orders(t), order_prefix="199", most_pairs=8)


@query
def duplicate_run(t):
    new = duplicate_orders.new_duplicates(_pairs(t), i.pair_ledger(t))
    return text_rows(duplicate_orders.duplicate_run_record(new, i.SHIP_AS_OF))


# --- documents ----------------------------------------------------------------------------------

def _reconciled(t) -> reconciliation.Reconciliation:
    return reconciliation.reconcile_status(i.order_documents(t), i.warehouse_orders(t), i.ORDERS_AS_OF, i.ALL_HOURS,
                                           i.WAREHOUSE_ORDER, recent_only=False)


@query
def reconcile_status(t):
    return _reconciled(t).compared


@query
def reconcile_recent(t):
    """The orders of two years up to the report's moment: few against the warehouse."""
    return reconciliation.reconcile_status(i.order_documents(t), i.warehouse_orders(t), i.ORDERS_AS_OF, i.RECENT_HOURS,
                                           i.WAREHOUSE_ORDER).compared


@query
def reconcile_diverging(t):
    return _reconciled(t).diverging


@query
def reconcile_missing(t):
    return _reconciled(t).missing


@query
def reconcile_counters(t):
    return _reconciled(t).counters


@query
def analysed_order_listing(t):
    """Order numbers as they stand, among them some with leading zeros, letters and over 38 digits."""
    ids = _reconciled(t).compared.select("nro_os")
    odd = [F.concat(F.lit("00"), "nro_os"), F.concat(F.lit("A-"), "nro_os"), F.concat("nro_os", F.repeat(F.lit("9"), F.lit(40)))]
    return aggregates.id_listing(ids.unionByName(ids.select(F.explode(F.array(*odd)).alias("nro_os"))), "nro_os")


@query
def pending_order_report(t):
    return pending_orders.pending_orders(i.order_documents(t), i.ORDERS_AS_OF)


@query
def sibling_lookup(t):
    return maintenance.maintenance_monitor(i.order_documents(t), i.ORDERS_AS_OF, i.ALL_HOURS)


@query
def order_export_rows(t):
    found, _ = order_export.order_export(i.requested_ids(t), i.order_documents(t), i.ORDERS_AS_OF)
    return text_rows(found)


@query
def sql_text_export(t):
    return order_export.order_export(i.requested_ids(t), i.order_documents(t), i.ORDERS_AS_OF, "update_sql")[0]


@query
def orders_not_found(t):
    return order_export.order_export(i.requested_ids(t), i.order_documents(t), i.ORDERS_AS_OF)[1]


@query
def parameter_list_rows(t):
    lists = t.part.select(F.concat(F.lit("['"), F.col("p_partkey").cast("string"), F.lit("', 'OS-"),
                                   F.col("p_size").cast("string"), F.lit("']")).alias("os_list"))
    return parameter_rows(lists, "os_list")


# --- sessions -----------------------------------------------------------------------------------

@query
def session_pairing(t):
    return text_rows(sequence.pair_sessions(i.login_events(t), "username", "loginTime", "event", "id"))


@query
def login_logout_report(t):
    return login_report.login_report(i.login_events(t), dt.date(2024, 1, 1), dt.date(2024, 2, 1), ["user 7", "USER 11"])


# --- calendar and rates -------------------------------------------------------------------------

def _quote(t) -> DataFrame:
    return pages.latest_quotes(i.quote_response(t))


@query
def latest_quotes(t):
    return _quote(t)


@query
def calendar_gap_fill(t):
    return exchange_rates.fx_calendar(i.fx_table(t), _quote(t), i.FX_AS_OF)


@query
def calendar_repair(t):
    return exchange_rates.fx_calendar(i.fx_table(t), _quote(t), i.FX_AS_OF, repair_attributes=True)


@query
def upsert_by_join(t):
    rows = exchange_rates.fx_calendar(i.fx_table(t), _quote(t), i.FX_AS_OF, repair_attributes=True)
    changed = rows.withColumn("CotacaoGBP", F.col("CotacaoGBP") * 2)
    return text_rows(exchange_rates.refreshed_calendar(i.fx_table(t), changed))


@query
def insert_if_absent(t):
    return text_rows(exchange_rates.fx_insert_if_absent(i.fx_table(t), _quote(t), i.FX_AS_OF))


# --- channel metrics, chatbot, campaigns, calls ----------------------------------------------------

def _metrics(t) -> DataFrame:
    return channels.channel_metrics(i.metric_responses(t), i.metric_responses(t, "purchase"))


@query
def metric_series_join(t):
    return _metrics(t)


@query
def window_replace(t):
    fresh = _metrics(t).filter(F.col("data") >= F.date_sub(F.lit(i.EVENTS_AS_OF).cast("date"), 2))
    return channels.refreshed_metrics(i.stored_metrics(t), fresh, dt.date.fromisoformat(i.EVENTS_AS_OF))


def _landed(t, rows: DataFrame, style: str) -> DataFrame:
    """The records after they were landed as pages and read again."""
    path = work_folder(t.spark, f"pages-{style}")
    land_pages(rows, path, style)
    return pages.records(pages.read_pages(t.spark, path, rows.schema, style, one_per_line=True))


@query
def chatbot_event_table(t):
    return chatbot.chatbot_events(_landed(t, i.chatbot_records(t), "offset"), i.EVENTS_AS_OF)


@query
def top_categories(t):
    return chatbot.top_categories(chatbot.chatbot_events(i.chatbot_records(t)))


def _campaigns(t) -> tuple[DataFrame, DataFrame]:
    return campaigns.campaign_city_normalisation(_landed(t, i.campaign_rows(t), "offset"), i.official_parts(t), i.listed_parts(t))


@query
def campaign_city_rows(t):
    return _campaigns(t)[0]


@query
def campaign_quarantine(t):
    return rounded(_campaigns(t)[1])


@query
def best_match_names(t):
    official = campaigns.official_cities(i.official_parts(t), i.listed_parts(t))
    return rounded(matching.best_match(i.campaign_rows(t), "city", official, "nome_cidade"))


@query
def token_similarity(t):
    """Sent city against the true name, row by row."""
    rows = t.part.select("p_name", F.reverse("p_name").alias("mirrored"), F.lower("p_brand").alias("brand"),
                         F.concat_ws(" ", F.reverse(F.split("p_name", " "))).alias("swapped")).distinct()
    return rounded(rows.select("p_name", "mirrored", "brand", *[
        text.token_sort_ratio("p_name", c).alias(f"score_{c}") for c in ("mirrored", "brand", "swapped")]))


@query
def call_log_rows(t):
    path = work_folder(t.spark, "calls")
    rows = i.call_records(t)
    land_pages(rows, path, "content")
    return text_rows(call_log.call_log(call_log.call_records(t.spark, path, one_per_line=True, record=rows.schema), i.EVENTS_AS_OF))


@query
def damaged_page_rows(t):
    """Pages of customers in each style, every seventh cut off in its middle: ids of the records that are read, and the
    first id of each page in the quarantine."""
    found = []
    for style in ("offset", "numbered", "content"):
        path = work_folder(t.spark, f"damaged-{style}")
        rows = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
        listed = rows.groupBy(F.floor(F.col("id") / 20).alias("page")).agg(F.sort_array(F.collect_list(F.struct("id", "name"))).alias("data"))
        meta = F.struct(F.struct(F.col("page").alias("current_page")).alias("pagination"))
        page = {"offset": F.struct("data"), "numbered": F.struct("data", meta.alias("meta")),
                "content": F.struct(F.col("page").alias("pagina"), F.col("data").alias("content"))}[style]
        whole = F.to_json(page)
        cut = F.when(F.col("page") % 7 == 3, F.substring(whole, F.lit(1), (F.length(whole) / 2).cast("int"))).otherwise(whole)
        listed.select(cut.alias("value")).write.text(path)
        read = pages.read_pages(t.spark, path, rows.schema, style, one_per_line=True)
        first = F.regexp_extract("text", r'"id":(\d+)', 1).cast("long").alias("id")
        found += [pages.records(read, refuse=False).select(F.lit(style).alias("style"), F.lit("read").alias("kind"), "id"),
                  pages.damaged_pages(read).select(F.lit(style).alias("style"), F.lit("quarantine").alias("kind"), first)]
    return functools.reduce(DataFrame.unionByName, found)


@query
def call_freshness(t):
    return call_log.call_freshness(call_log.call_log(i.call_records(t), i.EVENTS_AS_OF), i.EVENTS_AS_OF)


# --- capacity and registry ------------------------------------------------------------------------

@query
def capacity_chain(t):
    setup, installer, city, _ = i.capacity_inputs(t)
    return capacity.capacity_rows(setup, installer, city, i.SHIP_AS_OF)


@query
def null_safe_anti(t):
    return capacity.new_capacity_rows(*i.capacity_inputs(t), i.SHIP_AS_OF)


@query
def mark_installed(t):
    tickets = i.tickets(t)
    first, second = (tickets.filter(F.col("Tipo") == kind) for kind in ("Service Task", "Question"))
    return phase_status.mark_installed(first, second, i.registry(t))


@query
def installed_people(t):
    tickets = i.tickets(t)
    first, second = (tickets.filter(F.col("Tipo") == kind) for kind in ("Service Task", "Question"))
    return phase_status.installed_keys(first, second, "CPF")


# --- travel -----------------------------------------------------------------------------------------

def _travel(feed: str) -> None:
    def run(t):
        """The feed landed as pages with many records, read with its guards, at full width."""
        path = work_folder(t.spark, f"travel-{feed}")
        land_pages(feed_records(t, feed), path, "numbered")
        return travel.travel_tables(t.spark, {feed: path}, one_per_line=True)[feed]

    run.__name__ = f"travel_{feed}"
    query(run)


for _feed in [*travel.FEEDS, "fatura", "creditos"]:
    _travel(_feed)


# --- functions ----------------------------------------------------------------------------------------

@query
def lenient_casts(t):
    """Malformed and well-formed text from the events through every lenient cast."""
    odd = F.when(F.col("value") < 20, "n/a").otherwise(F.col("props"))
    return t.events.select(
        "event_id",
        casts.try_date(F.when(F.col("value") < 20, "2024-13-45").otherwise(F.date_format("ts", "yyyy-MM-dd"))).alias("d"),
        casts.try_day_first(F.when(F.col("value") < 20, F.date_format("ts", "yyyy-MM-dd"))
                            .otherwise(F.date_format("ts", "dd-MM-yyyy"))).alias("d105"),
        casts.try_bigint(F.when(F.col("value") < 20, F.lit("x1")).otherwise(F.col("user_id").cast("string"))).alias("n"),
        casts.cents(F.when(F.col("value") < 20, F.lit("")).otherwise(F.col("user_id").cast("string"))).alias("units"),
        F.date_format(casts.try_stamp(F.when(F.col("value") < 20, F.lit("soon")).otherwise(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))), "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        casts.minute_text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("minute"),
        text.digits_only(odd).alias("digits"), casts.int_text("user_id").alias("user_text"))


@query
def mixed_dates(t):
    layouts = (F.when(F.col("event_type") == "click", F.date_format("ts", "MM/dd/yyyy"))
               .when(F.col("event_type") == "view", F.date_format("ts", "yyyyMMdd"))
               .when(F.col("event_type") == "error", F.concat(F.lit("25/"), F.date_format("ts", "MM/yyyy")))
               .when(F.col("event_type") == "signup", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("none"))
    return t.events.select("event_id", casts.mixed_date(layouts).alias("d"))


@query
def time_formats(t):
    return t.events.select(
        "event_id", casts.stamp_text("ts", "NULL").alias("stamp"), casts.day_text("ts").alias("day"),
        casts.stamp_text(casts.shift_hours("ts", -3)).alias("shifted"),
        calendar.whole_days("ts", casts.moment(i.EVENTS_AS_OF)).alias("days"),
        casts.stamp_text(casts.drop_zone(casts.attach_utc("ts"))).alias("same"))


@query
def text_cleanup(t):
    return t.pages.select(
        "page_id", text.digits_only("url").alias("digits"), text.strip_chars("html", "[]'#").alias("stripped"),
        text.postal_key(F.concat(F.lit(" "), F.col("url"), F.lit(" "))).alias("postal"),
        text.first_filled(F.when(F.col("html").contains("***"), "  ").otherwise(F.col("url")), F.lit("")).alias("filled"),
        text.concat_key("page_id", F.when(F.col("url").contains("?"), F.col("url"))).alias("key"),
        text.token_sort("html").alias("sorted_words"))


@query
def sql_literals(t):
    return t.documents.select(
        "doc_id", text.sql_literal("text").alias("quoted"),
        text.sql_literal(F.when(F.col("lang") == "fr", F.lit("")).otherwise(F.col("source"))).alias("maybe"),
        text.full_address("source", "n_chars", F.when(F.col("lang") == "en", F.col("lang")), "lang", F.lit(None), "doc_id",
                          "lang").alias("address"),
        text.or_text(F.when(F.col("lang") == "de", F.col("source")), "N/A").alias("defaulted"))


@query
def calendar_attributes(t):
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("Data")).distinct()
    return days.select("Data", *calendar.calendar_columns("Data"))


@query
def growth_and_ratio(t):
    """Risk functions on order prices and keys."""
    a, b = F.col("o_custkey"), F.col("o_orderkey") % 997
    ratio = risk.safe_ratio(a, b)
    df = t.orders.select(
        "o_orderkey", risk.growth(b, a).alias("change"), ratio.alias("ratio"),
        risk.blended_risk(ratio, F.lit(0.25)).alias("blend"),
        risk.months_crossed(F.col("o_orderdate"), F.lit(i.ORDERS_AS_OF).cast("date")).alias("months"))
    shade = risk.alert_colour("change", "blend", "ratio", 0.3)
    return rounded(df.withColumns({"curve": risk.lifecycle_curve("months"), "colour": shade,
                                   "level": risk.colour_level(shade)}))


# --- filters, sets, limits ----------------------------------------------------------------------------

@query
def predicate_flags(t):
    """Every filter predicate as a count over the orders."""
    date, status = F.col("o_orderdate").cast("date"), F.col("o_orderstatus")
    conditions = {
        "band_previous": filters.days_back(date, i.ORDERS_AS_OF, 16, 10),
        "band_current": filters.days_back(date, i.ORDERS_AS_OF, 9, 3),
        "not_listed": filters.not_listed("o_orderpriority", ["5-LOW", "1-URGENT"]),
        "prefixed": F.col("o_orderpriority").startswith("1-"),
        "not_prefixed": ~F.col("o_orderpriority").startswith("4-NOT"),
        "unequal": F.col("o_custkey") != F.col("o_orderkey"),
        "today": date == casts.day(i.ORDERS_AS_OF),
        "before_today": date < casts.day(i.ORDERS_AS_OF),
        "last_hours": filters.since_hours("o_orderdate", i.ORDERS_AS_OF, 240),
        "older_hours": filters.until_hours("o_orderdate", i.ORDERS_AS_OF, 240),
        "one_day": filters.within_days("o_orderdate", dt.date(2000, 2, 29), dt.date(2000, 3, 1)),
        "not_ignored": filters.not_ignored("o_orderpriority", ["5-Low", "2-high"]),
        "filled": filters.filled("o_orderpriority", F.when(status != "F", status)),
    }
    return aggregates.counts_when(t.orders, ["o_orderstatus"], conditions)


@query
def threshold_split(t):
    """Rows at or above a limit and below it; rows without a value are in neither."""
    scored = t.customer.select("c_mktsegment", F.when(F.col("c_acctbal") > -500, F.col("c_acctbal")).alias("score"))
    high, low = filters.at_least(scored, "score", 50)
    both = filters.union_all([high.withColumn("side", F.lit("kept")), low.withColumn("side", F.lit("low"))])
    return both.groupBy("c_mktsegment", "side").agg(F.count(F.lit(1)).alias("n"))


@query
def union_missing_columns(t):
    frames = [t.customer.select(F.col("c_name").alias("name"), "c_nationkey"),
              t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("other"))]
    return filters.drop_existing(filters.union_all(frames), ["absent"])


@query
def union_distinct_keys(t):
    return filters.union_distinct(t.orders.select(F.col("o_custkey").alias("key")),
                                  t.customer.select(F.col("c_custkey").alias("key")))


@query
def order_preview(t):
    return filters.preview(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])


@query
def distinct_minutes(t):
    return t.events.select("user_id", "event_type", F.date_format("ts", casts.MINUTE).alias("minute")).distinct()


@query
def kpi_hidden_key(t):
    counted = aggregates.labelled_counts(
        t.orders, ["o_orderpriority"], {"open": F.col("o_orderstatus") == "O", "all": F.lit(True)},
        {"open": F.col("o_orderdate").cast("date")})
    return counted


@query
def kpi_band_counts(t):
    """Bookings of both bands per (nation, population); the dimension joins per-nation counts."""
    date = F.col("o_orderdate").cast("date")
    per_nation = aggregates.counts_when(
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")), ["c_nationkey"],
        {"previous": filters.days_back(date, i.ORDERS_AS_OF, 160, 100), "current": filters.days_back(date, i.ORDERS_AS_OF, 90, 30)})
    people = i.customers_per_nation(t).withColumnRenamed("n_nationkey", "c_nationkey")
    return joins.left_chain(per_nation, [people], "c_nationkey").withColumnRenamed("_people", "people")


@query
def first_row_per_key(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    first = joins.first_per_key(rows, ["l_orderkey"], ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"])
    return text_rows(first)


@query
def semi_join_keys(t):
    return joins.keys_in(t.customer.select("c_custkey", "c_name"), t.orders.filter(F.col("o_orderpriority") == "1-URGENT"),
                         "c_custkey", "o_custkey")


# --- nested ---------------------------------------------------------------------------------------------

def _lines():
    return F.split("text", "\n")


@query
def explode_turn_lines(t):
    rows = t.conversations.select("conv_id", "turn", _lines().alias("lines"))
    return nested.explode_items(rows, "lines", "line", "pos")


@query
def explode_outer_ids(t):
    words = F.array_remove(F.split("text", " "), "")
    return nested.explode_ids(t.documents.select("doc_id", words.alias("ids")), "ids")


@query
def join_list_fields(t):
    """Lists made of the lines of each conversation turn, joined in every supported way."""
    items = F.transform(_lines(), lambda x, n: F.struct(
        x.alias("name"), F.when(F.length(x) > 30, F.length(x)).alias("size"), n.alias("n")))
    df = t.conversations.select("conv_id", "turn", items.alias("items"))
    return df.select(
        "conv_id", "turn", nested.joined(F.col("items.n")).alias("ids"), nested.joined_field("items", "name").alias("names"),
        nested.joined_field("items", "size").alias("sizes"),
        nested.joined_pairs("items", lambda x: F.concat(x["name"], F.lit("("), nested.text_or_blank(x["size"]), F.lit(")")))
        .alias("pairs"),
        nested.any_item("items", lambda x: x["size"] > 100).alias("has_long"),
        nested.first_item("items", lambda x: x["size"] > 50)["name"].alias("first_long"),
        nested.first_item("items")["name"].alias("first"))


@query
def json_expand(t):
    parsed = t.events.select("event_id", F.col("value").alias("amount"),
                             F.struct(F.from_json("props", "k bigint").alias("props"), F.col("user_id").alias("cpf")).alias("crm"))
    return nested.expand_struct(parsed, "crm", ["cpf", "absent"])


@query
def plain_cells(t):
    df = t.conversations.select("conv_id", "turn", _lines().alias("lines"),
                                F.struct("role", F.length("text").alias("size"), F.lit(None).cast("string").alias("note")).alias("info"))
    return nested.to_plain_cells(df)


# --- checks ---------------------------------------------------------------------------------------------

@query
def freshness_days(t):
    return aggregates.freshness(t.events, "ts", i.EVENTS_AS_OF)


@query
def missing_pages(t):
    read = t.lineitem.select((F.col("l_orderkey") + 1).alias("page"), (F.col("l_orderkey") + 1).alias("total_pages"))
    return quality.missing_pages(read)


@query
def guarded_rows(t):
    return quality.require_rows(t.region, "region")


@query
def page_row_totals(t):
    """Declared and read records of landed pages."""
    path, rows = work_folder(t.spark, "totals"), t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    land_pages(rows, path, "numbered")
    return quality.row_total(pages.read_pages(t.spark, path, rows.schema, "numbered", one_per_line=True))


# --- sinks ----------------------------------------------------------------------------------------------

@query
def csv_report_rows(t):
    """Pending orders written as a report and read back."""
    return _csv_back(t)


@query
def titled_list_lines(t):
    path = work_folder(t.spark, "list")
    absent = order_export.order_export(i.requested_ids(t), i.order_documents(t), i.ORDERS_AS_OF)[1]
    reports.titled_list(absent, "number", "OSs não encontradas:", path)
    return t.spark.read.text(path)


@query
def text_report_lines(t):
    path = work_folder(t.spark, "text")
    lines = order_export.order_export(i.requested_ids(t), i.order_documents(t), i.ORDERS_AS_OF, "update_sql")[0]
    reports.text_report(lines, path)
    return t.spark.read.text(path)


@query
def parquet_hand_over(t):
    path = work_folder(t.spark, "cells")
    df = t.conversations.select("conv_id", "turn", _lines().alias("lines"))
    reports.parquet_cells(df, path)
    return read_parquet(t.spark, path)


@query
def replaced_days(t):
    """Daily rows written per day, then the error days written again: only those change."""
    path = work_folder(t.spark, "days")
    stored = i.stored_metrics(t)
    tables.replace_days(stored, path, "data")
    late = stored.filter(F.col("engajados") > 0).withColumn("ativos", F.col("ativos") * 10)
    tables.replace_days(late, path, "data")
    return t.spark.read.parquet(path).select("data", "ativos", "engajados")


@query
def appended_rows(t):
    path = work_folder(t.spark, "append")
    tables.replace(i.cities(t), path)
    tables.append(i.cities(t).filter(F.col("regiao") == "ASIA"), path)
    return read_parquet(t.spark, path)


# --- streams --------------------------------------------------------------------------------------------

def _stream(t, name: str) -> DataFrame:
    schema = getattr(t, name).schema
    return t.spark.readStream.schema(schema).parquet(f"{t.folder}/{name}*.parquet")


def _run(writer, checkpoint: str) -> None:
    started = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()


class StreamTables(i.Tables):
    """The tables with one of them as a stream."""

    def __init__(self, t, name: str):
        super().__init__(t.spark, t.folder)
        self.__dict__[name] = _stream(t, name)


@query
def stream_created_per_day(t):
    path = work_folder(t.spark, "created")
    counted = created.created_per_day(_stream(t, "events"), "ts", ["event_type"])
    _run(counted.writeStream.outputMode("update").foreachBatch(created.created_sink(f"{path}/out", ["event_type"])), f"{path}/checkpoint")
    return created.latest_counts(created.written_counts(t.spark, f"{path}/out"), ["event_type"])


@query
def stream_alert_once(t):
    path = work_folder(t.spark, "once")
    rows = _stream(t, "events").select("user_id", "event_type")
    _run(rows.writeStream.foreachBatch(once.once_sink(f"{path}/ledger", ["user_id", "event_type"])), f"{path}/checkpoint")
    return once.read_ledger(t.spark, f"{path}/ledger", rows.schema)


@query
def stream_once_within(t):
    """Users and kinds of events, once within the horizon."""
    path = work_folder(t.spark, "within")
    rows = _stream(t, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    found = once.once_within(rows, ["user_id", "event_type"], "ts", "100 days").select("user_id", "event_type")
    _run(found.writeStream.format("parquet").option("path", f"{path}/out"), f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out")


@query
def stream_reconcile_status(t):
    path = work_folder(t.spark, "reconcile")
    docs = i.order_documents(StreamTables(t, "orders"))
    sink = streamed.reconcile_sink(lambda: i.warehouse_orders(t), f"{path}/out", i.WAREHOUSE_ORDER)
    _run(docs.writeStream.foreachBatch(sink), f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out").drop("batch_no")


@query
def stream_session_pairing(t):
    """Day by day, like the daily report; the days that are still open at the end are flushed."""
    path = work_folder(t.spark, "sessions")
    logins = i.login_events(StreamTables(t, "events"))
    sink = sessions.session_sink(f"{path}/inbox", f"{path}/report", "username", "loginTime", "event", "id")
    _run(logins.writeStream.foreachBatch(sink), f"{path}/checkpoint")
    sessions.report_days(t.spark, f"{path}/inbox", f"{path}/report", "username", "loginTime", "event", "id", None, 1 << 40)
    return text_rows(t.spark.read.parquet(f"{path}/report").drop("batch_no"))


@query
def stream_open_sessions(t):
    """Pairs as they end; of the days that are over an hour before the newest event."""
    path = work_folder(t.spark, "open")
    logins = i.login_events(StreamTables(t, "events"))
    found = open_sessions.session_stream(logins, "username", "loginTime", "event", "id")
    _run(found.writeStream.format("parquet").option("path", f"{path}/out"), f"{path}/checkpoint")
    newest = i.login_events(t).filter(F.col("event").isin("LOGIN", "LOGOUT")).agg(F.max(F.col("loginTime").cast("timestamp_ntz"))).first()[0]
    over = F.col("day") < F.lit((newest - dt.timedelta(hours=1)).date())
    return text_rows(t.spark.read.parquet(f"{path}/out").filter(over & ~F.col("late")).drop("late"))


# --- the write side -------------------------------------------------------------------------------------

def _table(t, rows: DataFrame, path: str, column: str | None = None) -> str:
    """A catalog table of the rows, in a folder of the run, partitioned by the column if there is one."""
    name = f"t_{path.rsplit('-', 1)[1]}"
    if column:
        tables.create_partitioned(t.spark, name, rows, column, f"{path}/table")
    else:
        tables.switch_table(t.spark, name, rows, path)
    return name


@query
def committed_alerts(t):
    """The alert job twice over one ledger: the second run has nothing new."""
    path = work_folder(t.spark, "commit")
    name = _table(t, i.city_ledger(t).select("ibge", "calculo_prevencao", *[F.lit(None).cast(k).alias(c) for c, k in (
        ("nome_cidade", "string"), ("nivel_alerta", "int"), ("data_alerta", "string"))]), path)
    for run_id in ("first", "second"):
        new = demand_alerts.demand_alerts(i.tickets(t), i.cities(t), i.family_counts(t), i.city_campaigns(t), t.spark.table(name), i.SHIP_AS_OF)
        tables.commit_alerts(t.spark, new, name, list(demand_alerts.LEDGER_KEY), f"{path}/batch", f"{path}/runs", demand_alerts.alert_batch,
                             lambda rows: demand_alerts.ledger_rows(rows, i.SHIP_AS_OF), lambda rows: demand_alerts.run_record(rows, i.SHIP_AS_OF), run_id,
                             f"{path}/staged")
    alerted = t.spark.read.parquet(f"{path}/runs/run=first").agg(F.coalesce(F.sum("qtd_cidades"), F.lit(0))).first()[0]
    again = t.spark.read.parquet(f"{path}/batch").count()
    return t.spark.table(name).filter("data_alerta IS NOT NULL").withColumns({"second_run": F.lit(again), "alerted": F.lit(alerted)})


@query
def upserted_table(t):
    """The calendar merge on a stored table with a partition for each year."""
    path = work_folder(t.spark, "upsert")
    year = F.year("Data").alias("year")
    name = _table(t, i.fx_table(t).select("*", year), path, "year")
    rows = exchange_rates.fx_calendar(t.spark.table(name).drop("year"), _quote(t), i.FX_AS_OF, repair_attributes=True)
    tables.upsert_table(t.spark, name, rows.withColumn("CotacaoGBP", F.col("CotacaoGBP") * 2).select("*", year), "Data", path)
    return text_rows(t.spark.table(name).drop("year"))


@query
def appended_absent(t):
    """Order numbers added to a stored list of customers' numbers where it does not have them, twice."""
    path = work_folder(t.spark, "absent")
    name = _table(t, t.customer.select(F.col("c_custkey").alias("number"), F.col("c_name").alias("name")), path)
    for _ in range(2):
        tables.append_absent(t.spark, name, t.orders.select(F.col("o_orderkey").alias("number")), "number")
    return t.spark.table(name)


@query
def replaced_trailing(t):
    """The trailing days of the stored metrics, a partition each, replaced by fresh ones."""
    path = work_folder(t.spark, "trailing")
    name = _table(t, i.stored_metrics(t), path, "data")
    start = dt.date.fromisoformat(i.EVENTS_AS_OF) - dt.timedelta(days=2)
    fresh = _metrics(t).filter(F.col("data") >= F.lit(start))
    tables.replace_trailing(t.spark, name, fresh, "data", start, path)
    return t.spark.table(name).select(*i.stored_metrics(t).columns)


def _csv_back(t, **form) -> DataFrame:
    path, rows = work_folder(t.spark, "csv"), pending_orders.pending_orders(i.order_documents(t), i.ORDERS_AS_OF)
    reports.csv_report(rows, path, **form)
    return reports.read_csv_report(t.spark, path, rows.columns, form.get("sep", ";"))


@query
def csv_comma_rows(t):
    return _csv_back(t, sep=",")


@query
def csv_plain_rows(t):
    """Without a byte-order mark."""
    return _csv_back(t, bom=False)
