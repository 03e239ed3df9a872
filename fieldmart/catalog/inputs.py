"""Report inputs derived from the benchmark tables.

The benchmark tables know nothing of tickets or cities, so each function here gives one of them the
columns a report expects. All of it is row-wise or a plain join or group, over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import schemas

SHIP_AS_OF = "2001-11-04"
ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31"
FX_AS_OF = "2001-09-30"
# Documents are matched by hours: this many reach back before the first order.
ALL_HOURS = 60_000
RECENT_HOURS = 2 * 365 * 24
FOLLOW_UP = 1_000_000_000_000


class Tables:
    """The parquet tables of one folder, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = table
        return table


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def build(kind: T.DataType, values) -> Column:
    """A struct column of the given type from nested dicts; fields without a value are null."""
    if isinstance(kind, T.StructType) and isinstance(values, dict):
        return F.struct(*[build(f.dataType, values.get(f.name)).alias(f.name) for f in kind.fields])
    if values is None:
        return F.lit(None).cast(kind)
    return values.cast(kind)


# --- tickets and cities -------------------------------------------------------------------------

def tickets(t: Tables) -> DataFrame:
    """One ticket per line item, created more and more densely towards the run date."""
    age = F.date_diff(F.lit(SHIP_AS_OF).cast("date"), F.col("l_shipdate").cast("date"))
    back = F.floor(age * age / F.lit(300000)).cast("int")
    open_ = F.col("l_linestatus") == "O"
    step = {1: "BACKOFFICE", 2: "IN_CORRECTION", 3: "IN_AUDITING", 4: "CANCELLED", 5: "VALIDATION"}
    other = F.lit("INSTALLED")
    for number, status in step.items():
        other = F.when(F.col("l_linenumber") == number, status).otherwise(other)
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.withColumn("_created", F.date_sub(F.lit(SHIP_AS_OF).cast("date"), back))
    return rows.select(
        text("s_nationkey").alias("IBGE"),
        text("l_orderkey").alias("IDdoticket"),
        F.when(F.col("l_tax") > 0.075, "Question").otherwise("Service Task").alias("Tipo"),
        F.when(open_, "IN_PROGRESS").when(F.col("l_returnflag").isin("R", "A"), "INSTALLED")
        .otherwise(other).alias("Status"),
        F.when(open_, None).when(F.col("l_returnflag") == "R", "Instalada")
        .when(F.col("l_returnflag") == "A", "Executado - Procedente").alias("StatusdaInstalação"),
        F.when(F.col("l_discount") < 0.065, "Agendamento").when(F.col("l_discount") < 0.085, "Interferência")
        .when(F.col("l_discount") < 0.095, "Contestação").otherwise("Manutenção")
        .alias("MotivodocontatoInstalação"),
        F.col("_created").alias("Horadacriação"),
        F.when(F.col("l_linenumber") < 7, F.date_add("_created", F.col("l_linenumber") * 4 - 8))
        .alias("DataHoraAgendamento"),
        text("l_partkey").alias("CPF"),
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("F-"), text("l_suppkey")))
        .otherwise(text("l_suppkey")).alias("CodFamilia"),
        F.col("s_name").alias("Instaladora"),
        F.col("s_nationkey").alias("_nation"),
    )


def phase_tickets(t: Tables) -> DataFrame:
    """Tickets with installer and city attributes."""
    nation = t.nation.select(F.col("n_nationkey").alias("_nation"), F.col("n_name").alias("Municipio"),
                             F.concat(F.lit("R"), text("n_regionkey")).alias("UF"),
                             F.concat(F.lit("Fase "), text("n_regionkey")).alias("Fase"))
    return tickets(t).join(nation, "_nation").withColumnRenamed("IBGE", "ibge").drop("_nation")


def customers_per_nation(t: Tables) -> DataFrame:
    return t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("_people"))


def cities(t: Tables) -> DataFrame:
    rows = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .join(customers_per_nation(t), "n_nationkey", "left"))
    return rows.select(
        text("n_nationkey").alias("cIBGE"), F.col("r_name").alias("regiao"),
        F.concat(F.lit("R"), text("n_regionkey")).alias("uf"), F.col("n_name").alias("nome_cidade"),
        F.concat(F.lit("Fase "), text("n_regionkey")).alias("fase"),
        (F.col("_people") * (F.col("n_nationkey") * 3 + 20)).alias("domicilios_particulares"))


def family_counts(t: Tables) -> DataFrame:
    rows = t.nation.join(customers_per_nation(t), "n_nationkey", "left")
    return rows.select(F.col("n_nationkey").alias("ibge"),
                       (F.col("_people") * (F.col("n_nationkey") * 2 + 25)).alias("CODIGO FAMILIAR"))


def city_campaigns(t: Tables) -> DataFrame:
    start = F.add_months(F.lit(SHIP_AS_OF).cast("date"), F.lit(2) - F.col("n_nationkey"))
    return t.nation.select(F.col("n_nationkey").alias("cód. IBGE"), start.alias("INÍCIO DE CAMPANHA"))


def city_ledger(t: Tables) -> DataFrame:
    asia = t.nation.join(t.region.filter(F.col("r_name") == "ASIA"), F.col("n_regionkey") == F.col("r_regionkey"))
    return asia.select(text("n_nationkey").alias("ibge"), F.col("n_name").alias("nome_cidade"),
                       F.lit("Alerta - Amarelo").alias("calculo_prevencao"))


def registry(t: Tables) -> DataFrame:
    status = (F.when(F.col("p_type") == "STANDARD", None).when(F.col("p_type") == "PROMO", "Instalado")
              .otherwise("Pendente"))
    return t.part.select(text("p_partkey").alias("cpf"), F.col("p_size").cast("bigint").alias("cod_familia"),
                         status.alias("status_cpf"), status.alias("status_codfamilia"))


# --- legacy tickets and new orders --------------------------------------------------------------

def legacy_tickets(t: Tables) -> DataFrame:
    """One closed legacy ticket per customer."""
    return t.customer.select(
        F.concat(F.lit("F"), text("c_custkey")).alias("IDdoticket"),
        F.when(F.col("c_mktsegment") == "BUILDING", "3").when(F.col("c_mktsegment") == "MACHINERY", "5")
        .otherwise("4").alias("Status"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "Contestação").otherwise("Agendamento")
        .alias("MotivodocontatoInstalação"),
        F.when(F.col("c_acctbal") < 0, "Improdutiva").otherwise("Instalada").alias("StatusdaInstalação"),
        text("c_nationkey").alias("B_IBGE"), F.col("c_name").alias("B_NOME"), text("c_custkey").alias("B_CPF"),
        F.col("c_nationkey").alias("Grupo"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.floor(F.col("c_acctbal") / 30).cast("int"))
        .alias("Horadetérminodocompromisso"),
    )


def crm_orders(t: Tables) -> DataFrame:
    key = F.lpad(text("o_custkey"), 8, "0")
    return t.orders.select(
        F.concat(text(F.year("o_orderdate")), F.lpad(text("o_orderkey"), 12, "0")).alias("service_order_number"),
        F.when(F.col("o_orderstatus") == "F", "CANCELLED_BY_USER").when(F.col("o_orderstatus") == "O", "OPEN")
        .otherwise("PENDING").alias("service_order_status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Manutenção").when(
            F.col("o_orderpriority") == "1-URGENT", "Agendamento de Instalação")
        .otherwise("Agendamento").alias("service_order_type"),
        F.col("o_orderpriority").alias("installer_response_classification"),
        F.col("o_orderdate").alias("service_order_created_at"),
        (F.col("o_orderdate") + F.expr("INTERVAL 2 DAY")).alias("schedule_date_time"),
        F.concat(F.lit("Name "), text("o_custkey")).alias("customer_name"),
        text("o_custkey").alias("customer_cpf"),
        F.when(F.col("o_orderpriority") == "1-URGENT", None).when(F.col("o_orderpriority") == "2-HIGH", "  ")
        .otherwise(F.concat(F.lit("B"), text("o_custkey"))).alias("customer_ibge"),
        F.concat(F.lit(" "), F.substring(key, 1, 5), F.lit("-"), F.substring(key, 6, 3)).alias("customer_postal_code"),
        F.lit("crew").alias("installer"),
    )


def installer_groups(t: Tables) -> DataFrame:
    return t.nation.filter(F.col("n_regionkey") > 0).select(
        F.col("n_nationkey").alias("id"), F.concat(F.lit("Crew "), F.col("n_name")).alias("instaladora"))


def postal_codes(t: Tables) -> DataFrame:
    return t.customer.select(F.lpad(text("c_custkey"), 8, "0").alias("postal_code"),
                             F.when(F.col("c_acctbal") > 0, text("c_nationkey")).otherwise("").alias("IBGE"))


def pair_ledger(t: Tables) -> DataFrame:
    """Pairs that were alerted before: the urgent orders of 1998."""
    old = t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.year("o_orderdate") == 1998))
    return old.select(F.concat(F.lit("F"), text("o_custkey")).alias("OsFresh"),
                      F.concat(F.lit("1998"), F.lpad(text("o_orderkey"), 12, "0")).alias("OsCRM_EAF"))


# --- documents ----------------------------------------------------------------------------------

def order_documents(t: Tables) -> DataFrame:
    """One ticket document per order: the order itself, and a follow-up service for urgent and high
    priority. The arrays are made from the row, so they stay short however large the table is."""
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    low, medium = F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority") == "3-MEDIUM"
    fix, book = F.lit("Manutenção - Problema técnico"), F.lit("Agendamento")
    date = F.col("o_orderdate")
    visit = build(schemas.SERVICE_ORDER["schedules"].dataType.elementType,
                  {"date": date + F.expr("INTERVAL 2 DAY"), "installer": F.concat(F.lit("I"), text("o_custkey"))})
    done = F.col("o_orderstatus") == "F"
    main = build(schemas.SERVICE, {
        "protocol": {"number": F.concat(F.lit("P-"), text("o_orderkey")), "createdAt": date,
                     "channel": F.lit("phone")},
        "serviceOrder": {
            "number": text("o_orderkey"),
            "status": F.when(F.col("o_orderstatus") == "O", "OPEN").when(F.col("o_orderstatus") == "P", "PENDING")
            .otherwise("DONE"),
            "type": F.when(urgent, fix).otherwise(book),
            "failureReason": F.when(high, "client's absence"),
            "registeredAt": date + F.expr("INTERVAL 9 HOUR"),
            "schedules": F.when(~low, F.array(visit)).otherwise(F.array().cast(
                schemas.SERVICE_ORDER["schedules"].dataType)),
            "installerResponse": {
                "appointmentEndTime": F.when(done, date + F.expr("INTERVAL 75 HOUR")),
                "classification": F.when(done, F.lit("it's done")),
                "pta": F.when(done, text(F.col("o_totalprice") > 250000)),
            },
        },
        "tabulation": F.col("o_orderpriority"),
        "failureReason": F.when(high, "client's absence"),
    })
    follow = build(schemas.SERVICE, {
        "protocol": {"number": F.concat(F.lit("P-"), text("o_orderkey"))},
        "serviceOrder": {
            "number": text(F.col("o_orderkey") + F.lit(FOLLOW_UP)),
            "status": F.lit("IN_VALIDATION"),
            "type": F.when(high, fix).otherwise(book),
            "registeredAt": date + F.expr("INTERVAL 30 DAY"),
            "installerResponse": {"appointmentEndTime": date + F.expr("INTERVAL 31 DAY")},
        },
    })
    customer = build(schemas.TICKET["customer"].dataType, {
        "name": F.concat(F.lit("Name "), text("o_custkey")),
        "cpf": F.when(~medium, text("o_custkey")),
        "cadUnico": {"ibgeCode": text("o_custkey")},
        "address": {"streetName": F.lit("Rua"), "number": text("o_custkey"), "city": F.lit("Cidade")},
        "contacts": F.array(build(schemas.struct(value=schemas.TEXT), {"value": text("o_custkey")})),
    })
    services = F.when(urgent | high, F.array(main, follow)).otherwise(F.array(main))
    return t.orders.select(
        text("o_orderkey").alias("_id"), date.alias("createdAt"), date.alias("lastModifiedDate"),
        F.when(~low, F.concat(F.lit("agent"), text("o_custkey"))).alias("createdBy"),
        customer.alias("customer"), services.alias("services"))


def warehouse_orders(t: Tables) -> DataFrame:
    """Warehouse status per order number: line items, several rows per number."""
    return t.lineitem.select(
        text("l_orderkey").alias("service_order_number"),
        F.when(F.col("l_linestatus") == "O", "OPEN").otherwise("DONE").alias("service_order_status"),
        "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")


WAREHOUSE_ORDER = ("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "status_sql")


def requested_ids(t: Tables) -> DataFrame:
    """Order numbers somebody asks for: orders with a line of more than 40 pieces, and as many numbers
    that no document has."""
    asked = t.lineitem.filter(F.col("l_quantity") > 40).select("l_orderkey").distinct()
    known = asked.select(text("l_orderkey").alias("number"))
    unknown = asked.select(text(F.col("l_orderkey") + F.lit(2 * FOLLOW_UP)).alias("number"))
    return known.unionByName(unknown)


# --- events -------------------------------------------------------------------------------------

def login_events(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "LOGIN").when(F.col("event_type") == "error", "LOGOUT")
    return t.events.select(F.col("event_id").alias("id"),
                           F.concat(F.lit("User "), text("user_id")).alias("username"),
                           F.coalesce(kind, F.upper("event_type")).alias("event"), F.col("ts").alias("loginTime"))


def chatbot_records(t: Tables) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    crm = F.struct(text("event_id").alias("uuid"), F.col("props").alias("ibgeCode"),
                   F.concat(F.lit("user "), text("user_id")).alias("name"))
    return t.events.select(
        text("event_id").alias("id"), F.concat(F.lit("55"), text("user_id")).alias("phone"),
        F.when(F.col("value") < 90, stamp).otherwise("unknown").alias("date"), F.lit("chat").alias("channel"),
        F.col("event_type").alias("category"), F.col("props").alias("tracking"),
        F.when(F.col("event_type") == "error", crm).alias("crm"))


def metric_responses(t: Tables, kind: str | None = None) -> DataFrame:
    """Responses of a daily metric: distinct users per day, one item per response."""
    events = t.events if kind is None else t.events.filter(F.col("event_type") == kind)
    days = events.groupBy(F.col("ts").cast("date").alias("d")).agg(F.countDistinct("user_id").alias("n"))
    item = F.struct(F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("T00:00:00.000Z")).alias("intervalStart"),
                    F.col("n").alias("count"))
    return days.select(F.struct(F.array(item).alias("items")).alias("resource"))


def stored_metrics(t: Tables) -> DataFrame:
    """The stored metric table before its refresh: events per day."""
    return t.events.groupBy(F.col("ts").cast("date").alias("data")).agg(
        F.count(F.lit(1)).alias("ativos"), F.count_if(F.col("event_type") == "error").alias("engajados"))


# --- calendar, capacity, campaigns, calls --------------------------------------------------------

def fx_table(t: Tables) -> DataFrame:
    """Calendar with one row per order date; attributes are unknown, rates come from order prices."""
    rates = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("Data")).agg(
        (F.max("o_totalprice") / 1000).alias("CotacaoUSD"), (F.min("o_totalprice") / 1000).alias("CotacaoEUR"),
        (F.max("o_totalprice") / 2000).alias("CotacaoGBP"))
    numbers = ("Ano", "MesNum", "AnoMesINT", "Trimestre", "Semana", "DiaSemana")
    names = ("Ano NomeMes MesAbre MesAno MesNum AnoMesINT InicioMes Trimestre TrimestreAbreviado Bimestre "
             "Semestre Semana DiaSemana NomeDia").split()
    return rates.select("Data", *[F.lit(None).cast("int" if n in numbers else "string").alias(n) for n in names],
                        "CotacaoUSD", "CotacaoEUR", "CotacaoGBP",
                        F.lit(None).cast("timestamp_ntz").alias("DataAtualizacao"))


def quote_response(t: Tables) -> DataFrame:
    def bid(c: Column) -> Column:
        return F.struct(text(c.cast("decimal(18,2)")).alias("bid"))

    return t.orders.agg(bid(F.max("o_totalprice")).alias("USDBRL"), bid(F.min("o_totalprice")).alias("EURBRL"),
                        bid(F.max("o_totalprice") / 2).alias("GBPBRL"))


def capacity_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(capacity, installers, city codes, stored rows). Installers in debt are unknown to the list."""
    setup = t.supplier.select(F.col("s_suppkey").alias("id_installer"), F.col("s_nationkey").alias("id_city"),
                              F.floor(F.abs("s_acctbal")).cast("int").alias("capacity"))
    installer = t.supplier.filter(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("id"),
                                                                 F.col("s_name").alias("name"))
    city = t.nation.select(F.col("n_nationkey").alias("id"), text("n_nationkey").alias("city_code"))
    stored = (t.supplier.join(t.nation.filter(F.col("n_regionkey") == 1), F.col("s_nationkey") == F.col("n_nationkey"))
              .select(F.when(F.col("s_acctbal") > 0, F.concat(
                  text("s_nationkey"), F.col("s_name"), text(F.floor(F.abs("s_acctbal")).cast("int")))).alias("concat")))
    return setup, installer, city, stored


def campaign_rows(t: Tables) -> DataFrame:
    """Campaign sends whose city is a part name, misspelled according to the part type."""
    name, words = F.col("p_name"), F.split("p_name", " ")
    kind = F.col("p_type")
    city = (F.when(F.col("p_size") == 50, None)
            .when(kind == "STANDARD", F.concat(F.get(words, F.lit(1)), F.lit("  "), F.get(words, F.lit(0))))
            .when(kind == "SMALL", F.expr("substring(p_name, 1, length(p_name) - 2)"))
            .when(kind == "LARGE", F.translate(name, "aeiou", ""))
            .when(kind == "PROMO", F.upper(name))
            .when(kind == "MEDIUM", F.concat(name, F.lit(" "), F.lower("p_brand")))
            .otherwise(name))
    sent = F.when(F.col("p_size") < 20, F.concat(F.lit("2025-08-"), F.lpad(text(F.col("p_size") + 1), 2, "0"))) \
        .when(F.col("p_size") < 40, F.concat(F.lit("09/"), F.lpad(text(F.col("p_size") - 10), 2, "0"), F.lit("/2025"))) \
        .otherwise("2025-10-01T08:30:00")
    return t.part.select(F.concat(F.lit("55"), text(F.col("p_size"))).alias("phone"), sent.alias("date"),
                         F.col("p_brand").alias("campaignName"), city.alias("city"), F.col("p_type").alias("status"),
                         F.lit("parts").alias("origin"), F.concat(F.lit("c"), text("p_size")).alias("id"))


def official_parts(t: Tables) -> DataFrame:
    """Official names; several codes per name, as for a name that exists in several states."""
    return t.part.select(F.concat(F.col("p_type"), F.lit(":"), F.col("p_name")).alias("cIBGE"),
                         F.col("p_name").alias("nome_cidade")).distinct()


def listed_parts(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_type").isin("SMALL", "LARGE") & (F.col("p_size") > 10)).select(
        F.concat(F.col("p_type"), F.lit(":"), F.col("p_name")).alias("cIBGE")).distinct()


def call_records(t: Tables) -> DataFrame:
    """One call per document; every line of its text is one attendance."""
    lines = F.split("text", "\n")
    visit = F.transform(lines, lambda x, i: F.struct(
        x.alias("tipo"), F.length(x).cast("bigint").alias("tempoEspera"),
        (i * 1000).cast("bigint").alias("tempoAtendimento"), (F.length(x) > 60).alias("atendidaAte60Seg"),
        (F.length(x) < 10).alias("desistenciaAte60Seg"), (i > 5).alias("atendidaPos60Seg"),
        F.lit(None).cast("boolean").alias("desistenciaPos60Seg")))
    caller = F.struct(
        F.col("source").alias("origem"), (F.col("n_chars") > 500).alias("cadastroLocalizadoEAF"),
        F.upper("lang").alias("uf"), F.lit(None).cast("string").alias("ddd"),
        text("n_chars").alias("codigoCidadeIBGE"), text("doc_id").alias("cpf"),
        F.lit("['x']").alias("cep"), F.concat(F.lit("55"), text("doc_id")).alias("telefone"))
    start = F.when(F.col("lang") == "fr", "bad").otherwise(
        F.concat(F.lit("2024-01-"), F.lpad(text(F.col("n_chars") % 28 + 1), 2, "0"), F.lit("T08:15:30")))
    return t.documents.select(
        text("doc_id").alias("id"), start.alias("dataHoraInicio"), F.lit("2024-02-01 10:00:00").alias("dataHoraFim"),
        visit.alias("atendimento"), F.when(F.col("lang") != "de", caller).alias("interlocutor"),
        F.lit("csv").alias("csv"))
