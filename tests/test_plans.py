"""Report tables on small hand-made inputs, with the awkward rows."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from fieldmart.plans import (call_log, campaigns, capacity, channels, chatbot, demand_alerts, duplicate_orders,
                             exchange_rates, indicators, login_report, maintenance, order_export, pending_orders,
                             phase_status, reconciliation)
from fieldmart.sources import schemas

NOW = dt.datetime(2025, 3, 10, 12, 0)
TODAY = NOW.date()


def ago(**kwargs):
    return NOW - dt.timedelta(**kwargs)


# --- documents ------------------------------------------------------------------------------------

def service(number=None, status=None, kind=None, registered=None, ended=None, **order):
    reply = {"appointmentEndTime": ended} if ended else None
    return {"serviceOrder": {"number": number, "status": status, "type": kind, "registeredAt": registered,
                             "installerResponse": reply, **order}}


def docs(spark, *documents):
    return spark.createDataFrame(list(documents), schemas.TICKET)


def test_pending_orders(spark, rows):
    df = docs(
        spark,
        {"createdBy": None, "services": [service("1", "OPEN", "T", ago(hours=5), schedules=[]), service("2", "DONE", "T", ago(hours=9))]},
        {"createdBy": "me", "services": [service("3", "PENDING", None, ago(hours=4, minutes=59)),
                                         service(None, "VALIDATION", None, ago(days=1), schedules=[{"installer": "I"}], failureReason="f")]},
        {"services": None}, {"services": []})
    assert rows(pending_orders.pending_orders(df, NOW)) == sorted([
        ("1", "T", "OPEN", "2025-03-10 07:00:00", None, "NULL", "NULL"),
        ("NULL", "NULL", "VALIDATION", "2025-03-09 12:00:00", "I", "f", "me")], key=repr)


def test_maintenance_monitor(spark, rows):
    fix = maintenance.MAINTENANCE
    old, older, fresh = ago(days=91), ago(days=200, hours=1), ago(days=90)
    df = docs(
        spark,
        {"createdAt": ago(hours=1), "customer": {"cpf": "9"}, "services": [
            service("OS-1", "X", fix, ago(hours=2)), service("2", "X", "B", None, fresh), service("3", "X", "B", None, older),
            service("4", "X", fix, None, old), service("", "X", fix)]},
        {"createdAt": ago(hours=1), "services": [service("5", "X", fix, None, old)]},
        {"createdAt": ago(hours=4), "services": [service("6", "X", fix, None, old)]},
        {"createdAt": ago(hours=1), "services": [service("7", "X", "B", None, old)]},
        {"createdAt": ago(hours=1), "services": [service("8", "X", fix), service("9", "X", "B", None, fresh)]})
    stamp = "%Y-%m-%d %H:%M:%S"
    assert rows(maintenance.maintenance_monitor(df, NOW)) == sorted([
        ("1", ago(hours=2).strftime(stamp), "9", "3", "B", older.strftime(stamp), 200),
        ("4", "NULL", "9", "3", "B", older.strftime(stamp), 200),
        ("5", "NULL", "NULL", "5", fix, old.strftime(stamp), 91)], key=repr)


def test_maintenance_reads_only_needed_columns(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs(spark, {"createdAt": ago(hours=1), "services": [service("1", "X", "B")]}).write.parquet(path)
    df = maintenance.maintenance_monitor(spark.read.parquet(path), NOW)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("ReadSchema"):]
    assert "GreaterThanOrEqual(createdAt" in plan and "Exchange hash" not in plan
    assert "appointmentEndTime" in scan
    for name in ("protocol", "cadUnico", "schedules", "tabulation", "evidence", "status"):
        assert name not in scan


def test_reconcile_status(spark, rows):
    df = docs(
        spark,
        {"createdAt": ago(minutes=5), "services": [service("OS-1", "A"), service("2", "A"), service("3", "A"), service("4", "A"),
                                                   service("", "A"), service("5", None)]},
        {"createdAt": ago(hours=2), "services": [service("6", "A")]}, {"createdAt": None, "services": [service("7", "A")]})
    warehouse = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", None)],
                                      "service_order_number string, service_order_status string")
    got = reconciliation.reconcile_status(df, warehouse, NOW)
    at = "2025-03-10 11:55:00"
    assert rows(got.diverging) == sorted([("2", "A", "B", at), ("3", "A", None, at)], key=repr)
    assert rows(got.missing) == [("4", "A", at)] and tuple(got.counters.first()) == (4, 2, 1)


def test_order_export(spark, rows):
    df = docs(
        spark,
        {"_id": "b", "createdAt": ago(days=2), "lastModifiedDate": NOW, "customer": {
            "name": "D'Ávila", "address": {"streetName": "Rua", "city": "C"}, "contacts": [{"value": "p1"}, {"value": "p2"}]},
         "services": [service("8", "X"), {**service("7", "OPEN", "T", NOW, None, schedules=[{"date": NOW, "installer": "I"}]),
                                          "protocol": {"number": "P-5"}}]},
        {"_id": "c", "createdAt": ago(days=2), "services": [service(), service("7", "TIE", "T", NOW)]},
        {"_id": "a", "createdAt": ago(days=1), "services": [service("7", "LATER")]})
    ids = spark.createDataFrame([("7",), ("99",)], "number string")
    found, absent = order_export.order_export(ids, df, NOW)
    assert len(found.columns) == 36 and found.columns[:4] == order_export.ROW_START
    row = found.first()
    assert (row["protocol_number"], row["service_order_status"], row["installer"], row["customer_phone"],
            row["failure_reason"], row["customer_full_address"]) == (
        "5", "OPEN", "I", "p1", "N/A", "Rua, None - None - None - None , C-None")
    assert rows(absent) == [("99",)]
    text, _ = order_export.order_export(ids, df, NOW, "update_sql", table="t")
    line = text.first()["value"]
    assert line.startswith("UPDATE t SET [protocol_number] = '5', [protocol_created_at] = NULL, [protocol_channel] = NULL, ")
    assert "[customer_name] = 'D''Ávila'" in line and "[synched_at] = '2025-03-10 12:00:00'" in line
    assert line.endswith(" WHERE [service_order_number] = '7';") and line.count("[") == 37
    with pytest.raises(ValueError):
        order_export.order_export(ids, df, NOW, "xml")


# --- city alerts ----------------------------------------------------------------------------------

TICKET_COLUMNS = ("IBGE string, IDdoticket string, Tipo string, Status string, `StatusdaInstalação` string, "
                  "`MotivodocontatoInstalação` string, `Horadacriação` date, DataHoraAgendamento date")


def booking(city, days, status="IN_PROGRESS", reason="Agendamento", scheduled=1):
    when = TODAY + dt.timedelta(days=scheduled) if scheduled is not None else None
    return (city, "t", "Service Task", status, None, reason, TODAY - dt.timedelta(days=days), when)


def alert_inputs(spark, tickets, months=(1,), homes=100, families=100, ledger=()):
    cities = spark.createDataFrame([(str(n), "N", "PE", f"C{n}", "1", homes) for n in range(1, len(months) + 1)],
                                   "cIBGE string, regiao string, uf string, nome_cidade string, fase string, domicilios_particulares long")
    registry = spark.createDataFrame([(n, families) for n in range(1, len(months) + 1)], "ibge int, `CODIGO FAMILIAR` long")
    starts = [(n, None if m is None else (dt.date(2025, 3, 1) - dt.timedelta(days=30 * m)) if m >= 0 else dt.date(2025, 5, 1))
              for n, m in enumerate(months, 1)]
    campaigns_ = spark.createDataFrame(starts, "`cód. IBGE` int, `INÍCIO DE CAMPANHA` date")
    known = spark.createDataFrame(list(ledger), "ibge string, calculo_prevencao string")
    return spark.createDataFrame(tickets, TICKET_COLUMNS), cities, registry, campaigns_, known


def test_city_counts_bands(spark):
    days = [2, 3, 9, 10, 16, 17]
    counts = demand_alerts.city_counts(spark.createDataFrame(
        [booking("1", d) for d in days] + [booking("1", 5, scheduled=None), booking("1", 5, "CANCELLED"),
                                           booking("1", 5, reason="Outro"), booking("1", 12, scheduled=-1), booking("", 12)],
        TICKET_COLUMNS), NOW)
    row = counts.filter("ibge = '1'").first()
    assert (row["new_agendados_semana_atual"], row["new_agendados_semana_anterior"]) == (2, 3)
    assert (row["backlog_semana_atual"], row["backlog_futuro_semana_anterior"]) == (1, 3)
    assert counts.filter("ibge = ''").first()["new_agendados_semana_anterior"] == 0


def test_demand_alerts_once(spark, rows):
    tickets = [booking("1", 5)] * 60 + [booking("1", 12)] * 5
    inputs = alert_inputs(spark, tickets)
    alerts = demand_alerts.demand_alerts(*inputs, NOW)
    row = alerts.first()
    assert (row["calculo_prevencao"], row["nivel_calculo_prevencao"], row["variacao_agendamentos_semana"]) == ("Alerta - Amarelo", 2, 11.0)
    assert (row["porcentagem_de_risco_semana_anterior"], row["porcentagem_de_risco_semana_atual"]) == (0.05, 0.65)
    assert len(demand_alerts.alert_batch(alerts).columns) == 12
    assert rows(demand_alerts.ledger_rows(alerts, NOW)) == [("1", "C1", "Alerta - Amarelo", 2, "10-03-2025")]
    assert rows(demand_alerts.run_record(alerts, NOW)) == [(dt.datetime(2025, 3, 10, 9, 0), 1)]
    again = demand_alerts.demand_alerts(*inputs[:4], alerts.select("ibge", "calculo_prevencao"), NOW)
    assert again.count() == 0 and demand_alerts.run_record(again, NOW).count() == 0


@pytest.mark.parametrize("months,fixed,expected", [(1, False, 1), (5, False, 0), (5, True, 1), (12, False, 1), (None, False, 1), (-1, False, 0)])
def test_curve_decides(spark, months, fixed, expected):
    inputs = alert_inputs(spark, [booking("1", 5)] * 60, (months,))
    assert demand_alerts.demand_alerts(*inputs, NOW, fix_declining=fixed).count() == expected


def test_city_without_current_bookings_has_no_households(spark):
    inputs = alert_inputs(spark, [booking("1", 12)] * 3, (1, 1))
    got = {r["ibge"]: r for r in demand_alerts.city_indicators(*inputs[:4], NOW).collect()}
    assert (got["1"]["qtd_domicilios"], got["1"]["iba_semana_atual"], got["2"]["iba_semana_atual"]) == (0, 3, 0)


# --- indicators -----------------------------------------------------------------------------------

def test_indicator_history(spark, rows):
    def row(status, created, scheduled=None, result=None, ticket="1", reason="Agendamento"):
        return ("I", "1", "PE", "C", "F", reason, status, result, TODAY - dt.timedelta(days=created),
                None if scheduled is None else TODAY + dt.timedelta(days=scheduled), ticket)

    df = spark.createDataFrame([
        row("IN_PROGRESS", 0), row("IN_PROGRESS", 1, -1), row("IN_PROGRESS", 1, 0), row("INSTALLED", 3, result="Instalada"),
        row("INSTALLED", 3, result="Instalada", reason="Outro"), row("INSTALLED", 3, result="Improdutiva", ticket="5"),
        row("INSTALLED", 3, ticket="6"), row("BACKOFFICE", 3, ticket="7"), row("BACKOFFICE", 3, ticket="7"), row("IN_AUDITING", 3),
    ], "Instaladora string, ibge string, UF string, Municipio string, Fase string, `MotivodocontatoInstalação` string, "
       "Status string, `StatusdaInstalação` string, `Horadacriação` date, DataHoraAgendamento date, IDdoticket string")
    history, counts = indicators.indicator_history(df, NOW)
    assert history.columns == ["instaladora", "ibge", "uf", "municipio", "fase", "motivo_contato", "regra", "quantidade", "data_registro"]
    assert sorted((r["regra"], r["quantidade"]) for r in history.collect()) == [
        ("Backlog", 1), ("Criados", 1), ("Em aberto", 1), ("Em aberto", 2), ("Instalados", 1)]
    assert tuple(counts.first()) == (0, 1, 1, 1, "10-03-2025")


# --- duplicates -----------------------------------------------------------------------------------

def test_duplicate_orders(spark, rows):
    ticket = spark.createDataFrame([
        ("F1", "4", "Agendamento", "Instalada", "10", "Ana", "p1", 1, NOW), ("F2", "3", "Agendamento", "Instalada", "10", "B", "p1", 1, NOW),
        ("F3", "5", "Contestação", "Instalada", "10", "C", "p1", 1, NOW), ("F4", "5", None, "Instalada", "10", "D", "p1", 1, NOW),
        ("2025009", "5", "Outro", "Instalada", "11", "E", "p2", 9, None)],
        "IDdoticket string, Status string, `MotivodocontatoInstalação` string, `StatusdaInstalação` string, B_IBGE string, "
        "B_NOME string, B_CPF string, Grupo int, `Horadetérminodocompromisso` timestamp_ntz")
    order = ("OPEN", "Agendamento", None, NOW, NOW, "N")
    crm = spark.createDataFrame([
        ("2025001", *order, "p1", " ", "12-345", "crew"), ("2024001", *order, "p1", None, None, "crew"),
        ("2025002", "CANCELLED_X", *order[1:], "p1", None, None, "crew"), ("2025003", *order, "p1", "77", None, "crew"),
        ("2025009", *order, "p2", None, None, "crew"), ("2025010", *order, None, None, None, "crew")],
        "service_order_number string, service_order_status string, service_order_type string, "
        "installer_response_classification string, service_order_created_at timestamp_ntz, schedule_date_time timestamp_ntz, "
        "customer_name string, customer_cpf string, customer_ibge string, customer_postal_code string, installer string")
    groups = spark.createDataFrame([(1, "G")], "id int, instaladora string")
    cities = spark.createDataFrame([("10", "F1")], "cIBGE string, fase string")
    postal = spark.createDataFrame([("12345 ", "88"), ("1-2345", "")], "postal_code string, IBGE string")
    pairs = duplicate_orders.duplicate_orders(ticket, crm, groups, cities, postal)
    assert len(pairs.columns) == 17
    got = [(r["OsFresh"], r["OsCRM_EAF"], r["IBGE_CRM_EAF"], r["InstaladoraFresh"], r["FaseCidade"]) for r in pairs.collect()]
    assert sorted(got, key=repr) == sorted([("F1", "2025001", "88", "G", "F1"), ("F1", "2025001", None, "G", "F1"),
                                            ("F1", "2025003", "77", "G", "F1")], key=repr)
    ledger = spark.createDataFrame([], "OsFresh string, OsCRM_EAF string")
    first = duplicate_orders.new_duplicates(pairs, ledger, n=1, dedupe_batch=True)
    left = duplicate_orders.new_duplicates(pairs, first.select("OsFresh", "OsCRM_EAF"), n=1)
    assert (first.first()["OsCRM_EAF"], left.first()["OsCRM_EAF"]) == ("2025001", "2025003")
    done = first.select("OsFresh", "OsCRM_EAF").union(left.select("OsFresh", "OsCRM_EAF"))
    assert duplicate_orders.new_duplicates(pairs, done, n=1).count() == 0
    assert rows(duplicate_orders.duplicate_run_record(pairs, NOW)) == [(dt.datetime(2025, 3, 10, 9), 3)]


# --- campaigns, chatbot, channels, calls ----------------------------------------------------------

def test_campaigns(spark, rows):
    cities = spark.createDataFrame([("1", "São Paulo"), ("2", "Bom Jesus"), ("3", "Bom Jesus"), ("4", "Fora")], "cIBGE string, nome_cidade string")
    extra = spark.createDataFrame([("1",), ("2",), ("3",), ("3",)], "cIBGE string")
    sent = spark.createDataFrame([
        ("p1", "2025-08-01", "Paulo São"), ("p1", "2025-08-01", "Paulo São"), ("p2", "08/02/2025", "bom jesus"),
        ("p3", "2025-08-03", "XQZW"), ("p4", "2025-08-04", None)], "phone string, date string, city string")
    clean, low = campaigns.campaign_city_normalisation(sent, cities, extra)
    assert clean.columns == ["phone", "date", "city", "ibge"]
    assert rows(clean) == sorted([("p1", dt.date(2025, 8, 1), "São Paulo", "1"), ("p2", dt.date(2025, 8, 2), "Bom Jesus", "2"),
                                  ("p2", dt.date(2025, 8, 2), "Bom Jesus", "3")], key=repr)
    assert [r["phone"] for r in low.collect()] == ["p3"]
    single, _ = campaigns.campaign_city_normalisation(sent, cities, extra, dedupe_dim=True)
    assert single.count() == 2


def test_chatbot(spark, rows):
    records = spark.createDataFrame([
        {"id": "1", "phone": "a", "date": "2025-03-01T10:00:01", "category": "x", "crm": {"uuid": "1", "name": "n"}},
        {"id": "2", "phone": "a", "date": "2025-03-01T10:00:59", "category": "x", "crm": {"uuid": "2", "name": "n"}},
        {"id": "3", "phone": "a", "date": "broken", "category": None, "crm": None},
        {"id": "4", "phone": "a", "date": "2024-03-01T10:00:00", "category": "y", "crm": None}], schemas.CHATBOT_EVENT)
    events = chatbot.chatbot_events(records, NOW)
    assert events.columns == ["phone", "date", "channel", "category", "action", "status", "protocol", "name"]
    assert sorted((str(r["date"]), r["name"]) for r in events.collect()) == [("2025-03-01 10:00", "n"), ("None", None)]
    assert chatbot.chatbot_events(records).count() == 3
    assert [tuple(r) for r in chatbot.top_categories(chatbot.chatbot_events(records)).collect()] == [("x", 1), ("y", 1)]


def test_channels(spark, rows):
    day = dt.date(2025, 3, 8)
    active = spark.createDataFrame([(day, 5), (day + dt.timedelta(days=1), 6)], "intervalStart date, ativos long")
    engaged = spark.createDataFrame([(day, 2), (dt.date(2025, 1, 1), 9)], "intervalStart date, engajados long")
    fresh = channels.join_series(active, engaged)
    assert rows(fresh) == sorted([(day, 5, 2), (day + dt.timedelta(days=1), 6, None)], key=repr)
    stored = spark.createDataFrame([(dt.date(2025, 3, 7), 1, 1), (day, 9, 9), (dt.date(2025, 3, 10), 9, 9)],
                                   "data date, ativos long, engajados long")
    once = channels.refreshed_metrics(stored, fresh, TODAY)
    assert [r[1] for r in once.orderBy("data").collect()] == [1, 5, 6]
    assert rows(channels.refreshed_metrics(once, fresh, TODAY)) == rows(once)


def test_call_log(spark):
    visit = {"tipo": "fila", "tempoEspera": 1, "tempoAtendimento": 2, "atendidaAte60Seg": True, "desistenciaAte60Seg": False}
    df = spark.createDataFrame([
        {"id": "1", "dataHoraInicio": "2025-03-09T08:00:00", "dataHoraFim": "bad", "csv": "x", "atendimento": [visit, {**visit, "tipo": "['o']"}],
         "interlocutor": {"origem": "web", "cadastroLocalizadoEAF": True, "codigoCidadeIBGE": "26", "cpf": "1"}},
        {"id": "2", "atendimento": [], "interlocutor": None}], schemas.CALL)
    got = {r["id"]: r for r in call_log.call_log(df, NOW).collect()}
    a, b = got["1"], got["2"]
    assert (a["dataHoraInicio"], a["dataHoraFim"], a["data_atualizacao"]) == (dt.datetime(2025, 3, 9, 8), None, "10-03-2025")
    assert (a["tipo"], a["tempoEspera_ms"], a["atendidaAte60Seg"], a["desistenciaPos60Seg"]) == ("fila, o", "1, 1", "True, True", "None, None")
    assert (a["cpf"], a["uf"], a["cadastroLocalizadoEAF"]) == ("26", "None", "True")
    assert (b["tipo"], b["cpf"], b["origem"]) == ("", None, None)
    assert call_log.call_log(df, NOW, fix_cpf=True).filter("id = '1'").first()["cpf"] == "1"
    assert "csv" not in a.asDict()


# --- logins, rates, capacity, registry ------------------------------------------------------------

def test_login_report(spark, rows):
    day = dt.datetime(2025, 3, 9)
    df = spark.createDataFrame([
        (1, "ana", "LOGIN", day), (2, "ana", "LOGOUT", day + dt.timedelta(hours=2, seconds=3)), (3, "ana", "LOGIN", day + dt.timedelta(hours=20)),
        (4, "ana", "LOGOUT", day + dt.timedelta(hours=24)), (5, "Bot X", "LOGIN", day), (6, None, "LOGIN", day + dt.timedelta(hours=5))],
        "id int, username string, event string, loginTime timestamp_ntz")
    got = login_report.login_report(df, day.date(), ignored=["bot x"])
    assert got.columns == ["usuario", "data", "horario entrada", "horario saida"]
    assert rows(got) == sorted([("ana", "2025-03-08", "21:00:00", "23:00:03"), ("ana", "2025-03-09", "17:00:00", "N/A"),
                                ("NULL", "2025-03-09", "02:00:00", "N/A")], key=repr)


def fx(spark, *data):
    return spark.createDataFrame(list(data), "Data date, Ano int, CotacaoUSD double, CotacaoEUR double, CotacaoGBP double, DataAtualizacao timestamp_ntz")


def test_exchange_rates(spark, rows):
    quote = spark.createDataFrame([(5.0, 6.0, 7.0)], "CotacaoUSD double, CotacaoEUR double, CotacaoGBP double")
    table = fx(spark, (dt.date(2025, 3, 7), 2025, 1.0, 1.0, 1.0, None), (dt.date(2025, 3, 8), None, 2.0, 2.0, 2.0, NOW))
    new = exchange_rates.fx_calendar(table, quote, NOW)
    assert [(r["Data"].day, r["CotacaoUSD"], r["DiaSemana"]) for r in new.orderBy("Data").collect()] == [(9, 5.0, 7), (10, 5.0, 1)]
    repaired = exchange_rates.refreshed_calendar(table, exchange_rates.fx_calendar(table, quote, NOW, repair_attributes=True))
    assert [(r["Data"].day, r["Ano"], r["CotacaoUSD"]) for r in repaired.orderBy("Data").collect()] == [
        (7, 2025, 1.0), (8, 2025, 2.0), (9, 2025, 5.0), (10, 2025, 5.0)]
    assert exchange_rates.fx_calendar(repaired, quote, NOW).count() == 0
    absent = exchange_rates.fx_insert_if_absent(table, quote, NOW)
    assert rows(absent) == [(TODAY, 5.0, 6.0, 7.0, NOW)]
    assert exchange_rates.fx_insert_if_absent(repaired, quote, NOW).count() == 0


def test_capacity(spark, rows):
    setup = spark.createDataFrame([(1, 1, 5), (2, 1, 6), (9, 1, 7), (1, 9, 8)], "id_installer int, id_city int, capacity int")
    installer = spark.createDataFrame([(1, "A"), (2, "B")], "id int, name string")
    city = spark.createDataFrame([(1, "26")], "id int, city_code string")
    stored = spark.createDataFrame([("26A5",)], "concat string")
    got = capacity.new_capacity_rows(setup, installer, city, stored, NOW)
    assert rows(got) == sorted([("26", "B", "6", "26B6", TODAY), ("26", None, "7", None, TODAY), (None, "A", "8", None, TODAY)], key=repr)
    later = stored.union(got.select("concat"))
    assert capacity.new_capacity_rows(setup, installer, city, later, NOW).count() == 0


def test_mark_installed(spark, rows):
    columns = "CPF string, CodFamilia string, Status string, `StatusdaInstalação` string, `MotivodocontatoInstalação` string"
    done = ("INSTALLED", "Executada procedente", "Contestação")
    a = spark.createDataFrame([("1", "x", *done), ("2", " 20 ", *done), ("3", "30", "OPEN", *done[1:])], columns)
    b = spark.createDataFrame([("2", "20", *done), (None, None, *done)], columns)
    registry = spark.createDataFrame([("1", 10, "P", "P"), ("1", 11, None, "P"), ("2", 20, None, "P"), ("3", 30, "P", "P"), (None, None, "P", "P")],
                                     "cpf string, cod_familia long, status_cpf string, status_codfamilia string")
    once = phase_status.mark_installed(a, b, registry)
    assert rows(once) == sorted([("1", 10, "Instalado", "P"), ("1", 11, "Instalado", "P"), ("2", 20, None, "Instalado"),
                                 ("3", 30, "P", "P"), (None, None, "P", "P")], key=repr)
    assert rows(phase_status.mark_installed(a, b, once)) == rows(once)


def test_a_person_id_that_stands_for_many_makes_no_pairs_and_is_reported(spark, rows):
    """A placeholder on 3000 rows of both systems would make nine million pairs."""
    ticket = spark.range(3005).select(
        F.concat(F.lit("F"), "id").alias("IDdoticket"), F.lit("4").alias("Status"), F.lit("Agendamento").alias("MotivodocontatoInstalação"),
        F.lit("Instalada").alias("StatusdaInstalação"), F.lit("10").alias("B_IBGE"), F.lit("N").alias("B_NOME"),
        F.when(F.col("id") < 3000, "").when(F.col("id") < 3004, F.col("id").cast("string")).alias("B_CPF"), F.lit(1).alias("Grupo"),
        F.lit(NOW).cast("timestamp_ntz").alias("Horadetérminodocompromisso"))
    crm = spark.range(3010).select(
        F.concat(F.lit("2025"), "id").alias("service_order_number"), F.lit("OPEN").alias("service_order_status"), F.lit("Agendamento").alias("service_order_type"),
        F.lit("x").alias("installer_response_classification"), F.lit(NOW).cast("timestamp_ntz").alias("service_order_created_at"),
        F.lit(NOW).cast("timestamp_ntz").alias("schedule_date_time"), F.lit("N").alias("customer_name"),
        F.when(F.col("id") < 3000, "").when(F.col("id") < 3008, (3000 + F.col("id") % 2).cast("string")).alias("customer_cpf"),
        F.lit(None).cast("string").alias("customer_ibge"), F.lit(None).cast("string").alias("customer_postal_code"), F.lit("crew").alias("installer"))
    groups = spark.createDataFrame([(1, "G")], "id int, instaladora string")
    cities = spark.createDataFrame([("10", "F1")], "cIBGE string, fase string")
    postal = spark.createDataFrame([], "postal_code string, IBGE string")
    pairs = duplicate_orders.duplicate_orders(ticket, crm, groups, cities, postal)
    assert sorted({(r["OsFresh"], r["CPF_Fresh"]) for r in pairs.collect()}) == [("F3000", "3000"), ("F3001", "3001")]
    assert pairs.count() == 8
    assert rows(duplicate_orders.crowded_people(ticket, crm)) == [("", 3000, 3000)]
    assert rows(duplicate_orders.crowded_people(ticket, crm, most_pairs=3)) == [("", 3000, 3000), ("3000", 1, 4), ("3001", 1, 4)]
    assert duplicate_orders.duplicate_orders(ticket, crm, groups, cities, postal, most_pairs=None).count() == 3000 * 3000 + 8
