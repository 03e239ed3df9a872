"""Weekly demand and risk per city, the colour alert, and the alert-once ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import as_col, day, day_text, moment, shift_hours, try_date
from ..functions.risk import (blended_risk, colour_by_curve, colour_level, growth, lifecycle_curve,
                              months_crossed, safe_ratio)
from ..operators.aggregates import counts_when
from ..operators.filters import days_back, not_listed
from ..operators.joins import anti_join, fill_zero, left_chain

# Ticket vocabulary.
SERVICE_TASK, IN_PROGRESS, INSTALLED, DONE = "Service Task", "IN_PROGRESS", "INSTALLED", "Instalada"
BOOKING_REASONS = ("Agendamento", "Interferência")
NOT_BOOKED = ("CANCELLED", "CANCELLED_NOT_DELIVERED", "INSTALLER_INTEGRATION_ERROR", "VALIDATION")
MIN_LEVEL = 2
LEDGER_KEY = ("ibge", "calculo_prevencao")


def open_task() -> Column:
    return ((F.col("Tipo") == SERVICE_TASK) & (F.col("Status") == IN_PROGRESS)
            & F.col("StatusdaInstalação").isNull())


def future_backlog(as_of) -> Column:
    return open_task() & (try_date("DataHoraAgendamento") >= day(as_of))


def overdue_backlog(as_of) -> Column:
    return open_task() & (try_date("DataHoraAgendamento") < day(as_of))


def installed() -> Column:
    return ((F.col("StatusdaInstalação") == DONE) & (F.col("Tipo") == SERVICE_TASK)
            & (F.col("Status") == INSTALLED) & F.col("MotivodocontatoInstalação").isin(*BOOKING_REASONS))


def booked() -> Column:
    return (F.col("MotivodocontatoInstalação").isin(*BOOKING_REASONS)
            & not_listed("Status", NOT_BOOKED) & F.col("DataHoraAgendamento").isNotNull())


def city_counts(tickets: DataFrame, as_of) -> DataFrame:
    """All eight ticket counts per city in one scan and one shuffle of per-city rows."""
    created = try_date("Horadacriação")
    week_ago, today = created <= F.date_sub(day(as_of), 10), created <= day(as_of)
    before = booked() & days_back(created, as_of, 16, 10) & (F.col("IBGE") != "")
    now = booked() & days_back(created, as_of, 9, 3)
    has_id = F.col("IDdoticket").isNotNull()
    counts = counts_when(tickets, ["IBGE"], {
        "backlog_futuro_semana_anterior": future_backlog(as_of) & week_ago,
        "backlog_futuro_semana_atual": future_backlog(as_of) & today,
        "backlog_semana_anterior": overdue_backlog(as_of) & week_ago,
        "backlog_semana_atual": overdue_backlog(as_of) & today,
        "instalados_semana_anterior": installed() & week_ago,
        "instalados_semana_atual": installed() & today,
        "new_agendados_semana_anterior": before & has_id,
        "new_agendados_semana_atual": now & has_id,
        "_booked_now": now,
    })
    return counts.withColumnRenamed("IBGE", "ibge")


def campaign_curves(campaigns: DataFrame, as_of) -> DataFrame:
    """``ibge, curva``; campaigns that have not started yet are left out."""
    start = F.col("`INÍCIO DE CAMPANHA`").cast("date")
    curve = lifecycle_curve(months_crossed(start, day(as_of)))
    return (campaigns.select(F.col("`cód. IBGE`").cast("string").alias("ibge"), curve.alias("curva"))
            .filter(F.col("curva").isNotNull()))


def city_indicators(tickets: DataFrame, cities: DataFrame, registry: DataFrame, campaigns: DataFrame,
                    as_of) -> DataFrame:
    """One row per city: totals of both weeks, bookings, registry count, households and curve.

    The household count is known only for cities with bookings this week; elsewhere it is 0.
    ``cities`` has one row per code.
    """
    dim = cities.select(F.col("cIBGE").alias("ibge"), "regiao", "uf", "nome_cidade", "fase",
                        "domicilios_particulares")
    known = registry.select(F.col("ibge").cast("string").alias("ibge"),
                            F.col("`CODIGO FAMILIAR`").alias("qtd_cadunico"))
    wide = left_chain(dim, [city_counts(tickets, as_of), known, campaign_curves(campaigns, as_of)], "ibge")
    homes = F.when(F.col("_booked_now") > 0, F.col("domicilios_particulares"))
    wide = fill_zero(wide.withColumn("qtd_domicilios", homes))

    def total(week: str) -> Column:
        return (F.col(f"instalados_semana_{week}") + F.col(f"backlog_semana_{week}")
                + F.col(f"backlog_futuro_semana_{week}")).alias(f"iba_semana_{week}")

    return wide.select("ibge", "regiao", "uf", "nome_cidade", "fase", total("anterior"), total("atual"),
                       "qtd_cadunico", "curva", "new_agendados_semana_anterior", "qtd_domicilios",
                       "new_agendados_semana_atual")


def with_risk(indicators: DataFrame, fix_declining: bool = False) -> DataFrame:
    """Growth, the four ratios, both risks, the colour and its level."""
    df = indicators.withColumn("variacao_agendamentos_semana",
                               growth("new_agendados_semana_anterior", "new_agendados_semana_atual"))
    for week in ("anterior", "atual"):
        df = df.withColumns({
            f"porcentagem_iba_cadunico_semana_{week}": safe_ratio(f"iba_semana_{week}", "qtd_cadunico"),
            f"porcentagem_iba_domicilios_semana_{week}": safe_ratio(f"iba_semana_{week}", "qtd_domicilios"),
        }).withColumn(f"porcentagem_de_risco_semana_{week}",
                      blended_risk(f"porcentagem_iba_domicilios_semana_{week}",
                                   f"porcentagem_iba_cadunico_semana_{week}"))
    colour = colour_by_curve("curva", "variacao_agendamentos_semana", "porcentagem_de_risco_semana_anterior",
                             "porcentagem_de_risco_semana_atual", fix_declining)
    return (df.withColumn("calculo_prevencao", colour)
            .withColumn("nivel_calculo_prevencao", colour_level("calculo_prevencao")))


def demand_alerts(tickets: DataFrame, cities: DataFrame, registry: DataFrame, campaigns: DataFrame,
                  ledger: DataFrame, as_of, fix_declining: bool = False) -> DataFrame:
    """Cities at level 2 or above whose (city, colour) pair was never alerted before."""
    risky = with_risk(city_indicators(tickets, cities, registry, campaigns, as_of), fix_declining)
    due = risky.filter(F.col("nivel_calculo_prevencao") >= MIN_LEVEL)
    return anti_join(due, ledger, LEDGER_KEY)


def alert_batch(alerts: DataFrame) -> DataFrame:
    """Rows of the current alert batch."""
    return alerts.select(
        F.col("ibge").alias("IBGE"), F.col("regiao").alias("Região"), F.col("uf").alias("UF"),
        F.col("nome_cidade").alias("Município"), F.col("fase").alias("Fase"), F.col("curva").alias("Curva"),
        F.col("new_agendados_semana_anterior").alias("Agendamentos Semana Anterior"),
        F.col("new_agendados_semana_atual").alias("Agendamentos Semana Atual"),
        F.col("variacao_agendamentos_semana").alias("% Variação Agendamentos Semana"),
        F.col("porcentagem_de_risco_semana_anterior").alias("% Risco Semana Anterior"),
        F.col("porcentagem_de_risco_semana_atual").alias("% Risco Semana Atual"),
        F.col("calculo_prevencao").alias("Cor do alerta"),
    )


def ledger_rows(alerts: DataFrame, as_of) -> DataFrame:
    """Rows that the alerts add to the ledger."""
    return alerts.select("ibge", "nome_cidade", "calculo_prevencao",
                         F.col("nivel_calculo_prevencao").alias("nivel_alerta"),
                         day_text(moment(as_of)).alias("data_alerta"))


def run_record(new_rows: DataFrame, as_of, count: str = "qtd_cidades") -> DataFrame:
    """One row with the shifted run time and the number of new rows; no row when there are none."""
    counted = new_rows.agg(F.count(F.lit(1)).alias(count)).filter(as_col(count) > 0)
    return counted.select(shift_hours(moment(as_of), -3).alias("dataHora_disparo"), count)
