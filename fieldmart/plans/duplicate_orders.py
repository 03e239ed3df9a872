"""People installed in the legacy system who have an open order in the new one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_filled, postal_key
from ..operators.filters import not_listed
from ..operators.joins import anti_join, crowded_keys, without_keys
from .demand_alerts import run_record

# Vocabulary of both systems.
CLOSED = ("4", "5")
DONE = "Instalada"
EXCLUDED_REASONS = (
    "Cobrança Indevida", "Contestação", "Manutenção", "Manutenção - Problema Técnico",
    "Manutenção - Técnico Não Compareceu", "Reclamação por problema técnico",
)
ORDER_TYPES = ("Agendamento de Instalação", "Agendamento")
ORDER_PREFIX, CANCELLED_PREFIX = "2025", "CANCELLED"
PAIR = ("OsFresh", "OsCRM_EAF")


# Pairs that one person may make. A person has a handful of orders; a placeholder (blank, 000...) can stand on
# any number of rows of both systems.
MOST_PAIRS = 10_000


def _sides(ticket: DataFrame, crm: DataFrame, order_prefix: str) -> tuple[DataFrame, DataFrame]:
    """Both sides, filtered and cut to the needed columns."""
    legacy = ticket.filter(
        F.col("Status").isin(*CLOSED) & not_listed("MotivodocontatoInstalação", EXCLUDED_REASONS)
        & (F.col("StatusdaInstalação") == DONE)
    ).select(
        F.col("IDdoticket").alias("OsFresh"), F.col("StatusdaInstalação").alias("StatusInstalacaoFresh"),
        F.col("B_IBGE").alias("IBGE_Fresh"),
        F.col("Horadetérminodocompromisso").cast("date").alias("DataInstalacaoFresh"),
        F.col("B_NOME").alias("NomeFresh"), F.col("B_CPF").alias("CPF_Fresh"), F.col("Grupo").alias("_group"),
    )
    orders = crm.filter(
        F.col("service_order_number").startswith(order_prefix)
        & ~F.col("service_order_status").startswith(CANCELLED_PREFIX)
        & F.col("service_order_type").isin(*ORDER_TYPES)
    ).select(
        F.col("service_order_number").alias("OsCRM_EAF"), F.col("service_order_status").alias("StatusCRM_EAF"),
        F.col("installer_response_classification").alias("StatusInstalacaoCRM_EAF"),
        F.col("service_order_created_at").cast("date").alias("CriacaoCRM_EAF"),
        F.col("schedule_date_time").cast("date").alias("DataAgendamentoCRM_EAF"),
        F.col("customer_name").alias("NomeCRM_EAF"), F.col("installer").alias("InstaladoraCRM_EAF"),
        F.col("customer_cpf").alias("_person"), F.col("customer_ibge").alias("_ibge"),
        postal_key("customer_postal_code").alias("_postal"),
    )
    return legacy, orders


def crowded_people(ticket: DataFrame, crm: DataFrame, order_prefix: str = ORDER_PREFIX, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``person, n_legacy, n_orders`` of the person ids that ``duplicate_orders`` leaves out and somebody has to look at."""
    legacy, orders = _sides(ticket, crm, order_prefix)
    found = crowded_keys(legacy, orders, "CPF_Fresh", "_person", most_pairs)
    return found.select(F.col("key").alias("person"), F.col("n_left").alias("n_legacy"), F.col("n_right").alias("n_orders"))


def duplicate_orders(ticket: DataFrame, crm: DataFrame, groups: DataFrame, cities: DataFrame, postal: DataFrame,
                     order_prefix: str = ORDER_PREFIX, most_pairs: int | None = MOST_PAIRS) -> DataFrame:
    """Every (legacy ticket, new order) pair of one person, with installer, city phase and city code.

    Both sides are filtered and cut to the needed columns before they meet on the person. A person id that would
    make more than ``most_pairs`` pairs makes none and is listed by ``crowded_people``; None sets no limit.
    """
    legacy, orders = _sides(ticket, crm, order_prefix)
    if most_pairs is not None:
        crowded = crowded_keys(legacy, orders, "CPF_Fresh", "_person", most_pairs)
        legacy = without_keys(legacy, "CPF_Fresh", crowded)
    installers = groups.select(F.col("id").alias("_group"), F.col("instaladora").alias("InstaladoraFresh"))
    phases = cities.select(F.col("cIBGE").alias("IBGE_Fresh"), F.col("fase").alias("FaseCidade"))
    codes = postal.select(postal_key("postal_code").alias("_postal"), F.col("IBGE").alias("_postal_ibge"))

    pairs = legacy.join(orders, (F.col("CPF_Fresh") == F.col("_person"))
                        & (F.col("OsFresh") != F.col("OsCRM_EAF")))
    full = (pairs.join(installers, "_group", "left").join(phases, "IBGE_Fresh", "left")
            .join(codes, "_postal", "left"))
    # The columns of the report.
    return full.select(
        "OsFresh", "StatusInstalacaoFresh", "IBGE_Fresh", "DataInstalacaoFresh", "InstaladoraFresh",
        "NomeFresh", "CPF_Fresh", "OsCRM_EAF", "StatusCRM_EAF", "StatusInstalacaoCRM_EAF", "CriacaoCRM_EAF",
        "DataAgendamentoCRM_EAF", "NomeCRM_EAF", first_filled("_ibge", "_postal_ibge").alias("IBGE_CRM_EAF"),
        "InstaladoraCRM_EAF", F.col("CPF_Fresh").alias("CPF_CRM_EAF"), "FaseCidade",
    )


def new_duplicates(pairs: DataFrame, ledger: DataFrame, n: int | None = None,
                   dedupe_batch: bool = False) -> DataFrame:
    """Pairs that were never alerted; with ``n`` the first n of them in pair order, the rest stay
    due for the next run."""
    fresh = anti_join(pairs, ledger, PAIR, dedupe_batch)
    return fresh if n is None else fresh.orderBy(*PAIR).limit(n)


def duplicate_run_record(new_rows: DataFrame, as_of) -> DataFrame:
    return run_record(new_rows, as_of, "qtd_alertas")
