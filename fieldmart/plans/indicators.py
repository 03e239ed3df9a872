"""Daily snapshot of ticket counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import day, day_text, moment
from ..operators.aggregates import approx_distinct_counts, distinct_counts, labelled_counts
from .demand_alerts import BOOKING_REASONS, DONE, IN_PROGRESS, INSTALLED

KEYS = ["Instaladora", "ibge", "UF", "Municipio", "Fase", "MotivodocontatoInstalação"]
RENAMED = {"Instaladora": "instaladora", "UF": "uf", "Municipio": "municipio", "Fase": "fase",
           "MotivodocontatoInstalação": "motivo_contato"}


def grouped_counts(tickets: DataFrame, as_of) -> DataFrame:
    """Created today, open, overdue and installed counts in one scan and one shuffle.

    Open tickets are also grouped by their creation date, which is not shown, so the visible keys
    of that rule repeat.
    """
    rules = {
        "Criados": F.col("Horadacriação") == day(as_of),
        "Em aberto": F.col("Status") == IN_PROGRESS,
        "Backlog": (F.col("Status") == IN_PROGRESS) & (F.col("DataHoraAgendamento") < day(as_of)),
        "Instalados": ((F.col("Status") == INSTALLED) & (F.col("StatusdaInstalação") == DONE)
                       & F.col("MotivodocontatoInstalação").isin(*BOOKING_REASONS)),
    }
    counted = labelled_counts(tickets, KEYS, rules, {"Em aberto": F.col("Horadacriação")})
    return counted.withColumnsRenamed(RENAMED)


def status_counts(tickets: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: distinct tickets in correction, in audit, unproductive and in back office."""
    classes = {
        "qtd_correcao": F.col("Status") == "IN_CORRECTION",
        "qtd_auditoria": F.col("Status") == "IN_AUDITING",
        "qtd_improdutiva": (F.col("Status") == INSTALLED) & (F.col("StatusdaInstalação") != DONE),
        "qtd_backoffice": F.col("Status") == "BACKOFFICE",
    }
    count = approx_distinct_counts if approximate else distinct_counts
    return count(tickets, "IDdoticket", classes)


def indicator_history(tickets: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """(grouped counts, status counts), both stamped with the run date."""
    stamp = day_text(moment(as_of))
    return (grouped_counts(tickets, as_of).withColumn("data_registro", stamp),
            status_counts(tickets).withColumn("data_registro", stamp))
