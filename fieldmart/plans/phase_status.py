"""Registry rows of people and families with an installed ticket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import try_bigint
from ..operators.filters import union_distinct
from ..operators.joins import mark_key_kinds
from .demand_alerts import INSTALLED

# What counts as an installation, and the status written.
INSTALLATION_RESULTS = ("Executada procedente", "Executado - Procedente", "Instalada")
REASONS = ("Agendamento", "Interferência", "Contestação")
MARK = "Instalado"


def _done() -> Column:
    return ((F.col("Status") == INSTALLED) & F.col("StatusdaInstalação").isin(*INSTALLATION_RESULTS)
            & F.col("MotivodocontatoInstalação").isin(*REASONS))


def installed_keys(tickets: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """Distinct keys with an installed ticket in either table."""
    return union_distinct(tickets.filter(_done()).select(key), extra.filter(_done()).select(key))


def mark_installed(tickets: DataFrame, extra: DataFrame, registry: DataFrame) -> DataFrame:
    """The registry with both status columns brought up to date. Each ticket table is read once, for the
    people and the families, and the registry twice."""
    person = F.struct(F.lit("cpf").alias("kind"), F.col("CPF").cast("string").alias("key"))
    family = F.struct(F.lit("cod_familia").alias("kind"), try_bigint("CodFamilia").cast("string").alias("key"))
    found = [t.filter(_done()).select(F.explode(F.array(person, family)).alias("found")) for t in (tickets, extra)]
    return mark_key_kinds(registry, found[0].unionByName(found[1]).select("found.*"),
                          {"cpf": "status_cpf", "cod_familia": "status_codfamilia"}, MARK)
