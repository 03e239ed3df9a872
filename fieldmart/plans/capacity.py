"""Installer capacity rows that the warehouse has not seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import day, int_text
from ..functions.text import concat_key
from ..operators.joins import null_safe_anti


def capacity_rows(setup: DataFrame, installer: DataFrame, city: DataFrame, as_of) -> DataFrame:
    """Capacity with installer name and city code, its text key and the run date."""
    names = installer.select(F.col("id").alias("id_installer"), F.col("name").alias("instaladora"))
    codes = city.select(F.col("id").alias("id_city"), F.col("city_code").alias("ibge"))
    rows = (setup.select("id_installer", "id_city", int_text("capacity").alias("instalacoes_dia"))
            .join(names, "id_installer", "left").join(codes, "id_city", "left"))
    return rows.select("ibge", "instaladora", "instalacoes_dia",
                       concat_key("ibge", "instaladora", "instalacoes_dia").alias("concat"),
                       day(as_of).alias("data_informacao"))


def new_capacity_rows(setup: DataFrame, installer: DataFrame, city: DataFrame, existing: DataFrame,
                      as_of) -> DataFrame:
    """The rows whose key is not stored yet; a null key counts as stored once one is stored."""
    return null_safe_anti(capacity_rows(setup, installer, city, as_of), existing, "concat")
