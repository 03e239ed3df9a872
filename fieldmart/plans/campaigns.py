"""Campaign sends with their free-text city replaced by the official name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import mixed_date
from ..operators.filters import at_least
from ..operators.joins import keys_in
from ..operators.matching import best_match

MIN_SIMILARITY = 50


def official_cities(cities: DataFrame, extra: DataFrame) -> DataFrame:
    """``ibge, nome_cidade`` of the cities that belong to the extra phase."""
    return keys_in(cities, extra, "cIBGE").select(F.col("cIBGE").alias("ibge"), "nome_cidade")


def scored_campaigns(campaigns: DataFrame, official: DataFrame) -> DataFrame:
    """Campaign rows plus ``city_normalizado`` and ``similaridade``; both null without a city."""
    best = best_match(campaigns, "city", official, "nome_cidade").select(
        F.col("name").alias("_city"), F.col("matched").alias("city_normalizado"),
        F.col("score").alias("similaridade"))
    return campaigns.join(best, campaigns["city"] == best["_city"], "left").drop("_city")


def campaign_city_normalisation(campaigns: DataFrame, cities: DataFrame, extra: DataFrame,
                                dedupe_dim: bool = False) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows).

    Rows below the similarity limit are quarantined with their best guess and score; rows without
    a city are in neither. A city name that exists in two states gives a row for each, unless
    ``dedupe_dim`` keeps the smallest code per name.
    """
    official = official_cities(cities, extra)
    good, low = at_least(scored_campaigns(campaigns, official), "similaridade", MIN_SIMILARITY)
    dim = official.select("ibge", F.col("nome_cidade").alias("city_normalizado"))
    if dedupe_dim:
        dim = dim.groupBy("city_normalizado").agg(F.min("ibge").alias("ibge"))
    others = [c for c in campaigns.columns if c != "city"]
    named = good.join(dim, "city_normalizado", "left")
    clean = named.select(*others, F.col("city_normalizado").alias("city"), "ibge").distinct()
    return clean.withColumn("date", mixed_date("date")), low
