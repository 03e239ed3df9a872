"""Calendar dimension with daily exchange rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from ..functions.casts import day, moment
from ..operators.joins import insert_if_absent, upsert
from ..operators.sequence import missing_dates

RATES = ["CotacaoUSD", "CotacaoEUR", "CotacaoGBP"]


def only_quote(quote: DataFrame) -> DataFrame:
    """The rates of the one quote; an error when there are none or several."""
    one = quote.agg(F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in RATES])
    checked = F.when(F.col("_n") == 1, True).otherwise(F.raise_error(F.concat(F.col("_n").cast("string"), F.lit(" quotes instead of one"))).cast("boolean"))
    return one.filter(checked).select(*RATES)


def fx_calendar(calendar: DataFrame, quote: DataFrame, as_of, repair_attributes: bool = False) -> DataFrame:
    """Rows to merge into the calendar: every date after its newest one up to ``as_of``, with all
    attributes and the current quote (one row). ``repair_attributes`` adds the existing dates that
    lack attributes, with the rates they have."""
    dates = missing_dates(calendar, "Data", as_of)
    attributes = calendar_columns("Data")
    rates = only_quote(quote)
    # The quote is one row and the missing dates are days since the last run.
    fresh = dates.withColumn("_one", F.lit(1)).join(rates.withColumn("_one", F.lit(1)), "_one").select(
        "Data", *attributes, *RATES)
    if not repair_attributes:
        return fresh
    hollow = calendar.filter(F.col("Ano").isNull()).select("Data", *attributes, *RATES)
    return fresh.unionByName(hollow)


def refreshed_calendar(calendar: DataFrame, rows: DataFrame) -> DataFrame:
    """The calendar after the merge."""
    return upsert(calendar, rows, "Data")


def fx_insert_if_absent(calendar: DataFrame, quote: DataFrame, as_of) -> DataFrame:
    """Today's rates as a row to append, or nothing when the calendar has the date."""
    today = only_quote(quote).select(day(as_of).alias("Data"), *RATES, moment(as_of).alias("DataAtualizacao"))
    return insert_if_absent(calendar, today, "Data")
