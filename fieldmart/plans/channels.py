"""Daily active and engaged users of the messaging channel."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import left_chain, replace_window
from ..sources.pages import metric_series

TRAILING_DAYS = 2


def channel_metrics(active: DataFrame, engaged: DataFrame) -> DataFrame:
    """``data, ativos, engajados``: every active day, engaged count where there is one."""
    return join_series(metric_series(active, "ativos"), metric_series(engaged, "engajados"))


def join_series(active: DataFrame, engaged: DataFrame) -> DataFrame:
    joined = left_chain(active, [engaged], "intervalStart")
    return joined.select(F.col("intervalStart").alias("data"), "ativos", "engajados")


def refreshed_metrics(target: DataFrame, fresh: DataFrame, as_of: dt.date) -> DataFrame:
    """The target with the last two days replaced."""
    return replace_window(target, fresh, "data", as_of - dt.timedelta(days=TRAILING_DAYS))
