"""Demand and risk expressions behind the city alerts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import as_col

# Curve names, colour ladder, thresholds.
LONG_TAIL, DECLINING, GROWING = "Long Tail", "Decrescente", "Crescente"
GROWTH_LIMIT = {GROWING: 0.4, DECLINING: 0.2, LONG_TAIL: 0.3}
LOW_RISK, HIGH_RISK = 0.5, 0.8
MIN_GROWTH_COUNT = 50
COLOURS = (
    "Comunicado - Verde",
    "Alerta - Amarelo",
    "Comunicado - Amarelo",
    "Alerta - Vermelho",
    "Alerta - Vermelho Crítico",
)


def safe_ratio(n: Column | str, d: Column | str) -> Column:
    """0 when the denominator is 0 or missing."""
    d = as_col(d)
    return F.when(d != 0, as_col(n).cast("double") / d).otherwise(F.lit(0.0))


def growth(previous: Column | str, current: Column | str) -> Column:
    """Relative growth, counted only from a rise of more than 50; 1 when nothing was there before."""
    previous, current = as_col(previous), as_col(current)
    rise = current - previous
    return (F.when(rise <= MIN_GROWTH_COUNT, F.lit(0.0))
            .when(previous == 0, F.lit(1.0))
            .otherwise(rise.cast("double") / previous))


def blended_risk(a: Column | str, b: Column | str) -> Column:
    return as_col(a) * F.lit(0.5) + as_col(b) * F.lit(0.5)


def months_crossed(start: Column | str, end: Column | str) -> Column:
    """Number of month boundaries between two dates, days ignored."""
    start, end = as_col(start), as_col(end)
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def lifecycle_curve(months: Column | str) -> Column:
    m = F.coalesce(as_col(months), F.lit(0))
    return F.when(m >= 9, LONG_TAIL).when(m >= 3, DECLINING).when(m >= 0, GROWING)


def alert_colour(change: Column | str, before: Column | str, now: Column | str, limit: float) -> Column:
    """First matching rung of the ladder. Values that sit exactly on a threshold fall through."""
    change, before, now = as_col(change), as_col(before), as_col(now)
    rungs = (
        (before < LOW_RISK) & (now < LOW_RISK),
        (before < LOW_RISK) & (now < HIGH_RISK),
        (before < HIGH_RISK) & (now < HIGH_RISK),
        (before < HIGH_RISK) & (now > HIGH_RISK),
        (before > HIGH_RISK) & (now > HIGH_RISK),
    )
    ladder = F.lit(None).cast("string")
    for rung, colour in reversed(list(zip(rungs, COLOURS))):
        ladder = F.when(rung, F.lit(colour)).otherwise(ladder)
    return F.when(change > limit, ladder)


def colour_by_curve(curve: Column | str, change: Column | str, before: Column | str,
                    now: Column | str, fix_declining: bool = False) -> Column:
    """The ladder for the city's curve. Declining cities get no colour unless ``fix_declining``:
    the established reports look for a differently spelled curve name."""
    curve = as_col(curve)
    chosen = F.when(curve == GROWING, alert_colour(change, before, now, GROWTH_LIMIT[GROWING]))
    chosen = chosen.when(curve == LONG_TAIL, alert_colour(change, before, now, GROWTH_LIMIT[LONG_TAIL]))
    if fix_declining:
        chosen = chosen.when(curve == DECLINING,
                             alert_colour(change, before, now, GROWTH_LIMIT[DECLINING]))
    return chosen


def colour_level(colour: Column | str) -> Column:
    """1..5 by position on the ladder, 0 for anything else."""
    place = F.array_position(F.array(*[F.lit(c) for c in COLOURS]), as_col(colour))
    return F.coalesce(place, F.lit(0)).cast("int")
