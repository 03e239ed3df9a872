"""Maintenance orders on tickets where an earlier visit ended long ago."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import whole_days
from ..functions.casts import moment, stamp_text
from ..functions.text import digits_only, or_text
from ..operators.filters import filled, since_hours
from ..operators.nested import explode_items, first_item, slim_items

MAINTENANCE = "Manutenção - Problema técnico"


def ended_before(as_of, days: int):
    limit = moment(as_of) - F.expr(f"INTERVAL '{int(days)}' DAY")
    return lambda service: service["ended"] < limit


def maintenance_monitor(docs: DataFrame, as_of, hours: int = 3, days: int = 90) -> DataFrame:
    """One row per maintenance order of a recent ticket that has, on the same ticket (itself included),
    a service that ended more than ``days`` days ago; the first such service in list order.

    The sibling is found inside the row, so nothing is shuffled, and only four leaves of the service
    list are read. It is looked up after the maintenance test, for the few rows that pass it.
    """
    services = slim_items("services", number="serviceOrder.number", type="serviceOrder.type",
                          registered="serviceOrder.registeredAt",
                          ended="serviceOrder.installerResponse.appointmentEndTime")
    recent = docs.filter(since_hours("createdAt", as_of, hours)).select(
        services.alias("services"), or_text("customer.cpf", "NULL").alias("customer_cpf"))
    items = explode_items(recent.withColumn("all", F.col("services")), "services", "s")
    due = (F.col("s.type") == MAINTENANCE) & filled("s.number")
    mine = items.withColumn("sibling", F.when(due, first_item("all", ended_before(as_of, days))))
    return mine.filter(F.col("sibling").isNotNull()).select(
        digits_only("s.number").alias("nro_os_manutencao"),
        stamp_text("s.registered", "NULL").alias("registered_at_manutencao"),
        "customer_cpf",
        or_text("sibling.number", "N/A").alias("os_vizinha_number"),
        or_text("sibling.type", "N/A").alias("os_vizinha_type"),
        stamp_text("sibling.ended").alias("appointment_end_time"),
        whole_days("sibling.ended", moment(as_of)).alias("dias_desde_appointment"),
    )
