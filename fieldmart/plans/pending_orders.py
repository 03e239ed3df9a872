"""Orders that have been waiting for hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import stamp_text
from ..functions.text import or_text
from ..operators.filters import until_hours
from ..operators.nested import explode_items, first_item, slim_items

# The statuses that count as waiting.
WAITING = ("PENDING", "OPEN", "IN_VALIDATION", "VALIDATION", "INSTALLER_INTEGRATION_ERROR")


def pending_orders(docs: DataFrame, as_of, hours: int = 5) -> DataFrame:
    """One row per waiting order registered at least ``hours`` hours before ``as_of``."""
    order = {name: f"serviceOrder.{name}" for name in
             ("number", "type", "status", "registeredAt", "schedules", "failureReason")}
    tickets = docs.select("createdBy", slim_items("services", **order).alias("services"))
    items = explode_items(tickets, "services", "s")
    late = items.filter(F.col("s.status").isin(*WAITING) & until_hours("s.registeredAt", as_of, hours))
    return late.select(
        or_text("s.number", "NULL").alias("nro OS"),
        or_text("s.type", "NULL").alias("type"),
        F.col("s.status").alias("status"),
        stamp_text("s.registeredAt", "NULL").alias("registeredAt"),
        first_item("s.schedules")["installer"].alias("installer"),
        or_text("s.failureReason", "NULL").alias("failureReason"),
        or_text("createdBy", "NULL").alias("createdBy"),
    )
