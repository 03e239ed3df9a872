"""Listed orders as flat rows or as UPDATE text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import moment
from ..functions.text import digits_only, full_address, or_text, update_statement
from ..operators.joins import anti_join, lookup_first
from ..operators.nested import explode_items, first_item, slim_items

TABLE = "crm_ticket_data"


def order_columns(as_of) -> list[Column]:
    """The 36 columns of one order, taken from document ``d`` and its service ``s``."""
    order, reply = "s.serviceOrder", "s.serviceOrder.installerResponse"
    visit = first_item(f"{order}.schedules")
    address = [f"d.customer.address.{p}" for p in
               ("streetName", "number", "complement", "neighborhood", "postalCode", "city", "state")]

    def col(path: str, name: str) -> Column:
        return F.col(path).alias(name)

    # The 36 columns of the export.
    return [
        digits_only("s.protocol.number").alias("protocol_number"),
        col("s.protocol.createdAt", "protocol_created_at"),
        col("s.protocol.channel", "protocol_channel"),
        col(f"{order}.notation", "notation"),
        col(f"{order}.status", "service_order_status"),
        col(f"{order}.type", "service_order_type"),
        col(f"{order}.registeredAt", "service_order_created_at"),
        visit["date"].alias("schedule_date_time"),
        visit["installer"].alias("installer"),
        visit["installer"].alias("schedule_installer"),
        col(f"{reply}.appointmentEndTime", "installer_response_appointment_end_time"),
        col(f"{reply}.equipmentSerialNumber", "installer_response_equipment_serial_number"),
        col(f"{reply}.classification", "installer_response_classification"),
        col("d.lastModifiedDate", "last_modified_date"),
        col("d.customer.name", "customer_name"),
        col("d.customer.cpf", "customer_cpf"),
        first_item("d.customer.contacts")["value"].alias("customer_phone"),
        col("d.customer.cadUnico.familyCode", "customer_family_code"),
        col("d.customer.cadUnico.nis", "customer_nis"),
        col("d.customer.email", "customer_email"),
        col("d.customer.cadUnico.ibgeCode", "customer_ibge"),
        col("d.customer.address.postalCode", "customer_postal_code"),
        full_address(*address).alias("customer_full_address"),
        col("d.customer.address.reference", "customer_address_reference"),
        col("s.tabulation", "tabulation"),
        or_text("s.failureReason", "N/A").alias("failure_reason"),
        moment(as_of).alias("synched_at"),
        col(f"{reply}.appointmentStartTime", "installer_response_appointment_start_time"),
        col(f"{reply}.representantCpf", "installer_response_representant_cpf"),
        col(f"{reply}.representantName", "installer_response_representant_name"),
        col(f"{reply}.evidence.fileUrl", "installer_response_evidence"),
        col(f"{reply}.technicianId", "installer_response_technician_id"),
        col(f"{reply}.caidEquipamento", "isntaller_response_caid_equipment"),
        col(f"{reply}.scidEquipamento", "installer_response_scid_equipment"),
        col(f"{reply}.latlongInstalacao", "installer_response_lat_long_installation"),
        col(f"{reply}.pta", "installer_response_pta"),
    ]


# The row form puts the note before the channel; the UPDATE form keeps the order above.
ROW_START = ["protocol_number", "protocol_created_at", "notation", "protocol_channel"]


def listed_orders(ids: DataFrame, docs: DataFrame, doc_order: str = "createdAt", number: str = "number",
                  doc_id: str = "_id") -> tuple[DataFrame, DataFrame]:
    """(``number, d, s`` of the first document and service per id, ids without a document).

    The pick reads the numbers, the order and the document ids alone; documents are fetched by the ids
    of the picked ones. Equal times and places go to the smallest document id, which must not be null.
    """
    order = F.col(doc_order).alias("_at"), F.col(doc_id).alias("_doc")
    leaves = slim_items("services", number="serviceOrder.number", registered="serviceOrder.registeredAt")
    items = explode_items(docs.select(*order, leaves.alias("leaves")), "leaves", "leaf")
    keyed = items.select(F.col("leaf.number").alias(number), "_at", "pos", F.col("leaf.registered").alias("_made"), "_doc")
    picked, _ = lookup_first(ids, keyed, number, ["_at", "pos", "_made", "_doc"])
    whole = F.struct(*[F.col(c) for c in docs.columns if c != "services"]).alias("d")
    documents = docs.select(F.col(doc_id).alias("_doc"), whole, "services")
    found = picked.join(documents, "_doc").select(number, "d", F.get("services", F.col("pos")).alias("s"))
    # The absent ids need one leaf of the documents, not the documents.
    numbers = docs.select(F.explode_outer("services.serviceOrder.number").alias(number))
    return found, anti_join(ids.select(number), numbers, [number])


def order_export(ids: DataFrame, docs: DataFrame, as_of, mode: str = "csv", table: str = TABLE,
                 doc_order: str = "createdAt") -> tuple[DataFrame, DataFrame]:
    """(export, ids not found). ``csv`` gives the 36-column rows, ``update_sql`` one statement per row."""
    found, absent = listed_orders(ids, docs, doc_order)
    if mode == "csv":
        rows = found.select(*order_columns(as_of))
        rest = [c for c in rows.columns if c not in ROW_START]
        return rows.select(*ROW_START, *rest), absent
    if mode != "update_sql":
        raise ValueError(f"unknown export mode {mode!r}")
    rows = found.select("number", *order_columns(as_of))
    fields = [(n, kind) for n, kind in rows.dtypes if n != "number"]
    return rows.select(update_statement(table, fields, "service_order_number", "number").alias("value")), absent
