"""Corporate travel: ten nested feeds flattened to ten tables.

Each feed is described by a list of fields; the input schema and the flat columns both follow
from it, so a feed costs one scan and one projection.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import cents
from ..functions.text import protocol_text
from ..operators.filters import drop_existing, select_existing
from ..operators.nested import (explode_ids, explode_structs, flatten_all, joined, joined_field,
                                joined_pairs, text_or_blank, to_plain_cells)
from ..operators.quality import require_complete, require_rows
from ..sources.pages import open_pages, read_pages, records
from ..sources.schemas import TEXT, travel_type


@dataclass(frozen=True)
class Plain:
    """Top-level fields, kept under their names."""
    names: str


@dataclass(frozen=True)
class Inside:
    """Fields of a nested struct, named ``<prefix>_<field>``; the prefix is the last path part."""
    path: str
    names: str
    prefix: str = ""


@dataclass(frozen=True)
class Ids:
    """A list of plain values as comma text."""
    name: str


@dataclass(frozen=True)
class Listed:
    """One field of every struct in a list as one text."""
    path: str
    field: str
    alias: str


@dataclass(frozen=True)
class Paired:
    """Two fields of every struct in a list, written ``first`` + opening + ``second`` + closing."""
    path: str
    first: str
    second: str
    opening: str
    closing: str
    alias: str


Field = Plain | Inside | Ids | Listed | Paired

# The fields of each feed, in table order.
ORDER = [
    Plain("id oldId protocol bookingId bookingType status labelStatus reason costCenterId"),
    Ids("tagsIds"),
    Plain("cancelReason consumer discount refunds additionalCharge antecedence paymentMethod amount "
          "netAmount consumersQuantity integrationMetadata reprovedReason approvalExpirationDate "
          "withinPolitics noHasInvoice createdAt updatedAt reservedBy slug orderCreatedByReqOffline"),
]
CLIENT = Inside("client.data", "id name email username birthday costCenterId groupId permission "
                               "active language createdAt updatedAt", "client")
FLIGHT_LEG = ("from to departureDate arrivalDate tax flightNumber cabinType hasStops duration "
              "cabinBusinessClass emissionGrams")
FLIGHT_LINE = "id name iata callSign status"
BUS_LEG = "type seatClass departureDate arrivalDate price tax insurancePrice refundable"
BUS_STOP = "id name city station address"
BUS_LINE = "id name displayName"


def people(path: str, alias: str, fields: dict[str, str]) -> list[Field]:
    return [Listed(path, field, f"{alias}_{suffix}") for field, suffix in fields.items()]


def bus_leg(side: str) -> list[Field]:
    return [Inside(side, BUS_LEG), Inside(f"{side}.from", BUS_STOP, f"{side}_from"),
            Inside(f"{side}.to", BUS_STOP, f"{side}_to"), Inside(f"{side}.cia", BUS_LINE, f"{side}_cia")]


def flight_leg(side: str) -> list[Field]:
    return [Inside(side, FLIGHT_LEG), Inside(f"{side}.cia", FLIGHT_LINE, f"{side}_cia")]


PERSON = {"name": "nomes", "email": "emails", "document": "documentos", "userId": "userIds"}

FEEDS: dict[str, list[Field]] = {
    "colaboradores": [
        Plain("id name username email gender role"),
        Inside("position", "id label"),
        Plain("firstLogin groupId language permission birthday costCenterId integrationMetadata "
              "onVacation hasPin active parentEmail phoneNumber avatar isPasswordTemporary "
              "hasPhysicalBlueCard hasLoginRestriction hasApp createdAt updatedAt typeKey keyPix "
              "acceptedTermLgpd"),
        Inside("costCenter", "id name customFieldMsSelectOptionId integrationMetadata deletedAt "
                             "createdAt updatedAt"),
        Inside("document.data", "id number label", "document"),
        Inside("document.data.type", "id label", "document_type"),
        Inside("document.data", "createdAt updatedAt", "document"),
        Paired("allDocuments.data", "type.label", "label", ":", "", "allDocuments"),
    ],
    "centro_custo": [
        Plain("id v3Id name integrationMetadata deletedAt invoicing_email invoicing_cnpj "
              "createdAt updatedAt"),
    ],
    "grupo": [Plain("id name"), Ids("employeesIds"), Plain("amountEmployees createdAt updatedAt")],
    "despesa": [
        Plain("id protocol description date amount currency originalCurrencyAmount "
              "defaultCurrencyCompany isReimbursable"),
        Ids("receipts"),
        Plain("rdvId costCenterId isValid userId expenditureTypeId pixId isNFe accessKey category mcc "
              "postalCode commerce_lat commerce_lng commerce_document updatedByBlue quoteHasModified "
              "nfeUri nfeUF establishmentAddress merchant afterUpdateBlueValue beforeUpdateBlueValue "
              "integrationMetadata quantity blueMsId isAnnexRequired"),
        Ids("tagsIds"),
        Plain("createdAt updatedAt"),
    ],
    "automovel": [
        *ORDER,
        Inside("withdraw", "date city address"), Inside("deposit", "date city address"),
        Plain("depositInAnotherLocation group description renter allowanceDescription amountPerDay "
              "totalDays dailyAmount rateDepositAnotherPlace withdrawObservation depositObservation "
              "usedAgreement corporateNameOfAgreement reserveCode bookingDays"),
        CLIENT,
        *people("drivers.data", "drivers", PERSON),
    ],
    "aereo": [
        *ORDER,
        Plain("type isRoundTrip creditRefunds hasBag bagAmount hasComfortSeat comfortSeatAmount "
              "hasInsurance insuranceAmount hasAutoCheckin autoCheckinAmount isInternational "
              "totalEmissionGrams"),
        Listed("ticketOutbound", "ticket", "ticketOutbound"),
        Listed("ticketInbound", "ticket", "ticketInbound"),
        *flight_leg("outbound"), *flight_leg("inbound"),
        *people("travellers.data", "travellers",
                {**PERSON, "bestPrice": "bestPrice", "nationality": "nationalities"}),
    ],
    "onibus": [
        *ORDER, Plain("isRoundTrip hasInsurance"), CLIENT, *bus_leg("outbound"), *bus_leg("inbound"),
    ],
    "hotel": [
        *ORDER,
        Plain("checkin checkout hotelName city roomDescription allowancesDescription thumbnail "
              "isRefundable refundDeadline dailyAmount bookingDays daysHosted bestPrice isBestPrice"),
        Inside("costCenter.data", "id name v3Id integrationMetadata deletedAt", "costCenter"),
        CLIENT,
        Inside("address", "streetName streetNumber postCode region district countryName placeId "
                          "description name type lat lng cityName"),
        Listed("tags.data", "name", "tags_nomes"),
        *people("nextApprovalUsers.data", "nextApprovers", {"name": "nomes", "email": "emails"}),
        Paired("approvalFlowHistory.data", "actionLabel", "date", "(", ")", "approvalFlowHistory"),
        *people("guests.data", "guests", {**PERSON, "nationality": "nationalities"}),
    ],
}

# The columns held in cents.
CENTS = {
    "despesa": "amount afterUpdateBlueValue beforeUpdateBlueValue",
    "automovel": "amount netAmount amountPerDay dailyAmount refunds",
    "aereo": "amount netAmount refunds discount additionalCharge bagAmount comfortSeatAmount "
             "insuranceAmount autoCheckinAmount outbound_tax inbound_tax",
    "onibus": "amount netAmount refunds discount additionalCharge outbound_price outbound_tax "
              "outbound_insurancePrice inbound_price inbound_tax inbound_insurancePrice",
    "hotel": "amount netAmount refunds discount additionalCharge dailyAmount bestPrice",
    "fatura": "amount",
}
# Fields of an invoice that are left out, columns of a credit.
INVOICE_DROPPED = ["description", "invoicedCompany"]
CREDIT_COLUMNS = ["id", "name", "createdAt", "updatedAt", "credit.id", "credit.totalAmount",
                  "credit.description", "credit.user"]


def _put(tree: dict, path: str, leaf) -> None:
    *parents, last = path.split(".")
    for part in parents:
        tree = tree.setdefault(part, {})
        if isinstance(tree, list):  # a list of structs keeps its element tree in one cell
            tree = tree[0]
    tree.setdefault(last, leaf)


def _as_type(node) -> T.DataType:
    if isinstance(node, dict):
        return T.StructType([T.StructField(k, _as_type(v)) for k, v in node.items()])
    if isinstance(node, list):
        return T.ArrayType(_as_type(node[0]))
    return node


def record_schema(feed: str) -> T.StructType:
    """Input schema of one record of a described feed."""
    tree: dict = {}
    for f in FEEDS[feed]:
        if isinstance(f, Plain):
            for name in f.names.split():
                _put(tree, name, travel_type(name))
        elif isinstance(f, Inside):
            for name in f.names.split():
                _put(tree, f"{f.path}.{name}", travel_type(name))
        elif isinstance(f, Ids):
            _put(tree, f.name, T.ArrayType(TEXT))
        else:
            _put(tree, f.path, [{}])
            for name in ([f.field] if isinstance(f, Listed) else [f.first, f.second]):
                _put(tree, f"{f.path}.{name}", TEXT)
    return _as_type(tree)


def _columns(f: Field) -> Iterable[Column]:
    if isinstance(f, Plain):
        return [F.col(n) for n in f.names.split()]
    if isinstance(f, Inside):
        prefix = f.prefix or f.path
        return [F.col(f"{f.path}.{n}").alias(f"{prefix}_{n}") for n in f.names.split()]
    if isinstance(f, Ids):
        return [joined(f.name).alias(f.name)]
    if isinstance(f, Listed):
        return [joined_field(f.path, f.field).alias(f.alias)]

    def field(x: Column, path: str) -> Column:
        for part in path.split("."):
            x = x[part]
        return text_or_blank(x)

    return [joined_pairs(f.path, lambda x: F.concat(field(x, f.first), F.lit(f.opening),
                                                    field(x, f.second), F.lit(f.closing))).alias(f.alias)]


def flatten(feed: str, df: DataFrame) -> DataFrame:
    """Flat columns of a described feed: paths opened, lists joined, cents to units, clean protocol."""
    money = set(CENTS.get(feed, "").split())
    if feed == "grupo":
        return explode_ids(df.select("id", "name", "employeesIds", "amountEmployees", "createdAt",
                                     "updatedAt"), "employeesIds")
    flat = df.select(*[c for f in FEEDS[feed] for c in _columns(f)])
    cells = []
    for name in flat.columns:
        c = F.col(f"`{name}`")
        if name in money:
            c = cents(c)
        elif name == "protocol":
            c = protocol_text(c)
        cells.append(c.alias(name))
    return flat.select(*cells)


def flat_types(feed: str) -> dict[str, T.DataType]:
    """The flat columns of a described feed and their types, in table order."""
    types: dict[str, T.DataType] = {}
    for f in FEEDS[feed]:
        if isinstance(f, Plain):
            types |= {n: travel_type(n) for n in f.names.split()}
        elif isinstance(f, Inside):
            types |= {f"{f.prefix or f.path}_{n}": travel_type(n) for n in f.names.split()}
        else:
            types[f.name if isinstance(f, Ids) else f.alias] = TEXT
    return types | dict.fromkeys(CENTS.get(feed, "").split(), T.DoubleType())


def invoices(df: DataFrame) -> DataFrame:
    """Every field of the invoice, amount in units, nested details as JSON text."""
    money = set(CENTS["fatura"].split())
    kept = drop_existing(df, INVOICE_DROPPED)
    return to_plain_cells(kept.select(*[(cents(f"`{c}`") if c in money else F.col(f"`{c}`")).alias(c)
                                        for c in kept.columns]))


def credits(df: DataFrame) -> DataFrame:
    """Credits per consumer. The movements below a credit multiply its rows although none of their
    columns is kept."""
    flat = flatten_all(df)
    one = explode_structs(flat, "credits.data", "credit.")
    two = explode_structs(one, "credit.data", "credit_data.")
    return to_plain_cells(select_existing(two, CREDIT_COLUMNS))


def travel_table(feed: str, df: DataFrame) -> DataFrame:
    if feed == "fatura":
        return invoices(df)
    if feed == "creditos":
        return credits(df)
    return to_plain_cells(flatten(feed, df))


def travel_tables(spark: SparkSession, folders: dict[str, str],
                  schemas: dict[str, T.StructType] | None = None,
                  one_per_line: bool = False) -> dict[str, DataFrame]:
    """All given feeds from their landed page folders, refused when pages are damaged or missing or a feed
    is empty. ``fatura`` and ``creditos`` have no fixed field list: their fields are those that the pages
    hold, unless ``schemas`` names a record schema."""
    tables = {}
    for feed, path in folders.items():
        schema = (schemas or {}).get(feed) or (record_schema(feed) if feed in FEEDS else None)
        if schema is None:
            pages = open_pages(spark, path, "numbered", one_per_line)
        else:
            pages = read_pages(spark, path, schema, "numbered", one_per_line)
        tables[feed] = require_rows(travel_table(feed, records(require_complete(pages, feed))), feed)
    return tables
