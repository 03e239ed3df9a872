"""Landed JSON pages of paged interfaces. Fetching is done elsewhere; files are the unit of work.

A page that is not whole JSON (cut off, an error message instead) or whose list of records is not a list is
*damaged*. Pages carry its text in ``damaged`` and its file in ``file``. ``records`` refuses damaged pages, or
leaves them out where the caller keeps ``damaged_pages`` in a quarantine; no record is lost without a word.

Feeds whose fields are not known before are read with ``open_pages``: the schema then comes from the records.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import try_stamp
from ..operators.nested import explode_items


def page_schema(record: T.StructType, style: str = "offset") -> T.StructType:
    """Schema of one page around its records.

    ``offset``: ``{"data": [...]}``. ``numbered``: the same plus page number and declared totals.
    ``content``: ``{"content": [...], "totalPaginas": n}``.
    """
    records = T.ArrayType(record)
    if style == "content":
        return T.StructType([T.StructField("pagina", T.LongType()),
                             T.StructField("totalPaginas", T.LongType()),
                             T.StructField("content", records)])
    fields = [T.StructField("data", records)]
    if style == "numbered":
        pagination = T.StructType([T.StructField(n, T.LongType())
                                   for n in ("current_page", "total_pages", "total")])
        fields.append(T.StructField("meta", T.StructType([T.StructField("pagination", pagination)])))
    return T.StructType(fields)


DAMAGED = "_damaged_text"
SHOWN = 80  # characters of a damaged page in an error


def read_pages(spark: SparkSession, path: str, record: T.StructType, style: str = "offset",
               one_per_line: bool = False) -> DataFrame:
    """One row per page, with its ``file`` and, where it is damaged, its text as ``damaged``. Missing fields
    and values of the wrong type are null.

    Pages are whole files, or lines of files with ``one_per_line``: then big files are split. An empty file or
    line is no page.
    """
    schema = page_schema(record, style).add(DAMAGED, T.StringType())
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", DAMAGED)
    raw = reader.json(path, multiLine=not one_per_line)
    return _named(raw.withColumn("file", F.col("_metadata.file_path")), style)


def parse_pages(lines: DataFrame, text: str, record: T.StructType, style: str = "offset", file: Column | None = None) -> DataFrame:
    """The same for pages that are text cells of a table; ``file`` says where a page is from. Null is no page."""
    schema = page_schema(record, style).add(DAMAGED, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": DAMAGED}
    source = F.lit(None).cast("string") if file is None else file
    parsed = lines.filter(F.col(text).isNotNull()).select(F.from_json(F.col(text), schema, options).alias("p"), source.alias("file"))
    return _named(parsed.select("p.*", "file"), style)


def _named(pages: DataFrame, style: str) -> DataFrame:
    listed = "content" if style == "content" else "data"
    damaged = F.when(F.col(listed).isNull(), F.col(DAMAGED)).alias("damaged")
    numbers = {"numbered": {"page": "meta.pagination.current_page", "total_pages": "meta.pagination.total_pages", "total": "meta.pagination.total"},
               "content": {"page": "pagina", "total_pages": "totalPaginas"}}.get(style, {})
    return pages.select(F.col(listed).alias("data"), *[F.col(path).alias(name) for name, path in numbers.items()], "file", damaged)


def damaged_pages(pages: DataFrame) -> DataFrame:
    """The quarantine: file and whole text of every damaged page."""
    return pages.filter(F.col("damaged").isNotNull()).select("file", F.col("damaged").alias("text"))


def whole_pages(pages: DataFrame, refuse: bool = True) -> DataFrame:
    """The pages that are whole. A damaged one stops the job with its file and the start of its text, or is left
    out without ``refuse``. Pages without these columns are taken as whole."""
    if "damaged" not in pages.columns:
        return pages
    if not refuse:
        return pages.filter(F.col("damaged").isNull())
    said = F.concat(F.lit("damaged page in "), F.coalesce("file", F.lit("a table")), F.lit(": "), F.substring("damaged", 1, SHOWN))
    return pages.withColumn("data", F.when(F.col("damaged").isNotNull(), F.raise_error(said)).otherwise(F.col("data")))


def records(pages: DataFrame, refuse: bool = True) -> DataFrame:
    """The records of all pages as top-level columns; for damaged pages see ``whole_pages``."""
    return explode_items(whole_pages(pages, refuse).select("data"), "data", "r").select("r.*")


# --- feeds without a field list ------------------------------------------------------------------------------

def open_pages(spark: SparkSession, path: str, style: str = "offset", one_per_line: bool = False) -> DataFrame:
    """Pages like those of ``read_pages`` with records of whatever fields they have: a schema is taken from the
    records of all whole pages (``open_schema``) and the pages are read with it, so files are read twice."""
    texts = spark.read.option("wholetext", not one_per_line).text(path)
    listed = "$.content" if style == "content" else "$.data"
    found = F.try_variant_get(F.try_parse_json("value"), listed, "array<variant>")
    kind = open_schema(texts.select(F.explode(found).alias("record")), "record")
    return read_pages(spark, path, kind, style, one_per_line)


def open_schema(rows: DataFrame, record: str) -> T.StructType:
    """The schema that holds all records of a VARIANT column.

    Whole numbers of any size are ``bigint`` or decimals, other numbers doubles. A field that is of unlike kinds
    in different records (number and text, list and object) is text: readers keep the JSON text there. A field that
    is null in all records is text, too. One aggregate that is combined before the shuffle; its result has the size
    of the schema. Without any record there are no fields.
    """
    written = rows.select(F.schema_of_variant_agg(record).alias("kind")).first()["kind"]
    # Object types are written OBJECT<...>; names stand in back quotes if need be.
    parts = re.split(r"(`(?:[^`]|``)*`)", written)
    plain = "".join(p if p.startswith("`") else re.sub(r"\bOBJECT<", "STRUCT<", p) for p in parts)
    kind = _readable(T._parse_datatype_string(plain)) if plain not in ("VOID", "VARIANT") else None
    return kind if isinstance(kind, T.StructType) else T.StructType()


def _readable(kind: T.DataType) -> T.DataType:
    """The type as which a JSON reader takes values of an inferred type."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in kind.fields]) if kind.fields else T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_readable(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return kind if kind.scale == 0 else T.DoubleType()
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


METRIC = T.StructType([T.StructField("resource", T.StructType([T.StructField("items", T.ArrayType(
    T.StructType([T.StructField("intervalStart", T.StringType()), T.StructField("count", T.LongType())])))]))])


def metric_series(responses: DataFrame, value: str) -> DataFrame:
    """``intervalStart`` (date) and a count per item of a metric response."""
    items = explode_items(responses.select(F.col("resource.items").alias("items")), "items", "i")
    start = F.coalesce(F.to_date(F.substring("i.intervalStart", 1, 10)),
                       try_stamp("i.intervalStart").cast("date"))
    return items.select(start.alias("intervalStart"), F.col("i.count").alias(value))


_QUOTE = T.StructType([T.StructField("bid", T.StringType())])
QUOTES = T.StructType([T.StructField(pair, _QUOTE) for pair in ("USDBRL", "EURBRL", "GBPBRL")])


def latest_quotes(response: DataFrame) -> DataFrame:
    """The bid of the three currencies as doubles."""
    def bid(pair: str) -> Column:
        return F.col(f"{pair}.bid").cast("double")

    return response.select(bid("USDBRL").alias("CotacaoUSD"), bid("EURBRL").alias("CotacaoEUR"),
                           bid("GBPBRL").alias("CotacaoGBP"))
