"""Operators on arrays and structs inside a row. None of them shuffles."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import as_col


def slim_items(array: str, **paths: str) -> Column:
    """An array of structs cut down to the named fields (dotted paths inside the element).

    Field by field, so that a columnar source reads just these leaves; a function that takes the
    elements as a whole would make it read all of them.
    """
    return F.arrays_zip(*[F.col(f"{array}.{path}").alias(name) for name, path in paths.items()])


def explode_items(df: DataFrame, array: str, item: str = "item", pos: str = "pos") -> DataFrame:
    """One row per array element with its position; rows without elements disappear.

    Outer explode and a filter on the position: a plain explode makes Spark add a size check on the
    array below, which computes a derived array (parsed JSON, say) several times per row.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c != array]
    return df.select(*keep, F.posexplode_outer(array).alias(pos, item)).filter(F.col(pos).isNotNull())


def explode_ids(df: DataFrame, array: str) -> DataFrame:
    """One row per element; a row with a null or empty array stays with a null element."""
    return df.select(*[F.explode_outer(array).alias(array) if c == array else F.col(f"`{c}`")
                       for c in df.columns])


def any_item(array: Column | str, test: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.exists(as_col(array), test), F.lit(False))


def first_item(array: Column | str, test: Callable[[Column], Column] | None = None) -> Column:
    """The first element (that passes the test), else null."""
    array = as_col(array)
    return F.get(F.filter(array, test) if test else array, F.lit(0))


def joined(array: Column | str, sep: str = ", ") -> Column:
    """Elements as text; a null or empty array gives the empty text."""
    items = F.transform(as_col(array), lambda x: x.cast("string"))
    return F.coalesce(F.array_join(items, sep, "None"), F.lit(""))


def joined_field(array: Column | str, field: str, sep: str = "; ") -> Column:
    """One field of every struct, missing values as empty text."""
    items = F.transform(as_col(array), lambda x: F.coalesce(x[field].cast("string"), F.lit("")))
    return F.coalesce(F.array_join(items, sep), F.lit(""))


def joined_pairs(array: Column | str, render: Callable[[Column], Column], sep: str = "; ") -> Column:
    """A text made from several fields of every struct."""
    return F.coalesce(F.array_join(F.transform(as_col(array), render), sep), F.lit(""))


def text_or_blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def to_plain_cells(df: DataFrame) -> DataFrame:
    """Arrays, structs and maps become JSON text, NaN becomes null, other cells stay."""
    cells = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c, {"ignoreNullFields": "false"})
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        cells.append(c.alias(field.name))
    return df.select(*cells)


def flat_fields(schema: T.StructType, root: str, prefix: str = "") -> list[tuple[str, Column]]:
    """(dotted name, column) of every leaf below a struct column; arrays are leaves."""
    out: list[tuple[str, Column]] = []
    for field in schema.fields:
        path, name = f"{root}.`{field.name}`", f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            out += flat_fields(field.dataType, path, f"{name}.")
        else:
            out.append((name, F.col(path)))
    return out


def expand_struct(df: DataFrame, struct: str, drop: Iterable[str] = ()) -> DataFrame:
    """Replaces a struct column by its leaves, without the dropped names (every copy of them).

    A missing or non-struct column just goes away. Two surviving columns of one name are an error.
    """
    gone = set(drop)
    out = [(c, F.col(f"`{c}`")) for c in df.columns if c != struct and c not in gone]
    kind = df.schema[struct].dataType if struct in df.columns else None
    if isinstance(kind, T.StructType):
        out += [(n, c) for n, c in flat_fields(kind, f"`{struct}`") if n not in gone]
    names = [n for n, _ in out]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"expanding {struct} gives these names twice: {twice}")
    return df.select(*[c.alias(n) for n, c in out])


def explode_structs(df: DataFrame, array: str, prefix: str) -> DataFrame:
    """One row per struct of the array (at least one), its leaves as ``prefix`` columns.

    Without such an array of structs the frame is returned as it is.
    """
    kind = df.schema[array].dataType if array in df.columns else None
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)):
        return df
    keep = [F.col(f"`{c}`") for c in df.columns if c != array]
    rows = df.select(*keep, F.explode_outer(F.col(f"`{array}`")).alias("_item"))
    leaves = flat_fields(kind.elementType, "_item")
    return rows.select(*keep, *[c.alias(f"{prefix}{n}") for n, c in leaves])


def flatten_all(df: DataFrame) -> DataFrame:
    """Every struct column opened into dotted leaf columns."""
    out = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            out += [c.alias(n) for n, c in flat_fields(field.dataType, f"`{field.name}`", f"{field.name}.")]
        else:
            out.append(F.col(f"`{field.name}`"))
    return df.select(*out)
