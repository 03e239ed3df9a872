"""Text clean-up, defaults, SQL text, and the token-sort similarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import STAMP, as_col


def digits_only(c: Column | str) -> Column:
    """ASCII digits of the text; null gives the empty string."""
    return F.regexp_replace(F.coalesce(as_col(c).cast("string"), F.lit("")), "[^0-9]", "")


def postal_key(c: Column | str) -> Column:
    return F.trim(F.replace(as_col(c), F.lit("-"), F.lit("")))


def strip_chars(c: Column | str, chars: str) -> Column:
    return F.translate(as_col(c), chars, "")


def protocol_text(c: Column | str) -> Column:
    return strip_chars(as_col(c).cast("string"), "#")


def blank_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(F.trim(c) != "", c)


def first_filled(first: Column | str, fallback: Column | str) -> Column:
    """``first`` unless it is null or blank, then ``fallback`` unless it is empty."""
    return F.coalesce(blank_to_null(first), F.nullif(as_col(fallback), F.lit("")))


def concat_key(*cols: Column | str) -> Column:
    """Joined text of the parts; null as soon as one part is null."""
    return F.concat(*[as_col(c).cast("string") for c in cols])


def or_text(c: Column | str, text: str) -> Column:
    return F.coalesce(as_col(c).cast("string"), F.lit(text))


def full_address(street: Column | str, number: Column | str, complement: Column | str,
                 district: Column | str, postal: Column | str, city: Column | str,
                 state: Column | str) -> Column:
    """One-line address; a missing part prints as ``None``."""
    parts = [or_text(c, "None") for c in (street, number, complement, district, postal, city, state)]
    return F.format_string("%s, %s - %s - %s - %s , %s-%s", *parts)


def sql_literal(c: Column | str, data_type: str = "string") -> Column:
    """The value as it stands in SQL text: NULL, a quoted timestamp, or quoted text."""
    c = as_col(c)
    if data_type.startswith("timestamp"):
        text = F.date_format(c, STAMP)
    elif data_type == "boolean":
        text = F.initcap(c.cast("string"))
    else:
        text = c.cast("string")
    quoted = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(text.isNull() | (text == ""), F.lit("NULL")).otherwise(quoted)


def update_statement(table: str, fields: Sequence[tuple[str, str]], key_name: str,
                     key: Column | str) -> Column:
    """``UPDATE`` text per row. ``fields`` are (column name, data type) pairs of the row."""
    pieces = [F.concat(F.lit(f"[{name}] = "), sql_literal(F.col(f"`{name}`"), kind))
              for name, kind in fields]
    return F.concat(F.lit(f"UPDATE {table} SET "), F.concat_ws(", ", *pieces),
                    F.lit(f" WHERE [{key_name}] = '"), digits_only(key), F.lit("';"))


def listed_text(items: Column, strict: bool = True) -> Column:
    """An array as comma text. Strict rendering prints booleans capitalised and null as ``None``,
    and loses brackets and quotes that are inside the values."""
    def render(x: Column) -> Column:
        text = x.cast("string")
        if not strict:
            return text
        text = F.when(text.isin("true", "false"), F.initcap(text)).otherwise(text)
        return F.translate(F.coalesce(text, F.lit("None")), "[]'", "")

    return F.array_join(F.transform(items, render), ", ")


def token_sort(c: Column | str) -> Column:
    """Words of the text in code-point order, single blanks between them."""
    words = F.filter(F.split(as_col(c), r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def _characters(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda ch: ch != "")


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two short texts, as nested folds.

    The row-by-row table is folded over the characters of ``a``; within a row, the running
    value is the last entry of the array built so far.
    """
    b_chars = _characters(b)
    start = F.transform(F.concat(F.array(F.lit("")), b_chars), lambda _: F.lit(0))

    def next_row(row: Column, ch: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.size(b_chars)),
            F.array(F.lit(0)),
            lambda built, j: F.concat(built, F.array(F.when(
                F.element_at(b_chars, j) == ch, F.element_at(row, j) + F.lit(1),
            ).otherwise(F.greatest(F.element_at(row, j + F.lit(1)), F.element_at(built, -1))))),
        )

    folded = F.aggregate(_characters(a), start, next_row)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(F.element_at(folded, -1))


def token_sort_ratio(a: Column | str, b: Column | str) -> Column:
    """0..100 similarity of two texts: 200 * LCS / (length a + length b) on sorted words."""
    left, right = token_sort(a), token_sort(b)
    total = F.length(left) + F.length(right)
    return F.when(total == 0, F.lit(100.0)).otherwise(
        F.lit(200.0) * lcs_length(left, right) / total)
