"""Grouped and global aggregates. All of them combine inside each task before they shuffle."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import as_col, day


def counts_when(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """One pass, one conditional row count per name (63 at most). Rows that meet no condition are left
    out before the aggregate, so a key without any counted row has no row.

    Each condition becomes a bit of one number. The generator keeps the filter on it from being merged
    with it, which would compute every condition twice.
    """
    met = functools.reduce(operator.add, [F.when(cond, F.lit(1 << n)).otherwise(0).cast("long") for n, cond in enumerate(conditions.values())])
    counted = df.select(*keys, F.explode(F.array(met)).alias("_met")).filter("_met <> 0")
    return counted.groupBy(*keys).agg(*[F.count_if(F.col("_met").bitwiseAND(F.lit(1 << n)) != 0).alias(name) for n, name in enumerate(conditions)])


def any_of(conditions: Iterable[Column]) -> Column:
    return functools.reduce(operator.or_, [F.coalesce(c, F.lit(False)) for c in conditions])


def labelled_counts(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column],
                    hidden: Mapping[str, Column] | None = None, label: str = "regra",
                    count: str = "quantidade") -> DataFrame:
    """One scan and one shuffle for several filtered group counts: a row is counted once under each
    rule it meets; rows that meet none are left out before.

    ``hidden`` names, per rule, one more grouping value that is not part of the result, so the
    visible keys of that rule may repeat. Other rules are not grouped by it.
    """
    hidden = hidden or {}
    met = F.array(*[F.when(cond, F.struct(F.lit(name).alias("label"), hidden.get(name, F.lit(None)).cast("string").alias("extra")))
                    for name, cond in rules.items()])
    tagged = df.filter(any_of(rules.values())).select(*keys, F.explode(F.filter(met, lambda m: m.isNotNull())).alias("_rule"))
    rows = tagged.select(*keys, F.col("_rule.label").alias(label), F.col("_rule.extra").alias("_extra"))
    return rows.groupBy(*keys, label, "_extra").agg(F.count(F.lit(1)).alias(count)).drop("_extra")


def distinct_counts(df: DataFrame, item: str, classes: Mapping[str, Column]) -> DataFrame:
    """One row with a distinct item count per class; classes must exclude each other.

    Distinct (class, item) pairs first, then a plain count: no row is expanded per class.
    """
    label = F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in classes.items()])
    pairs = (df.select(label.alias("_class"), F.col(item).alias("_item"))
             .filter(F.col("_class").isNotNull() & F.col("_item").isNotNull()).distinct())
    return pairs.agg(*[F.count_if(F.col("_class") == name).alias(name) for name in classes])


def approx_distinct_counts(df: DataFrame, item: str, classes: Mapping[str, Column],
                           error: float = 0.02) -> DataFrame:
    """Sketch form of :func:`distinct_counts`: a single pass without a shuffle of the items."""
    return df.agg(*[F.approx_count_distinct(F.when(cond, F.col(item)), error).alias(name)
                    for name, cond in classes.items()])


def top_counts(df: DataFrame, c: str, n: int = 10, count: str = "quantidade") -> DataFrame:
    """The n most frequent values, null left out; equal counts in value order."""
    return (df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(count))
            .orderBy(F.desc(count), F.asc(c)).limit(n))


def outcome_counts(df: DataFrame, outcomes: Sequence[str], c: str = "outcome") -> DataFrame:
    """One row: rows analysed, then one counter per outcome."""
    return df.agg(F.count(F.lit(1)).alias("analysed"),
                  *[F.count_if(F.col(c) == name).alias(name) for name in outcomes])


def id_listing(df: DataFrame, c: str, tail: int = 3, text: str = "ids") -> DataFrame:
    """All distinct ids, as they stand, as comma text: one line per block of ids that have the same
    length and differ in their last ``tail`` characters only (``12???``).

    So a line holds at most as many ids as there are such endings, and no group grows with the data.
    """
    ids = df.select(F.col(c).cast("string").alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    length = F.length("_id")
    head = F.when(length > tail, F.expr(f"left(_id, length(_id) - {tail})")).otherwise("")
    blocks = ids.groupBy(length.alias("_length"), F.concat(head, F.repeat(F.lit("?"), F.least(length, F.lit(tail)))).alias("block"))
    return blocks.agg(F.array_join(F.sort_array(F.collect_list("_id")), ", ").alias(text)).drop("_length")


def freshness(df: DataFrame, c: str, as_of, limit: int = 2) -> DataFrame:
    """One row: newest date, whole days since then, and whether action is due."""
    newest = df.agg(F.max(as_col(c).cast("date")).alias("newest"))
    age = F.date_diff(day(as_of), F.col("newest"))
    return newest.select("newest", age.alias("age_days"), (age >= limit).alias("is_stale"))
