"""Joins. None of them carries a broadcast hint: Spark broadcasts a side when its size allows
and otherwise shuffles both, and adaptive execution splits the partitions of a hot key.
Right sides are reduced to one row per key wherever the semantics allow, so that only the
left side can be skewed and can be split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import as_col


def left_chain(base: DataFrame, frames: Sequence[DataFrame], on: str | list[str]) -> DataFrame:
    for frame in frames:
        base = base.join(frame, on, "left")
    return base


def fill_zero(df: DataFrame) -> DataFrame:
    """Nulls of numeric columns become 0; text keeps its nulls."""
    return df.fillna(0)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in the given order.

    An aggregate instead of a numbered window: each task keeps one row per key before the
    shuffle, so a key with a huge number of rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[as_col(c).alias(f"o{i}") for i, c in enumerate(order)])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), ranked).alias("_first"))
    return picked.select(*keys, *[F.col(f"_first.`{c}`").alias(c) for c in rest])


def anti_join(df: DataFrame, known: DataFrame, keys: Sequence[str], dedupe_batch: bool = False,
              known_unique: bool = False) -> DataFrame:
    """Rows whose key is not in ``known`` yet. Repeats inside the batch all pass unless told otherwise.

    ``known_unique`` saves the reduction of a ledger that holds each key once.
    """
    seen = known.select(*keys)
    fresh = df.join(seen if known_unique else seen.distinct(), list(keys), "left_anti")
    return fresh.dropDuplicates(list(keys)) if dedupe_batch else fresh


def null_safe_anti(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Anti join on one key where a null key equals a null key."""
    seen = known.select(F.col(key).alias("_seen")).distinct()
    return df.join(seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")


def keys_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in the other table."""
    listed = other.select(F.col(other_key or key).alias(key)).distinct()
    return df.join(listed, key, "left_semi")


KEYS_PUSHED = 5_000


def only_keys(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str | None = None, pushed: int = KEYS_PUSHED) -> DataFrame:
    """Rows of a large table whose key is among a few wanted ones.

    Up to ``pushed`` distinct keys become a list in the scan's filter, so files and row groups without any of them
    (by their least and greatest key, or Bloom filter) are not read. More keys go through a semi join. Both have the
    same rows. Null keys match nothing. The wanted keys are computed at once.
    """
    column = wanted.schema[wanted_key or key].dataType
    keys = wanted.select(F.col(wanted_key or key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    first = [r[0] for r in keys.limit(pushed + 1).collect()]  # bounded
    if len(first) > pushed or column != df.schema[key].dataType:  # a cast would not reach the scan
        return df.join(keys, key, "left_semi")
    return df.filter(F.col(key).isin(first))


def crowded_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str, most: int) -> DataFrame:
    """``key, n_left, n_right`` of the keys whose rows on both sides would make more than ``most`` pairs.

    Counted before anything is joined: one combined aggregate on each side, no pair is made.
    """
    a = left.filter(F.col(left_key).isNotNull()).groupBy(F.col(left_key).alias("key")).agg(F.count(F.lit(1)).alias("n_left"))
    b = right.filter(F.col(right_key).isNotNull()).groupBy(F.col(right_key).alias("key")).agg(F.count(F.lit(1)).alias("n_right"))
    return a.join(b, "key").filter(F.col("n_left").cast("decimal(20,0)") * F.col("n_right") > most)


def without_keys(df: DataFrame, key: str, crowded: DataFrame) -> DataFrame:
    """Rows whose key is not among the crowded ones; rows without a key stay."""
    return df.join(crowded.select(F.col("key").alias("_crowded")), F.col(key) == F.col("_crowded"), "left_anti")


def reconcile(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str,
              order: Sequence[str], small_left: bool = False) -> DataFrame:
    """Compares every left row with the first right row of its key.

    Adds the right value and ``outcome``: ``missing`` without a right row, ``diverges`` when the
    values differ (a null right value differs), else ``equal``. With ``small_left`` the right table is
    first cut down to the left keys: worth it for a few recent rows against a whole warehouse, but a
    second pass over the left side otherwise.
    """
    rows = right.select(key, right_value, *[c for c in order if c not in (key, right_value)])
    if small_left:
        rows = keys_in(rows, left, key)
    first = first_per_key(rows, [key], order).select(key, right_value, F.lit(True).alias("_found"))
    joined = left.join(first, key, "left")
    outcome = (F.when(F.col("_found").isNull(), F.lit("missing"))
               .when(~F.col(left_value).eqNullSafe(F.col(right_value)), F.lit("diverges"))
               .otherwise(F.lit("equal")))
    return joined.withColumn("outcome", outcome).drop("_found")


def lookup_first(ids: DataFrame, rows: DataFrame, key: str,
                 order: Sequence[Column | str]) -> tuple[DataFrame, DataFrame]:
    """For every requested id, the first matching row, and separately the ids without one.

    Rows are cut down to the requested ids before they are ranked.
    """
    wanted = ids.select(key)
    matching = rows.join(wanted.distinct(), key, "left_semi")
    found = wanted.join(first_per_key(matching, [key], order), key, "inner")
    absent = wanted.join(rows.select(key).distinct(), key, "left_anti")
    return found, absent


def mark_keys(table: DataFrame, keys: DataFrame, key: str, status: str, value: str) -> DataFrame:
    """Sets ``status`` to ``value`` on all rows of a key that is in ``keys`` and has at least one row
    with another status. A key whose statuses are all null or already ``value`` is left alone."""
    named = keys.select(F.lit(key).alias("kind"), F.col(key).cast("string").alias("key"))
    return mark_key_kinds(table, named, {key: status}, value)


def mark_key_kinds(table: DataFrame, keys: DataFrame, columns: Mapping[str, str], value: str) -> DataFrame:
    """``mark_keys`` for several key columns at once: ``columns`` maps each to its status column, and
    ``keys`` has rows ``kind, key`` with the name of the key column and the key as text.

    One pass finds the open keys of all kinds, one marks. The kind is part of the joined value and no
    filter, so that every join reads the same open keys, computed once.
    """
    def pair(kind: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(kind).cast("string").alias("key"))

    # An open key has both its parts; an entry without a key or open status is null and goes.
    entries = F.array_compact(F.array(*[
        F.when((F.col(status) != value) & F.col(key).isNotNull(), pair(key)) for key, status in columns.items()]))
    known = keys.select(F.struct("kind", "key").alias("_key")).distinct()
    open_keys = (table.select(F.explode(entries).alias("_key")).distinct()
                 .join(known, "_key", "left_semi").withColumn("_hit", F.lit(True)))
    hit = table
    for key in columns:
        side = open_keys.select(F.col("_key").alias(f"_key_{key}"), F.col("_hit").alias(f"_hit_{key}"))
        hit = hit.join(side, pair(key) == F.col(f"_key_{key}"), "left")
    keys_of = {status: key for key, status in columns.items()}
    return hit.select(*[F.when(F.col(f"_hit_{keys_of[c]}"), F.lit(value)).otherwise(F.col(f"`{c}`")).alias(c)
                        if c in keys_of else F.col(f"`{c}`") for c in table.columns])


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The target after update-or-insert: source values win on equal keys, other target columns stay.

    ``source`` must have one row per key; its null values do not overwrite.
    """
    t, s = target.alias("t"), source.alias("s")
    joined = t.join(s, F.col(f"t.`{key}`") == F.col(f"s.`{key}`"), "full_outer")
    have = set(source.columns)
    return joined.select(*[
        (F.coalesce(F.col(f"s.`{c}`"), F.col(f"t.`{c}`")) if c in have else F.col(f"t.`{c}`")).alias(c)
        for c in target.columns
    ])


def insert_if_absent(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The source rows whose key the target does not have."""
    return source.join(target.select(key).distinct(), key, "left_anti")


def replace_window(target: DataFrame, fresh: DataFrame, date_col: str, start) -> DataFrame:
    """The target with everything from ``start`` on replaced by the fresh rows."""
    from ..functions.casts import day

    return target.filter(F.col(date_col) < day(start)).unionByName(fresh, allowMissingColumns=True)
