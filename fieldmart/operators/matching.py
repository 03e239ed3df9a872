"""Nearest official name by token-sort similarity, one way for every size.

The score of two texts is ``200 * common / (la + lb)``, with the length of their longest common subsequence as
``common``. Distinct names meet the official names in blocks of a fixed size on both sides, so a task holds one
block of each and no list is sent whole. Inside a block all pairs are scored at once and bit-parallel: a machine
word holds 64 places of a name, and a letter of an official name moves all of them, for all pairs, in four
operations. A name's best of each block then goes into one aggregate.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import as_col
from ..functions.text import token_sort

NAMES_BLOCK, OFFICIAL_BLOCK = 2048, 512  # names of a block on either side, about
_PAIRS_AT_ONCE = 1 << 19


def common_lengths() -> Callable[[list[str], list[str]], np.ndarray]:
    """A function of two lists of texts: the length of the longest common subsequence of each pair, (right, left).

    Each bit of ``free`` is a place of a left text; it is cleared when the subsequence grows there. The function
    carries all it needs, so executors need no copy of this package.
    """
    at_once = _PAIRS_AT_ONCE

    def block(left: list[str], right: list[str]) -> np.ndarray:
        words = max(1, -(-max(map(len, left)) // 64))
        letters: dict[str, int] = {}
        for text in left:
            for letter in text:
                letters.setdefault(letter, len(letters))
        places = np.zeros((words, len(letters) + 1, len(left)), np.uint64)  # the last row: letters that no left text has
        for column, text in enumerate(left):
            for place, letter in enumerate(text):
                places[place >> 6, letters[letter], column] |= np.uint64(1 << (place & 63))
        order = sorted(range(len(right)), key=lambda i: -len(right[i]))
        longest = len(right[order[0]])
        codes = np.full((len(right), max(longest, 1)), len(letters), np.int64)
        for row, i in enumerate(order):
            codes[row, : len(right[i])] = [letters.get(letter, len(letters)) for letter in right[i]]
        going = [sum(1 for i in order if len(right[i]) > step) for step in range(longest)]
        free = np.full((words, len(right), len(left)), np.uint64(2**64 - 1))
        for step, rows in enumerate(going):
            carry = None
            for word in range(words):
                now = free[word, :rows]
                met = now & places[word][codes[:rows, step]]
                moved = now + met
                over = moved < now
                if carry is not None:
                    moved += carry
                    over |= (moved == 0) & carry.astype(bool)
                free[word, :rows] = moved | (now & ~met)
                carry = over.astype(np.uint64)
        common = np.empty((len(right), len(left)), np.int64)
        common[order] = 64 * words - np.bitwise_count(free).sum(axis=0, dtype=np.int64)
        return common

    def common(left: list[str], right: list[str]) -> np.ndarray:
        if not left or not right:
            return np.zeros((len(right), len(left)), np.int64)
        wide = -(-max(map(len, left)) // 64) or 1
        size = max(1, at_once // (len(right) * wide))
        return np.concatenate([block(left[i: i + size], right) for i in range(0, len(left), size)], axis=1)

    return common


def _block_best():
    """Of one block of names and one of official names: each name's best, the first by rank among equals."""
    common = common_lengths()

    def best(names: pa.Table, official: pa.Table) -> pa.Table:
        kinds = official.schema.field("rank").type
        rows = sorted(zip(*(official.column(c).to_pylist() for c in ("rank", "matched", "sorted_official")), strict=True),
                      key=lambda r: (r[0] is not None, r[0], r[1]))
        left, right = names.column("sorted_name").to_pylist(), [r[2] for r in rows]
        if not left or not right:
            rows, score, first, name = [], np.empty(0), [], []
        else:
            total = np.array([len(t) for t in right])[:, None] + np.array([len(t) for t in left])[None, :]
            scores = np.where(total == 0, 100.0, 200.0 * common(left, right) / np.maximum(total, 1))
            top = scores.argmax(axis=0)  # the first of equal ones
            score, first, name = scores[top, np.arange(len(left))], top.tolist(), names.column("name").to_pylist()
        return pa.table({"name": pa.array(name, pa.string()), "loss": pa.array(-score, pa.float64()),
                         "rank": pa.array([rows[i][0] for i in first], kinds), "matched": pa.array([rows[i][1] for i in first], pa.string())})

    return best


def best_match(names: DataFrame, name: str, official: DataFrame, official_name: str,
               rank: str | None = None) -> DataFrame:
    """``name, matched, score`` for every distinct non-null name; no rows without official names.

    Equal scores go to the official name that ranks first (by ``rank``, a number or text, else alphabetically), so a
    name that shares no letter with any gets the first of all at score 0. Every name is scored against every official
    name with other sorted words than the rest: the work is their product, in equal blocks.
    """
    listed = official.filter(F.col(official_name).isNotNull()).withColumn("sorted_official", token_sort(official_name))
    # One row per sorted text: only the first-ranked of equal texts can ever win.
    listed = listed.groupBy("sorted_official").agg(
        F.min(F.struct(as_col(rank or official_name).alias("rank"), F.col(official_name).alias("matched"))).alias("head")).select(
        "sorted_official", F.col("head.rank").alias("rank"), F.col("head.matched").alias("matched"))
    wanted = names.select(F.col(name).alias("name")).filter(F.col("name").isNotNull()).distinct().withColumn("sorted_name", token_sort("name"))

    def blocks(df: DataFrame, c: str, size: int):  # about so many; any number is right
        return df.agg(F.greatest(F.ceil(F.approx_count_distinct(c) / size), F.lit(1)).cast("int").alias("n")).scalar()

    rows, columns = blocks(names, name, NAMES_BLOCK), blocks(official, official_name, OFFICIAL_BLOCK)
    left = wanted.select(F.pmod(F.xxhash64("name"), rows).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), columns - 1)).alias("j"), "name", "sorted_name")
    right = listed.select(F.explode(F.sequence(F.lit(0), rows - 1)).alias("i"), F.pmod(F.xxhash64("sorted_official"), columns).cast("int").alias("j"),
                          "sorted_official", "rank", "matched")
    kind = T.StructType([T.StructField("name", T.StringType()), T.StructField("loss", T.DoubleType()),
                         T.StructField("rank", right.schema["rank"].dataType), T.StructField("matched", T.StringType())])
    best = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(_block_best(), kind)
    near = best.groupBy("name").agg(F.min(F.struct("loss", "rank", "matched")).alias("near"))
    return near.select("name", F.col("near.matched").alias("matched"), (-F.col("near.loss")).alias("score"))
