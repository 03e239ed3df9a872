"""Mixing sources to target weights: exact block quotas, split over the output shards by a tree.

Each source's documents lie end to end in an order given by a keyed hash; blocks are stretches of that
order. A source's target says how many times all its documents are taken and how many words one more,
partial pass takes: whole documents in order, each that fits into what is left, through to the end of the order.
That gives each source a number of block draws. A tree over the shards splits these numbers: at each
node the left half gets its share of each source by a multivariate hypergeometric draw, so every shard
is a random sample without replacement of all draws, and the numbers stay exact. A shard's draws are a
stretch of the source's permuted draws, disjoint from those of other shards; rows are shuffled inside
their shard.

Any task can walk the tree from the seed alone; the driver sees one row per source.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, cut, whole_row

BLOCK_WORDS = 1 << 15
SHARD_WORDS = 1 << 21  # words of the mix in an output shard, if their number isn't given
BUCKET_ROWS = 512  # documents whose places are counted together
MOST_SOURCES = 100_000


def word_count(text: str) -> Column:
    """How many ``[^\\x20\\x09-\\x0D]+`` a text has: pieces between spaces, without the empty ones at the ends."""
    col, spaces = F.coalesce(F.col(text), F.lit("")), F.array(*[F.lit(c) for c in SPACES])
    ends = F.array_contains(spaces, F.substring(col, 1, 1)).cast("int") + F.array_contains(spaces, F.substring(col, -1, 1)).cast("int")
    return F.when(col == "", 0).otherwise(F.size(F.split(col, "[ \\t\\n\\x0b\\f\\r]+")) - ends).cast("long")


@dataclass(frozen=True)
class Quota:
    """What the mix takes of one source."""

    source: str | None
    size: int  # words
    target: float
    passes: int  # over all documents
    rest: float  # words of one more pass
    blocks: int
    rest_blocks: int

    @property
    def draws(self) -> int:
        return self.passes * self.blocks + self.rest_blocks


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Shares ``share`` x all sizes by weight; none gets over ``most`` x its size, the excess goes to the others by weight."""
    out, left, open_ = [0.0] * len(sizes), share * sum(sizes), list(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def plan(sizes: dict[str | None, int], weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
         block: int = BLOCK_WORDS) -> list[Quota]:
    """Quotas of the sources in code point order, null last; ``weights`` repeat along that order."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = targets([sizes[s] for s in names], [weights[i % len(weights)] for i in range(len(names))], share, most)
    out = []
    for name, target in zip(names, goal, strict=True):
        size = sizes[name]
        passes = int(target // size) if size else 0
        rest = target - passes * size if size else 0.0
        blocks = -(-size // block)
        out.append(Quota(name, size, target, passes, rest, blocks, min(blocks, int(rest // block) + 2) if rest else 0))
    return out


class SplitTree:
    """Splits the draws of all sources among ``shards`` shards."""

    def __init__(self, draws: Sequence[int], shards: int, seed: int):
        self.draws, self.shards, self.seed, self.known = np.array(draws, np.int64), shards, seed, {}
        if self.draws.sum() >= 10**9:
            raise ValueError("over 10^9 blocks; take larger ones")

    def left(self, lo: int, hi: int, draws: np.ndarray) -> np.ndarray:
        """What the left half of the shards lo..hi gets of their draws."""
        if (lo, hi) not in self.known:
            mine = round(int(draws.sum()) * ((lo + hi) // 2 - lo) / (hi - lo))
            rng = np.random.default_rng([self.seed, lo, hi])
            self.known[lo, hi] = rng.multivariate_hypergeometric(draws, mine, method="marginals")
        return self.known[lo, hi]

    def shard_of(self, source: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The shards that hold the given places among the draws of the given sources."""
        out = np.zeros(len(source), np.int64)
        todo = [(0, self.shards, self.draws, np.arange(len(source)), place.astype(np.int64))]
        while todo:
            lo, hi, draws, rows, at = todo.pop()
            if hi - lo == 1 or not len(rows):
                out[rows] = lo
                continue
            left = self.left(lo, hi, draws)
            first = at < left[source[rows]]
            mid = (lo + hi) // 2
            todo.append((lo, mid, left, rows[first], at[first]))
            todo.append((mid, hi, draws - left, rows[~first], at[~first] - left[source[rows[~first]]]))
        return out


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0..size-1, elementwise: a Feistel network on the next even power of two,
    walked along its cycle until the result is in range."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    value, todo = index.astype(np.uint64), np.ones(len(index), bool)
    with np.errstate(over="ignore"):
        while todo.any():
            a, b = value[todo] >> half[todo], value[todo] & mask[todo]
            for turn in range(4):
                x = (b + key[todo].astype(np.uint64) + np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
                x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                a, b = b, (a ^ (x >> np.uint64(32))) & mask[todo]
            value[todo] = (a << half[todo]) | b
            todo = value >= size.astype(np.uint64)
    return value.astype(np.int64)


def _fill(zone: pd.DataFrame) -> pd.DataFrame:
    """Of the documents around the end of the partial pass, those that fit, in order."""
    zone = zone.sort_values("place")
    left, taken = float(zone["left"].iloc[0]) - int(zone["at"].iloc[0]), []
    for size in zone["size"]:
        taken.append(size <= left)
        left -= size if size <= left else 0
    return zone.assign(extra=np.array(taken, bool), left=left)[["number", "place", "at", "size", "extra", "left"]]


ZONE = "number int, place long, at long, size long, extra boolean, left double"


def _ahead(rows: DataFrame, block: int) -> DataFrame:
    """``at``: the words of a source's rows before each of them."""
    rows = rows.withColumn("stretch", F.floor(F.col("place") / block))
    order = Window.partitionBy("number", "stretch").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy("number").orderBy("stretch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.groupBy("number", "stretch").agg(F.sum("size").alias("words"))
    sums = sums.select("number", "stretch", (F.sum("words").over(ahead) - F.col("words")).alias("offset"))
    rows = rows.withColumn("before", F.sum("size").over(order) - F.col("size"))
    return rows.join(sums, ["number", "stretch"]).withColumn("at", F.col("before") + F.col("offset"))


def _partial(placed: DataFrame, quotas: Sequence[Quota], block: int) -> DataFrame:
    """(n2, p2, at): the documents that the partial pass takes besides those up to ``rest - block``, and
    where they lie in it.

    The first round tries the documents less than a block from the cut. What is then left goes to later documents that
    are no larger, again up to a block behind the new cut, until no document fits: the same as trying all
    in order. At last the smallest document left out is taken if that comes nearer to the target.
    """
    spark, places = placed.sparkSession, "n2 int, p2 long, at long"
    wordy = placed.filter((F.col("size") > 0) & (F.col("rest") > 0)).select("number", "place", "size", "rest")
    rests = {i: q.rest for i, q in enumerate(quotas) if q.rest > 0}
    left, after, found = dict(rests), dict.fromkeys(rests, -1), spark.createDataFrame([], places)
    todo, first = list(rests), True
    while todo:
        if first:
            rows = wordy.withColumns({"at": F.col("place"), "left": F.col("rest")})
            rows = rows.filter(F.col("place") + F.col("size") > F.greatest(F.lit(0.0), F.col("rest") - block))
        else:
            state = spark.createDataFrame([(i, after[i], float(left[i])) for i in todo], "number int, after long, left double")
            rows = _ahead(wordy.join(state, "number").filter((F.col("place") > F.col("after")) & (F.col("size") <= F.col("left"))), block)
        rows = rows.filter(F.col("at") < F.col("left") + block)
        near = F.col("at") + F.col("size") > F.col("left") - block
        tried = rows.filter(near).groupBy("number").applyInPandas(_fill, ZONE)
        if not first:
            sure = rows.filter(~near)
            tried = tried.unionByName(sure.select("number", "place", "at", "size", F.lit(True).alias("extra"),
                                                  (F.col("left") - F.col("at") - F.col("size")).alias("left")))
        tried = cut(tried)
        ends = tried.groupBy("number").agg(F.max("place").alias("after"), F.min("left").alias("left")).collect()
        begun = spark.createDataFrame([(i, float(rests[i] - left[i])) for i in todo], "n2 int, begun double")
        taken = tried.filter("extra").join(begun, F.col("number") == F.col("n2"))
        found = found.unionByName(taken.select("n2", F.col("place").alias("p2"), F.floor(F.col("begun") + F.col("at")).alias("at")))
        for r in ends:
            after[r.number], left[r.number] = r.after, r.left
        todo, first = [r.number for r in ends if r.left >= 1], False
    state = spark.createDataFrame([(i, float(v)) for i, v in left.items()], "number int, left double")
    out = wordy.join(state, "number").filter((F.col("size") < 2 * F.col("left")) & (F.col("place") + F.col("size") > F.col("rest") - block))
    out = out.join(found, (F.col("number") == F.col("n2")) & (F.col("place") == F.col("p2")), "left_anti")
    one = out.groupBy("number").agg(F.min(F.struct("size", "place")).alias("least")).collect()
    more = [(r.number, r.least.place, int(rests[r.number] - left[r.number])) for r in one]
    return found.unionByName(spark.createDataFrame(more, places))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, shards: int | None = None, seed: int = 7,
        block: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, key, size, source_size, target, shards), one row for each row of ``docs``.

    ``shards`` has the shard of each time the document is taken, whole: none to ``most`` times. ``key``
    is a hash of the row; rows that are equal get equal keys. A source's taken words differ from its
    target by at most half of the smallest document that the partial pass leaves out.
    Null sources are one source; documents without words are not taken; an empty table gives an empty
    result. A text counts whole, whatever its length. Runs with the same rows and seed agree.
    """
    spark = docs.sparkSession
    rows = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(docs, seed).alias("key"),
                           F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size")))
    totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"over {MOST_SOURCES} sources; group them first")
    quotas = plan({r.source: r.size for r in totals}, weights, share, most, block)
    shards = shards or max(8, int(sum(q.target for q in quotas) // SHARD_WORDS) + 1)
    count = {r.source: r.n for r in totals}
    listed = spark.createDataFrame(
        [(i, q.source, q.size, float(q.target), q.passes, float(q.rest), q.blocks, q.rest_blocks, -(-count[q.source] // BUCKET_ROWS)) for i, q in enumerate(quotas)],
        "number int, name string, source_size long, target double, passes int, rest double, blocks long, rest_blocks long, buckets long")
    rows = rows.join(listed, F.col("source").eqNullSafe(F.col("name"))).drop("name", "source")
    rows = rows.withColumn("bucket", F.pmod("key", "buckets")).drop("buckets")

    order = Window.partitionBy("number", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("before", F.sum("size").over(order) - F.col("size"))
    sums = rows.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.select("number", "bucket", (F.sum("words").over(ahead) - F.col("words")).alias("offset"))
    placed = cut(local.join(sums, ["number", "bucket"]).withColumn("place", F.col("before") + F.col("offset")).drop("before", "offset", "bucket"))

    wordy, extra = F.col("size") > 0, _partial(placed, quotas, block)
    placed = placed.join(extra, wordy & (F.col("number") == F.col("n2")) & (F.col("place") == F.col("p2")), "left")
    inside = wordy & (F.col("place") + F.col("size") <= F.greatest(F.lit(0.0), F.col("rest") - block)) | F.col("p2").isNotNull()
    drawn = _draw([q.draws for q in quotas], shards, seed)(
        "number", F.floor(F.col("place") / block), F.floor(F.coalesce("at", "place") / block), F.when(wordy, F.col("passes")).otherwise(0),
        inside.cast("int"), "passes", "blocks", "rest_blocks")
    return placed.select("doc_id", "key", "size", "source_size", "target", drawn.alias("shards"))


def row_key(docs: DataFrame, seed: int) -> Column:
    """A hash of all columns of a row that Spark can hash."""
    return F.xxhash64(F.lit(seed), *[F.col(f"`{n}`") for n, kind in docs.dtypes if not kind.startswith(("map", "variant"))])


def _draw(draws: list[int], shards: int, seed: int):
    @F.arrow_udf("array<int>")
    def draw(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        tree = SplitTree(draws, shards, seed)
        for part in parts:
            number, block, rest_block, whole, extra, passes, blocks, rest_blocks = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in part)
            times = whole + extra
            row = np.repeat(np.arange(len(times)), times)
            turn = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            last = turn >= whole[row]  # the partial pass
            turn[last] = passes[row][last]
            size = np.where(last, rest_blocks[row], blocks[row])
            mine = np.where(last, rest_block[row], block[row])
            place = turn * blocks[row] + permuted(mine, size, number[row] * 1_000_003 + turn * 7919 + seed)
            shard = tree.shard_of(number[row], place)
            yield pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(times))), pa.int32()), pa.array(shard, pa.int32()))
    return draw


def mixed(docs: DataFrame, id_col: str = "doc_id", seed: int = 7, shard_col: str | None = None, **settings) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, in random order inside its shard, a shard in a partition.

    All columns come back as they are. With ``shard_col`` the number of the shard is added in a column of that name,
    in place of a column that has it.
    """
    number = F.col(f"`{id_col}`").cast("long")
    taken = mix(docs, id_col, seed=seed, **settings)
    taken = taken.groupBy(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("unnamed"), "key").agg(F.flatten(F.collect_list("shards")).alias("shards"))
    keys = ["id", "unnamed", "key"]
    rows = docs.select(F.coalesce(number, F.lit(0)).alias("id"), number.isNull().alias("unnamed"), row_key(docs, seed).alias("key"), whole_row(docs))
    rows = rows.dropDuplicates(keys).join(taken.filter(F.size("shards") > 0), keys)
    rows = rows.select("key", "row", F.posexplode("shards").alias("turn", "shard"))
    rows = rows.withColumn("order", F.xxhash64(F.lit(seed), "shard", "key", "turn"))
    dealt = rows.repartition("shard").sortWithinPartitions("shard", "order")
    if shard_col is None:
        return dealt.select("row.*")
    return dealt.select(*[F.col(f"row.`{c}`") for c in docs.columns if c != shard_col], F.col("shard").alias(shard_col))
