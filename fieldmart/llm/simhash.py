"""Near-duplicates by SimHash: fingerprints, a range join in the space of segment bit counts, components.

A fingerprint's 64 bits are cut into segments; the number of one bits in each segment makes a point
with 32 coordinates. Moving one bit moves one coordinate by one, so the Manhattan distance of two
points is a lower bound of the Hamming distance of their fingerprints.

If two points are at most 3 apart, one of their two halves (16 coordinates each) is at most 1 apart.
So a grid over each half with unit cells needs one look into the own cell and one into each cell that
is one step up: 2 x (1 + about 12) rows for each fingerprint, independent of the number of documents.
Pairs that meet there pass the bound over all coordinates and then the exact bit distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, cut, map_texts, whole_row
from .components import roots

SEGMENT = 2  # bits
LOW_BITS = 0x5555555555555555
CHUNK = 1 << 16  # shingles counted at a time, which bounds the memory that a long text takes


def fingerprint_of(text: bytes, shingle: int = 3) -> int:
    """SimHash of a text: majority bits of the XXH64 (seed 42) of its word shingles, repeats included."""
    import xxhash

    words = text.lower().split()  # bytes: only A-Z change, and only the six ASCII spaces split
    if not words:
        return 0
    joined, size = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), dtype=">u8", count=len(words) - size + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at: at + CHUNK]
        ones += np.unpackbits(part.view(np.uint8)).reshape(len(part), 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fingerprint): the fingerprint as a signed long. Texts without words: zero."""
    def work():
        def step(batch):
            found = np.array([fingerprint_of(t, shingle) for t in as_bytes(batch.column(2))], dtype=np.uint64)
            return {"doc_id": batch.column(0), "text_hash": batch.column(1), "fingerprint": pa.array(found.view(np.int64))}
        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return map_texts(rows, "doc_id long, text_hash long, fingerprint long", work)


def _neighbourhood(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For points with 16 counts of 0..2 each: row numbers, cells and 1 for the cells one step up."""
    weights = 3 ** np.arange(points.shape[1], dtype=np.int64)
    home = points @ weights
    row, axis = np.nonzero(points < SEGMENT)
    return (np.concatenate((np.arange(len(points)), row)), np.concatenate((home, home[row] + weights[axis])),
            np.concatenate((np.zeros(len(points), np.int64), np.ones(len(row), np.int64))))


def segment_counts(fingerprint: np.ndarray) -> np.ndarray:
    """Ones in each of the 32 segments."""
    bits = np.unpackbits(fingerprint.astype(">u8").view(np.uint8)).reshape(-1, 64)
    return bits.reshape(-1, 64 // SEGMENT, SEGMENT).sum(axis=2, dtype=np.int64)


def grid(distinct: DataFrame) -> DataFrame:
    """(half, cell, up, fingerprint): the own cell of each half, and the cells one step up from it."""
    def work():
        def step(batch):
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            counts = segment_counts(prints.view(np.uint64))
            parts = [_neighbourhood(counts[:, :16]), _neighbourhood(counts[:, 16:])]
            return {"half": np.concatenate([np.full(len(p[0]), h) for h, p in enumerate(parts)]).astype(np.int32),
                    "cell": np.concatenate([p[1] for p in parts]).astype(np.int32),
                    "up": np.concatenate([p[2] for p in parts]).astype(np.int32),
                    "fingerprint": prints[np.concatenate([p[0] for p in parts])]}
        return step

    return map_texts(distinct.select("fingerprint"), "half int, cell int, up int, fingerprint long", work)


def _segment_bound(a: str, b: str) -> Column:
    """Manhattan distance of two fingerprints' segment counts, in bit arithmetic.

    For each two-bit segment, one mask says whether its count is 1 and one whether it is 2.
    """
    def masks(x):
        high = F.shiftrightunsigned(x, 1)
        return F.col(x).bitwiseXOR(high).bitwiseAND(F.lit(LOW_BITS)), F.col(x).bitwiseAND(high).bitwiseAND(F.lit(LOW_BITS))

    (one_a, two_a), (one_b, two_b) = masks(a), masks(b)
    odd = one_a.bitwiseXOR(one_b)
    return F.bit_count(odd) + 2 * F.bit_count(two_a.bitwiseXOR(two_b).bitwiseAND(F.bitwise_not(odd)))


def links(distinct: DataFrame, bits: int = 3) -> DataFrame:
    """(a, b): the fingerprints that differ in at most ``bits`` bits, a < b, each pair once or more."""
    if bits > 3:
        raise ValueError("the grid looks one cell up in each half, which finds distances up to 3")
    cells = grid(distinct)
    home = cells.filter("up = 0").select("half", "cell", F.col("fingerprint").alias("p"))
    seen = cells.select("half", "cell", "up", F.col("fingerprint").alias("q"))
    met = home.join(seen, ["half", "cell"]).filter("up = 1 OR p < q")
    near = met.filter(_segment_bound("p", "q") <= bits).filter(F.bit_count(F.col("p").bitwiseXOR(F.col("q"))) <= bits)
    return near.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    bits: int = 3) -> DataFrame:
    """(doc_id, text_hash, fingerprint, root, component_id), one row for each row of ``docs``.

    ``component_id`` is the smallest doc_id that can be reached over links, ``root`` the smallest
    fingerprint. Null and blank texts have fingerprint zero, which links like any other. A null doc_id
    is never the smallest; a component that has no other gets null. Repeated rows stay. An empty table
    gives an empty result. Other columns of ``docs`` are not read. Texts of any
    length are hashed whole, a bounded number of shingles at a time.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle))
    distinct = cut(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    linked = roots(cut(links(distinct, bits).distinct()))
    placed = distinct.join(linked.withColumnRenamed("vertex", "fingerprint"), "fingerprint", "left")
    placed = placed.withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = cut(placed.join(smallest, "root").select("fingerprint", "root", "component_id"))
    return prints.join(known, "fingerprint").select("doc_id", "text_hash", "fingerprint", "root", "component_id")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, with all its columns as they are.

    Texts are shuffled once, for the join and the choice among equal rows together."""
    found = near_duplicates(docs, id_col, text_col, **settings)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first"))
    first = first.select("first.unnamed", F.coalesce("first.doc_id", F.lit(0)).alias("id"), "first.text_hash")
    number = F.col(f"`{id_col}`").cast("long")
    keys = ["unnamed", "id", "text_hash"]
    rows = docs.select(number.isNull().alias("unnamed"), F.coalesce(number, F.lit(0)).alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"), whole_row(docs))
    return rows.join(first, keys, "left_semi").dropDuplicates(keys).select("row.*")


def hex_digits(fingerprint: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
