"""Removal of byte strings that occur more than once, by merging Burrows-Wheeler transforms.

Every window of 200 bytes is filed under its anchor, the smallest hash of the 32-byte strings inside it;
equal windows have equal anchors. Neighbouring windows with one anchor form a run, and the text under a
run is its region; the long runs of periodic text are cut, so that a region has at most 368 bytes. Regions that are equal as a whole are counted with a groupBy. What is left are anchors
with several different regions: their windows may or may not be shared. Their regions (each once) go to
the partition of their anchor. There, shards of them are sorted and transformed one by one, and the
transforms of all shards are merged: an interleave of all suffixes starts in one interval and is refined
from right to left, one symbol at a time, by a stable distribution along the transforms' symbols and last-
to-first maps. No suffixes are compared in the merge. After k rounds two suffixes share an interval exactly
if their first k symbols agree, so the common prefixes come out on the way; intervals of one suffix are
dropped at once, for all that is in front of them is unique, too. A symbol stands for 25 bytes, so eight
rounds tell which windows are repeated.

Anchors with very many different regions (the edges of a passage that countless documents share) are not
brought together: their windows are counted by 128-bit hashes, which splits over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, cut, map_texts

WINDOW = 200
ANCHOR = 32
SYMBOL = 25  # bytes; eight make a window
ROUNDS = WINDOW // SYMBOL
STARTS = WINDOW - ANCHOR + 1  # places of an anchor in a window
SHARD = 1 << 18  # bytes transformed together
CHUNK = 1 << 20  # bytes of shards merged together, if the last anchor's regions end there
CROWD = 20_000  # different regions of an anchor from which its windows are counted by hash
# Odd multipliers of the hashes.
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _eights(raw: bytes) -> np.ndarray:
    """The 8 bytes from each place on, as numbers."""
    return np.ndarray((max(0, len(raw) - 7),), "<u8", buffer=raw, strides=(1,)) if len(raw) >= 8 else np.empty(0, np.uint64)


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    out = parts[0] * MIX[0]
    for part, factor in zip(parts[1:], MIX[1:], strict=False):
        out ^= out >> np.uint64(31)
        out += part
        out *= factor
    return out ^ (out >> np.uint64(29))


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each stretch of ``size`` values."""
    step = 1
    while step * 2 <= size:
        values = pick(values[:-step], values[step:])
        step *= 2
    return pick(values[: len(values) - (size - step)], values[size - step:]) if size > step else values


def runs(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window start of each run, its anchor, and whether the anchor occurs twice in it."""
    if len(raw) < WINDOW:
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(bool)
    x, n = _eights(raw), len(raw) - ANCHOR + 1
    hashes = _mixed([x[k: k + n] for k in range(0, ANCHOR, 8)])
    least = _sliding(hashes, STARTS, np.minimum)
    change = np.flatnonzero(least[1:] != least[:-1]) + 1
    first, last = np.concatenate(([0], change)), np.concatenate((change - 1, [len(least) - 1]))
    anchors = least[first]
    twice = np.zeros(len(first), bool)
    edge = np.zeros(STARTS - 1, np.uint64)
    selected = np.count_nonzero(hashes == _sliding(np.concatenate((edge, least, edge)), STARTS, np.maximum))
    if selected != len(first):
        twice[:] = [np.count_nonzero(hashes[a: b + STARTS] == h) > 1 for a, b, h in zip(first.tolist(), last.tolist(), anchors, strict=True)]
    return first, last, anchors, twice


# --- transforms ------------------------------------------------------------------------------------------

class Transform:
    """The Burrows-Wheeler transform of a shard: symbols before the sorted suffixes, and the last-to-first map.

    A region's suffixes start at each of its bytes and step by one symbol (25 bytes), so a region is 25
    strings, one for each phase. A suffix without a symbol before it has -1 in the map.
    """

    def __init__(self, regions: list[bytes]):
        sizes = np.array([len(r) + 1 for r in regions], np.int64)  # with the empty suffix at the end
        starts = np.cumsum(sizes) - sizes
        text = b"\0".join(regions) + bytes(SYMBOL + 8)
        n = int(sizes.sum())
        x = _eights(text)
        symbols = _mixed([x[k: k + n] for k in (0, 8, 16, SYMBOL - 8)])
        inside = np.arange(n) - np.repeat(starts, sizes)
        symbols[inside + SYMBOL >= np.repeat(sizes, sizes)] = 0  # the last, shorter pieces end the strings
        rank, step = np.unique(symbols, return_inverse=True)[1].astype(np.int64), 1
        room = np.repeat(sizes, sizes) - inside
        while step < ROUNDS:  # order by 2, 4, 8 symbols
            ahead = np.zeros(n, np.int64)
            reach = np.flatnonzero(room > step * SYMBOL)
            ahead[reach] = rank[reach + step * SYMBOL] + 1
            rank = np.unique(rank * (n + 1) + ahead, return_inverse=True)[1].astype(np.int64)
            step *= 2
        order = np.argsort(rank, kind="stable")
        row = np.empty(n, np.int64)
        row[order] = np.arange(n)
        before = order - SYMBOL
        has = inside[order] >= SYMBOL
        self.size, self.place, self.text = n, order, text
        self.symbol = np.where(has, symbols[np.where(has, before, 0)], 0)
        self.back = np.where(has, row[np.where(has, before, 0)], -1)
        self.region, self.inside = np.repeat(np.arange(len(regions)), sizes)[order], inside[order]


def merged(transforms: list[Transform]) -> tuple[np.ndarray, np.ndarray]:
    """Rows (over all transforms, one after the other) whose first eight symbols occur twice, and the interval of each."""
    offset = np.cumsum([0, *[t.size for t in transforms]])
    symbol = np.concatenate([t.symbol for t in transforms])
    back = np.concatenate([np.where(t.back >= 0, t.back + o, -1) for t, o in zip(transforms, offset, strict=False)])
    rows, interval = np.arange(len(symbol)), np.zeros(len(symbol), np.int64)
    for _ in range(ROUNDS):
        kept = back[rows] >= 0
        rows, interval = rows[kept], interval[kept]
        spread = np.argsort(symbol[rows], kind="stable")
        rows, interval = rows[spread], interval[spread]
        letters = symbol[rows]
        new = np.ones(len(rows), bool)
        new[1:] = (letters[1:] != letters[:-1]) | (interval[1:] != interval[:-1])
        interval = np.cumsum(new) - 1
        several = np.bincount(interval, minlength=1)[interval] > 1 if len(rows) else np.empty(0, bool)
        rows, interval = back[rows][several], interval[several]
    return rows, interval


def repeated_starts(regions: list[bytes]) -> list[np.ndarray]:
    """For each region the places from which its next 200 bytes stand at another place of the regions, too."""
    shards, held = [[]], 0
    for i, region in enumerate(regions):
        if held and held + len(region) > SHARD:
            shards.append([])
            held = 0
        shards[-1].append(i)
        held += len(region)
    transforms = [Transform([regions[i] for i in shard]) for shard in shards if shard]
    if not transforms:
        return []
    rows, interval = merged(transforms)
    _check(transforms, rows, interval)
    region = np.concatenate([np.array(s)[t.region] for t, s in zip(transforms, shards, strict=True)])[rows]
    inside = np.concatenate([t.inside for t in transforms])[rows]
    order = np.lexsort((inside, region))
    region, inside = region[order], inside[order]
    bounds = np.searchsorted(region, np.arange(len(regions) + 1))
    return [inside[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _check(transforms: list[Transform], rows: np.ndarray, interval: np.ndarray) -> None:
    """Compares the bytes of neighbours in an interval, for symbols were compared by their hashes."""
    base = np.cumsum([0, *[len(t.text) for t in transforms]])
    text = _eights(b"".join(t.text for t in transforms))
    place = np.concatenate([t.place + b for t, b in zip(transforms, base, strict=False)])[rows]
    same = np.flatnonzero(interval[1:] == interval[:-1])
    for k in range(0, WINDOW, 8):
        if (text[place[same] + k] != text[place[same + 1] + k]).any():
            raise ValueError("two symbols have one hash; take other multipliers")


def stretches(starts: np.ndarray) -> list[tuple[int, int]]:
    """Joined byte ranges that windows at the given ascending starts cover."""
    if not len(starts):
        return []
    cut_at = np.flatnonzero(np.diff(starts) > WINDOW) + 1
    return [(int(s[0]), int(s[-1]) + WINDOW) for s in np.split(starts, cut_at)]


# --- jobs ------------------------------------------------------------------------------------------------

KEYS = "doc_id long, text_hash long"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))


def _cut_runs(first: np.ndarray, last: np.ndarray, anchors: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of at most ``STARTS`` windows; only in periodic text are there longer ones. Each window stays in one run."""
    parts = (last - first) // STARTS + 1
    row = np.repeat(np.arange(len(first)), parts)
    start = first[row] + STARTS * (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts))
    return start, np.minimum(start + STARTS - 1, last[row]), anchors[row], twice[row]


def region_rows(keyed: DataFrame) -> DataFrame:
    """(doc_id, text_hash, anchor, region, first, last, twice): a row for each run; ``region`` hashes its text."""
    import xxhash

    digest = xxhash.xxh64_intdigest

    def work():
        def step(batch):
            rows, out = [], [[], [], [], [], []]
            for i, text in enumerate(as_bytes(batch.column(2))):
                first, last, anchors, twice = _cut_runs(*runs(text))
                rows.append(np.full(len(first), i))
                hashed = np.fromiter((digest(text[a: b + WINDOW]) for a, b in zip(first.tolist(), last.tolist(), strict=True)), np.uint64, len(first))
                for column, values in zip(out, (anchors.view(np.int64), hashed.view(np.int64), first, last, twice), strict=True):
                    column.append(values)
            rows = np.concatenate(rows) if rows else np.empty(0, np.int64)
            anchor, region, first, last, twice = (np.concatenate(c) if c else np.empty(0, np.int64) for c in out)
            return {"doc_id": batch.column(0).take(pa.array(rows)), "text_hash": batch.column(1).take(pa.array(rows)), "anchor": anchor,
                    "region": region, "first": first.astype(np.int32), "last": last.astype(np.int32), "twice": twice.astype(bool)}
        return step

    return map_texts(keyed, f"{KEYS}, anchor long, region long, first int, last int, twice boolean", work)


def _same(a: DataFrame, b: DataFrame):
    return (a.text_hash == b.text_hash) & a.doc_id.eqNullSafe(b.doc_id)


def _region_texts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, doc_id, text_hash, first, text) of the wanted regions, once more for each equal row of ``keyed``."""
    lists = wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("anchor", "first", "last")).alias("parts"))
    rows = keyed.join(lists, _same(keyed, lists)).select(keyed.doc_id, keyed.text_hash, keyed.text, "parts")

    def work():
        def step(batch):
            row, anchor, first, text = [], [], [], []
            for i, (raw, parts) in enumerate(zip(as_bytes(batch.column(2)), batch.column(3).to_pylist(), strict=True)):
                for p in parts:
                    row.append(i)
                    anchor.append(p["anchor"])
                    first.append(p["first"])
                    text.append(raw[p["first"]: p["last"] + WINDOW])
            return {"doc_id": batch.column(0).take(pa.array(row, pa.int64())), "text_hash": batch.column(1).take(pa.array(row, pa.int64())),
                    "anchor": anchor, "first": first, "text": pa.array(text, pa.binary())}
        return step

    return map_texts(rows, f"{KEYS}, anchor long, first int, text binary", work)


MARKS = f"{KEYS}, start int, stop int"


def _merged_marks(texts: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, stop): repeated stretches, from regions that meet in their anchor's partition."""
    rows = texts.select("anchor", "doc_id", "text_hash", "first", "text").repartition("anchor").sortWithinPartitions("anchor")
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple, bytes] = {}  # by place, so that equal rows of the table bring a region once
        size, last = 0, None

        def marks():
            out: list[list] = [[], [], [], []]
            for (doc_id, text_hash, first), starts in zip(waiting, repeated_starts(list(waiting.values())), strict=True):
                for a, b in stretches(starts):
                    for column, value in zip(out, (doc_id, text_hash, first + a, first + b), strict=True):
                        column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

        for batch in batches:
            for anchor, *place, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if size >= CHUNK and anchor != last:
                    yield marks()
                    waiting, size = {}, 0
                waiting[tuple(place)] = text
                size, last = size + len(text), anchor
        if waiting:
            yield marks()

    return rows.mapInArrow(run, MARKS)


def _counted_marks(texts: DataFrame) -> DataFrame:
    """The same for crowded anchors: windows are counted by their hashes."""
    def work():
        def step(batch):
            row, start, one, two = [], [], [], []
            for i, (first, text) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                for at in range(len(text) - WINDOW + 1):
                    digest = hashlib.blake2b(text[at: at + WINDOW], digest_size=16).digest()
                    row.append(i)
                    start.append(first + at)
                    one.append(int.from_bytes(digest[:8], "little", signed=True))
                    two.append(int.from_bytes(digest[8:], "little", signed=True))
            return {"doc_id": batch.column(0).take(pa.array(row, pa.int64())), "text_hash": batch.column(1).take(pa.array(row, pa.int64())),
                    "start": start, "one": one, "two": two}
        return step

    windows = map_texts(texts.select("doc_id", "text_hash", "first", "text"), f"{KEYS}, start int, one long, two long", work)
    windows = cut(windows.distinct())  # equal rows of the table bring a window once
    common = windows.groupBy("one", "two").agg(F.count("*").alias("n")).filter("n > 1")
    return windows.join(common, ["one", "two"]).select("doc_id", "text_hash", "start", (F.col("start") + WINDOW).cast("int").alias("stop"))


def repeated_stretches(keyed: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(doc_id, text_hash, start, stop): byte ranges, which may overlap, whose union is all that repeated windows cover."""
    rows = cut(region_rows(keyed))
    kinds = rows.groupBy("anchor", "region").agg(F.count("*").alias("n"), F.max("twice").alias("twice"))
    anchors = kinds.groupBy("anchor").agg(F.sum("n").alias("rows"), F.count("*").alias("regions"), F.min("n").alias("fewest"),
                                          F.max(F.col("twice") & (F.col("n") == 1)).alias("inner")).filter("rows > 1 OR inner")
    known = kinds.join(anchors, "anchor").select(
        "anchor", "region", "n", ((F.col("fewest") == 1) & ((F.col("regions") > 1) | F.col("inner"))).alias("open"), (F.col("regions") > crowd).alias("crowded"))
    known = cut(known.filter("n > 1 OR open"))
    tagged = cut(rows.join(known, ["anchor", "region"]))
    marks = tagged.filter("n > 1").select("doc_id", "text_hash", F.col("first").alias("start"), (F.col("last") + WINDOW).cast("int").alias("stop"))

    place = ["doc_id", "text_hash", "first", "last"]
    shared = tagged.filter("open AND n > 1").groupBy("anchor", "region").agg(F.min(F.struct(*place)).alias("one"), F.max("crowded").alias("crowded"))
    wanted = tagged.filter("open AND n = 1").select("anchor", "crowded", *place).unionByName(shared.select("anchor", "crowded", "one.*"))
    marks = marks.unionByName(_merged_marks(_region_texts(keyed, wanted.filter("NOT crowded"))))
    if not known.filter("crowded").isEmpty():
        marks = marks.unionByName(_counted_marks(_region_texts(keyed, wanted.filter("crowded"))))
    return marks


SPANS = "array<struct<start:int,stop:int>>"


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): removed byte ranges, ascending and apart, and the other bytes; one row for each row of ``docs``.

    Bytes under a 200-byte string that also starts anywhere else are removed. Null texts are empty; a
    repeated row repeats all its strings; rows with one id are documents of their own. Other columns are
    not read; an empty table gives an empty result. Texts of any length are searched whole.
    """
    keyed = _keyed(docs, id_col, text_col)
    marks = repeated_stretches(keyed, crowd).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "stop")).alias("marks"))
    marks = marks.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "marks")
    rows = keyed.join(marks, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "marks")

    def work():
        def step(batch):
            sizes, removed, kept = [], [], []
            for raw, marked in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                spans: list[list[int]] = []
                for start, stop in sorted((m["start"], m["stop"]) for m in marked or ()):
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], stop)
                    else:
                        spans.append([start, stop])
                sizes.append(len(raw))
                removed.append([{"start": a, "stop": b} for a, b in spans])
                kept.append(b"".join(raw[a:b] for a, b in zip([0, *[s[1] for s in spans]], [*[s[0] for s in spans], len(raw)], strict=True)))
            return {"doc_id": batch.column(0), "n_bytes": sizes, "removed": pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                    "kept": pa.array(kept, pa.binary())}
        return step

    return map_texts(rows, f"doc_id long, n_bytes long, removed {SPANS}, kept binary", work)
