"""Links between texts whose sets of word shingles are nearly equal (Jaccard), by size-banded tiles.

Sets are arrays of sorted 64-bit shingle hashes. Two sets that link differ in few elements: with sizes a <= b and
similarity t, in at most (1 - t) / (1 + t) * (a + b). Sets are banded by size; in a band this gives one bound d for
all pairs whose smaller set is in it. The range of hashes is cut into more than d parts, so linked sets have equal
content in some part, and the content of each part, hashed, names the tile in which sets meet. (A set with so many
empty parts that only these could be equal takes further cuts of a mixed range besides; both sets of such a pair do.)
A tile so holds sets that share several shingles in one place, not all that share a common one.

In a tile, hashed bitmaps are compared: a bit that only one of two sets has stands for an element that the other lacks,
so bit counts bound the overlap from above. Pairs that pass the bound are counted exactly on the sorted arrays.

Pairs are not emitted for whole tiles. Each set first meets the smallest set of each of its tiles, which settles
groups of near copies; pairs inside a component that is known are not looked at again. Only tiles that still hold several components go on: those of their sets that
are not in the largest component meet one block of about 256 others first, of which only the most similar one is passed on for each of them. Most sets
that link with any other are placed by that. In tiles that hold several components even then, they meet all others in blocks of about 256 by 256, split
over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, cut, map_texts
from .components import roots

BLOCK = 256  # sets of a side of a block
GROWTH = 1.4  # width of a size band
CUTS = 6  # further cuts of the hash range for sets with many empty parts


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, size: int = 4) -> np.ndarray:
    """Sorted hashes of the distinct word shingles of a text; fewer words make one shingle, none an empty set."""
    import xxhash

    words = text.lower().split()  # bytes: only A-Z change, and only the six ASCII spaces split
    if not words:
        return np.empty(0, np.uint64)
    joined, size = b" ".join(words), min(size, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1:].tolist(), strict=True)
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in spans), np.uint64, len(words) - size + 1))


class Bands:
    """Size bands for links at ``num`` / ``den``: for each (low, high, parts, spare). Its pairs have their smaller set in
    low.. below the next band's low, and the larger one up to high; of their parts at least ``spare`` are equal. Zero parts:
    each element is one."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.bands = num, den, []
        self.next = -(-num // (den - num))  # smaller sets link only if they are equal

    def _extend(self) -> None:
        low = self.next
        self.next = max(low + 2, int(low * GROWTH))
        small = self.next - 1
        high = small * self.den // self.num
        differ = (self.den - self.num) * (small + high) // (self.den + self.num)
        for spare in range(2, low + 2):  # so many that a set rarely has as many empty parts
            parts = differ + spare
            empty = parts * (1 - 1 / parts) ** low
            if spare >= empty + 3 * empty ** 0.5:
                break
        else:  # very small sets of low similarity: each element is a part
            parts = spare = 0
        self.bands.append((low, high, parts, spare))

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """(band, parts, spare) of all bands in which a set of this size may have partners."""
        while self.next <= size:
            self._extend()
        return [(k, parts, spare) for k, (low, high, parts, spare) in enumerate(self.bands) if low <= size <= high]


def tile_keys(hashes: np.ndarray, bands: Bands) -> np.ndarray:
    """Names of the tiles of a set: one for each part that is not empty, in each band."""
    found = []
    for band, parts, spare in bands.of(len(hashes)):
        for cut_no in range(CUTS + 1):
            salt = np.uint64((band * (CUTS + 2) + cut_no + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
            if cut_no == CUTS:  # practically never
                found.append(_mixed(np.array([salt])))
                break
            if not parts:
                found.append(_mixed(hashes ^ salt))
                break
            spread = np.sort(_mixed(hashes + np.uint64(cut_no))) if cut_no else hashes
            part = (spread >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            content = np.add.reduceat(_mixed(spread ^ np.uint64(0x5851F42D4C957F2D)), first)
            found.append(_mixed(content ^ _mixed(part[first] + salt)))
            if parts - len(first) < spare:
                break
    return np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)


def bitmap(hashes: np.ndarray) -> bytes:
    """Bit ``hash mod size`` for each element; the size is a power of two, four to eight times as many bits as elements."""
    size = max(64, 1 << (4 * len(hashes) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(hashes & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bits: bytes, size: int) -> np.ndarray:
    """The bitmap with ``size`` bytes: halves laid on each other."""
    out = np.frombuffer(bits, np.uint64)
    while out.nbytes > size:
        out = out[: len(out) // 2] | out[len(out) // 2:]
    return out


def overlap_bound(one: tuple[int, np.ndarray], sizes: np.ndarray, maps: np.ndarray) -> np.ndarray:
    """Most elements that a set (size, bitmap) can share with each of several sets."""
    size, bits = one
    mine = np.bitwise_count(bits & ~maps).sum(axis=1, dtype=np.int64)
    theirs = np.bitwise_count(maps & ~bits).sum(axis=1, dtype=np.int64)
    return np.minimum(size - mine, sizes - theirs)


def described(docs: DataFrame, id_col: str, text_col: str, shingle: int, num: int, den: int) -> DataFrame:
    """(doc_id, text_hash, set_id, size, bits, tiles) for each row."""
    def work():
        bands = Bands(num, den)

        def step(batch):
            sets = [shingle_set(t, shingle) for t in as_bytes(batch.column(2))]
            ids = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in sets]
            keys = [tile_keys(s, bands) for s in sets]
            offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int64), *keys])
            return {"doc_id": batch.column(0), "text_hash": batch.column(1), "set_id": ids, "size": [len(s) for s in sets],
                    "bits": [bitmap(s) if len(s) else None for s in sets],
                    "tiles": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))}
        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return map_texts(rows, "doc_id long, text_hash long, set_id long, size long, bits binary, tiles array<long>", work)


def _may_link(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, share): the pairs (a, b) whose bitmaps allow a link, and the similarity that they allow in thousandths."""
    def work():
        def step(batch):
            a, b, size_a, bits_a, size_b, bits_b = (c.to_pylist() for c in batch.columns)
            share = np.zeros(len(a), np.int64)
            for i in range(len(a)):
                width = min(len(bits_a[i]), len(bits_b[i]))
                most = int(overlap_bound((size_a[i], _folded(bits_a[i], width)), np.array([size_b[i]]), _folded(bits_b[i], width)[None, :])[0])
                union = size_a[i] + size_b[i] - most
                share[i] = 1000 * most // union if den * most >= num * union else -1
            return {"a": a, "b": b, "share": share}
        return step

    one = sets.select(F.col("set_id").alias("a"), F.col("size").alias("size_a"), F.col("bits").alias("bits_a"))
    other = sets.select(F.col("set_id").alias("b"), F.col("size").alias("size_b"), F.col("bits").alias("bits_b"))
    rows = pairs.join(one, "a").join(other, "b").select("a", "b", "size_a", "bits_a", "size_b", "bits_b")
    return map_texts(rows, "a long, b long, share long", work).filter("share >= 0")


def _arrays(ids: DataFrame, sets: DataFrame, docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(set_id, hashes): the sorted arrays of the sets, from their texts."""
    def work():
        def step(batch):
            arrays = [shingle_set(t, shingle).view(np.int64) for t in as_bytes(batch.column(1))]
            offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
            return {"set_id": batch.column(0), "hashes": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))}
        return step

    wanted = sets.join(ids, "set_id", "left_semi").select("set_id", F.col("text_hash").alias("wanted"))
    texts = docs.select(F.xxhash64(text_col).alias("found"), F.col(text_col).alias("text"))
    rows = texts.join(wanted, F.col("found") == F.col("wanted")).dropDuplicates(["set_id"])
    return map_texts(rows.select("set_id", "text"), "set_id long, hashes array<long>", work)


def _linked(pairs: DataFrame, arrays: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): the pairs that link, by intersection of their sorted arrays."""
    def work():
        def step(batch):
            lists = [batch.column(i) for i in (2, 3)]
            flat = [c.flatten().to_numpy(zero_copy_only=False).view(np.uint64) for c in lists]
            ends = [np.cumsum(c.value_lengths().to_numpy(zero_copy_only=False)) for c in lists]
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (f[(e[i - 1] if i else 0): e[i]] for f, e in zip(flat, ends, strict=True))
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int(np.count_nonzero(y[place] == x))
                good[i] = den * both >= num * (len(x) + len(y) - both)
            return {"a": batch.column(0), "b": batch.column(1), "good": good}
        return step

    one, other = (arrays.select(F.col("set_id").alias(n), F.col("hashes").alias(f"of_{n}")) for n in ("a", "b"))
    rows = pairs.select("a", "b").join(one, "a").join(other, "b").select("a", "b", "of_a", "of_b")
    return map_texts(rows, "a long, b long, good boolean", work).filter("good").select("a", "b")


def _placed(frame: DataFrame, column: str, component: DataFrame, name: str) -> DataFrame:
    """``frame`` with the component (the set itself if it has no link) of the set in ``column``."""
    at = component.select(F.col("vertex").alias("at"), F.col("root").alias("found"))
    return frame.join(at, F.col(column) == F.col("at"), "left").withColumn(name, F.coalesce("found", column)).drop("at", "found")


def _blocks(members: DataFrame, sets: DataFrame, num: int, den: int, whole: bool = True) -> DataFrame:
    """(a, b, share): pairs of different components in one tile that bitmaps allow to link, without those of the tile's
    first set, and the similarity that they allow in thousandths. Not ``whole``: of each set in a tile only the most similar
    pair with one block of others, so no more pairs than there are members."""
    parts = members.groupBy("tile", "component").agg(F.count(F.lit(1)).alias("n"))
    tiles = parts.groupBy("tile").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("most"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    tiles = tiles.filter("parts > 1").select("tile", blocks(F.col("all") - F.col("most.n")).alias("rows"), blocks(F.col("all")).alias("columns"),
                                             F.col("most.component").alias("home"))
    inside = members.join(tiles, "tile")
    spot = lambda n: F.pmod(F.xxhash64("set_id"), F.col(n)).cast("int")
    chosen = F.pmod(F.xxhash64("tile"), F.col("columns")).cast("int")
    met = F.sequence(F.lit(0), F.col("columns") - 1) if whole else F.array(chosen)
    upright = inside.filter("component <> home").select("tile", spot("rows").alias("i"), F.explode(met).alias("j"),
                                                        F.lit(0).alias("side"), "set_id", "component")
    inside = inside if whole else inside.filter(spot("columns") == chosen)
    across = inside.select("tile", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), spot("columns").alias("j"), F.lit(1).alias("side"), "set_id", "component")
    dealt = upright.union(across).join(sets.select("set_id", "size", "bits"), "set_id")
    dealt = dealt.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j", "side").select("tile", "i", "j", "side", "set_id", "component", "size", "bits")

    def compare(rows: list[tuple]) -> list[tuple[int, int, int]]:
        split = next((k for k, r in enumerate(rows) if r[0]), len(rows))
        left, right = rows[:split], rows[split:]
        if not left or not right:
            return []
        width = min(len(r[4]) for r in rows)
        ids, parts, sizes = (np.array([r[k] for r in right], np.int64) for k in (1, 2, 3))
        maps = np.stack([_folded(r[4], width) for r in right])
        out = []
        for _, set_id, component, size, bits in left:
            most = overlap_bound((size, _folded(bits, width)), sizes, maps)
            union = size + sizes - most
            near = np.flatnonzero((parts != component) & (den * most >= num * union))
            share = 1000 * most[near] // union[near]
            if len(near) > 1 and not whole:
                near, share = near[[share.argmax()]], share[[share.argmax()]]
            out += [(min(set_id, i), max(set_id, i), s) for i, s in zip(ids[near].tolist(), share.tolist(), strict=True)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            pairs = []
            for tile, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (tile, i, j) != key:
                    pairs += compare(rows)
                    key, rows = (tile, i, j), []
                rows.append(row)
            yield table_of(pairs)
        yield table_of(compare(rows))

    def table_of(pairs: list[tuple[int, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in range(3)], ["a", "b", "share"])

    return dealt.mapInArrow(run, "a long, b long, share long").groupBy("a", "b").agg(F.max("share").alias("share"))


def _merged(component: DataFrame, edges: DataFrame) -> DataFrame:
    """The components after links between some of them, given as (a, b) by their roots."""
    higher = roots(edges)
    up = higher.select(F.col("vertex").alias("at"), F.col("root").alias("up"))
    known = component.join(up, component.root == F.col("at"), "left").select("vertex", F.coalesce("up", "root").alias("root"))
    return cut(known.union(higher.join(component.select("vertex"), "vertex", "left_anti").select("vertex", "root")))


def _settled(component: DataFrame, pairs: DataFrame, sets: DataFrame, docs: DataFrame, text_col: str, shingle: int, num: int, den: int) -> DataFrame:
    """The components after all links among the pairs (a, b, share).

    Of the pairs between the same two components, the most similar come first: once one of them links, the others have
    nothing to add. The pairs taken in a round grow, so few rounds settle also components that many pairs do not link.
    """
    take = 1
    while True:
        ends = _placed(_placed(pairs, "a", component, "of_a"), "b", component, "of_b").filter("of_a <> of_b")
        ends = ends.withColumns({"low": F.least("of_a", "of_b"), "high": F.greatest("of_a", "of_b")})
        order = Window.partitionBy("low", "high").orderBy(F.desc("share"), "a", "b")
        now = cut(ends.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= take).select("a", "b", "low", "high"))
        if now.isEmpty():
            return component
        ids = now.select(F.col("a").alias("set_id")).union(now.select("b")).distinct()
        good = cut(_linked(now, _arrays(ids, sets, docs, text_col, shingle), num, den))
        if not good.isEmpty():
            component = _merged(component, now.join(good, ["a", "b"]).select(F.col("low").alias("a"), F.col("high").alias("b")).distinct())
        pairs, take = cut(ends.join(now.select("a", "b"), ["a", "b"], "left_anti").select("a", "b", "share")), 32 * take


def set_components(sets: DataFrame, docs: DataFrame, text_col: str, shingle: int, num: int, den: int) -> DataFrame:
    """(vertex, root): the component, named by its smallest set, of every set that links with another one."""
    entries = sets.select("set_id", F.explode("tiles").alias("tile"))
    tiles = entries.groupBy("tile").agg(F.min("set_id").alias("first"), F.max("set_id").alias("last")).filter("first < last").select("tile", "first")
    members = cut(entries.join(cut(tiles), "tile").filter("set_id <> first"))
    # Each set with the first set that it shares most tiles with.
    shared = members.groupBy(F.col("set_id").alias("a"), F.col("first").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    nearest = shared.groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("b"))
    nearest = cut(_may_link(nearest, sets, num, den))
    ids = nearest.select(F.col("a").alias("set_id")).union(nearest.select("b")).distinct()
    component = roots(cut(_linked(nearest, _arrays(ids, sets, docs, text_col, shingle), num, den)))
    # Then with those first sets that are in another component still.
    apart = _placed(_placed(members, "set_id", component, "of_a"), "first", component, "of_b").filter("of_a <> of_b")
    star = apart.select(F.col("set_id").alias("a"), F.col("first").alias("b")).distinct().join(nearest, ["a", "b"], "left_anti")
    component = _settled(component, cut(_may_link(star, sets, num, den)), sets, docs, text_col, shingle, num, den)
    # Tiles that hold several components still: the most similar pairs first, then all of what is left.
    some = cut(_blocks(cut(_placed(members, "set_id", component, "component")), sets, num, den, whole=False))
    component = _settled(component, some, sets, docs, text_col, shingle, num, den)
    rest = cut(_blocks(cut(_placed(members, "set_id", component, "component")), sets, num, den))
    return _settled(component, rest, sets, docs, text_col, shingle, num, den)


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, set_id, n_shingles, component_id), one row for each row of ``docs``.

    A text's set has its distinct shingles of lower-cased (A-Z) words; a text of fewer words has one shingle of all of them.
    Two texts link at Jaccard similarity ``num`` / ``den`` or more; ``component_id`` is the smallest doc_id that links lead
    to. Null, empty and blank texts have no shingles and link with nothing: their component is their own doc_id, also for
    repeated rows. A null doc_id is never the smallest; a component without any other gets null. Repeated rows stay. An
    empty table gives an empty result. Other columns of ``docs`` are not read. Shingles and sets are told apart by 64-bit
    hashes. Long texts are handled whole; one text must fit into a task.
    """
    if not 0 < num < den:
        raise ValueError("the similarity must lie between 0 and 1")
    rows = cut(described(docs, id_col, text_col, shingle, num, den))
    sets = cut(rows.filter("size(tiles) > 0").select("set_id", "text_hash", "size", "bits", "tiles").dropDuplicates(["set_id"]))
    component = set_components(sets, docs, text_col, shingle, num, den)
    placed = rows.select("doc_id", "set_id", F.col("size").alias("n_shingles"))
    full = _placed(placed.filter("n_shingles > 0"), "set_id", component, "root")
    smallest = full.groupBy(F.col("root").alias("of")).agg(F.min("doc_id").alias("component_id"))
    found = full.join(smallest, F.col("root") == F.col("of")).select("doc_id", "set_id", "n_shingles", "component_id")
    return found.union(placed.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id")))
