"""Benchmark passages in documents, by a prefix-filtered set join with exact verification.

An item's windows are its runs of 13 words (or the whole item, if shorter). A window occurs in a
document only if all its words do, so with words ordered from rare to common the required prefix of
that containment is one word: the window's rarest. Documents are searched for these words alone. A
hit at word p, with the rare word at offset k of the window, can only be the occurrence that starts at
p - k (positional bound) and must end inside the document (length bound); it counts when all words of
the window stand there.

The windows go to the tasks in blocks of a fixed size, each of which meets all documents, so the
benchmark may be of any size; documents are not shuffled.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, cut, map_texts

WINDOW = 13
BLOCK_WORDS = 2_000_000  # words of benchmark text that one block may hold (its size in a task is bounded by that)
# ASCII bytes that are not part of words.
GAPS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_SPACE = bytes.maketrans(GAPS, b" " * len(GAPS))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return text.lower().translate(_TO_SPACE).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> Iterator[tuple[bytes, ...]]:
    if words:
        for at in range(max(1, len(words) - size + 1)):
            yield tuple(words[at: at + size])


def _word_counts(docs: DataFrame, text_col: str, vocabulary: DataFrame) -> DataFrame:
    """(word, n): how many documents hold each word of the vocabulary."""
    def work():
        def step(batch):
            seen: Counter = Counter()
            for text in as_bytes(batch.column(0)):
                seen.update(set(words_of(text)))
            return {"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())}
        return step

    found = map_texts(docs.select(F.col(text_col).alias("text")), "word binary, n long", work)
    return found.join(vocabulary, "word", "left_semi").groupBy("word").agg(F.sum("n").alias("n"))


def item_windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(item_id, words): the distinct windows of each item."""
    def work():
        def step(batch):
            ids, windows = [], []
            for item, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                for window in dict.fromkeys(windows_of(words_of(text), size)):
                    ids.append(item)
                    windows.append(list(window))
            return {"item_id": pa.array(ids, pa.string()), "words": pa.array(windows, pa.list_(pa.binary()))}
        return step

    rows = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))
    return map_texts(rows, "item_id string, words array<binary>", work).distinct()


def rare_word_index(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str, size: int) -> DataFrame:
    """(rare, offset, words, item_ids, block): each window with the word that documents hold least often."""
    windows = cut(item_windows(items, item_id, item_text, size).groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")))
    spread = windows.select("words", F.posexplode("words").alias("offset", "word"))
    counts = _word_counts(docs, text_col, spread.select("word").distinct())
    ranked = spread.join(counts, "word", "left").groupBy("words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("first"))
    indexed = ranked.join(windows, "words").select(F.col("first.word").alias("rare"), F.col("first.offset").alias("offset"), "words", "item_ids")
    return cut(indexed)


def _blocks(index: DataFrame) -> Iterator[dict]:
    """The index in bounded parts, read one after the other: {rare word: [(offset, window, items)]}."""
    block, held = defaultdict(list), 0
    for row in index.toLocalIterator():
        block[bytes(row.rare)].append((row.offset, [bytes(w) for w in row.words], list(row.item_ids)))
        held += len(row.words) + len(row.item_ids)
        if held >= BLOCK_WORDS:
            yield dict(block)
            block, held = defaultdict(list), 0
    yield dict(block)


def occurrences(words: list[bytes], block: dict, rare: frozenset) -> tuple[list[tuple[int, int]], set[str]]:
    """(start, end) of each window of the block in the words, and the items with such windows."""
    spans, items = [], set()
    if not rare.isdisjoint(words):
        for at, word in enumerate(words):
            if word in rare:
                for offset, window, ids in block[word]:
                    start = at - offset
                    if start >= 0 and start + len(window) <= len(words) and words[start: start + len(window)] == window:
                        spans.append((start, start + len(window)))
                        items.update(ids)
    return spans, items


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, without overlaps."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


SPANS = "array<struct<start:int,stop:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def marked(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
           size: int = WINDOW) -> DataFrame:
    """``docs`` with a column ``decontaminated``: struct(n_words, spans of hit words, item_ids).

    An earlier column of that name is replaced. Null texts and items have no words; repeated rows stay;
    texts of any length are searched whole; rows of an item id count as one item; items without an id are left out. With an empty benchmark
    nothing is hit.
    """
    index = rare_word_index(docs, items, text_col, item_id, item_text, size)
    context = docs.sparkSession.sparkContext
    out = docs.drop("decontaminated").withColumn("decontaminated", F.lit(None).cast(f"struct<n_words:int,spans:{SPANS},item_ids:array<string>>"))
    for number, block in enumerate(_blocks(index)):
        if number:
            out = cut(out)  # so that a task holds one block at a time
        out = out.withColumn("decontaminated", _search(context.broadcast(block))(F.col(text_col), F.col("decontaminated")))
    return out


def _search(shared):
    """A column function: what was found so far, with the occurrences of one block added."""
    @F.arrow_udf(f"struct<n_words:int,spans:{SPANS},item_ids:array<string>>")
    def search(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        block = shared.value
        rare = frozenset(block)
        for texts, before in parts:
            sizes, spans, items = [], [], []
            for text, old in zip(as_bytes(texts), before.to_pylist(), strict=True):
                words = words_of(text)
                found, ids = occurrences(words, block, rare)
                if old:
                    found += [(s["start"], s["stop"]) for s in old["spans"]]
                    ids.update(old["item_ids"])
                sizes.append(len(words))
                spans.append([{"start": a, "stop": b} for a, b in _joined(found)])
                items.append(sorted(ids))
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int32()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))],
                                             names=["n_words", "spans", "item_ids"])
    return search


def hit_words(found: str = "decontaminated"):
    """How many words the spans cover."""
    return F.aggregate(f"{found}.spans", F.lit(0).cast("long"), lambda n, s: n + s.stop - s.start)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row for each row of ``docs``.

    A document is contaminated when at least one word in twenty is hit, and one word at least.
    """
    rows = marked(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), items, **settings)
    rows = rows.select("doc_id", "decontaminated", hit_words().alias("n_hit"))
    return rows.select("doc_id", F.col("decontaminated.n_words").cast("long").alias("n_words"), "n_hit",
                       F.size("decontaminated.item_ids").cast("long").alias("n_items"),
                       F.sha2(F.array_join("decontaminated.item_ids", ","), 256).alias("items_sha256"),
                       is_contaminated(F.col("n_hit"), F.col("decontaminated.n_words")).alias("contaminated"))


def is_contaminated(n_hit, n_words):
    return (n_hit > 0) & (20 * n_hit >= n_words)
