"""Stretches of a text that repeat with a period, found with suffix trees.

A run is a stretch of consecutive words with smallest period q and at least ``TIMES`` * q and ``LEAST`` words
that cannot be extended on either side. A word of a run occurs in it four times or more, so a text is first
cut at words that are too rare, again and again inside the pieces until nothing changes; every run lies
whole inside one piece, and most texts end there. The pieces that are left are joined by separators that
occur once each.

For this text and its reversal Ukkonen's construction gives the suffix trees. A walk around each tree (the
Euler tour) lists the leaves and the shallowest node between neighbours; a sparse table over these depths
answers in constant time how far two suffixes agree (the depth of their lowest common ancestor). Each run has
a root that is the longest Lyndon word from some place, in one of the two orders of the alphabet (children
taken up or down in the walk). So each place gives one candidate for each order: its longest Lyndon word,
which ends where the next smaller suffix begins. It is extended to the right with the tree of the text and
to the left with the tree of the reversal.

Texts are independent of each other, so there is no shuffle. One text must fit into a task: trees take about
500 bytes for each word that is left after the cutting.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, map_texts

TIMES = 4  # length of a run in periods, at least
LEAST = 6  # words of a run, at least


class SuffixTree:
    """Ukkonen's tree of a text whose last symbol occurs once. ``text`` holds numbers below ``letters``."""

    def __init__(self, text: list[int], letters: int):
        n = len(text)
        first, last, link, edges = [0], [0], [0], {}  # node 0 is the root
        node = length = open_suffixes = 0
        edge = 0
        for i, letter in enumerate(text):
            open_suffixes += 1
            waiting = 0  # inner node made in this step that still lacks its link
            while open_suffixes:
                if not length:
                    edge = i
                key = node * letters + text[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(first)
                    first.append(i)
                    last.append(n)
                    link.append(0)
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    at, end = first[child], last[child]
                    span = (end if end <= i else i + 1) - at
                    if length >= span:  # walk down
                        node, edge, length = child, edge + span, length - span
                        continue
                    if text[at + length] == letter:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    middle = len(first)
                    first += (at, i)
                    last += (at + length, n)
                    link += (0, 0)
                    edges[key] = middle
                    first[child] = at + length
                    edges[middle * letters + text[at + length]] = child
                    edges[middle * letters + letter] = middle + 1
                    if waiting:
                        link[waiting] = middle
                    waiting = middle
                open_suffixes -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - open_suffixes + 1
        self.size, self.letters, self.first, self.last = n, letters, first, last
        self.keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.children = np.fromiter(edges.values(), np.int64, len(edges))

    def tour(self, rank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of the walk, and the depth of the lowest common ancestor of each and the one
        before it. ``rank`` gives the order of the letters (default: their numbers)."""
        parent, letter = np.divmod(self.keys, self.letters)
        order = np.lexsort((-(letter if rank is None else rank[letter]), parent))  # the last is taken from the stack first
        kids = self.children[order].tolist()
        ends = np.cumsum(np.bincount(parent, minlength=len(self.first)))
        ends, starts = ends.tolist(), np.concatenate(([0], ends[:-1])).tolist()
        first, last, above = self.first, self.last, [0] * len(self.first)
        leaves, lows, after_leaf = [], [0], False
        stack = kids[starts[0]: ends[0]]
        while stack:
            node = stack.pop()
            depth = above[node]
            if after_leaf:
                lows.append(depth)
                after_leaf = False
            a, b = starts[node], ends[node]
            if a == b:
                leaves.append(first[node] - depth)
                after_leaf = True
            else:
                depth += last[node] - first[node]
                below = kids[a:b]
                for kid in below:
                    above[kid] = depth
                stack += below
        return np.array(leaves, np.int64), np.array(lows, np.int32)


class Agreement:
    """How many symbols two suffixes share, in constant time: least depth between their leaves in the tour."""

    def __init__(self, leaves: np.ndarray, lows: np.ndarray):
        self.place = np.empty(len(leaves), np.int64)
        self.place[leaves] = np.arange(len(leaves))
        self.tables = [lows]
        while 2 ** len(self.tables) <= len(lows):
            before, half = self.tables[-1], 2 ** (len(self.tables) - 1)
            self.tables.append(np.minimum(before[:-half], before[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For places a != b, all inside the text."""
        x, y = self.place[a], self.place[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.tables[k][low[at]], self.tables[k][high[at] - 2 ** k])
        return out


def next_smaller(place: np.ndarray) -> np.ndarray:
    """For each suffix the next one to its right that comes earlier in the order, or the text's end."""
    ranks, out, stack = place.tolist(), [len(place)] * len(place), []
    for i, rank in enumerate(ranks):
        while stack and ranks[stack[-1]] > rank:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def all_runs(text: np.ndarray, separators: int) -> np.ndarray:
    """Rows (start, length, period) of all stretches that go through two periods or more and cannot be extended,
    with their smallest period. The letters below ``separators`` occur once each and the text ends with one."""
    letters, n = int(text.max()) + 1, len(text)
    tree = SuffixTree(text.tolist(), letters)
    up = tree.tour()
    rank = np.arange(letters)
    rank[separators:] = rank[separators:][::-1].copy()  # separators come first in both orders
    down = tree.tour(rank)
    del tree
    ahead = Agreement(*up)
    orders = [ahead.place, np.empty(n, np.int64)]
    orders[1][down[0]] = np.arange(n)
    # Reversed, the text's last separator comes first; another one ends it.
    back = Agreement(*SuffixTree([*text[::-1].tolist(), letters], letters + 1).tour())
    found = []
    for place in orders:
        begin, end = np.arange(n), next_smaller(place)
        inside = (text >= separators) & (end < n)
        begin, end = begin[inside], end[inside]
        right = ahead(begin, end)
        left = np.zeros(len(begin), np.int64)
        some = np.flatnonzero(begin > 0)
        left[some] = back(n - begin[some], n - end[some])  # from the word before each, to the left
        found.append(np.stack((begin - left, end - begin + left + right, end - begin), axis=1))
    rows = np.concatenate(found)
    return np.unique(rows[rows[:, 1] >= 2 * rows[:, 2]], axis=0)


def _pieces(words: np.ndarray) -> np.ndarray:
    """Places of words that may stand in a run: in a stretch of such places of at least ``LEAST`` words each occurs
    ``TIMES`` times or more."""
    at = np.flatnonzero(np.bincount(words)[words] >= TIMES)
    while len(at):
        piece = np.cumsum(np.diff(at, prepend=at[0]) > 1)
        keys = np.unique(piece * (int(words.max()) + 1) + words[at], return_inverse=True, return_counts=True)
        keep = (keys[2][keys[1]] >= TIMES) & (np.bincount(piece)[piece] >= LEAST)
        if keep.all():
            break
        at = at[keep]
    return at


def periodic_runs(words: list[bytes]) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence of words, by start, then period."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    at = _pieces(ids) if len(ids) >= LEAST else np.empty(0, np.int64)
    if not len(at):
        return np.empty((0, 3), np.int64)
    piece = np.cumsum(np.diff(at, prepend=at[0]) > 1)
    count = int(piece[-1]) + 1
    letters = np.unique(ids[at], return_inverse=True)[1]
    text = np.empty(len(at) + count, np.int64)  # each piece and its separator
    slots = np.arange(len(at)) + piece
    text[slots] = letters + count
    home = np.zeros(len(text), np.int64)
    home[slots] = at
    breaks = np.ones(len(text), bool)
    breaks[slots] = False
    text[breaks] = np.arange(count)
    rows = all_runs(text, count)
    rows = rows[(rows[:, 1] >= LEAST) & (rows[:, 1] >= TIMES * rows[:, 2])]
    rows[:, 0] = home[rows[:, 0]]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapsed(words: list[bytes], rows: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by single spaces."""
    if not len(rows):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist())


def strongest(rows: np.ndarray) -> tuple[int, int, int] | None:
    """The run of the greatest length / period; ties: the first by start, then period."""
    best = None
    for start, length, period in rows.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, runs, strongest, collapsed) for each row of ``docs``.

    ``runs`` is an array of (start, length, period) in words by start, then period; ``strongest`` is the one
    with the greatest length / period (null without runs, ties: smallest start, then period); ``collapsed``
    is the text with each run cut down to its first period. Null, empty and blank texts have no words: no
    runs, and an empty collapsed text. Repeated rows and null ids stay, one row each; an empty table gives an
    empty result. Other columns are not read. Long texts are handled whole.
    """
    import pyarrow as pa

    kind = "struct<start:long,length:long,period:long>"

    def work():
        run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

        def step(batch):
            listed, best, texts = [], [], []
            for text in as_bytes(batch.column(1)):
                words = text.split()  # bytes: only the six ASCII spaces split
                rows = periodic_runs(words)
                listed.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in rows.tolist()])
                top = strongest(rows)
                best.append(top and dict(zip(("start", "length", "period"), top, strict=True)))
                texts.append(collapsed(words, rows).decode())
            return {"doc_id": batch.column(0), "runs": pa.array(listed, pa.list_(run)), "strongest": pa.array(best, run),
                    "collapsed": pa.array(texts, pa.string())}
        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(rows, f"doc_id long, runs array<{kind}>, strongest {kind}, collapsed string", work)
