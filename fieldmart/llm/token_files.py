"""Token ids in files: texts to ids, ids to checksummed blocks of an adaptive range coder, and back.

Texts are sorted by doc_id over all partitions; each partition writes segments, rows of one Parquet
table with whole documents in them. A segment's ids are cut into blocks. Each block starts anew and can
be read with its segment's frequency table alone: magic, number of ids, number of payload words, CRC-32 of the
ids, payload. The table lists the segment's repeated ids by falling count; all ids are coded as their ranks in it.

Three predictions drive a block's arithmetic coder. Order 2 and order 1 each remember the id that
followed the last two ids, or the last one, when that context (hashed) was last seen. Order 0 counts
how often each class of ids occurred, from the counts in the table on and as of the last multiple of ``EVERY`` ids; a class
holds ids of neighbouring ranks, so of like counts, uniformly. The mix of the three is
p2 [id = a] + (1 - p2) p1 [id = b] + (1 - p2) (1 - p1) order0(id), where p2 and p1 follow, every ``JUDGED`` ids, how often
the predictions were right. Writer and reader change everything alike.

Blocks don't depend on each other, so a task codes ``LANES`` of them side by side: one step of the loop handles the
next id of every block, so the cost of a step's array operations is shared by all of them. A reader follows the contexts step by step;
a writer knows its blocks whole and finds what the predictions say by sorting each block's places by context. What a task holds is bounded in ids and bytes, not in rows.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_bytes, work_path

MAGIC = b"MXR2"
HEADER = "<4sIII"  # magic, ids, payload words, CRC-32
BLOCK = 2048  # ids
SEGMENT = 1 << 23  # ids; a longer document is a segment of its own
LANES = 4096  # blocks coded side by side, which bounds a task's memory
SLICE = 1 << 24  # bytes of texts that are split into units together
LISTED = 4  # occurrences from which the table lists an id
EVERY = 64  # ids between two changes of the order-0 counts
TABLE = 10  # log2 of the remembered contexts of an order
STEP, MOST = 16, 1 << 12  # growth of an order-0 count, and bound of their sum; order 0 always has ONE // 16, so each class has a share
ONE = 1 << 16  # scale of probabilities
NONE = (1 << 16) - 1  # no id was seen in this context
EDGE = 15  # log2 of the scale of the cumulated order-0 counts
WIDE = 64  # places for the cumulated counts of a lane; 2^16 ids have 57 classes
ONE_HASH, TWO_HASH = 0x9E3779B1, 0x85EBCA6B
TOGETHER = 64  # blocks whose predictions a writer finds together
JUDGED = 8  # ids between two changes of the trust in the predictions
KEPT = 1 << 24  # bytes of units, and of their ids, that a task remembers
GATHERED = 1 << 15  # stretches copied together
ENCODED = 1 << 12  # units encoded together, which bounds the numbers that Python holds


def _class(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each id, the number of bits that tell its members apart, and those bits."""
    value = ids.astype(np.int64) + 4
    bits = np.frexp(value.astype(np.float64))[1].astype(np.int64) - 3
    return 4 * bits + (value >> bits) - 4, bits, value & ((1 << bits) - 1)


class Table:
    """Ids of a segment by falling count, the others (``LISTED`` not reached) after them in their own order, and the share
    of each class of ranks."""

    def __init__(self, listed: np.ndarray, start: np.ndarray, largest: int):
        rest = np.ones(largest + 1, bool)
        rest[listed] = False
        self.listed, self.start = listed.astype(np.int64), start.astype(np.int32)
        self.id_of = np.concatenate((self.listed, np.flatnonzero(rest))).astype(np.int32)
        self.rank_of = np.empty(largest + 1, np.int32)
        self.rank_of[self.id_of] = np.arange(largest + 1, dtype=np.int32)

    @classmethod
    def of(cls, ids: np.ndarray, largest: int) -> Table:
        counts = np.bincount(ids, minlength=largest + 1)
        common = np.flatnonzero(counts >= LISTED)
        found = cls(common[np.argsort(-counts[common], kind="stable")], np.empty(0), largest)
        shares = np.bincount(_class(np.arange(largest + 1))[0], weights=counts[found.id_of])
        found.start = (1 + shares * (MOST // 2) // max(1, len(ids))).astype(np.int32)
        return found

    def pack(self) -> bytes:
        return zlib.compress(np.concatenate(([len(self.start)], self.start, self.listed)).astype("<u2").tobytes())

    @classmethod
    def unpack(cls, raw: bytes, largest: int) -> Table:
        numbers = np.frombuffer(zlib.decompress(raw), "<u2").astype(np.int64)
        return cls(numbers[1 + numbers[0]:], numbers[1: 1 + numbers[0]], largest)


class _Lanes:
    """What writer and reader know of each block: counts, trust in the predictions, the range."""

    def __init__(self, lanes: int, table: Table):
        self.classes = len(table.start)
        self.freq = np.tile(table.start.astype(np.int32), (lanes, 1))
        self.row = np.arange(lanes, dtype=np.int64) * (self.classes + 1)
        self.edges = np.full((lanes, WIDE), 1 << EDGE, np.uint32)  # cumulated counts
        self.tree = [np.full((lanes, k, 4), 1 << EDGE, np.uint16) for k in (1, 4, 16)]  # every 16th edge, every 4th, all
        self.edge_row, self.tree_row = (np.arange(lanes, dtype=np.int64) * k for k in (WIDE, 4))
        self.trust = np.full((2, lanes), ONE // 4, np.uint32)  # in order 2 and order 1
        self.range = np.full(lanes, 2**64 - 1, np.uint64)
        self.recount(lanes)

    def predict(self, n: int, known, differs):
        """For the first ``n`` lanes: shares of ONE of order 2, if it has an id, of order 1, if it has another, and of the rest."""
        share2 = self.trust[0, :n] * known
        left = ONE - share2
        share1 = (left * self.trust[1, :n] >> 16) * differs
        return share2, share1, left - share1

    def shares(self, places, share0):
        """Start and size of the classes at these places of the edges, in what is left to order 0."""
        flat = self.edges.reshape(-1)
        start = share0 * flat.take(places) >> EDGE
        return start, (share0 * flat.take(places + 1) >> EDGE) - start

    def judge(self, n: int, tried, right) -> None:
        """How often the predictions had an id lately, and how often it came."""
        old = self.trust[:, :n].astype(np.int64)
        self.trust[:, :n] = np.maximum(old + ((right * np.int64(3 * ONE // 4) - tried * old) >> 4), 64)

    def count(self, n: int, came) -> None:
        """Adds the classes that came from order 0 lately; ``classes`` stands for none."""
        came = np.bincount((self.row[:n, None] + came.T).reshape(-1), minlength=n * (self.classes + 1))
        self.freq[:n] += (STEP * came.reshape(n, -1)[:, : self.classes]).astype(np.int32)
        self.recount(n)

    def recount(self, n: int) -> None:
        """The edges of the order-0 classes by their counts."""
        freq = self.freq[:n]
        ends = np.cumsum(freq, axis=1, dtype=np.uint32)
        if len(full := np.flatnonzero(ends[:, -1] > MOST)):
            freq[full] = (freq[full] + 1) >> 1
            ends[full] = np.cumsum(freq[full], axis=1, dtype=np.uint32)
        self.edges[:n, 0] = 0
        self.edges[:n, 1: self.classes + 1] = (ends << EDGE) // ends[:, -1:]
        for level, step in zip(self.tree, (16, 4, 1), strict=True):
            level[:n, :, :3] = self.edges[:n].reshape(n, -1, 4 * step)[:, :, step::step]

    def find(self, n: int, reach) -> np.ndarray:
        """Place of the last edge up to ``reach``. Four edges are compared at once, 16 bits each: a difference keeps its top bit."""
        tops, aim = np.uint64(0x8000_8000_8000_8000), reach * np.uint64(0x1_0001_0001_0001)
        aim |= tops
        first, *others = (level.reshape(-1).view(np.uint64) for level in self.tree)
        place = self.tree_row[:n] + np.bitwise_count((aim - first[:n]) & tops)
        for level in others:
            place = 4 * place + np.bitwise_count((aim - level.take(place)) & tops)
        return place


def _longest_first(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes in order of falling size, and how many of them are still going at each step."""
    order = np.argsort(-sizes, kind="stable")
    going = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(int(sizes.max(initial=0))), side="right")
    return order, going


def _remembered(ids: np.ndarray, context: np.ndarray) -> np.ndarray:
    """In each row, the id that came when the place's context was last seen."""
    order = np.argsort(context, axis=1, kind="stable")
    order += np.arange(len(ids))[:, None] * ids.shape[1]
    context, came, order = context.take(order), ids.take(order), order.reshape(-1)
    came[:, 1:] = np.where(context[:, 1:] == context[:, :-1], came[:, :-1], np.uint16(NONE))
    came[:, :1] = NONE
    found = np.empty(ids.size, ids.dtype)
    found[order] = came.reshape(-1)
    return found.reshape(ids.shape)


KNOWN, DIFFERS, HIT, LITERAL = 1, 2, 4, 8  # order 2 has an id, order 1 has another, order 2's came, none of the two came


def _foresee(blocks: list[np.ndarray], table: Table, longest: int):
    """What the predictions say of blocks, which a writer knows whole: for each id (steps by lanes) its class and its bits among the
    members, or zeros if it is predicted, and the signs above; for each ``JUDGED`` ids the times that the predictions
    had an id, and were right."""
    class_of, _, rest_of = _class(np.arange(len(table.rank_of)))
    class_of, rest_of, lanes = class_of.astype(np.uint8), rest_of.astype(np.uint16), len(blocks)
    classes, signs, rest = (np.zeros((longest, lanes), kind) for kind in (np.uint8, np.uint8, np.uint16))
    tried, right = (np.zeros((longest // JUDGED, 2, lanes), np.uint8) for _ in range(2))
    for at in range(0, lanes, TOGETHER):
        some = blocks[at: at + TOGETHER]
        ids = np.zeros((len(some), max(map(len, some), default=0)), np.uint16)
        for lane, block in enumerate(some):
            ids[lane, : len(block)] = table.rank_of[block]
        before = np.zeros((len(some), ids.shape[1] + 2), np.uint32)
        before[:, 2:] = ids
        one = before[:, 1:-1] * np.uint32(ONE_HASH)
        two = one + before[:, :-2] * np.uint32(TWO_HASH)
        a, b = (_remembered(ids, (c >> (32 - TABLE)).astype(np.uint16)) for c in (two, one))
        known, hits = (a != NONE, b != NONE), (ids == a, ids == b)
        literal = ~(hits[0] | hits[1])
        to = slice(at, at + len(some))
        n = ids.shape[1]
        signs[:n, to] = (known[0] * np.uint8(KNOWN) | (known[1] & (a != b)) * np.uint8(DIFFERS) | hits[0] * np.uint8(HIT) | literal * np.uint8(LITERAL)).T
        ids *= literal  # the first id's class has it alone, so without bits
        classes[:n, to], rest[:n, to] = class_of.take(ids).T, rest_of.take(ids).T
        for k in range(2):
            for sums, seen in ((tried, known[k]), (right, hits[k])):
                sums[: n // JUDGED, k, to] = seen[:, : n // JUDGED * JUDGED].reshape(len(some), -1, JUDGED).sum(axis=2, dtype=np.uint8).T
    return classes, signs, rest, tried, right


def encode_blocks(blocks: list[np.ndarray], table: Table) -> list[bytes]:
    """Each block's ids (up to the table's largest, at most 2^16 - 5) as bytes."""
    if len(blocks) > LANES:
        return [b for i in range(0, len(blocks), LANES) for b in encode_blocks(blocks[i: i + LANES], table)]
    sizes = np.array([len(b) for b in blocks], np.int64)
    order, going = _longest_first(sizes)
    classes, signs, rest, tried, right = _foresee([blocks[i] for i in order.tolist()], table, len(going))
    state = _Lanes(len(blocks), table)
    low, place = np.zeros(len(blocks), np.uint64), np.zeros(len(blocks), np.int64)
    out = np.zeros((len(blocks), len(going) // 2 + EVERY + 3), np.uint32)

    def carry(lanes):
        at = place[lanes] - 1
        while len(lanes):
            out[lanes, at] += np.uint32(1)
            again = out[lanes, at] == 0
            lanes, at = lanes[again], at[again] - 1

    for t, n in enumerate(going.tolist()):
        kind, sign = classes[t, :n], signs[t, :n]
        share2, share1, share0 = state.predict(n, sign & KNOWN, (sign & DIFFERS) != 0)
        hit2, literal = (sign & HIT) != 0, sign >= LITERAL
        start, size = state.shares(state.edge_row[:n] + kind, share0)
        start = np.where(literal, start + (share2 + share1), share2 * ~hit2)
        size = np.where(literal, size, np.where(hit2, share2, share1))
        unit = state.range[:n] >> 16
        fine = unit * size >> (kind >> 2)  # four classes for each number of bits
        before = low[:n]
        now = before + (unit * start + fine * rest[t, :n])
        over = np.flatnonzero(now < before)
        low[:n] = now
        if len(over):
            carry(over)
        state.range[:n] = fine
        short = np.flatnonzero(fine < 1 << 32)
        words, at = now.take(short), place.take(short)
        out[short, at] = words >> 32
        place[short] = at + 1
        low[short] = words << 32
        state.range[short] = fine.take(short) << 32
        if t % JUDGED == JUDGED - 1:
            state.judge(n, tried[t // JUDGED, :, :n], right[t // JUDGED, :, :n])
        if t % EVERY == EVERY - 1:
            lately = slice(t - EVERY + 1, t + 1)
            state.count(n, np.where(signs[lately, :n] >= LITERAL, classes[lately, :n], np.uint8(state.classes)))
            if int(place.max()) + EVERY + 2 > out.shape[1]:  # an id takes a word at most
                out = np.concatenate((out, np.zeros_like(out)), axis=1)
    done = [b""] * len(blocks)
    for lane, i in enumerate(order):
        words = out[lane, : place[lane] + 2]
        words[-2:] = int(low[lane]) >> 32, int(low[lane]) & 0xFFFFFFFF
        done[i] = struct.pack(HEADER, MAGIC, sizes[i], len(words), checksum(blocks[i])) + words.astype(">u4").tobytes()
    return done


def decode_blocks(blocks: list[bytes], table: Table) -> list[np.ndarray]:
    """The ids of each block; raises if a block is not as it was written."""
    if len(blocks) > LANES:
        return [b for i in range(0, len(blocks), LANES) for b in decode_blocks(blocks[i: i + LANES], table)]
    heads = [struct.unpack_from(HEADER, b) for b in blocks]
    if any(magic != MAGIC or len(b) != struct.calcsize(HEADER) + 4 * words for b, (magic, _, words, _) in zip(blocks, heads, strict=True)):
        raise ValueError("not a block of token ids")
    sizes, lanes = np.array([h[1] for h in heads], np.int64), len(blocks)
    order, going = _longest_first(sizes)
    coded = np.zeros((lanes, max([h[2] for h in heads], default=0) + 3), np.uint32)
    for lane, i in enumerate(order):
        coded[lane, : heads[i][2]] = np.frombuffer(blocks[i], ">u4", offset=struct.calcsize(HEADER))
    flat, width, row = coded.reshape(-1), coded.shape[1], np.arange(lanes, dtype=np.int64) * coded.shape[1]
    state = _Lanes(lanes, table)
    ids = np.zeros((len(going), lanes), np.uint16)
    bits = np.arange(WIDE, dtype=np.uint64) // 4  # of each class, the largest number they can tell, and the first member
    first = (((4 + np.arange(WIDE, dtype=np.uint64) % 4) << bits) - 4).astype(np.uint16)
    bits[state.classes:] = 0  # a predicted id, noted as one class more, has none
    largest = (np.uint64(1) << bits) - 1
    seen = np.full(2 * lanes << TABLE, NONE, np.uint16)  # what came in the contexts of order 2, then of order 1
    base = np.arange(2 * lanes, dtype=np.int64).reshape(2, lanes) << TABLE
    last, older, contexts = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32), np.empty((2, lanes), np.uint32)
    tried, right = (np.zeros((2, lanes), np.uint8) for _ in range(2))
    came = np.zeros((EVERY, lanes), np.uint8)
    code, place = coded[:, 0].astype(np.uint64) << 32 | coded[:, 1], np.full(lanes, 2, np.int64)
    for t, n in enumerate(going.tolist()):
        context = contexts[:, :n]
        np.multiply(last[:n], np.uint32(ONE_HASH), out=context[1])
        np.multiply(older[:n], np.uint32(TWO_HASH), out=context[0])
        context[0] += context[1]
        at = (base[:, :n] + (context >> (32 - TABLE))).reshape(-1)
        guess = seen.take(at).reshape(2, n)
        known = guess != NONE
        share2, share1, share0 = state.predict(n, known[0], known[1] & (guess[0] != guess[1]))
        unit = state.range[:n] >> 16
        aim = np.minimum(code[:n] // unit, ONE - 1).astype(np.uint32)
        guessed = share2 + share1
        hit2, literal = aim < share2, aim >= guessed
        reach = (((np.maximum(aim, guessed) - guessed + 1) << EDGE) - 1) // share0
        places = state.find(n, reach)
        start, size = state.shares(places, share0)
        start = np.where(literal, start + guessed, share2 * ~hit2)
        size = np.where(literal, size, np.where(hit2, share2, share1))
        kind = np.where(literal, places - state.edge_row[:n], state.classes)
        fine = unit * size >> bits.take(kind)
        left = code[:n] - unit * start
        rest = np.minimum(left // fine, largest.take(kind))
        now = left - fine * rest
        x = np.where(literal, first.take(kind) + rest.astype(np.uint16), np.where(hit2, guess[0], guess[1]))
        ids[t, :n] = x
        code[:n] = now
        state.range[:n] = fine
        short = np.flatnonzero(fine < 1 << 32)
        stand = place.take(short)
        code[short] = now.take(short) << 32 | flat.take(row.take(short) + np.minimum(stand, width - 1))
        place[short] = stand + 1
        state.range[short] = fine.take(short) << 32
        seen[at] = np.concatenate((x, x))
        older, last = last, x.astype(np.uint32)
        tried[:, :n] += known.view(np.uint8)
        right[:, :n] += (guess == x).view(np.uint8)
        came[t % EVERY, :n] = kind
        if t % JUDGED == JUDGED - 1:
            state.judge(n, tried[:, :n], right[:, :n])
            tried[:] = right[:] = 0
        if t % EVERY == EVERY - 1:
            state.count(n, came[:, :n])
    found: list[np.ndarray] = [np.empty(0, np.int32)] * len(blocks)
    for lanes in range(0, len(blocks), TOGETHER):
        ranks = np.minimum(ids[:, lanes: lanes + TOGETHER].T, len(table.id_of) - 1)
        for i, row in zip(order[lanes: lanes + TOGETHER].tolist(), table.id_of.take(ranks), strict=True):
            found[i] = row[: sizes[i]]
            if checksum(found[i]) != heads[i][3]:
                raise ValueError("a block's checksum is wrong")
    return found


def checksum(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


PLAIN = 0x250  # up to here a character is one letter, digit or sign in its composed form
# Those whose small letters lie there as well; 24 capitals, as in Azerbaijani and Ewe, have others.
PLAIN_CHARACTERS = "".join(re.escape(chr(c)) for c in range(PLAIN) if all(ord(x) < PLAIN for x in chr(c).lower()))


def _class_of(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(PLAIN) if unicodedata.category(chr(c))[0] == kind)


LETTERS, DIGITS, SPACE = _class_of("L"), _class_of("N"), "\t\n\x0b\x0c\r \x85\xa0"
# The tokenizer's own pattern for the units that it merges apart from each other.
UNITS = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{SPACE}{LETTERS}{DIGITS}]+"


# The tokenizer's signs for bytes: those that print stand for themselves, the others for the next signs from 256 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SIGN_OF = np.arange(256, dtype="<u2")
for _k, _byte in enumerate(sorted(set(range(256)) - set(_PRINTED))):
    SIGN_OF[_byte] = 256 + _k if _byte != 10 else 10  # no unit holds a line end


def _lines(texts: pa.Array) -> str:
    """Texts with line ends between them."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), "\n")[0].as_py()


def _gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``pool`` one after the other, and where each begins and the last ends."""
    stops = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=stops[1:])
    found = np.empty(int(stops[-1]), pool.dtype)
    for i in range(0, len(sizes), GATHERED):
        j = min(i + GATHERED, len(sizes))
        places = np.repeat(starts[i:j] - stops[i:j], sizes[i:j])
        places += np.arange(stops[i], stops[j])
        found[stops[i]: stops[j]] = pool.take(places)
    return found, stops


class UnitIds:
    """Ids of texts by the tokenizers library, each distinct word cut into units and each distinct unit encoded once.

    The tokenizer lower-cases, drops white space, and merges inside units only, so a text's ids are those
    of its units. Words are cut at ASCII spaces and told apart by Arrow. Those of ASCII letters are units as they are, the
    others are cut here. A unit's bytes go to the library's model without its normalizer, which has nothing to do then. A word
    with characters that aren't in ``PLAIN_CHARACTERS`` or with special strings is left whole to the library, which finds
    the units inside. Some words of every call are compared with what the library makes of them as they stand. Units and
    such words are remembered with their ids in flat arrays: Python's objects would take many times their bytes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.plain = re.compile(f"[{PLAIN_CHARACTERS}]*").fullmatch
        self.units = re.compile(f"\n|{UNITS}").findall
        self.forget()

    def forget(self) -> None:
        self.known, self.pool, self.ends = pa.array([], pa.string()), np.empty(0, np.uint16), np.zeros(1, np.int64)

    def held(self) -> int:
        """Bytes of what is remembered."""
        return self.known.nbytes + self.pool.nbytes + self.ends.nbytes

    def library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def merged(self, units: pa.Array) -> Iterator[list[int]]:
        """The ids of each unit, by the model alone; a byte of units that aren't printable ASCII by its sign."""
        tokenize, text = self.model.tokenize, _lines(units)
        if not (text.isascii() and text.replace("\n", "").isprintable()):
            text = SIGN_OF.take(np.frombuffer(text.encode(), np.uint8)).tobytes().decode("utf-16-le")
        return ([t.id for t in tokenize(unit)] for unit in text.split("\n"))

    def whole(self, words: pa.Array) -> Iterator[list[int]]:
        return map(self.library, words.to_pylist())

    def numbers(self, units: pa.Array, encode: Callable[[pa.Array], Iterator[list[int]]]) -> np.ndarray:
        """The numbers under which these units' ids are remembered, from now on if they are new."""
        if not len(units):
            return np.empty(0, np.int64)
        coded = units.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.known)
        new, count = coded.dictionary.filter(at.is_null()), len(self.known)
        at = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        at[at < 0] = np.arange(count, count + len(new))
        pools, sizes = [self.pool], []
        for i in range(0, len(new), ENCODED):
            ids = []
            for found in encode(new.slice(i, ENCODED)):
                ids += found
                sizes.append(len(found))
            pools.append(np.array(ids, np.uint16))
        if len(new):
            self.known, self.pool = pa.concat_arrays([self.known, new]), np.concatenate(pools)
            self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(sizes)))
        return at.take(coded.indices.to_numpy())

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of distinct words: a pool, and where each word's ids begin in it and how many they are."""
        alone = pc.ascii_is_alpha(words)
        first, rest = (np.flatnonzero(m.to_numpy(zero_copy_only=False)) for m in (alone, pc.invert(alone)))
        joined, foreign = _lines(words.take(pa.array(rest))), np.zeros(len(rest), bool)
        if "<|" in joined or not self.plain(joined):
            others = joined.split("\n")
            foreign[:] = ["<|" in w or not self.plain(w) for w in others]
            joined = "\n".join(w for w, f in zip(others, foreign.tolist(), strict=True) if not f)
        cut = pa.array(self.units(joined.lower() + "\n") if not foreign.all() else [], pa.string())
        line_end = pc.equal(cut, "\n")
        own, plain = rest[foreign], rest[~foreign]
        numbers = np.concatenate((
            self.numbers(pa.concat_arrays([pc.ascii_lower(words.filter(alone)), cut.filter(pc.invert(line_end))]), self.merged),
            self.numbers(words.take(pa.array(own)), self.whole)))
        units = np.ones(len(words), np.int64)  # in words of each kind in turn
        units[len(first): len(first) + len(plain)] = np.diff(np.flatnonzero(line_end.to_numpy(zero_copy_only=False)), prepend=-1) - 1
        starts = self.ends.take(numbers)
        ids, stops = _gather(self.pool, starts, self.ends.take(numbers + 1) - starts)
        bounds = stops.take(np.concatenate(([0], np.cumsum(units))))
        order = np.concatenate((first, plain, own))
        starts, sizes = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        starts[order], sizes[order] = bounds[:-1], np.diff(bounds)
        some = np.concatenate((first, plain))
        some = some[:: 1 + len(some) // 1000]
        if self.library(" ".join(words.take(pa.array(some)).to_pylist())) != _gather(ids, starts[some], sizes[some])[0].tolist():
            raise ValueError("this tokenizer cuts texts in another way")
        return ids, starts, sizes

    def texts(self, texts: list[bytes], end: int) -> list[np.ndarray]:
        if self.held() > KEPT:
            self.forget()
        whole = pa.array(texts, pa.binary()).cast(pa.string())
        # Special strings are found as they are written, so their texts keep their capitals.
        split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(whole, "<|"), whole, pc.ascii_lower(whole)))
        counts, coded = split.value_lengths().to_numpy(), split.flatten().dictionary_encode()
        del whole, split
        pool, starts, sizes = self.words(coded.dictionary)
        at = coded.indices.to_numpy()
        ids, stops = _gather(pool, starts.take(at), sizes.take(at))
        bounds = stops.take(np.concatenate(([0], np.cumsum(counts))))
        ids = np.insert(ids, bounds[1:], end)
        return [ids[a:b] for a, b in pairwise((bounds + np.arange(len(bounds))).tolist())]


SCHEMA = "part int, segment int, first long, n_ids long, largest int, table binary, doc_ids array<long>, lengths array<long>, blocks array<binary>"
_ARROW = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("largest", pa.int32()),
                    ("table", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("blocks", pa.list_(pa.binary()))])


_FOUND = pa.schema([("part", pa.int32()), ("local", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE`` bytes, of one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
        yield at, stop
        at = stop


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of all texts, each with ``end`` after it, in ascending doc_id order.

    Null ids come first, rows with one id in the order of their texts' hashes; null texts are empty.
    Parts are numbered in order, segments inside their part. Other columns are not read. Texts are
    encoded whole; one text and its ids must fit into a task.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash").drop("hash")
    # Each worker process has its own copy, which stays between tasks: the units known from one are not encoded again in the next.
    shared = docs.sparkSession.sparkContext.broadcast({})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value.get("coder") or shared.value.setdefault("coder", UnitIds(tokenizer))
        largest, part = coder.tokenizer.get_vocab_size() - 1, TaskContext.get().partitionId()
        number = first = 0

        def segment(names: list, ids: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal number, first
            joined, lengths = np.concatenate(ids), [len(x) for x in ids]
            ids.clear()
            pa.default_memory_pool().release_unused()
            table = Table.of(joined, largest)
            coded = encode_blocks([joined[i: i + BLOCK] for i in range(0, len(joined), BLOCK)], table)
            row = (part, number, first, len(joined), largest, table.pack(), names, lengths, coded)
            number, first = number + 1, first + len(joined)
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, _ARROW, strict=True)], schema=_ARROW)

        names, ids, held = [], [], 0
        for batch in batches:
            texts, ours = batch.column(1).cast(pa.binary()), batch.column(0).to_pylist()
            for at, stop in _slices(texts):
                for name, new in zip(ours[at:stop], coder.texts(as_bytes(texts.slice(at, stop - at)), end), strict=True):
                    if held and held + len(new) > SEGMENT:
                        yield segment(names, ids)
                        names, ids, held = [], [], 0
                    names.append(name)
                    ids.append(new)
                    held += len(new)
        batch = texts = new = None  # their memory is free for the last segment, mostly the only one
        if ids:
            yield segment(names, ids)

    try:
        rows.mapInArrow(run, SCHEMA).write.mode("errorifexists").parquet(path)
    finally:
        shared.unpersist()


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): each document of the files, ``start`` counted over all parts."""
    segments = spark.read.schema(SCHEMA).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # a segment at a time
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                ids = np.concatenate(decode_blocks(row["blocks"], Table.unpack(row["table"], row["largest"])))
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                checks = [checksum(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [np.full(len(ends), row["part"]), row["first"] + starts, row["doc_ids"], row["lengths"], checks]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND)

    found = segments.select("part", "first", "largest", "table", "doc_ids", "lengths", "blocks").mapInArrow(
        run, "part int, local long, doc_id long, n_tokens long, ids_crc32 long")
    sizes = segments.groupBy(F.col("part").alias("of")).agg(F.sum("n_ids").alias("size"))
    ahead = sizes.select("of", (F.sum("size").over(Window.orderBy("of")) - F.col("size")).alias("before"))  # a row per part
    return found.join(ahead, found.part == ahead.of).select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None, **settings) -> DataFrame:
    """Writes the files (to a new folder of the shared one, if none is given) and reads them back."""
    path = path or work_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, tokenizer, **settings)
    return read_token_files(docs.sparkSession, path)
