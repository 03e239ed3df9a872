import random

import numpy as np
import pytest
from cases import docs, empty, prose, rows_of
from fieldmart.llm import jaccard


def plain_set(text, size):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    return {tuple(words[i: i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain(rows, size, num, den):
    """(doc_id, n_shingles, component_id) for each row, by comparing all pairs."""
    sets = [plain_set(text, size) for _, text in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if group[i] != group[j] and sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                old = group[j]
                group = [group[i] if g == old else g for g in group]
    lowest = [min((r[0] for r, h in zip(rows, group, strict=True) if h == g and r[0] is not None), default=None) for g in group]
    return sorted(((r[0], len(s), low) for r, s, low in zip(rows, sets, lowest, strict=True)), key=repr)


def near_copies(seed, n=25):
    """Texts of many lengths with copies around and across the limit, and templates that share most of their words."""
    rng = random.Random(seed)
    found = []
    for _ in range(n):
        words = prose(rng, rng.choice((1, 3, 4, 8, 9, 10, 11, 15, 30, 80, 300))).split()
        found.append(words)
        for _ in range(rng.randint(0, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, 1 + len(words) // 20)):
                at = rng.randrange(len(copy))
                copy[at: at + rng.choice((0, 1))] = rng.choice((["new"], ["two", "more"], []))
            found.append(copy)
    page = prose(rng, 60).split()
    for k in range(80):
        copy = list(page)
        for _ in range(rng.choice((1, 1, 2, 3, 4))):
            copy[rng.randrange(60)] = f"v{k}"
        found.append(copy)
    return [(1000 - i, " ".join(w)) for i, w in enumerate(found)]


@pytest.mark.parametrize(("size", "num", "den"), [(4, 85, 100), (5, 80, 100), (2, 60, 100)])
def test_same_as_all_pairs(spark, size, num, den):
    rows = near_copies(size)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(jaccard.similar_sets(frame, shingle=size, num=num, den=den), "doc_id", "n_shingles", "component_id") == plain(rows, size, num, den)


def test_awkward_rows(spark):
    frame = docs(spark)
    for name in ("set_id", "text_hash", "tiles", "tile", "a", "b", "found", "wanted", "root"):
        frame = frame.withColumn(name, frame.lang)
    expected = plain([(r.doc_id, r.text) for r in frame.collect()], 4, 85, 100)
    # Without words a row is alone, also where its doc_id is repeated.
    assert rows_of(jaccard.similar_sets(frame, shingle=4, num=85, den=100), "doc_id", "n_shingles", "component_id") == expected
    assert jaccard.similar_sets(empty(spark)).count() == 0


def test_blocks_find_what_first_sets_miss(spark, monkeypatch):
    """A chain whose neighbours link and whose ends do not, with tiny blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:k * 6] + [f"x{j}" for j in range(k * 6)] + words[k * 6 * 2:])) for i, k in enumerate(range(8))]
    rows += [(100 + i, " ".join([*words[:80], f"y{i}", *words[80:]])) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(jaccard.similar_sets(frame, shingle=4, num=85, den=100), "doc_id", "n_shingles", "component_id") == plain(rows, 4, 85, 100)


def test_few_pairs_of_a_large_group_are_passed_on(spark, monkeypatch):
    """Sets that do not link with the first one, but all with each other: not every pair of them is needed."""
    passed, run = [], jaccard._blocks

    def blocks(*args, **settings):
        found = run(*args, **settings)
        passed.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "_blocks", blocks)
    words = " ".join(f"w{k}" for k in range(100))
    rows = [(0, words[::-1])] + [(i, f"{words} y{i}") for i in range(1, 121)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = jaccard.described(frame, "doc_id", "text", 4, 85, 100).selectExpr("doc_id AS set_id", "text_hash", "size", "bits", "array(7L) AS tiles")
    found = jaccard.set_components(sets, frame, "text", 4, 85, 100)
    assert sorted(map(tuple, found.collect())) == [(i, 1) for i in range(1, 121)]
    assert sum(passed) < 0.75 * 120 * 119 / 2  # of all pairs


def test_linked_sets_share_a_tile():
    rng, bands = np.random.default_rng(1), jaccard.Bands(85, 100)
    for n in (6, 7, 8, 12, 13, 20, 50, 200, 3000):
        for _ in range(60):
            one = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            least = -(-85 * n // 100)  # the smallest part of the set that still links with all of it
            other = np.sort(rng.permutation(one)[:least])
            assert set(jaccard.tile_keys(one, bands)) & set(jaccard.tile_keys(other, bands))


def test_sets_with_many_empty_parts_take_further_cuts():
    bands = jaccard.Bands(85, 100)
    crowded = np.arange(1, 31, dtype=np.uint64)  # all in one part of the range
    (_, parts, spare), *_ = bands.of(30)
    assert parts - 1 >= spare
    keys = jaccard.tile_keys(crowded, bands)
    assert len(keys) > 2 * len(bands.of(30)) and set(keys) & set(jaccard.tile_keys(crowded[:-2], bands))


def test_bound_is_above_the_overlap():
    rng = np.random.default_rng(2)
    for n in (5, 40, 900):
        one = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        other = np.unique(np.concatenate((rng.permutation(one)[: n // 2], rng.integers(0, 2**64, n, dtype=np.uint64))))
        x, y = jaccard.bitmap(one), jaccard.bitmap(other)
        width = min(len(x), len(y))
        most = jaccard.overlap_bound((len(one), jaccard._folded(x, width)), np.array([len(other)]), jaccard._folded(y, width)[None, :])
        assert len(np.intersect1d(one, other)) <= most[0] <= min(len(one), len(other))


def test_very_long_texts(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(200_000)]
    changed = list(words)
    for k in range(0, 200_000, 100):
        changed[k] = "z"
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(words[:150_000]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = rows_of(jaccard.similar_sets(frame, shingle=4, num=85, den=100), "doc_id", "component_id")
    assert found == [(1, 1), (2, 1), (3, 3)]
