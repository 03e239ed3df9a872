from collections import Counter

import numpy as np
from cases import docs, empty
from fieldmart.llm import mixing


def plain_targets(sizes, weights, share=1.5, most=2.0):
    """By halving the search for the water level."""
    lo, hi = 0.0, 1e12
    for _ in range(200):
        level = (lo + hi) / 2
        lo, hi = (level, hi) if sum(min(most * s, level * w) for s, w in zip(sizes, weights)) < share * sum(sizes) else (lo, level)
    return [min(most * s, lo * w) for s, w in zip(sizes, weights)]


def test_targets():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 20):
        sizes = rng.integers(0, 1000, n).tolist()
        weights = [(3, 1, 2)[i % 3] for i in range(n)]
        assert np.allclose(mixing.targets(sizes, weights, 1.5, 2.0), plain_targets(sizes, weights), atol=1e-6)


def test_mix(spark):
    found = mixing.mix(docs(spark)).collect()
    rows = docs(spark).collect()
    size = lambda t: len((t or "").encode().split())
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r.doc_id, size(r.text)) for r in rows)
    per_source = Counter()
    for r in rows:
        per_source[r.source] += size(r.text)
    names = sorted(per_source, key=lambda s: (s is None, s or ""))
    expected = dict(zip(names, plain_targets([per_source[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))])))
    assert {round(r.target, 4) for r in found} == {round(v, 4) for v in expected.values()}
    taken = Counter()
    for r in found:
        assert len(r.shards) <= 2 and (r.size or not r.shards)
        taken[round(r.target, 4)] += r.size * len(r.shards)
    for target, words in taken.items():
        mine = [r for r in found if round(r.target, 4) == target and r.size]
        least = min(len(r.shards) for r in mine)
        left_out = [r.size for r in mine if len(r.shards) == least]  # one more of the smallest is no nearer
        assert abs(words - target) <= max(1, min(left_out) / 2)
    again = mixing.mix(docs(spark).repartition(3)).collect()
    key = lambda r: (repr(r.doc_id), r.size, sorted(r.shards), r.key)
    assert sorted(map(key, found)) == sorted(map(key, again))


def test_a_document_over_a_block_across_the_cut(spark):
    rows = [(100 * s + i, "w " * (650 if i == 0 else 10), f"s{s}") for s in range(8) for i in range(100)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1,), share=1.3, block=50).collect()
    words = Counter()
    for r in found:
        words[r.doc_id // 100] += r.size * (len(r.shards) - 1)
    assert {len(r.shards) for r in found} == {1, 2}
    assert all(abs(words[s] - 0.3 * 1640) <= 5 for s in range(8))  # the short ones fill it


def test_mixed_rows(spark):
    frame = docs(spark)
    out = mixing.mixed(frame, block=200)
    assert out.columns == frame.columns
    given = {tuple(r) for r in frame.collect()}
    assert {tuple(r) for r in out.collect()} <= given  # every column as it was, "shard" among them
    drawn = mixing.mix(frame, block=200).collect()
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in drawn for _ in r.shards)
    numbered = mixing.mixed(frame, block=200, shard_col="shard")
    assert numbered.columns == [*(c for c in frame.columns if c != "shard"), "shard"]
    assert Counter((r.doc_id, r.shard) for r in numbered.collect()) == Counter((r.doc_id, x) for r in drawn for x in r.shards)


def test_tree_splits_exactly():
    tree = mixing.SplitTree([700, 0, 55, 1], 6, seed=1)
    shards = [tree.shard_of(np.full(n, s), np.arange(n)) for s, n in enumerate([700, 0, 55, 1])]
    sizes = np.bincount(np.concatenate(shards), minlength=6)
    assert sizes.sum() == 756 and sizes.max() - sizes.min() <= 3
    assert all((np.diff(s) >= 0).all() for s in shards)  # a shard's draws of a source are one stretch
    single = mixing.SplitTree([700, 0, 55, 1], 6, seed=1)
    assert [int(single.shard_of(np.array([0]), np.array([i]))[0]) for i in range(0, 700, 50)] == shards[0][::50].tolist()


def test_permutation():
    for n in (1, 2, 3, 17, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 9)).tolist()) == list(range(n))


def test_empty_table(spark):
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed(empty(spark)).count() == 0
