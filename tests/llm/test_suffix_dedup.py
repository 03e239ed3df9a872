import random
from collections import Counter

import numpy as np
import pytest
from cases import docs, empty, prose, rows_of
from fieldmart.llm import suffix_dedup


def plain(texts, size=200):
    seen = Counter(t[i: i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - size + 1):
            if seen[t[i: i + size]] > 1:
                hit[i: i + size] = True
        out.append((len(t), int(hit.sum()), np.frombuffer(t, np.uint8)[~hit].tobytes()))
    return out


def corpus(spark):
    rng = random.Random(8)
    passage, period = prose(rng, 120), "abc " * 200
    rows = [prose(rng, 40) + passage[rng.randint(0, 60):] + prose(rng, 30) for _ in range(25)]
    rows += [period, "q" + period[:400], "x" * 199, "x" * 200, "x" * 199 + "y", passage[:200], passage[1:201], "ä" * 150, "bä" + "ä" * 150]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 1])
def test_same_as_brute_force(spark, crowd):
    for frame in (corpus(spark), docs(spark)):
        rows = frame.collect()
        expected = sorted(((r.doc_id, *p) for r, p in zip(rows, plain([(r.text or "").encode() for r in rows]))), key=repr)
        found = suffix_dedup.without_repeats(frame, crowd=crowd).collect()
        got = [(r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.removed), bytes(r.kept)) for r in found]
        assert sorted(got, key=repr) == expected
        for r in found:
            assert all(a.stop < b.start for a, b in zip(r.removed, r.removed[1:]))


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 1])
def test_regions_of_periodic_text_are_bounded(spark, crowd):
    rng = random.Random(9)
    texts = [prose(rng, 20) + "-" * n + prose(rng, 20) for n in (150, 230, 700, 1900)] + ["abc " * 300 + "end", "bc a" * 250, "ab cd ef " * 90, prose(rng, 300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = [r.last - r.first + suffix_dedup.WINDOW for r in suffix_dedup.region_rows(suffix_dedup._keyed(frame, "doc_id", "text")).collect()]
    assert max(sizes) < 2 * suffix_dedup.WINDOW
    for some in (texts, texts[:3], texts[3:4], texts[4:5]):
        found = suffix_dedup.without_repeats(frame.filter(frame.text.isin(some)), crowd=crowd).collect()
        got = [(r.n_bytes, sum(s.stop - s.start for s in r.removed), bytes(r.kept)) for r in sorted(found, key=lambda r: r.doc_id)]
        assert got == plain([t.encode() for t in some])


def test_shards_merge_like_one(monkeypatch):
    rng = random.Random(5)
    base = [prose(rng, 80).encode() for _ in range(12)]
    regions = [a[:250] + b[50:330] for a in base[:6] for b in base[6:]]
    whole = [s.tolist() for s in suffix_dedup.repeated_starts(regions)]
    monkeypatch.setattr(suffix_dedup, "SHARD", 600)
    assert [s.tolist() for s in suffix_dedup.repeated_starts(regions)] == whole
    seen = Counter(r[i: i + 200] for r in regions for i in range(len(r) - 199))
    assert whole == [[i for i in range(len(r) - 199) if seen[r[i: i + 200]] > 1] for r in regions]


def test_empty_table(spark):
    assert rows_of(suffix_dedup.without_repeats(empty(spark)), "doc_id") == []
