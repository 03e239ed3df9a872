import numpy as np
import pytest
import xxhash
from cases import docs, empty, rows_of
from fieldmart.llm import simhash
from fieldmart.llm.components import roots
from pyspark.sql import functions as F


def plain_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i: i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, bits=3):
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    return [min((x for x, g in zip(ids, group) if g == mine and x is not None), default=None) for mine in group]


def test_same_as_brute_force(spark):
    rows = docs(spark).collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    expected = sorted(zip([r.doc_id for r in rows], [f"{p:016x}" for p in prints], plain_components([r.doc_id for r in rows], prints)), key=repr)
    found = simhash.near_duplicates(docs(spark)).withColumn("hex", simhash.hex_digits("fingerprint"))
    assert rows_of(found, "doc_id", "hex", "component_id") == expected


def test_links_are_all_pairs_within_three_bits(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False)) for b in base for _ in range(4)]
    values = sorted({int(np.uint64(v).astype(np.int64)) for v in [*near, 0, 2**64 - 1]})
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    found = {(r.a, r.b) for r in simhash.links(frame).collect()}
    mask = 2**64 - 1
    assert found == {(a, b) for a in values for b in values if a < b and ((a ^ b) & mask).bit_count() <= 3}


def test_bound_is_below_the_bit_distance(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(-2**63, 2**63 - 1, (200, 2))]
    rows = spark.createDataFrame(pairs, "a long, b long").select("a", "b", simhash._segment_bound("a", "b").alias("d")).collect()
    for r in rows:
        counts = simhash.segment_counts(np.array([r.a, r.b], np.int64).view(np.uint64))
        assert r.d == np.abs(counts[0] - counts[1]).sum() <= ((r.a ^ r.b) & (2**64 - 1)).bit_count()


def test_long_chain_is_one_component(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r.vertex, r.root) for r in roots(edges).collect()} == {(i, 0) for i in range(201)}


def test_survivors(spark):
    kept = simhash.survivors(docs(spark))
    assert kept.columns == docs(spark).columns
    found = simhash.near_duplicates(docs(spark))
    assert kept.count() == found.select("root").distinct().count()
    firsts = {r.component_id for r in found.select("component_id").distinct().collect()}
    assert {r.doc_id for r in kept.collect()} == firsts


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.survivors(empty(spark)).count() == 0


def test_more_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fingerprint long"), 4)
