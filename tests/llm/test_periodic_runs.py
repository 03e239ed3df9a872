import hashlib
import random
import zlib

import numpy as np
import pytest
from cases import docs, empty, rows_of
from fieldmart.llm import queries
from fieldmart.llm.periodic_runs import Agreement, SuffixTree, all_runs, collapsed, find_runs, next_smaller, periodic_runs, strongest


def plain_runs(words, times=4, least=6):
    """All (start, length, period) by trying each period."""
    found, n = set(), len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                piece = words[i: j + q]
                if all(any(piece[k] != piece[k + p] for k in range(len(piece) - p)) for p in range(1, q)):
                    found.add((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    drop = {i for start, length, period in runs for i in range(start + period, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in drop)


def some_words(rng):
    letters = rng.choice((1, 2, 3, 5))
    words = [b"abcde"[k: k + 1] for k in (rng.randrange(letters) for _ in range(rng.randint(0, 50)))]
    if words and rng.random() < 0.6:
        part = [b"abcde"[k: k + 1] for k in (rng.randrange(letters) for _ in range(rng.randint(1, 7)))]
        at = rng.randrange(len(words))
        words[at:at] = (part * 8)[: rng.randint(1, 8 * len(part))]
    return words


def test_runs_are_those_of_brute_force():
    rng = random.Random(4)
    for _ in range(1500):
        words = some_words(rng)
        rows = periodic_runs(words)
        assert [tuple(r) for r in rows.tolist()] == plain_runs(words)
        assert collapsed(words, rows) == plain_collapsed(words, plain_runs(words))


def test_trees_find_all_runs_of_two_periods():
    rng = random.Random(5)
    for _ in range(500):
        words = [rng.randrange(3) for _ in range(rng.randint(1, 30))]
        found = all_runs(np.array([w + 1 for w in words] + [0]), 1)
        assert [tuple(r) for r in found[np.lexsort((found[:, 2], found[:, 0]))].tolist()] == plain_runs(words, times=2, least=2)


def test_tour_gives_sorted_suffixes_and_agreement_their_common_prefixes():
    rng = random.Random(6)
    for _ in range(200):
        text = [rng.randrange(1, 4) for _ in range(rng.randint(1, 40))] + [0]
        leaves, lows = SuffixTree(text, 4).tour()
        assert leaves.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        agree = Agreement(leaves, lows)
        for _ in range(20 if len(text) > 1 else 0):
            a, b = rng.sample(range(len(text)), 2)
            shared = next(k for k in range(len(text)) if text[a + k] != text[b + k])
            assert agree(np.array([a]), np.array([b])).tolist() == [shared]
        after = next_smaller(agree.place).tolist()
        assert after == [next((j for j in range(i + 1, len(text)) if text[j:] < text[i:]), len(text)) for i in range(len(text))]


def test_strongest_takes_exact_shares_and_the_first_of_ties():
    assert strongest(np.array([[0, 9, 2], [20, 18, 4], [50, 18, 4]])) == (0, 9, 2)
    assert strongest(np.empty((0, 3), np.int64)) is None


def test_rows_of_awkward_texts(spark):
    frame = docs(spark)
    expected = []
    for row in frame.collect():
        words = (row.text or "").encode().split()
        runs = plain_runs(words)
        expected.append((row.doc_id, runs, plain_collapsed(words, runs).decode()))
    found = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in find_runs(frame).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert find_runs(empty(spark)).count() == 0


def test_very_long_texts(spark):
    rng = random.Random(7)
    words = [f"w{rng.randrange(5000)}" for _ in range(150_000)] + [f"p{k % 1700}" for k in range(20_000)] + ["x"] * 50_000
    row = find_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).collect()[0]
    assert [tuple(r) for r in row.runs] == [(150_000, 20_000, 1700), (170_000, 50_000, 1)]
    assert tuple(row.strongest) == (170_000, 50_000, 1)
    assert row.collapsed.split() == [*words[:151_700], "x"]


@pytest.fixture(scope="module")
def table_folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("runs")
    rng = random.Random(8)
    texts = [" ".join(w.decode() for w in some_words(rng)) for _ in range(200)] + [None, "", "one", " lead  and trail "]
    rows = list(enumerate(texts)) + [(None, "no id " * 9), (3, texts[3])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder), rows


def test_query_rebuilds_periodic_texts(spark, table_folder):
    folder, rows = table_folder
    expected = []
    for doc_id, text in rows:
        words, n = (text or "").encode().split(), len((text or "").split())
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        expected.append((doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(),
                         hashlib.sha256(plain_collapsed(words, runs)).hexdigest()))
    found = queries.RUNS["op13_periodic_runs"](spark, folder)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert found.columns == names
    assert rows_of(found, *names) == sorted(expected, key=repr)
