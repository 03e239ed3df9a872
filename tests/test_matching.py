import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmart.functions.text import token_sort_ratio
from fieldmart.operators import matching
from fieldmart.operators.matching import best_match, common_lengths


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def words(rng, longest):
    return " ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, longest))) for _ in range(rng.randint(1, 3)))


@pytest.mark.parametrize("longest", [4, 30, 90])
def test_common_lengths(longest):
    """Texts of less than one machine word and of several."""
    rng = random.Random(longest)
    left, right = ([words(rng, longest) for _ in range(40)] + ["", "z", "\0", "\U0001F600 a", "a" * 64, "a" * 128, "ab" * 64] for _ in range(2))
    found = common_lengths()(left, right)
    assert [[lcs(a, b) for a in left] for b in right] == found.tolist()
    assert common_lengths()([], right).shape == (len(right), 0) and common_lengths()([""], [""]).tolist() == [[0]]


def check(spark, names, official):
    sent = spark.createDataFrame([(n,) for n in names * 2] + [(None,)], "city string")
    listed = spark.createDataFrame(list(enumerate(official)), "rank int, name string")
    got = {r["name"]: (r["matched"], r["score"]) for r in
           best_match(sent, "city", listed, "name", "rank").collect()}
    assert set(got) == set(names)
    for name in names:
        scores = [ratio(name, o) for o in official]
        top = max(scores)
        assert got[name][1] == pytest.approx(top)
        assert got[name][0] == official[scores.index(top)]


def test_best_match_equals_brute_force(spark):
    """Many ties, equal texts in another order of words, no letter in common, the empty text."""
    rng = random.Random(7)
    official = list(dict.fromkeys(words(rng, 5) for _ in range(30)))
    names = list(dict.fromkeys(words(rng, 5) for _ in range(40)))
    check(spark, names + [official[3], " ".join(reversed(official[5].split())), "zzz", "\U0001F600", "", "q" * 70], official)
    check(spark, names[:5] + ["zzz"], [""])


def test_best_match_of_thousands(spark):
    """Thousands of names on both sides, half of them misspelt official ones, against all pairs."""
    rng = random.Random(11)
    syllables = ["ba", "ri", "São", "to", "ne", "cu", "li", "ma", "jo", "ão", "pe", "ra", "vi", "ta"]
    official = list(dict.fromkeys(" ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))).title()
                                           for _ in range(rng.randint(1, 3))) for _ in range(2500)))
    names = []
    for text in rng.sample(official, 1200):
        place = rng.randrange(len(text))
        names += [text[:place] + rng.choice("aeisx ") + text[place + 1:], "".join(rng.choices("abcdeimorstÇ ", k=rng.randint(1, 20)))]
    names = [n for n in dict.fromkeys(names)]
    sent, listed = spark.createDataFrame([(n,) for n in names], "city string"), spark.createDataFrame([(n,) for n in official], "name string")
    got = {r["name"]: (r["matched"], r["score"]) for r in best_match(sent, "city", listed, "name").collect()}
    ordered = sorted(official, key=lambda n: n.encode())
    sorted_texts = [" ".join(sorted(n.split())) for n in ordered]
    lengths = np.array([len(t) for t in sorted_texts])
    codes = np.full((len(ordered), lengths.max()), -1)
    for row, text in enumerate(sorted_texts):
        codes[row, :len(text)] = [ord(ch) for ch in text]
    assert set(got) == set(names) and len(names) > 2000
    for name in names:
        text = " ".join(sorted(name.split()))
        best = np.zeros((len(ordered), codes.shape[1] + 1), dtype=int)
        for ch in text:
            best[:, 1:] = np.maximum.accumulate(np.maximum(best[:, 1:], best[:, :-1] + (codes == ord(ch))), axis=1)
        scores = 200.0 * best[:, -1] / (lengths + len(text))
        assert got[name] == (ordered[int(scores.argmax())], pytest.approx(scores.max()))


def test_small_blocks_and_few_shuffles(spark, monkeypatch):
    rng = random.Random(23)
    official = list(dict.fromkeys(words(rng, 5) for _ in range(40)))
    names = list(dict.fromkeys(words(rng, 5) for _ in range(60)))
    monkeypatch.setattr(matching, "NAMES_BLOCK", 7)
    monkeypatch.setattr(matching, "OFFICIAL_BLOCK", 5)
    check(spark, names, official)
    sent, listed = spark.createDataFrame([("a",)], "city string"), spark.createDataFrame([("b",)], "name string")
    plan = best_match(sent, "city", listed, "name")._jdf.queryExecution().explainString(
        spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert plan.count("Exchange hashpartitioning") <= 8


def test_no_job_while_defining(spark):
    tracker = spark.sparkContext.statusTracker()
    sent, listed = spark.createDataFrame([("a",)], "city string"), spark.createDataFrame([("b",)], "name string")
    spark.sparkContext.setJobGroup("matching", "defining")
    best_match(sent, "city", listed, "name")
    assert list(tracker.getJobIdsForGroup("matching")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_official_names(spark):
    sent = spark.createDataFrame([("a",)], "city string")
    empty = spark.createDataFrame([], "name string")
    assert best_match(sent, "city", empty, "name").count() == 0


def test_column_form_equals_brute_force(spark):
    rng = random.Random(3)
    pairs = [(words(rng, 6), words(rng, 6)) for _ in range(60)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", token_sort_ratio("a", "b").alias("s"))
    for a, b, score in df.collect():
        assert score == pytest.approx(ratio(a, b))
    assert df.filter(F.col("s").isNull()).count() == 0
