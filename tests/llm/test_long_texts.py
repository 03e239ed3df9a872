"""Texts far over every size in which an operator works, whole, against plain versions."""

import random
from collections import Counter

import pytest
from fieldmart.llm import chat, classifier, decontaminate, mixing, quality_rules, simhash, suffix_dedup, token_counts
from pyspark.sql import functions as F
from test_simhash import plain_fingerprint
from test_suffix_dedup import plain as plain_suffixes
from test_tokens import PIECE

WORDS = 140_000


@pytest.fixture(scope="module")
def long_texts(spark):
    rng = random.Random(31)
    prose = " ".join(f"w{rng.randrange(20_000)}" + rng.choice(("", "", ".", "\n")) for _ in range(WORDS))
    other = " ".join(f"v{rng.randrange(20_000)}" for _ in range(WORDS // 2)) + " " + prose[-3000:]
    rows = [(1, prose, "en", "a"), (2, other, "en", "b"), (3, "loop " * WORDS, "de", "a"), (4, "x" * 200_000, "de", None), (5, "short one", "en", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), {r[0]: r[1] for r in rows}


def test_simhash(spark, long_texts):
    frame, texts = long_texts
    assert WORDS > 2 * simhash.CHUNK
    found = {r.doc_id: r.fingerprint % 2**64 for r in simhash.near_duplicates(frame).collect()}
    assert found == {i: plain_fingerprint(t) for i, t in texts.items()}


def test_token_counts(spark, long_texts):
    frame, texts = long_texts
    sp = token_counts.load(PIECE)
    found = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.token_counts(frame, PIECE).collect()}
    assert found == {i: (len(t.encode()), len(sp.encode(t))) for i, t in texts.items()}


def plain_measures(text):
    words, lines = text.split(), [line for line in text.split("\n") if line.split()]
    windows = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_measures(spark, long_texts):
    frame, texts = long_texts
    found = quality_rules.measures(frame).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found} == {i: plain_measures(t) for i, t in texts.items()}


def test_contamination_at_the_end(spark, long_texts):
    frame, texts = long_texts
    item = " ".join(texts[1].split()[-20:])
    found = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(frame, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()}
    assert {i: f[1:] for i, f in found.items()} == {1: (20, 1), 2: (20, 1), 3: (0, 0), 4: (0, 0), 5: (0, 0)}
    assert found[1][0] == len(decontaminate.words_of(texts[1].encode()))


def test_suffixes(spark, long_texts):
    frame, texts = long_texts
    few = frame.filter("doc_id IN (2, 4, 5)")
    expected = dict(zip((2, 4, 5), plain_suffixes([texts[i].encode() for i in (2, 4, 5)]), strict=True))
    for r in suffix_dedup.without_repeats(few).collect():
        assert (r.n_bytes, sum(s.stop - s.start for s in r.removed), bytes(r.kept)) == expected[r.doc_id]


def test_chat_and_scores_and_mix(spark, long_texts):
    frame, texts = long_texts
    turns = frame.select(F.lit(1).cast("long").alias("conv_id"), F.col("doc_id").alias("turn"), F.when(F.col("doc_id") % 2 == 0, "assistant").otherwise("user").alias("role"), "text")
    found = chat.digests(chat.format_conversations(turns)).collect()
    assert [(r.n_turns, r.loss_chars) for r in found] == [(5, len(texts[2]) + len(texts[4]))]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 6)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in classifier.scores(frame, labels).collect())
    sizes = {r.doc_id: r.size for r in mixing.mix(frame).collect()}
    assert sizes == {i: len(t.split()) for i, t in texts.items()}
