import random
import zlib

import numpy as np
from cases import LABELS, docs, empty, prose
from fieldmart.llm import classifier


def corpus(spark, n=700):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        text = prose(rng, rng.randint(5, 80))
        rows.append((i, text if good else " ".join(w + rng.choice(("###", "%%", "|")) for w in text.split())))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy(spark):
    frame, labels = corpus(spark)
    label = {r.doc_id: r.quality for r in labels.collect()}
    found = classifier.scores(frame, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)


def test_held_out_labels_change_nothing(spark):
    frame, labels = corpus(spark, 200)
    turned = labels.withColumn("quality", classifier.F.when(classifier.held_out("doc_id"), 1 - labels.quality).otherwise(labels.quality))
    a, b = ({r.doc_id: r.score for r in classifier.scores(frame, x).collect()} for x in (labels, turned))
    assert a == b


def test_awkward_rows_and_no_labels(spark):
    frame, labels = corpus(spark, 200)
    scored = classifier.scores(docs(spark), labels)  # ids overlap, texts do not fit: any model will do
    assert scored.count() == docs(spark).count() and scored.filter("score IS NULL").count() == 0
    none = spark.createDataFrame([(1, None, None), (2, 1, 0), (2, 0, 0)], LABELS)
    assert {(r.score, r.predicted) for r in classifier.scores(docs(spark), none).collect()} == {(0.5, 1)}
    assert classifier.scores(empty(spark), none).count() == 0


def test_descent_finds_a_separating_plane():
    rng = np.random.default_rng(0)
    signs = rng.choice((-1, 1), 200)
    vectors = [(np.array([0, 1 if s > 0 else 2, 3]), np.array([0.3, 0.9, rng.random()])) for s in signs]
    weights, bias = classifier.dual_coordinate_descent(vectors, signs, 4, np.ones(200))
    assert all(s * (weights[p] @ v + bias) > 0.9 for s, (p, v) in zip(signs, vectors))
