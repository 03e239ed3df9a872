"""Quality scores: a linear support vector machine on naive Bayes features.

Features are indicators of a text's byte n-grams, hashed to a fixed number of places, and of runs of one
word (an n-gram whose words are all the same, whichever word it is). Each is scaled
by the log ratio of its (smoothed) share in the two classes, counted over all labelled rows. A hinge
loss model on these vectors, each of length one, is fitted by dual coordinate descent, on a sample of
the labelled rows of about ``SAMPLE`` (a documented bound; the counts have no bound). Margins become
probabilities by a logistic curve fitted on a part of the sample that the model has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, cut, map_texts

BITS = 16  # log2 of the number of places
GRAMS = (2, 3)
SAMPLE = 6000  # labelled rows that the support vector machine sees, half of each class, give or take the luck of a hash; at most twice as many
SMOOTH = 1.0
PIECE = 8  # words
RUNS = {2: 0, 3: 1, 5: 2, 7: 3}  # places of runs of one word, by length
CHUNK = 1 << 20  # bytes of a text looked at together


def features(text: bytes, mask: np.ndarray) -> np.ndarray:
    """Places of a text's n-grams, ascending. ``mask``: all false, one byte for each place; stays so."""
    raw = np.frombuffer(text, np.uint8)
    for at in range(0, max(1, len(raw)), CHUNK):
        part = raw[at: at + CHUNK + max(GRAMS) - 1].astype(np.uint32)
        for n in GRAMS:
            if len(part) >= n:
                code = np.full(len(part) - n + 1, n, np.uint32)
                for k in range(n):
                    code = code * np.uint32(257) + part[k: len(part) - n + 1 + k]
                mask[(code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)] = True
    words = text.split()
    same = np.fromiter(map(eq, words, words[1:]), bool, max(0, len(words) - 1))
    for n, place in RUNS.items():
        mask[place] = len(same) > 0 and bool(same.any())
        same = same[1:] & same[:-1] if n == 2 else same[2:] & same[:-2]  # runs of 2, 3, 5, 7 words
    found = np.flatnonzero(mask)
    mask[found] = False
    return found.astype(np.int32)


def a_piece(text: bytes) -> bytes:
    """Some eight words of the text, so that the model also learns from short texts."""
    words = text.split()
    at = crc32(text) % max(1, len(words) - PIECE + 1)
    return b" ".join(words[at: at + PIECE])


@dataclass(frozen=True)
class Model:
    """Weights by place, squared scales by place (for the length of a vector), bias, logistic curve."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, places: np.ndarray) -> float:
        length = float(np.sqrt(self.squares[places].sum()))
        return (float(self.weights[places].sum()) / length if length else 0.0) + self.bias

    def score(self, places: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(places) + self.shift, -30, 30))))


def held_out(id_col: str) -> Column:
    """Rows that a fit may not see: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def dual_coordinate_descent(vectors: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, size: int, cost: np.ndarray,
                            rounds: int = 12, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2 / 2 + sum cost_i * max(0, 1 - y_i (w x_i + b)), one dual variable at a time."""
    weights, bias, alpha = np.zeros(size), 0.0, np.zeros(len(vectors))
    squares = [float(v @ v) + 1.0 for _, v in vectors]
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        largest = 0.0
        for i in rng.permutation(len(vectors)):
            places, values = vectors[i]
            slope = signs[i] * (weights[places] @ values + bias) - 1
            after = min(max(alpha[i] - slope / squares[i], 0.0), cost[i])
            step = (after - alpha[i]) * signs[i]
            if step:
                alpha[i] = after
                weights[places] += step * values
                bias += step
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return weights, bias


def logistic_curve(margins: np.ndarray, signs: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the most likely curve, with targets pulled off 0 and 1 a little so that it stays finite."""
    goal = np.where(signs > 0, (np.sum(signs > 0) + 1) / (np.sum(signs > 0) + 2), 1 / (np.sum(signs < 0) + 2))
    x, theta = np.stack([margins, np.ones(len(margins))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (weight * (goal - p)))
        theta = theta + step * min(1.0, 5 / max(1e-9, float(np.abs(step).max())))
    return float(max(theta[0], 0.0)), float(theta[1])


def _gather(train: DataFrame) -> DataFrame:
    """From (label, sampled, fold, text): n-gram counts of each task, and the vectors of the sample."""
    def work():
        mask = np.zeros(1 << BITS, bool)

        def step(batch):
            counts = np.zeros((2, 1 << BITS), np.int64)
            label, fold, places = [], [], []
            for y, sampled, f, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                           as_bytes(batch.column(3)), strict=True):
                found = features(text, mask)
                counts[y, found] += 1
                if sampled:
                    label += [y, y]
                    fold += [f, f]
                    places += [found, features(a_piece(text), mask)]
            some = np.flatnonzero(counts.sum(axis=0))
            n, m = len(some), len(label)
            return {"place": pa.array(some.tolist() + [None] * m, pa.int32()), "bad": pa.array(counts[0, some].tolist() + [None] * m, pa.int64()),
                    "good": pa.array(counts[1, some].tolist() + [None] * m, pa.int64()), "label": pa.array([None] * n + label, pa.int32()),
                    "fold": pa.array([None] * n + fold, pa.int32()), "places": pa.array([None] * n + places, pa.list_(pa.int32()))}
        return step

    return map_texts(train, "place int, bad long, good long, label int, fold int, places array<int>", work)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = SAMPLE) -> Model | None:
    """The model from all labelled rows that are not held out; None if a class or the sample has no row.

    Ids with null, other or contradicting labels are left out; a repeated row counts as often as it stands there.
    """
    known = (labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("id"))
             .agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("other")).filter("label = other").drop("other")
             .filter(~held_out("id")))
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    rate = F.when(F.col("label") == 1, sample / 2 / sizes[1]).otherwise(sample / 2 / sizes[0])
    known = known.withColumns({"sampled": F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < rate * 1_000_000,
                               "fold": (F.crc32(F.col("id").cast("string")) % 5).cast("int")})
    # a sort-merge join whatever the sizes: labels grow with the documents, so they are never broadcast
    train = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(known.hint("merge"), "id")
    gathered = cut(_gather(train.select("label", "sampled", "fold", "text")))

    totals = gathered.filter("place IS NOT NULL").groupBy("place").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas()
    counts = np.full((2, 1 << BITS), SMOOTH)
    counts[:, totals["place"]] += totals[["bad", "good"]].to_numpy().T
    shares = counts / counts.sum(axis=1, keepdims=True)
    ratio = np.log(shares[1] / shares[0])

    rows = gathered.filter("place IS NULL").select("label", "fold", "places").orderBy("label", F.xxhash64("places")).limit(4 * sample).toPandas()
    if rows.empty:
        return None
    signs = np.where(rows["label"] == 1, 1, -1)
    vectors = []
    for places in rows["places"]:
        values = ratio[places]
        vectors.append((places, (values / max(1e-12, float(np.sqrt(values @ values)))).astype(np.float32)))
    prior = np.where(signs > 0, sizes[1] / max(1, np.sum(signs > 0)), sizes[0] / max(1, np.sum(signs < 0)))
    seen = np.flatnonzero(rows["fold"] != 1)
    if len(set(signs[seen])) < 2:
        seen = np.arange(len(signs))
    weights, bias = dual_coordinate_descent([vectors[i] for i in seen], signs[seen], 1 << BITS, prior[seen] / prior[seen].mean())
    margins = np.array([weights[p] @ v + bias for p, v in vectors])
    check = np.flatnonzero(rows["fold"] == 1)
    if len(set(signs[check])) < 2:
        check = np.arange(len(signs))
    slope, shift = logistic_curve(margins[check], signs[check], prior[check] / prior[check].mean()) if len(set(signs[check])) == 2 else (1.0, 0.0)
    return Model(weights * ratio, ratio**2, bias, slope, shift)


def scorer(docs: DataFrame, model: Model | None):
    """A column function from text to score. Without a model every score is 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model and astuple(model))  # a fixed number of places

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found, mask = shared.value and Model(*shared.value), np.zeros(1 << BITS, bool)
        for texts in parts:
            yield pa.array([0.5 if found is None else found.score(features(t, mask)) for t in as_bytes(texts)], pa.float64())
    return score


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.3, **settings) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``; null texts score as empty ones.

    Only the text enters a score. Repeated rows stay, an empty table gives an empty result, other columns are not read.
    Texts of any length are scored whole.
    """
    model = fit(docs, labels, id_col, text_col, **settings)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), scorer(docs, model)(text_col).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= limit).cast("int"))
