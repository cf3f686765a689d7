"""Toxicity: FTRL against a plain loop, and what is learned from which rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import toxicity

DOCS = "doc_id bigint, text string, toxic string, score string"


def plain_ftrl(sets, labels, epochs):
    """One coordinate after the other, with dictionaries."""
    z, n = {}, {}

    def weight(i):
        shrink = 0.0 if i == toxicity.INTERCEPT else toxicity.L1
        if abs(z.get(i, 0.0)) <= shrink:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2
        return -(z[i] - math.copysign(shrink, z[i])) / rate

    for _ in range(epochs):
        for at, label in zip(sets, labels):
            at = [*at, toxicity.INTERCEPT]
            w = {i: weight(i) for i in at}
            gradient = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values()))))) - label
            for i in at:
                before = n.get(i, 0.0)
                sigma = (math.sqrt(before + gradient**2) - math.sqrt(before)) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + gradient - sigma * w[i]
                n[i] = before + gradient**2
    return {i: weight(i) for i in z if weight(i)}


def test_training_equals_a_plain_loop():
    draw = random.Random(1)
    sets = [np.array(sorted(draw.sample(range(200), 20)), np.int32) for _ in range(300)]
    labels = np.array([int(7 in s or draw.random() < 0.1) for s in sets])
    at, w = toxicity.train(sets, labels, 3)
    expect = plain_ftrl([s.tolist() for s in sets], labels.tolist(), 3)
    assert dict(zip(at.tolist(), w.tolist())) == pytest.approx(expect) and 7 in expect


def corpus(n, tail=""):
    draw = random.Random(2)
    words = ["".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    rows = []
    for i in range(n):
        label = i % 2
        text = " ".join(draw.choice(words) for _ in range(20)) + (" you utter fool" if label else " you kind soul")
        rows.append((i, text + tail, label))
    return rows


def learned(spark, rows, **names):
    docs = spark.createDataFrame([(i, t, "own", "s") for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    return toxicity.learn(toxicity.sampled(labels, docs))


def scores(spark, weights, texts):
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    return [r["s"] for r in docs.select(toxicity.score(docs, F.col("text"), weights).alias("s")).collect()]


def test_toxic_words_are_learned(spark):
    weights = learned(spark, corpus(400))
    bad, good, empty, null, shout = scores(spark, weights, ["You UTTER fool!", "you kind soul", "", None, "fool " * 100_000])
    assert bad > 0.5 > good and empty == null and 0 <= empty <= 1 and shout > 0.5
    assert len(weights) < 2000  # sparse, of a million coordinates


def test_texts_over_the_bound_are_learned_by_their_pieces(spark):
    weights = learned(spark, corpus(200, " filler" * 8000))
    assert weights and max(len(t) for _, t, _ in corpus(2, " filler" * 8000)) > toxicity.SAMPLE_TEXT
    bad, good = scores(spark, weights, ["you utter fool", "you kind soul"])
    assert bad > good


def test_scores_equal_the_sum_of_weights(spark):
    weights = learned(spark, corpus(300))
    texts = [t for _, t, _ in corpus(30)]
    for text, got in zip(texts, scores(spark, weights, texts)):
        (found,) = toxicity._feature_sets(pa.array([text]))
        total = weights[toxicity.INTERCEPT] + sum(weights.get(int(i), 0.0) for i in found)
        assert got == pytest.approx(1 / (1 + math.exp(-total)))


def test_nulls_repeats_and_nothing_to_learn(spark):
    rows = corpus(60)
    extra = [(None, "you utter fool", 1), (0, None, 0), (3, rows[3][1], None)]
    again = [*rows, *rows[:20], *extra]
    assert learned(spark, again) == learned(spark, rows)
    assert learned(spark, extra[:2]) == {} and learned(spark, []) == {}
    assert scores(spark, {}, ["you utter fool", None]) == [0.0, 0.0]


def test_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 25)
    rows = corpus(100)
    docs = spark.createDataFrame([(i, t, "own", "s") for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    assert toxicity.sampled(labels, docs).count() == 25
