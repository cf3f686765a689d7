import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom.llm import hard_negatives as hard

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, anchor string"


def test_lookups_give_exact_products():
    rng = np.random.default_rng(2)
    for low, high in ((-200, 200), (0, 1), (-1, 0), (-(1 << 25), 1 << 25)):
        a, c = rng.integers(low, high + 1, (5, 16)), rng.integers(low, high + 1, (40, 16))
        assert (hard.scores(hard.tables(a), hard.planes(c)) == c @ a.T).all()


def brute(rows, n_positives=5, n_negatives=10):
    def whole(v):
        return [math.floor(256 * x) for x in v]

    fine = [(i, whole(v), y) for i, v, y in rows if v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]

    def last(i):
        return (i is None, i or 0)

    out = []
    anchors = {(i, tuple(v), y) for i, v, y in fine if i is not None and i % 100 == 0}
    for i, v, y in anchors:
        scored = sorted(((sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in fine), key=lambda s: (-s[0], last(s[1])))
        for p, j, _ in [s for s in scored if s[2] == y and s[1] != i][:n_positives]:
            near = [s for s in scored if s[2] != y and 30 * p <= 100 * s[0] <= 90 * p][:n_negatives]
            out += [(i, j, k, s[1], p, s[0]) for k, s in enumerate(near, 1)]
    return sorted(out, key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    found = hard.mine(hard.usable(df), F.col("id") % 100 == 0, **how)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=str)


def rows_of(seed, n=400, width=10):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0.2, 0.4) for _ in range(width)], rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("pass_anchors", [1000, 2])
def test_equals_brute_force(spark, monkeypatch, pass_anchors):
    monkeypatch.setattr(hard, "ANCHOR_BLOCK", 2)
    rows = [(i * 25, v, y) for i, v, y in rows_of(1)]
    assert run(spark, rows, pass_anchors=pass_anchors) == brute(rows)


def test_nulls_ties_repeats_and_odd_vectors(spark):
    rows = [(i % 150, v, y) for i, v, y in rows_of(4, 300)]  # repeated ids
    rows += [(100, rows[100][1], rows[100][2])] * 5  # a repeated anchor
    rows += [(900 + i, [0.5] * 10, i % 3) for i in range(40)]  # ties, among them an anchor
    rows += [(None, [0.4] * 10, 1), (200, None, 1), (300, [0.1] * 10, None), (400, [0.1] * 9 + [None], 1),
             (500, [float("nan")] * 10, 1), (600, [float("inf")] * 10, 2), (700, [], 0), (800, [0.3] * 4, 0), (802, [0.9] * 20, 1)]
    assert run(spark, rows) == brute(rows)


def test_no_anchor_and_no_rows(spark):
    assert run(spark, [(1, [0.1], 0), (2, [0.1], 1)]) == []
    assert run(spark, [(100, [0.1], 0)]) == []
    empty = spark.createDataFrame([], SCHEMA)
    assert hard.mine(hard.usable(empty), F.col("id") % 100 == 0).collect() == []


def test_components_beyond_exact_scores_raise(spark):
    with pytest.raises(PySparkException, match="too large"):
        run(spark, [(100, [1e9], 0), (1, [0.1], 0)])
