"""Toxicity by logistic regression with FTRL-proximal updates over hashed word n-grams and skip-grams.

Every coordinate has its own learning rate, and the L1 term keeps weights at exactly zero until the gradients
agree, so the model is a short list of (feature, weight) that travels to every task. It is learned in one task
from a bounded sample of labelled texts; scoring is a map over the table.

Features are the distinct words, pairs of neighbours and pairs with one or two words between, in lower case
and without ASCII punctuation. An empty or null text has only the intercept. Without any labelled row there is
nothing to say: every score is 0. A document counts once in learning; of rows with equal ids the first text in
sorted order and the highest label count. Scored rows are kept one for one with all their columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import with_workers, worker_table
from pairloom.llm.shingles import mix, text_batches, word_hashes

#: Labelled rows learned from at most, and characters of a text: of a longer one its start, middle and end are
#: learned from. These are the bounds of the sample.
SAMPLE_ROWS = 15_000
SAMPLE_TEXT = 32 * 1024
BITS = 20
EPOCHS = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.0
INTERCEPT = 1 << BITS

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 32
_SKIPS = (1, 2, 3)


def features(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature number of everything found in a slice of texts, repeats included."""
    starts, words = word_hashes(_PLAIN[data])
    row = np.searchsorted(borders, starts, "right") - 1
    rows, found = [row], [words]
    for k in _SKIPS:
        same = row[k:] == row[:-k]
        rows.append(row[k:][same])
        found.append(mix(words[:-k] * np.uint64(2 * k + 1) + mix(words[k:] + np.uint64(k)))[same])
    return np.concatenate(rows), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


def _feature_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    for data, borders in text_batches(texts):
        row, found = features(data, borders)
        pairs = np.unique(row.astype(np.int64) << (BITS + 1) | found)
        edges = np.searchsorted(pairs >> (BITS + 1), np.arange(len(borders)))
        found = (pairs & ((1 << (BITS + 1)) - 1)).astype(np.int32)
        yield from (found[a:b] for a, b in zip(edges[:-1], edges[1:]))


def train(sets: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and weights of the non-zero coordinates; the rows are taken in the given order."""
    z, n = np.zeros(INTERCEPT + 1), np.zeros(INTERCEPT + 1)
    sets = [np.append(s, INTERCEPT) for s in sets]

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        shrink = np.where(at == INTERCEPT, 0.0, L1)
        return np.where(
            np.abs(zs) <= shrink, 0.0, -(zs - np.sign(zs) * shrink) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        )

    for _ in range(epochs):
        for at, label in zip(sets, labels):
            w = weights(at)
            step = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            before = n[at]
            z[at] += step - (np.sqrt(before + step * step) - np.sqrt(before)) / ALPHA * w
            n[at] = before + step * step
    every = np.arange(INTERCEPT + 1)
    w = weights(every)
    kept = np.flatnonzero(w)
    return kept, w[kept]


def sampled(labels: DataFrame, docs: DataFrame, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """The documents of a bounded sample of ``labels``, with their label: about SAMPLE_ROWS ids by hash.

    The sample is a broadcast of SAMPLE_ROWS ids at most, so the texts are not shuffled.
    """
    ids = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    ids = ids.groupBy(key).agg(F.max(label).alias(label))
    ids = ids.orderBy(F.xxhash64(F.col(key), F.lit("turn")), key).limit(SAMPLE_ROWS)
    return docs.drop(label).join(F.broadcast(ids), key)


def _bounded(text: Column) -> Column:
    """``text``, or start, middle and end of one with more than SAMPLE_TEXT characters."""
    n, size = F.char_length(text), SAMPLE_TEXT // 3
    starts = (F.lit(1), F.floor((n - size) / 2).cast("int"), n - size + 1)
    parts = [F.substring(text, start, F.lit(size)) for start in starts]
    return F.when(n <= SAMPLE_TEXT, text).otherwise(F.concat_ws("\n", *parts))


def learn(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> dict[int, float]:
    """Weights by feature number from rows with a key, a text and a label of 0 or 1; {} if there are none."""
    with_workers(labelled)
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label"))
    rows = rows.where(F.col("key").isNotNull() & F.col("label").isNotNull())
    rows = rows.where(F.col("text").isNotNull()).withColumn("text", _bounded(F.col("text")))
    rows = rows.groupBy("key").agg(F.min("text").alias("text"), F.max("label").cast("int").alias("label"))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order, sets, labels = [], [], []
        for batch in batches:
            order += batch["place"].tolist()
            labels += batch["label"].tolist()
            sets += _feature_sets(pa.array(batch["text"], pa.string()))
        if sets:
            turn = np.argsort(order, kind="stable")
            at, w = train([sets[i] for i in turn], np.asarray(labels)[turn])
            yield pd.DataFrame({"feature": at, "weight": w})

    one = rows.select("text", "label", F.xxhash64("key", F.lit("turn")).alias("place"), "key")
    one = one.orderBy("place", "key").limit(SAMPLE_ROWS).select("text", "label", "place")
    found = one.coalesce(1).mapInPandas(fit, "feature bigint, weight double").collect()
    return {r["feature"]: r["weight"] for r in found}


def _dense(at: bytes, weights: bytes) -> np.ndarray:
    out = np.zeros(INTERCEPT + 1)
    out[np.frombuffer(at, np.int64)] = np.frombuffer(weights, np.float64)
    return out


def score_batch(texts: pa.Array, at: bytes, weights: bytes) -> pa.Array:
    if not at:
        return pa.array(np.zeros(len(texts)))
    w, out = worker_table("toxicity", _dense, at, weights), []
    for data, borders in text_batches(texts):
        row, found = features(data, borders)
        heavy = w[found] != 0
        pairs = np.unique(row[heavy].astype(np.int64) << (BITS + 1) | found[heavy])
        total = np.full(len(borders) - 1, w[INTERCEPT])
        np.add.at(total, pairs >> (BITS + 1), w[pairs & ((1 << (BITS + 1)) - 1)])
        out.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
    return pa.array(np.concatenate(out) if out else np.zeros(0))


def score(df: DataFrame, text: Column, weights: dict[int, float]) -> Column:
    """The probability of label 1 for ``text``; the weights travel with the function."""
    with_workers(df)
    at = np.array(list(weights), np.int64).tobytes()
    values = np.array(list(weights.values()), np.float64).tobytes()

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return score_batch(texts, at, values)

    return scored(text)
