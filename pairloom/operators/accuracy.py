"""Scoring predictions against labels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.config import IGNORED_LABEL
from pairloom.functions.arrays import argmax_ids
from pairloom.session import ready_workers


def with_argmax(df: DataFrame, logits: str = "logits", name: str = "predictions") -> DataFrame:
    """Add the predicted ids; the logits are dropped, as nothing later needs them."""
    return df.withColumn(name, argmax_ids(F.col(logits))).drop(logits)


def _counts(ignore: int):
    @F.arrow_udf("struct<h: bigint, c: bigint>")
    def counts(predictions: pa.Array, labels: pa.Array) -> pa.Array:
        from pairloom.operators.accuracy import count_batch

        return count_batch(predictions, labels, ignore)

    return counts


def count_batch(predictions: pa.Array, labels: pa.Array, ignore: int) -> pa.Array:
    """Per row the positions that count and are predicted right (`h`), and those that count (`c`).

    Whole batches are compared as two lines of numbers. A null sequence has no count; a null in one is
    like an ignored label, or a wrong prediction.
    """
    n_p, n_y = (np.asarray(x.value_lengths().fill_null(0), np.int64) for x in (predictions, labels))
    p, y = (np.asarray(x.flatten().fill_null(ignore)) for x in (predictions, labels))
    counting = y != ignore
    if (n_p == n_y).all():
        right = counting & (p == y)
    else:
        row = np.repeat(np.arange(len(n_y)), n_y)
        place = np.arange(len(y)) - np.repeat(np.cumsum(n_y) - n_y, n_y)
        at = np.flatnonzero(place < n_p[row])
        right = np.zeros(len(y), bool)
        right[at] = counting[at] & (p[(np.cumsum(n_p) - n_p)[row[at]] + place[at]] == y[at])
    ends = np.cumsum(n_y)

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[ends] - total[ends - n_y]

    no_y = np.asarray(labels.is_null())
    none = no_y | np.asarray(predictions.is_null())
    return pa.StructArray.from_arrays(
        [pa.array(per_row(right), mask=none), pa.array(per_row(counting), mask=no_y)], ["h", "c"]
    )


def masked_token_accuracy(
    df: DataFrame, predictions: str = "predictions", labels: str = "labels", ignore: int = IGNORED_LABEL
) -> DataFrame:
    """Share of counting positions predicted right, over all tokens of all rows; 0.0 if none counts.

    ``mismatched`` counts rows whose two sequences differ in length; their positions beyond the
    shorter one count as wrong where the label counts.
    """
    p, y = F.col(predictions), F.col(labels)
    ready_workers(df.sparkSession)
    rows = df.select(_counts(ignore)(p, y).alias("n"), (F.size(p) != F.size(y)).alias("m"))
    sums = rows.agg(
        F.coalesce(F.sum("n.h"), F.lit(0)).alias("n_hits"),
        F.coalesce(F.sum("n.c"), F.lit(0)).alias("n_counted"),
        F.count_if("m").alias("mismatched"),
    )
    return sums.withColumn(
        "token_accuracy", F.coalesce(F.try_divide(F.col("n_hits"), F.col("n_counted")), F.lit(0.0))
    )
