"""Passages that cleaning repeated inside a text, also within one line."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.session import ship_package

SPANS = pa.list_(pa.struct([("start", pa.int64()), ("n_words", pa.int64()), ("span", pa.string())]))
SPANS_DDL = "array<struct<start: bigint, n_words: bigint, span: string>>"


def repeated_spans(df: DataFrame, key: str, least: int = 8, unspaced: Sequence[str] = ("zh",)) -> DataFrame:
    """``key, start, n_words, span``: passages that clean has more often than raw, where they come again.

    Every run of ``least`` words of clean is looked at. The k-th occurrence of a run is one too many if k is
    above 1 and above the run's number in raw. Runs that overlap and are each one too many make one span, as long
    as can be; ``start`` counts words from 0. Words are parted by white space; in languages that write
    without spaces (``unspaced``) every character is one. Nothing is shuffled.
    """
    if least < 1:
        raise ValueError(f"least must be 1 or more, got {least}")
    ship_package(df.sparkSession)

    @F.arrow_udf(SPANS_DDL)
    def found(split: pa.Array, raws: pa.Array, cleans: pa.Array) -> pa.Array:
        from pairloom.operators.repeats import spans_of

        rows = zip(split.to_pylist(), raws.to_pylist(), cleans.to_pylist())
        return pa.array([spans_of(raw or "", clean or "", least, bool(single)) for single, raw, clean in rows], SPANS)

    single: Column = F.col("lang").isin(*unspaced) if unspaced else F.lit(False)
    return df.select(key, F.inline(found(single, "raw", "clean")))


def run_numbers(words: np.ndarray, size: int) -> np.ndarray:
    """A number for every run of ``size`` words, the same for equal runs and no others.

    Numbers of runs of 1, 2, 4, ... words are made from pairs of the numbers before; the last step takes two that
    overlap. So no two different runs can meet, as hashes could.
    """
    if len(words) < size:
        return words[:0]
    numbers, width = words, 1
    while width < size:
        step = min(width, size - width)
        pairs = numbers[: len(numbers) - step] * (len(words) + 1) + numbers[step:]
        numbers, width = np.unique(pairs, return_inverse=True)[1], width + step
    return numbers


def spans_of(raw: str, clean: str, least: int, single: bool = False) -> list[dict]:
    """The spans of one pair, in order."""
    if single:
        before, after = ([c for c in t if not c.isspace()] for t in (raw, clean))
    else:
        before, after = raw.split(), clean.split()
    if len(after) <= least:
        return []
    known: dict[str, int] = {}
    both = np.array([known.setdefault(w, len(known)) for w in [*after, *before]], np.int64)
    numbers = run_numbers(both, least)
    n_after = len(after) - least + 1
    first = len(after)  # runs across the border of the texts are of neither
    runs, others = numbers[:n_after], numbers[first:]
    allowed = np.maximum(np.bincount(others, minlength=len(both)), 1)[runs]
    order = np.argsort(runs, kind="stable")
    ranked = runs[order]
    occurrence = np.empty(len(runs), np.int64)
    occurrence[order] = np.arange(len(runs)) - np.searchsorted(ranked, ranked) + 1
    again = np.concatenate(([False], occurrence > allowed, [False]))
    edges = np.flatnonzero(again[1:] != again[:-1])
    joint = "" if single else " "
    return [
        {"start": int(a), "n_words": int(b - a) + least - 1, "span": joint.join(after[a : b + least - 1])}
        for a, b in zip(edges[::2], edges[1::2])
    ]
