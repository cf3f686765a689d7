"""Byte-level ids: id = byte value + 3, 0 pads, 1 ends a sequence."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from pairloom.session import ready_workers

PAD_ID = 0
EOS_ID = 1
BYTE_OFFSET = 3


def byte_count(text: Column) -> Column:
    """Length of the id sequence, end marker included, without building it."""
    return F.octet_length(text) + 1


def byte_ids(text: Column, budget: int | None = None) -> Column:
    """The id sequence of ``text``; with a budget, cut so that the end marker still fits in it.

    Bytes become ids by arithmetic on Arrow buffers, whole batches at once. Only the bytes that the budget
    leaves go to the workers, so a long text under a small budget costs no more than the budget.
    """
    ready_workers(SparkSession.active())

    @F.arrow_udf("array<int>")
    def ids(data: pa.Array) -> pa.Array:
        from pairloom.functions.tokens import ids_of_bytes

        return ids_of_bytes(data)

    data = F.encode(text, "UTF-8")
    return ids(data if budget is None else F.substring(data, 1, budget - 1))


def bytes_and_borders(data: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows in a line, and where each row begins and the last one ends; null is empty."""
    wide = data.cast(pa.large_binary())
    if not len(wide):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    borders = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if wide.null_count:  # a null row may lie over bytes
        wide = wide.fill_null(b"")
        borders = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    values = wide.buffers()[2]
    line = np.frombuffer(values, np.uint8)[borders[0] : borders[-1]] if values is not None else np.zeros(0, np.uint8)
    return line, borders - borders[0]


def ids_of_bytes(data: pa.Array) -> pa.Array:
    """Lists of ids, each with the end marker; null for null."""
    line, borders = bytes_and_borders(data)
    borders = borders + np.arange(len(borders))  # every row before has one more id
    ids = np.full(int(borders[-1]), EOS_ID, np.int32)
    body = np.ones(len(ids), bool)
    body[borders[1:] - 1] = False
    ids[body] = line
    ids[body] += BYTE_OFFSET
    missing = data.is_null() if data.null_count else None
    if len(ids) < 1 << 31:
        return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(ids), mask=missing)
    wide = pa.LargeListArray.from_arrays(pa.array(borders), pa.array(ids), mask=missing)
    return wide
