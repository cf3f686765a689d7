"""Array expressions for id sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_right(ids: Column, width: Column, value: int) -> Column:
    """``ids`` as 64-bit integers, filled up to ``width`` with ``value``."""
    fill = F.array_repeat(F.lit(value).cast("bigint"), (width - F.array_size(ids)).cast("int"))
    return F.concat(ids.cast("array<bigint>"), fill)


def attention_mask(ids: Column, width: Column) -> Column:
    """1 for each real position, 0 for each padded one."""
    size = F.array_size(ids)
    return F.concat(
        F.array_repeat(F.lit(1).cast("bigint"), size),
        F.array_repeat(F.lit(0).cast("bigint"), (width - size).cast("int")),
    )


def round_up(size: Column, multiple: int) -> Column:
    return (F.ceil(size / F.lit(multiple)) * multiple).cast("int")


def argmax(vector: Column) -> Column:
    """Zero-based position of the largest value: the first one on ties; NaN counts as largest."""
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("int")


def argmax_ids(logits: Column) -> Column:
    """Per position of ``array<array<float>>``, the id with the largest logit."""
    return F.transform(logits, argmax)


def digest(ids: Column) -> Column:
    """A checksum of an id sequence that any SQL engine can reproduce."""
    return F.md5(F.array_join(ids.cast("array<string>"), ","))


def digest_rows(rows: Column) -> Column:
    """The checksum of all rows' ids in a line, without building that line of ids."""
    return F.md5(F.array_join(F.transform(rows, lambda ids: F.array_join(ids.cast("array<string>"), ",")), ","))
