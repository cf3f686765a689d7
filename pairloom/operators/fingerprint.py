"""A fingerprint of content and parameters: equal tag, equal prepared data."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from pairloom.config import PAIR_COLUMNS, PREPARE_VERSION
from pairloom.sources.pairs import content_key


def digest_columns(columns: Sequence[str] = PAIR_COLUMNS) -> list[Column]:
    """Aggregates ``n_rows, xor, total`` that do not depend on the order of the rows.

    From 60 bits of a hash of each row. Copies in even number cancel in the xor, not in the sum.
    """
    # 15 hexadecimal digits fit a 64-bit integer
    value = F.conv(F.substring(content_key(columns), 1, 15), 16, 10).cast("bigint")
    return [
        F.count("*").alias("n_rows"),
        F.coalesce(F.bit_xor(value), F.lit(0).cast("bigint")).alias("xor"),
        F.coalesce(F.sum(value.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("total"),
    ]


def content_digest(df: DataFrame, columns: Sequence[str] = PAIR_COLUMNS) -> DataFrame:
    """The digest of a table, one row: one pass, three numbers per task."""
    return df.agg(*digest_columns(columns))


def dataset_fingerprint(
    content: Row, tokenizer: dict[str, Any], max_input: int, max_target: int, **more: Any
) -> str:
    """16 hexadecimal digits over the content and all that decides how it is prepared."""
    identity = {
        "dataset": [content["n_rows"], content["xor"], content["total"]],
        "tokenizer": tokenizer,
        "max_input": max_input,
        "max_target": max_target,
        "prepare": PREPARE_VERSION,
        **more,
    }
    return hashlib.sha256(json.dumps(identity, sort_keys=True).encode()).hexdigest()[:16]
