"""Tokenizers: one that is a column expression, one that runs a plug-in in the Python workers.

Both offer ``encode(text, budget)``, a column ``struct<n, ids>``: the length before any cut and the
ids, cut to the budget with the end marker kept as last id. ``count(text)`` is the length alone.
``identity()`` is what a fingerprint of prepared data must depend on. ``worker()`` is the tokenizer as
pickled factory, for operators whose Python functions tokenise themselves.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import tokens
from pairloom.session import ready_workers


@dataclass(frozen=True)
class ByteTokenizer:
    """UTF-8 bytes as ids; lengths are known without building them."""

    name: str = "utf8-bytes"
    pad_id: int = tokens.PAD_ID
    eos_id: int = tokens.EOS_ID

    def count(self, text: Column) -> Column:
        return tokens.byte_count(text)

    def encode(self, text: Column, budget: int | None = None) -> Column:
        return F.struct(self.count(text).alias("n"), tokens.byte_ids(text, budget).alias("ids"))

    def identity(self) -> dict[str, Any]:
        return {"name": self.name, "offset": tokens.BYTE_OFFSET, "pad_id": self.pad_id, "eos_id": self.eos_id}

    def worker(self) -> bytes:
        return pickle.dumps(ByteLibrary)


class ByteLibrary:
    """What a plug-in library is asked for, for bytes."""

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(t.encode(), np.uint8).astype(np.int32) + tokens.BYTE_OFFSET for t in texts]

    def count_batch(self, texts: list[str]) -> list[int]:
        return [len(t) if t.isascii() else len(t.encode()) for t in texts]


def count_batch(library: Any, texts: list[str]) -> list[int]:
    """Tokens of each text, without special ids; a library may count faster than it encodes."""
    if hasattr(library, "count_batch"):
        return list(library.count_batch(texts))
    return [len(ids) for ids in library.encode_batch(texts)]


def cut_ids(ids: Any, eos_id: int, budget: int | None) -> np.ndarray:
    """A sequence of a model: ids with the end marker, cut so that the marker still fits in the budget."""
    kept = ids if budget is None else ids[: max(budget - 1, 0)]
    out = np.empty(len(kept) + 1, np.int64)
    out[:-1], out[-1] = kept, eos_id
    return out if budget != 0 else out[:0]


@dataclass(frozen=True)
class WorkerTokenizer:
    """A tokenizer library inside the Python workers.

    ``factory`` is a picklable callable, importable on the executors, that returns an object with
    ``encode_batch(list[str]) -> list[list[int]]`` without special ids. It is called once per
    worker process. Only the text goes to Python and only the cut ids come back.
    """

    factory: Callable[[], Any]
    name: str
    eos_id: int
    pad_id: int = 0
    vocabulary: str = ""
    special: dict[str, int] = field(default_factory=dict)

    def count(self, text: Column) -> Column:
        return self._encoder(0)(text)["n"]

    def encode(self, text: Column, budget: int | None = None) -> Column:
        return self._encoder(budget)(text)

    def identity(self) -> dict[str, Any]:
        return {
            "name": self.name,
            "vocabulary": self.vocabulary,
            "special": dict(self.special),
            "pad_id": self.pad_id,
            "eos_id": self.eos_id,
        }

    def worker(self) -> bytes:
        return pickle.dumps(self.factory)

    def _encoder(self, budget: int | None) -> Callable[[Column], Column]:
        ready_workers(SparkSession.active())
        factory, eos_id = self.worker(), self.eos_id

        def encode(texts: pa.Array) -> pa.Array:
            from pairloom.operators.tokenizers import encode_batch, worker_object

            return encode_batch(worker_object(factory), texts, eos_id, budget)

        return F.arrow_udf(encode, "struct<n: int, ids: array<int>>")


_worker_objects: dict[bytes, Any] = {}


def worker_object(factory: bytes) -> Any:
    """What the pickled factory builds; kept for the life of the worker process."""
    if factory not in _worker_objects:
        _worker_objects[factory] = pickle.loads(factory)()
    return _worker_objects[factory]


ENCODED = pa.struct([("n", pa.int32()), ("ids", pa.list_(pa.int32()))])


def encode_batch(library: Any, batch: pa.Array, eos_id: int, budget: int | None) -> pa.Array:
    texts = batch.to_pylist()
    bodies = iter(library.encode_batch([t for t in texts if t is not None]))
    encoded: list[dict[str, Any] | None] = []
    for text in texts:
        if text is None:
            encoded.append(None)
            continue
        body = next(bodies)
        encoded.append({"n": len(body) + 1, "ids": cut_ids(body, eos_id, budget).tolist()})
    return pa.array(encoded, ENCODED)
