"""Packing by power-of-two decomposition: no sequence crosses a document and none is padded.

A document's ids (its tokens and one end id) are cut into pieces whose lengths are powers of two: as many of the
longest length as fit, then one for every binary digit of the rest, longest first. Every piece is a sequence of
its own, so a model never attends over a border of documents. Sequences of equal length form a bucket, and
batches are drawn from one bucket at a time: all rows of a batch are equally long.

`pieces` reads the texts once, row by row. `bucketed` numbers the sequences, bucket after bucket, without gaps: a
count for each of CELLS cells of a bucket places the cells, and each cell is numbered on its own. A cell holds
an equal share of its bucket whatever the documents are, so copies, sources and long texts cannot load one task.

Null and empty texts are the end id alone, one sequence of length 1. Null and repeated ids are rows like others.
Special strings inside texts are one token each, as in the library. Very long texts are encoded in parts, cut
where the vocabulary's pattern begins a new match in any case.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import tokenizers
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.shared import spare_name, with_workers, worker_table, written
from pairloom.llm.token_counts import _byte_of_char

LONGEST = 1024
END_ID = 0
#: Numbering cells of a bucket; with the eleven buckets of 1 to 1024 their counts are 45,056 rows at most.
CELLS = 4096
#: Characters of a text that are encoded at once, where it can be cut.
PART = 1 << 18
#: Bytes of ids in one batch to Spark; one document may go beyond it.
FLUSH = 1 << 23

# The pattern of byte-level files that name none of their own.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A blank between two characters that are not white space: a match ends before it and one begins with it.
_SAFE = regex.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Texts to ids, as the file's own library gives them.

    A byte-level file whose ids are in the order of its merges is read as ranks, which encode three times as
    fast; other files, and parts too long to be matched that way, go through the library itself.
    """

    def __init__(self, path: str):
        self.library = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.ranked = _ranked(spec)
        self.specials = [t["content"] for t in spec["added_tokens"]]

    def encode(self, text: str) -> list[np.ndarray]:
        """The ids of one text, part by part."""
        return [self._part(part) for part in self._parts(text)]

    def _parts(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > PART and not any(" " in s for s in self.specials):
            cut = _SAFE.search(text, at + PART)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def _part(self, text: str) -> np.ndarray:
        if self.ranked is not None and len(text) <= 2 * PART:
            return self.ranked.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4")


def _ranked(spec: dict) -> tiktoken.Encoding | None:
    """The file as ranks, if it is a plain byte-level one whose ids are in the order of its merges."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type", "BPE") == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                           "byte_fallback", "ignore_merges"))
        and not any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        return None
    byte, special = _byte_of_char(), {t["content"]: t["id"] for t in spec["added_tokens"]}
    ids = {token: i for token, i in model["vocab"].items() if token not in special}
    merged = [ids.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    singles = [i for token, i in ids.items() if len(token) == 1]
    if None in merged or merged != sorted(set(merged)) or len(singles) != 256 or len(ids) != 256 + len(merged):
        return None
    if max(singles) > merged[0]:
        return None
    ranks = {bytes(byte[c] for c in token): i for token, i in ids.items()}
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_lengths(df: DataFrame, text: Column, path: str) -> Column:
    """The number of ids of ``text``, without the end id; null counts as empty."""
    with_workers(df)

    @F.arrow_udf("bigint")
    def lengths(texts: pa.Array) -> pa.Array:
        encoder = worker_table("packing", Encoder, path)
        return pa.array([sum(map(len, encoder.encode(t.as_py()))) if t.as_py() else 0 for t in texts], pa.int64())

    return lengths(text)


def cut(n: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of ``n`` ids: powers of two, none above ``longest``, in falling order."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


_PIECES = [("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", longest: int = LONGEST,
           end_id: int = END_ID) -> DataFrame:
    """`id`, `start`, `length`, `doc_tokens` and `ids` of every piece; ids are packed, 32 bits each, low byte first.

    ``longest`` must be a power of two. ``path`` is a file of the tokenizers library that every worker reads.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"longest must be a power of two, got {longest}")
    with_workers(docs)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = worker_table("packing", Encoder, path), np.array([end_id], "<u4")
        for batch in batches:
            owner, found, held = [], [], 0
            texts = batch.column(1)
            for row in range(len(texts)):
                body = texts[row].as_py()
                ids = np.concatenate([*(encoder.encode(body) if body else ()), end])
                data, at = ids.tobytes(), 0
                for size in cut(len(ids), longest):
                    owner.append(row)
                    found.append((at, size, len(ids), data[4 * at : 4 * (at + size)]))
                    at += size
                held += len(data)
                if held >= FLUSH or row == len(texts) - 1:
                    columns = [pa.array(c, t) for c, (_, t) in zip(zip(*found), _PIECES)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(owner, pa.int64())), *columns], ["id", *(n for n, _ in _PIECES)]
                    )
                    owner, found, held = [], [], 0

    schema = f"id {kind}, start bigint, length bigint, doc_tokens bigint, ids binary"
    return docs.select(id_col, text).mapInArrow(run, schema)


def bucketed(sequences: DataFrame, length: str = "length") -> DataFrame:
    """Add `place`, a sequence's number within its bucket, and `sequence_id`, its number over all, both from 0."""
    turn, cell = spare_name(sequences, "turn"), spare_name(sequences, "cell")
    rows = written(sequences.withColumn(turn, F.monotonically_increasing_id()), "sequences")
    rows = rows.withColumn(cell, F.pmod(F.xxhash64(turn), F.lit(CELLS)).cast("int"))
    counts = rows.groupBy(length, cell).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per bucket and cell, however many sequences there are
    before = Window.orderBy(length, cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    offsets = offsets.withColumn("_bucket", F.min("_before").over(Window.partitionBy(length)))
    number = F.row_number().over(Window.partitionBy(length, cell).orderBy(turn)) - 1
    numbered = rows.withColumn("_number", number.cast("bigint")).join(
        F.broadcast(offsets.select(length, cell, "_before", "_bucket")), [length, cell]
    )
    return numbered.select(
        *sequences.columns, (F.col("_before") - F.col("_bucket") + F.col("_number")).alias("place"),
        (F.col("_before") + F.col("_number")).alias("sequence_id"),
    )
