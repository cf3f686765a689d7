"""How filters interact: what each removes in every order, from one count per combination of failures.

A row's failures are a mask, and every figure of every order is a sum over masks, so the table is read once for
the masks and 120 orders cost no more than one. The last filter (E) asks whether a smaller id has the same text.
For it, a prepass with counting Bloom sketches clears the texts that are certainly unique:

1. Each task hashes its texts to HASHES counters of a sketch that has WIDTH counters a row (one power of two for
   the whole table) and sends the counters it touched, cut into ranges. Ranges are merged, each on its own, into
   a bit per counter: touched twice or more. A text with a counter touched once is unique.
2. Only possible repeats go on: their full texts are grouped, with the least id of each (pre-aggregated, so a text
   that a third of all rows share crosses once per task), and rows find that id by the text's SHA-256 and their
   own id, which no group makes hot.
3. Flags, labels and ids meet in one row per document without texts, and are counted by mask.

Merged bits are broadcast. They are bounded: a sketch has MOST_COUNTERS counters at most (32 MB of bits). Beyond
about 17 million rows it gets no wider; then it clears fewer texts, more cross, and the result stays exact.

Null texts are empty ones. A null id is neither smaller nor larger than any, so its row never fails E and makes
no other row fail. Rows with equal id and text do not fail for each other. Several labels of one id count as
their greatest values; null labels and ids without a label as none. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import with_workers, written

FILTERS = "ABCDE"
HASHES = 3
WIDTH = 16
#: Counters of a sketch at least and at most: the merged bits are MOST_COUNTERS / 8 bytes at most.
LEAST_COUNTERS, MOST_COUNTERS = 1 << 16, 1 << 28
#: Counters of one range, which one task merges (one byte each there), and of one row of the broadcast.
RANGE, SLICE = 1 << 22, 1 << 16
#: Rows whose counters are merged at once.
MERGED_ROWS = 1 << 18
#: Bytes of a text whose words are split at once, where it can be cut.
PART = 1 << 22

_UPPER = bytes(range(65, 91))
_MARKS = b"#$%&*|"
_SPACES = b"\t\n\x0b\x0c\r "


def word_counts(data: bytes) -> tuple[int, int]:
    """Words and distinct words, parted by ASCII white space."""
    if len(data) <= PART:
        words = data.split()
        return len(words), len(set(words))
    n, seen, at = 0, set(), 0
    while at < len(data):
        end = at + PART
        while end < len(data) and data[end] not in _SPACES:
            end += 1
        words = data[at:end].split()
        n += len(words)
        seen.update(words)
        at = end
    return n, len(seen)


def row_mask(text: str | None) -> int:
    """Bits 0 to 3: fails A, B, C, D."""
    data = (text or "").encode()
    n, distinct = word_counts(data)
    points = len(text or "")
    upper = len(data) - len(data.translate(None, _UPPER))
    marked = len(data) != len(data.translate(None, _MARKS))
    return (n < 100) | (100 * distinct < 80 * n) << 1 | (100 * upper > 10 * points) << 2 | marked << 3


def counters_for(rows: int) -> int:
    """The sketch's width: a power of two, WIDTH a row or more as long as that is within bounds."""
    wanted = max(LEAST_COUNTERS, rows * WIDTH)
    return min(MOST_COUNTERS, 1 << (wanted - 1).bit_length())


_SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)


def counters_of(digest: Column, width: int) -> list[Column]:
    """The counters of a text, by its digest."""
    return [F.xxhash64(digest, F.lit(i)).bitwiseAND(F.lit(width - 1)) for i in range(HASHES)]


def touched(counters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counters that rows of HASHES counters touch, in order, and how often; 2 stands for more, too."""
    # a text counts once in each of its counters, even where two of its hashes meet
    at = np.sort(counters, 1)
    first = np.concatenate((np.ones((len(at), 1), bool), at[:, 1:] != at[:, :-1]), 1)
    where, counts = np.unique(at[first], return_counts=True)
    return where, np.minimum(counts, 2).astype(np.uint8)


def added(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sketches as one."""
    where, back = np.unique(np.concatenate((a[0], b[0])), return_inverse=True)
    counts = np.bincount(back, np.concatenate((a[1], b[1])), len(where))
    return where, np.minimum(counts, 2).astype(np.uint8)


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _masked(docs: DataFrame, id_col: str, text: str, lang: str, width: int) -> DataFrame:
    """`id`, `part`, `digest` and `mask` of every row; on other rows (null mask) the sketch of a task, by range."""
    with_workers(docs)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "part", "digest", "mask", "range", "where", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64), np.zeros(0, np.uint8)
        waiting: list[np.ndarray] = []
        id_type = None
        for batch in batches:
            id_type, n = batch.column(0).type, len(batch)
            waiting.append(np.stack([np.asarray(batch.column(4 + i)) for i in range(HASHES)], 1))
            if sum(map(len, waiting)) >= MERGED_ROWS:
                total, waiting = added(total, touched(np.concatenate(waiting))), []
            masks = pa.array([row_mask(t.as_py()) for t in batch.column(3)], pa.int32())
            none = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], masks, *none], names)
        if waiting:
            total = added(total, touched(np.concatenate(waiting)))
        where, counts = total
        edges = np.flatnonzero(np.diff(where // RANGE, prepend=-1, append=-1)) if len(where) else []
        for a, b in zip(edges[:-1], edges[1:]):
            number = int(where[a] // RANGE)
            none = [pa.nulls(1, id_type), pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32())]
            data = (where[a:b] - number * RANGE).astype("<u4").tobytes(), counts[a:b].tobytes()
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array([number], pa.int32()), *(pa.array([d], pa.binary()) for d in data)], names
            )

    rows = docs.select(id_col, F.coalesce(F.col(lang), F.lit("")), _digest(text).alias("digest"), text)
    rows = rows.select("*", *counters_of(F.col("digest"), width))
    return rows.mapInArrow(
        run, f"id {kind}, part string, digest binary, mask int, range int, `where` binary, counts binary"
    )


def crowded(sketches: DataFrame, width: int) -> DataFrame:
    """The merged sketch: of every slice 64 counters a word, a bit set where the count is 2."""

    def run(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(min(width, RANGE), np.uint8)
        for part in parts:
            for where, counts in zip(part["where"], part["counts"]):
                at = np.frombuffer(where, "<u4")
                total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), 2)
        words = np.packbits(total == 2, bitorder="little").view("<i8").reshape(-1, SLICE // 64)
        yield pd.DataFrame({"slice": int(key[0]) * (RANGE // SLICE) + np.arange(len(words)), "words": list(words)})

    return sketches.groupBy("range").applyInPandas(run, "slice bigint, words array<bigint>")


def possible_repeats(rows: DataFrame, digest: str, bits: DataFrame, width: int) -> DataFrame:
    """The rows of whose counters every one was touched twice or more: all repeats, and few others.

    ``bits`` are MOST_COUNTERS bits at most.
    """
    for i, counter in enumerate(counters_of(F.col(digest), width)):
        at, own, words = f"_at{i}", f"_slice{i}", f"_words{i}"
        table = F.broadcast(bits.select(F.col("slice").alias(own), F.col("words").alias(words)))
        inside = F.col(at).bitwiseAND(F.lit(SLICE - 1))
        word = F.element_at(words, (F.shiftright(inside, 6) + 1).cast("int"))
        is_set = F.getbit(word, F.col(at).bitwiseAND(F.lit(63)).cast("int")) == 1
        joined = rows.withColumn(at, counter).join(table, F.shiftright(at, SLICE.bit_length() - 1) == F.col(own))
        rows = joined.where(is_set).drop(at, own, words)
    return rows


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
             quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """`part`, `mask` (bits A to E) and the `n`, `good` and `toxic` documents of it."""
    width = counters_for(docs.count())
    masked = written(_masked(docs, id_col, text, lang, width), "masked")
    rows = masked.where(F.col("mask").isNotNull()).select("id", "part", "digest", "mask")
    bits = written(crowded(masked.where(F.col("mask").isNull()).select("range", "where", "counts"), width), "bits")

    texts = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), _digest(text).alias("digest")
    )
    least = possible_repeats(texts, "digest", bits, width).groupBy("text").agg(F.min("id").alias("id"))
    least = written(least.select(_digest("text").alias("digest"), "id", F.lit(True).alias("first")), "least")

    # what the sketches let through, once per id, text and mask
    named = rows.where(F.col("id").isNotNull())
    maybe = possible_repeats(named, "digest", bits, width).groupBy("digest", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    again = maybe.join(least, ["digest", "id"], "left").where(F.col("first").isNull()).select("id", "part", "mask", "n")
    # as masks add up, a failure of E moves rows from one mask to another
    moved = again.select("id", "part", F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), (-F.col("n")).alias("n")),
        F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), F.col("n").alias("n")),
    )))
    flags = rows.groupBy("id", "part", "mask").agg(F.count(F.lit(1)).alias("n")).unionByName(moved)
    flags = flags.groupBy("id", "part", "mask").agg(F.sum("n").alias("n")).where("n > 0")
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.coalesce(F.max(quality) == 1, F.lit(False)).cast("int").alias("good"),
        F.coalesce(F.max(toxic) == 1, F.lit(False)).cast("int").alias("toxic"),
    )
    return flags.join(known, "id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.col("n") * F.col("good")), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.col("n") * F.col("toxic")), F.lit(0)).alias("toxic"),
    )


def interactions(counts: DataFrame) -> DataFrame:
    """What each filter does in every order, per part; ``counts`` as from :func:`failures`, 32 rows a part at most."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    own, before = [], []
    for order in orders:
        bits = [1 << FILTERS.index(f) for f in order]
        own += bits
        before += [sum(bits[:i]) for i in range(len(bits))]
    steps = len(FILTERS)
    masks = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    rows = masks.select("part", "masks", F.explode(F.sequence(F.lit(0), F.lit(len(own) - 1))).alias("k")).select(
        "part", "masks", F.element_at(F.lit(orders), F.expr(f"k div {steps} + 1").cast("int")).alias("filter_order"),
        (F.col("k") % steps + 1).alias("step"), F.element_at(F.lit(own), F.col("k") + 1).alias("own"),
        F.element_at(F.lit(before), F.col("k") + 1).alias("before"),
    )

    def total(value, wanted) -> Column:
        zero = F.lit(0).cast("bigint")
        return F.aggregate(F.filter("masks", wanted), zero, lambda s, m: s + value(m).cast("bigint"))

    def fails(m: Column) -> Column:
        return m["mask"].bitwiseAND(F.col("own")) > 0

    def earlier(m: Column) -> Column:
        return m["mask"].bitwiseAND(F.col("before")) > 0

    # among the orders of a mask's filters each comes first equally often
    share = [len(orders) // size for size in range(1, steps + 1)]
    return rows.select(
        "part", "filter_order", "step",
        total(lambda m: m["n"], lambda m: ~fails(m) & ~earlier(m)).alias("kept"),
        total(lambda m: m["n"], lambda m: fails(m) & ~earlier(m)).alias("removed"),
        total(lambda m: m["n"], lambda m: fails(m) & earlier(m)).alias("redundant"),
        total(lambda m: m["n"], lambda m: m["mask"] == F.col("own")).alias("unique_fails"),
        total(lambda m: m["good"], lambda m: fails(m) & ~earlier(m)).alias("good_lost"),
        total(lambda m: m["toxic"], lambda m: fails(m) & ~earlier(m)).alias("toxic_lost"),
        total(lambda m: m["n"] * F.element_at(F.lit(share), F.bit_count(m["mask"])), fails).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part (language; null as empty text), order of the five filters and step."""
    return interactions(failures(docs, labels, **columns))
