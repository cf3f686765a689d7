"""Hard negatives by Four-Russians scoring: exact inner products from table lookups.

Components are integers. An anchor's dimensions are taken in groups of eight, and the sums of all 256 subsets of a
group are tabled. A candidate is packed as bit planes: of each bit of its components (two's complement, the top
one counts negative) one byte per group. A plane's contribution to a score is then one lookup per group, and the
planes are added up by shifting, highest first. Tables of a block of anchors stand side by side, so one byte of a
candidate fetches the entries of the whole block.

The anchors are a stated query set against all rows. They are taken in passes of about PASS_ANCHORS, which is
what is collected and sent to every task; candidates are read where they lie and never shuffled. In each pass the
tasks first find the best rows of the anchor's own label, then, with the positives' scores known, for each
positive the best rows of other labels within its band. A task holds at most ``n_positives`` (times
``n_negatives``) rows per anchor and puts out only those; the last selection is a grouped limit.

Rows with a null label, a null vector or a null, infinite or NaN component take no part. Rows with the anchor's own
id are not "other rows" of it. Anchors equal in id, label and vector are answered once; rows that are candidates
count as often as they occur. A null id is no anchor and comes last among equal scores. Of vectors of different
lengths the shorter counts as filled up with zeros. A component beyond 25 bits raises: scores would not fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.shared import with_workers, written

SCALE = 256
GROUP = 8
#: Anchors of one pass, about: with 64 dimensions 16 MB go to every task.
PASS_ANCHORS = 30_000
#: Anchors whose tables stand side by side, and candidates scored at once.
ANCHOR_BLOCK, BLOCK = 128, 4096
#: Components lie in -2^LARGEST to 2^LARGEST - 1: inner products of 4,096 of them fit 62 bits.
LARGEST = 25

NO_ID = np.iinfo(np.int64).max


def tables(anchors: np.ndarray) -> np.ndarray:
    """Subset sums by group, byte and anchor; bit ``i`` of the byte stands for dimension ``i`` of the group."""
    groups = anchors.reshape(len(anchors), -1, GROUP)
    out = np.zeros((groups.shape[1], 1 << GROUP, len(anchors)), anchors.dtype)
    for i in range(GROUP):
        out[:, 1 << i : 2 << i] = out[:, : 1 << i] + groups[:, :, i].T[:, None, :]
    return out


def planes(vectors: np.ndarray) -> np.ndarray:
    """Bytes by plane (lowest first), group and row; the last plane is the sign's."""
    least, most = (int(vectors.min()), int(vectors.max())) if vectors.size else (0, 0)
    bits = 1 + max(most.bit_length(), (-least - 1).bit_length() if least < 0 else 0)
    packed = [np.packbits((vectors >> b & 1).astype(np.uint8), axis=1, bitorder="little").T for b in range(bits)]
    return np.stack(packed)


def scores(tabled: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Exact inner products of rows and anchors."""
    bits, groups, rows = packed.shape
    total = np.zeros((rows, tabled.shape[2]), tabled.dtype)
    for b in range(bits - 1, -1, -1):
        total += total
        for g in range(groups):
            part = tabled[g][packed[b, g]]
            if b == bits - 1:
                total -= part
            else:
                total += part
    return total


@dataclass(frozen=True)
class Anchors:
    """The anchors of one pass; ``low`` and ``high`` are score bounds by anchor and positive."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Best:
    """The best ``k`` rows of every slot: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k, self.n = k, slots
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(slots, np.iinfo(np.int64).min)  # the score to reach

    def offer(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ident = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ident)))
        order = np.lexsort((ident, -score, slot))
        slot, score, ident = slot[order], score[order], ident[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        full = place == self.k - 1
        self.least[slot[full]] = score[full]
        kept = place < self.k
        self.slot, self.score, self.id = slot[kept], score[kept], ident[kept]


def _dtype(width: int, a: np.ndarray, b: np.ndarray) -> type:
    """The narrowest type that holds all partial sums."""
    most = max(1, width) * (int(np.abs(a).max(initial=0)) + 1) * (2 * int(np.abs(b).max(initial=0)) + 2)
    return np.int32 if most < 1 << 31 else np.int64


def search(anchors: Anchors, k: int, batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple]:
    """Best rows for each anchor (own label), or for each anchor and band (other labels), of all batches."""
    bands = 1 if anchors.low is None else anchors.low.shape[1]
    blocks = range(0, len(anchors.ids), ANCHOR_BLOCK)
    best = [Best(len(anchors.ids[a : a + ANCHOR_BLOCK]) * bands, k) for a in blocks]
    for ids, labels, vectors in batches:
        width = max(vectors.shape[1], anchors.vectors.shape[1], 1)
        width += -width % GROUP
        vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
        packed = planes(vectors)
        for own, a in zip(best, blocks):
            part = slice(a, a + ANCHOR_BLOCK)
            block = anchors.vectors[part]
            kind = _dtype(width, block, vectors)
            tabled = tables(np.pad(block, ((0, 0), (0, width - block.shape[1]))).astype(kind))

            def bound(values: np.ndarray) -> np.ndarray:
                return np.clip(values, np.iinfo(kind).min, np.iinfo(kind).max).astype(kind)

            if anchors.low is None:
                near = np.flatnonzero(np.isin(labels, anchors.labels[part]))
                found = scores(tabled, packed[:, :, near])  # rows by anchors
                wanted = (labels[near, None] == anchors.labels[part]) & (ids[near, None] != anchors.ids[part])
                row, column = np.nonzero(wanted & (found >= bound(own.least)))
                own.offer(column, found[row, column].astype(np.int64), ids[near[row]])
                continue
            found = scores(tabled, packed)
            other = labels[:, None] != anchors.labels[part]
            least = own.least.reshape(-1, bands)
            rows, slots = [], []
            for band in range(bands):
                floor = np.maximum(anchors.low[part, band], least[:, band])
                inside = (found >= bound(floor)) & (found <= bound(anchors.high[part, band]))
                row, column = np.nonzero(inside & other)
                rows.append(row)
                slots.append(column * bands + band)
            row, slot = np.concatenate(rows), np.concatenate(slots)
            own.offer(slot, found[row, slot // bands].astype(np.int64), ids[row])
    for own, a in zip(best, blocks):
        if len(own.slot):
            yield a + own.slot // bands, own.slot % bands, own.score, own.id


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of integers as rows, filled up with zeros."""
    sizes = np.asarray(column.value_lengths(), np.int64)
    values = np.asarray(column.flatten(), np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


_FOUND = "anchor int, band int, score bigint, id bigint"


def _found(rows: DataFrame, anchors: Anchors, k: int) -> DataFrame:
    """Each task's best rows; ``rows`` has id, label and vector."""
    sent = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for batch in batches:
                for at in range(0, len(batch), BLOCK):
                    part = batch.slice(at, BLOCK)
                    yield np.asarray(part.column(0)), np.asarray(part.column(1)), _matrix(part.column(2))

        for anchor, band, score, ident in search(sent.value, k, read()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor, pa.int32()), pa.array(band, pa.int32()), pa.array(score), pa.array(ident)],
                ["anchor", "band", "score", "id"],
            )

    found = rows.select("id", "label", "vector").mapInArrow(run, _FOUND)
    order = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(table: DataFrame, id_col: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """`id`, `label` and `vector` (integers) of the rows that take part."""
    x = F.col(vector)
    fine = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)) & ~F.isnan(v))
    rows = table.where(F.col(label).isNotNull() & x.isNotNull()).where(F.coalesce(fine, F.lit(False)))
    limit = float(1 << LARGEST)

    def whole(v: Column) -> Column:
        scaled = v.cast("double") * SCALE
        beyond = (scaled < -limit) | (scaled >= limit)
        refused = F.raise_error(F.lit("a component is too large for exact scores"))
        return F.when(beyond, refused.cast("int")).otherwise(F.floor(scaled).cast("int"))

    return rows.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(NO_ID))).alias("id"), F.col(label).cast("bigint").alias("label"),
        F.transform(x, whole).alias("vector"),
    )


def mine(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10,
         band: tuple[int, int] = (30, 90), pass_anchors: int = PASS_ANCHORS) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id` and both scores.

    ``rows`` as from :func:`usable`. Negatives lie between ``band`` percent of the positive's score.
    """
    with_workers(rows)
    rows = written(rows, "vectors")
    anchors = rows.where(is_anchor & (F.col("id") != int(NO_ID))).distinct()
    anchors = written(anchors, "anchors")
    passes = max(1, -(-anchors.count() // pass_anchors))
    results = []
    for number in range(passes):
        chosen = anchors.where(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(passes)) == number)
        columns = chosen.orderBy("label", "id").toArrow().combine_chunks()  # blocks of few labels
        if not len(columns):
            continue
        ids, labels = (np.asarray(columns[c]).astype(np.int64) for c in ("id", "label"))
        vectors = _matrix(columns["vector"].chunk(0))
        first = _found(rows, Anchors(ids, labels, vectors), n_positives)
        first = written(first.select("anchor", F.col("rank").alias("place"), "score", "id"), "positives")
        best = first.toArrow()  # n_positives rows an anchor at most
        at = np.asarray(best["anchor"]), np.asarray(best["place"]) - 1
        score = np.asarray(best["score"]).astype(np.int64)
        low, high = np.ones((len(ids), n_positives), np.int64), np.zeros((len(ids), n_positives), np.int64)
        low[at], high[at] = -(-band[0] * score // 100), band[1] * score // 100  # an empty band where none is known
        second = _found(rows, Anchors(ids, labels, vectors, low, high), n_negatives)
        names = rows.sparkSession.createDataFrame(pa.table({"anchor": np.arange(len(ids), dtype=np.int32), "anchor_id": ids}))
        positives = first.select("anchor", (F.col("place") - 1).alias("band"), F.col("score").alias("positive_score"),
                                 F.col("id").alias("positive_id"))
        found = second.join(positives, ["anchor", "band"]).join(F.broadcast(names), "anchor")
        results.append(written(found.select(
            "anchor_id", _named("positive_id"), "rank", _named("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        ), f"negatives{number}"))
    if not results:
        schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return rows.sparkSession.createDataFrame([], schema)
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _named(column: str) -> Column:
    """The id, null where the row has none."""
    return F.when(F.col(column) != int(NO_ID), F.col(column)).alias(column)
