"""Length-grouped batches and their padded arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pairloom.config import IGNORED_LABEL, MAX_INPUT, MAX_TARGET, PAD_MULTIPLE
from pairloom.functions.arrays import attention_mask, pad_right, round_up
from pairloom.functions.text import prefixed
from pairloom.operators.ranking import zoned_rank
from pairloom.operators.tokenizers import ByteTokenizer, cut_ids, worker_object
from pairloom.session import ready_workers


def length_batches(
    df: DataFrame, key: str, batch: int = 2, mega: int = 50, seed: int = 42, length: str = "length"
) -> DataFrame:
    """Add ``zone, mega_id, batch_id, pos``: batches of rows of similar length, in random company.

    The rows, in seeded random order, are cut into groups of ``batch * mega``; each group is sorted
    by length, longest first, and cut into batches; only the last batch may be short. ``key`` must
    be unique.

    The rows are shuffled once. Windows and batches are formed inside zones of the random order,
    which are equal in size, so no length or source can overload a task.
    """
    group = batch * mega
    ranked = zoned_rank(df, key, seed, "_rank", unit=group)
    order = Window.partitionBy("zone", "mega_id").orderBy(F.desc(length), key)
    return (
        ranked.withColumn("mega_id", F.expr(f"(_rank - 1) div {group}"))
        .withColumn("_place", F.row_number().over(order) - 1)
        .withColumn("batch_id", F.col("mega_id") * mega + F.expr(f"_place div {batch}"))
        .withColumn("pos", F.col("_place") % batch)
        .drop("_rank", "_place")
    )


# grouping by all of these reuses the partitioning the batches were formed in
BATCH_KEYS = ("zone", "mega_id", "batch_id")


def sequence_lengths(tokenised: DataFrame, key: str) -> DataFrame:
    """``key, length, label_length``: form batches of these where only a report is wanted."""
    return tokenised.select(
        key, F.array_size("input_ids").alias("length"), F.array_size("labels").alias("label_length")
    )


def _lengths(batched: DataFrame) -> tuple[Column, Column]:
    if "input_ids" in batched.columns:
        return F.array_size("input_ids"), F.array_size("labels")
    return F.col("length"), F.col("label_length")


def _widths(batched: DataFrame, multiple: int, over: WindowSpec | None = None) -> dict[str, Column]:
    """The padded widths, as aggregates of a group or over a window."""
    widths = {}
    for name, length in zip(("input_width", "label_width"), _lengths(batched)):
        longest = F.max(length)
        widths[name] = round_up(longest if over is None else longest.over(over), multiple)
    return widths


def batch_widths(batched: DataFrame, multiple: int = PAD_MULTIPLE) -> DataFrame:
    """Rows per batch and the padded width of its inputs and labels, from arrays or lengths."""
    widths = _widths(batched, multiple)
    return (
        batched.groupBy(*BATCH_KEYS)
        .agg(F.count("*").cast("int").alias("n_rows"), *[w.alias(n) for n, w in widths.items()])
        .select("batch_id", "n_rows", *widths)
    )


def _padded(
    input_ids: Column, labels: Column, batch_id: Column, pad_id: int, label_pad: int
) -> dict[str, Column]:
    """The padded arrays of one row; an empty or missing sequence is an error."""
    input_width, label_width = F.col("input_width"), F.col("label_width")
    empty = (F.coalesce(F.array_size(input_ids), F.lit(0)) == 0) | (
        F.coalesce(F.array_size(labels), F.lit(0)) == 0
    )
    failure = F.raise_error(F.concat(F.lit("empty sequence in batch "), batch_id.cast("string")))

    def checked(padded: Column) -> Column:
        return F.when(empty, failure.cast("array<bigint>")).otherwise(padded)

    return {
        "input_ids": checked(pad_right(input_ids, input_width, pad_id)),
        "attention_mask": checked(attention_mask(input_ids, input_width)),
        "labels": checked(pad_right(labels, label_width, label_pad)),
    }


def pad_rows(
    batched: DataFrame,
    pad_id: int = 0,
    label_pad: int = IGNORED_LABEL,
    multiple: int = PAD_MULTIPLE,
) -> DataFrame:
    """Each row padded to the widths of its batch, with ``attention_mask``."""
    sized = batched.withColumns(_widths(batched, multiple, Window.partitionBy(*BATCH_KEYS)))
    ids, labels = F.col("input_ids"), F.col("labels")
    return sized.withColumns(_padded(ids, labels, F.col("batch_id"), pad_id, label_pad))


def collate(
    batched: DataFrame,
    pad_id: int = 0,
    label_pad: int = IGNORED_LABEL,
    multiple: int = PAD_MULTIPLE,
) -> DataFrame:
    """One row per batch with three rectangular arrays, rows in the order of ``pos``.

    The rows of a zone arrive in order, as the batches were formed there; each batch is padded and put out
    as soon as its last row is read, so a task holds one batch.
    """
    ready_workers(batched.sparkSession)
    rows = batched.select(*BATCH_KEYS, "pos", "input_ids", "labels")
    return _assembled(rows, _stored_ids, pad_id, label_pad, multiple)


def collate_texts(
    batched: DataFrame,
    tokenizer=ByteTokenizer(),
    max_input: int | None = MAX_INPUT,
    max_target: int | None = MAX_TARGET,
    label_pad: int = IGNORED_LABEL,
    multiple: int = PAD_MULTIPLE,
) -> DataFrame:
    """:func:`collate` from texts: ``lang, raw, clean`` are tokenised when their batch is put together.

    So the shuffle carries texts and lengths, a quarter of the size of ids or less.
    """
    ready_workers(batched.sparkSession)
    rows = batched.select(*BATCH_KEYS, "pos", prefixed(F.col("lang"), F.col("raw")), "clean")
    read = partial(_tokenised, tokenizer.worker(), tokenizer.eos_id, max_input, max_target)
    return _assembled(rows, read, tokenizer.pad_id, label_pad, multiple)


def _stored_ids(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    def rows(column: pa.Array) -> list[np.ndarray]:
        values = np.asarray(column.flatten(), np.int64)
        ends = np.cumsum(np.asarray(column.value_lengths().fill_null(0), np.int64))
        return np.split(values, ends[:-1])

    return zip(rows(batch.column(4)), rows(batch.column(5)))


def _tokenised(
    factory: bytes, eos_id: int, max_input: int | None, max_target: int | None, batch: pa.RecordBatch
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    library, sides = worker_object(factory), []
    for column, budget in ((4, max_input), (5, max_target)):
        texts = batch.column(column).to_pylist()
        found = iter(library.encode_batch([t for t in texts if t is not None]))
        # a missing text is a missing sequence
        sides.append([np.zeros(0, np.int64) if t is None else cut_ids(next(found), eos_id, budget) for t in texts])
    return zip(*sides)


def _assembled(rows: DataFrame, read: Callable, pad_id: int, label_pad: int, multiple: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pairloom.operators.batches import assemble

        return assemble(batches, read, pad_id, label_pad, multiple)

    # the rows already lie by zone, in order: grouping by it moves and sorts nothing
    return rows.groupBy("zone").applyInArrow(run, _BATCH_DDL)


#: Cells of padded ids in one Arrow batch, about; one training batch may go beyond it.
FLUSH_CELLS = 1 << 19
_BATCH_DDL = (
    "batch_id bigint, input_ids array<array<bigint>>, attention_mask array<array<bigint>>, labels array<array<bigint>>"
)


def assemble(
    batches: Iterator[pa.RecordBatch], read: Callable, pad_id: int, label_pad: int, multiple: int
) -> Iterator[pa.RecordBatch]:
    """Padded batches from the rows of a zone, which must come in the order of ``mega_id, batch_id, pos``."""
    done: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
    inputs: list[np.ndarray] = []
    labels: list[np.ndarray] = []
    cells, before = 0, None
    for batch in batches:
        places = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))
        for place, (ids, label) in zip(places, read(batch)):
            if before is not None and place <= before:
                raise RuntimeError(f"rows out of order: {place} after {before}")
            if before is not None and place[:2] != before[:2]:
                done.append(_rectangles(before[1], inputs, labels, pad_id, label_pad, multiple))
                cells += done[-1][1].size + done[-1][3].size
                inputs, labels = [], []
                if cells >= FLUSH_CELLS:
                    yield _record(done)
                    done, cells = [], 0
            if not len(ids) or not len(label):
                raise ValueError(f"empty sequence in batch {place[1]}")
            inputs.append(ids)
            labels.append(label)
            before = place
    if inputs:
        done.append(_rectangles(before[1], inputs, labels, pad_id, label_pad, multiple))
    if done:
        yield _record(done)


def _rectangles(
    batch_id: int, inputs: list[np.ndarray], labels: list[np.ndarray], pad_id: int, label_pad: int, multiple: int
) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    def filled(rows: list[np.ndarray], value: int) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(r) for r in rows])
        width = -(-int(sizes.max()) // multiple) * multiple
        real = np.arange(width) < sizes[:, None]
        out = np.full((len(rows), width), value, np.int64)
        out[real] = np.concatenate(rows)
        return out, real

    ids, real = filled(inputs, pad_id)
    return batch_id, ids, real.astype(np.int64), filled(labels, label_pad)[0]


def _record(done: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    def nested(matrices: list[np.ndarray]) -> pa.Array:
        widths = np.repeat([m.shape[1] for m in matrices], [m.shape[0] for m in matrices])
        cells = pa.array(np.concatenate([m.ravel() for m in matrices]))
        rows = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(widths))), pa.int32()), cells)
        borders = np.concatenate(([0], np.cumsum([m.shape[0] for m in matrices])))
        return pa.ListArray.from_arrays(pa.array(borders, pa.int32()), rows)

    ids, *arrays = zip(*done)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), *(nested(list(a)) for a in arrays)],
        ["batch_id", "input_ids", "attention_mask", "labels"],
    )


def padding_report(batched: DataFrame, multiple: int = PAD_MULTIPLE) -> DataFrame:
    """Real and padded cells per batch, for inputs and labels, from arrays or lengths."""
    n_input, n_label = _lengths(batched)
    widths = _widths(batched, multiple)
    sums = batched.groupBy(*BATCH_KEYS).agg(
        F.count("*").alias("n_rows"),
        F.sum(n_input).alias("input_cells"),
        F.sum(n_label).alias("label_cells"),
        *[w.alias(n) for n, w in widths.items()],
    )
    return sums.select(
        "batch_id",
        "n_rows",
        "input_cells",
        (F.col("n_rows") * F.col("input_width") - F.col("input_cells")).alias("input_padding"),
        "label_cells",
        (F.col("n_rows") * F.col("label_width") - F.col("label_cells")).alias("label_padding"),
    )


def padding_total(report: DataFrame) -> DataFrame:
    """The report over all batches, with the largest batch in cells."""
    cells = F.col("input_cells") + F.col("input_padding") + F.col("label_cells") + F.col("label_padding")
    padding = F.sum(F.col("input_padding") + F.col("label_padding"))
    return report.agg(
        F.count("*").alias("n_batches"),
        F.sum("n_rows").alias("n_rows"),
        F.sum(cells).alias("cells"),
        padding.alias("padding"),
        F.max(cells).alias("largest_batch"),
    )
