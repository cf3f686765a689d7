"""Checks on the files of sharded datasets: names, gaps, schemas, row counts.

The inputs are small tables about files, not their contents: a listing ``dataset, path, name,
top_level`` and footers ``dataset, path, name, n_rows, cols, error``. All checks group by
``dataset``, so one job covers any number of datasets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.config import FULL_CORPUS_ROWS, PAIR_COLUMNS, TOKEN_COLUMNS

# The names of shards, the glob they are found by, and of interrupted writes.
SHARD_NAME = r"^train-([0-9]+)-of-([0-9]+)\.parquet$"
SHARD_GLOB = r"^train-.*\.parquet$"
TMP_GLOB = r"^tmp-.*\.parquet$"
#: Indexes that a step of listing a run makes of one row, as a power of two.
BLOCK_BITS = 16


def train_files(listing: DataFrame) -> DataFrame:
    return listing.filter(F.col("name").rlike(SHARD_GLOB))


def shard_names(listing: DataFrame) -> DataFrame:
    """The ``train-*`` files with ``valid`` and, from the name, ``idx`` and ``of_m``."""

    def part(group: int) -> Column:
        return F.regexp_extract("name", SHARD_NAME, group).try_cast("bigint")

    # a number too long for 64 bits makes the name invalid
    named = train_files(listing).withColumns({"idx": part(1), "of_m": part(2)})
    return named.withColumn("valid", F.col("idx").isNotNull() & F.col("of_m").isNotNull())


def shard_gaps(names: DataFrame) -> DataFrame:
    """``dataset, first, last, n``: runs of indexes missing between 0 and the largest one present.

    Every index present is compared with the one before it, so the cost is that of the listing, however large
    the numbers in the names are.
    """
    present = names.filter("valid").select("dataset", "idx").distinct()
    before = F.lag("idx", 1, -1).over(Window.partitionBy("dataset").orderBy("idx"))
    runs = present.withColumn("first", before + 1).withColumn("last", F.col("idx") - 1)
    return runs.filter("first <= last").select("dataset", "first", "last", (F.col("idx") - F.col("first")).alias("n"))


def missing_indexes(gaps: DataFrame) -> DataFrame:
    """``dataset, idx``: every index of the runs of :func:`shard_gaps`, one row each.

    A run is cut into ever smaller blocks, none of which makes more than 65,536 of the next size; the last ones are
    dealt over the tasks before their indexes are listed, so a long run is not the work of one task.
    """
    runs = gaps.select("dataset", "first", "last")
    for bits in (3 * BLOCK_BITS, 2 * BLOCK_BITS, BLOCK_BITS):
        block = F.explode(F.sequence(F.shiftright("first", bits), F.shiftright("last", bits))).alias("_block")
        runs = runs.select("dataset", "first", "last", block).select(
            "dataset",
            F.greatest("first", F.shiftleft("_block", bits)).alias("first"),
            F.least("last", F.shiftleft("_block", bits) + ((1 << bits) - 1)).alias("last"),
        )
    dealt = runs.repartition("dataset", "first")
    return dealt.select("dataset", F.explode(F.sequence("first", "last")).alias("idx"))


def shard_duplicates(names: DataFrame) -> DataFrame:
    """Indexes that more than one file carries."""
    counts = names.filter("valid").groupBy("dataset", "idx").agg(F.count("*").alias("n_files"))
    return counts.filter("n_files > 1")


def shard_totals(names: DataFrame) -> DataFrame:
    """Per total named by the files: how many name it, how many files there are, and ``mismatch``."""
    counts = names.filter("valid").groupBy("dataset", "of_m").agg(F.count("*").alias("n_naming"))
    files = counts.groupBy("dataset").agg(F.sum("n_naming").alias("n_files"))
    return counts.join(files, "dataset").withColumn("mismatch", F.col("of_m") != F.col("n_files"))


def tmp_shards(listing: DataFrame) -> DataFrame:
    """Files an interrupted write left behind."""
    return listing.filter(F.col("name").rlike(TMP_GLOB))


def stray_files(listing: DataFrame, show: int = 5) -> DataFrame:
    """For datasets without any ``train-*`` file: up to ``show`` other file names, and their number."""
    top = listing.filter("top_level")
    with_train = train_files(listing).select("dataset").distinct()
    strays = top.join(with_train, "dataset", "left_anti").select("dataset", "name")
    counts = strays.groupBy("dataset").agg(F.count("*").alias("n_files"))
    # the limit on row_number is applied before the shuffle too
    first = strays.withColumn("_n", F.row_number().over(Window.partitionBy("dataset").orderBy("name")))
    return first.filter(F.col("_n") <= show).drop("_n").join(counts, "dataset")


def classify_schema(footers: DataFrame) -> DataFrame:
    """Add ``kind``: ``tok``, ``raw`` or ``unknown``; null for a file that could not be opened."""

    def has(columns: Sequence[str]) -> Column:
        return F.size(F.array_except(F.array(*[F.lit(c) for c in columns]), F.col("cols"))) == 0

    kind = F.when(has(TOKEN_COLUMNS), "tok").when(has(PAIR_COLUMNS), "raw").otherwise("unknown")
    return footers.withColumn("kind", F.when(F.col("error").isNull(), kind))


def corrupt_shards(footers: DataFrame) -> DataFrame:
    return footers.filter(F.col("error").isNotNull()).select("dataset", "path", "name", "error")


def unknown_schema(classified: DataFrame) -> DataFrame:
    return classified.filter("kind = 'unknown'").select("dataset", "path", "name", "cols")


def mixed_schema(classified: DataFrame) -> DataFrame:
    """Per dataset: how many files are of each known kind, and whether both occur."""
    counts = classified.filter("kind in ('tok', 'raw')").groupBy("dataset").agg(
        F.count_if(F.col("kind") == "tok").alias("n_tok"), F.count_if(F.col("kind") == "raw").alias("n_raw")
    )
    return counts.withColumn("mixed", (F.col("n_tok") > 0) & (F.col("n_raw") > 0))


def shard_row_stats(footers: DataFrame) -> DataFrame:
    """Files and total, least and most rows per file."""
    return footers.filter(F.col("error").isNull()).groupBy("dataset").agg(
        F.count("*").alias("n_files"),
        F.sum("n_rows").alias("total_rows"),
        F.min("n_rows").alias("min_rows"),
        F.max("n_rows").alias("max_rows"),
    )


def expected_rows(classified: DataFrame, expected: int | None = FULL_CORPUS_ROWS) -> DataFrame:
    """Per dataset of one known kind: total rows against ``expected``, and ``severity``.

    Too few or many rows are a warning for raw pairs; for tokenised data the difference is only
    told, as preparing may leave pairs out. ``expected=None`` compares nothing.
    """
    known = classified.filter("kind in ('tok', 'raw')").groupBy("dataset").agg(
        F.min("kind").alias("kind"), F.max("kind").alias("_other"), F.sum("n_rows").alias("total_rows")
    )
    wanted = F.lit(expected).cast("bigint")
    severity = (
        F.when(F.lit(expected is None), "ok")
        .when(F.col("kind") == "tok", "info")
        .when(F.col("total_rows") != wanted, "warn")
        .otherwise("ok")
    )
    return (
        known.filter(F.col("kind") == F.col("_other"))
        .drop("_other")
        .withColumn("difference", wanted - F.col("total_rows"))
        .withColumn("severity", severity)
    )


def length_range() -> list[Column]:
    """Aggregates: shortest and longest sequence of either column."""
    sizes = (("input", F.array_size("input_ids")), ("label", F.array_size("labels")))
    return [of(size).alias(f"{name}_{end}") for name, size in sizes for end, of in (("min", F.min), ("max", F.max))]


def empty_counts() -> list[Column]:
    """Aggregates: number of zero-length sequences; a missing sequence is not an empty one."""
    return [
        F.count_if(F.array_size("input_ids") == 0).alias("input_empty"),
        F.count_if(F.array_size("labels") == 0).alias("label_empty"),
    ]


def sequence_stats(tokenised: DataFrame) -> DataFrame:
    return tokenised.agg(*length_range())


def empty_sequences(tokenised: DataFrame) -> DataFrame:
    return tokenised.agg(*empty_counts())
