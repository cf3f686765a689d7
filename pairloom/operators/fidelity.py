"""What cleaning lost: numbers, structure, endings; and what it repeated. Lost terms are in ``terms.py``.

Each pair is judged on its own, so all of this is row-local.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions import text as tx

RAW, CLEAN = "raw", "clean"


def number_loss() -> Column:
    """Numbers of raw that clean has fewer times, counted with repetition."""
    return tx.multiset_excess(tx.numbers(F.col(RAW)), tx.numbers(F.col(CLEAN)))


def duplication_count() -> Column:
    """Lines that clean has more often than raw, counted with repetition."""
    return tx.multiset_excess(tx.lines(F.col(CLEAN)), tx.lines(F.col(RAW)))


def duplicated_lines(df: DataFrame, key: str) -> DataFrame:
    """The lines behind :func:`duplication_count`: ``key, line, n_raw, n_clean``. Nothing is shuffled."""
    found = tx.multiset_surplus(tx.lines(F.col(CLEAN)), tx.lines(F.col(RAW)))
    return df.select(key, F.inline(found).alias("line", "n_clean", "n_raw")).select(key, "line", "n_raw", "n_clean")


def list_items(text: Column) -> Column:
    return F.regexp_count(text, F.lit(tx.LIST_ITEM))


def table_rows(text: Column) -> Column:
    return F.regexp_count(text, F.lit(tx.TABLE_ROW))


def structure_loss(df: DataFrame) -> DataFrame:
    """Add list items and table rows of both sides and how many fewer clean has."""
    counts = {
        f"{what}_{side}": measure(F.col(side))
        for what, measure in (("items", list_items), ("rows", table_rows))
        for side in (RAW, CLEAN)
    }
    lost = {
        f"{what}_lost": F.greatest(F.col(f"{what}_{RAW}") - F.col(f"{what}_{CLEAN}"), F.lit(0))
        for what in ("items", "rows")
    }
    return df.withColumns(counts).withColumns(lost)


def ending_kept() -> Column:
    """Whether the last line of raw that is not blank occurs in clean."""
    return F.contains(F.col(CLEAN), tx.last_line(F.col(RAW)))


def fidelity_summary(df: DataFrame) -> DataFrame:
    """The row-local measures per language and, marked ``is_total``, over all: one scan."""
    # each text is searched once per pattern: the arrays are columns of their own
    found = structure_loss(df.select("lang", RAW, CLEAN)).withColumns(
        {"_raw_numbers": tx.numbers(F.col(RAW)), "_clean_numbers": tx.numbers(F.col(CLEAN))}
    )
    measured = found.select(
        "lang", "items_raw", "items_lost", "rows_raw", "rows_lost",
        F.size("_raw_numbers").alias("_numbers"),
        tx.multiset_excess(F.col("_raw_numbers"), F.col("_clean_numbers")).alias("_numbers_lost"),
        ending_kept().alias("_kept"),
        duplication_count().alias("_duplicated"),
    )
    return (
        measured.rollup("lang")
        .agg(
            (F.grouping("lang") == 1).alias("is_total"),
            F.count("*").alias("n_pairs"),
            F.sum("_numbers").alias("numbers"),
            F.sum("_numbers_lost").alias("numbers_lost"),
            F.sum("items_raw").alias("items"),
            F.sum("items_lost").alias("items_lost"),
            F.sum("rows_raw").alias("table_rows"),
            F.sum("rows_lost").alias("table_rows_lost"),
            F.count_if("_kept").alias("endings_kept"),
            F.sum("_duplicated").alias("lines_duplicated"),
        )
    )


def term_summary(losses: DataFrame) -> DataFrame:
    """:func:`pairloom.operators.terms.term_loss` per language and kind and, marked ``is_total``, per kind over all."""
    return losses.groupingSets([["lang", "kind"], ["kind"]], "lang", "kind").agg(
        (F.grouping("lang") == 1).alias("is_total"), F.sum("n_raw").alias("n_raw"), F.sum("lost").alias("lost")
    )
