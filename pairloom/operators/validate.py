"""Row validity of pair tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pairloom.config import LANGUAGES
from pairloom.sources.pairs import require_columns

REASONS = ("lang_missing", "lang_unsupported", "raw_missing", "clean_missing")


def _missing(df: DataFrame, column: str) -> Column:
    """True where the value is no string: null, or any value of a column of another type."""
    if not isinstance(df.schema[column].dataType, StringType):
        return F.lit(True)
    return F.col(column).isNull()


def validate_pairs(df: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """Add ``reasons`` (why the row is invalid, empty if it is not) and ``valid``.

    Languages match exactly, case included. Empty strings are valid text.
    """
    require_columns(df)
    no_lang = _missing(df, "lang")
    checks = {
        "lang_missing": no_lang,
        "lang_unsupported": ~no_lang & ~F.col("lang").cast("string").isin(*languages),
        "raw_missing": _missing(df, "raw"),
        "clean_missing": _missing(df, "clean"),
    }
    found = F.array_compact(F.array(*[F.when(broken, F.lit(reason)) for reason, broken in checks.items()]))
    return df.withColumn("reasons", found).withColumn("valid", F.size("reasons") == 0)


def invalid_counts(validated: DataFrame) -> DataFrame:
    """Number of rows per reason; a row with two reasons counts under both."""
    return (
        validated.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n_rows"))
    )


def reason_counts() -> list[Column]:
    """Aggregates over validated rows: how many have each reason."""
    return [F.count_if(F.array_contains("reasons", reason)).alias(reason) for reason in REASONS]


def raise_if_invalid(counts: Row) -> None:
    found = {reason: counts[reason] for reason in REASONS if counts[reason]}
    if found:
        raise ValueError(f"invalid values: {found}")


def require_valid(validated: DataFrame) -> DataFrame:
    """Raise if any row is invalid; runs one counting job."""
    raise_if_invalid(validated.agg(*reason_counts()).first())
    return validated
