"""From valid pairs to id sequences under budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.config import MAX_INPUT, MAX_TARGET
from pairloom.functions.text import prefixed
from pairloom.operators.tokenizers import ByteTokenizer
from pairloom.session import ready_workers

BYTES = ByteTokenizer()


def model_input() -> Column:
    return prefixed(F.col("lang"), F.col("raw"))


def budget_flags(
    df: DataFrame, tokenizer=BYTES, max_input: int = MAX_INPUT, max_target: int = MAX_TARGET
) -> DataFrame:
    """Add the uncut lengths and whether they exceed the budgets. Builds no id sequence."""
    return df.withColumns(
        {"input_length": tokenizer.count(model_input()), "target_length": tokenizer.count(F.col("clean"))}
    ).withColumns(
        {
            "is_input_truncated": F.col("input_length") > max_input,
            "is_target_truncated": F.col("target_length") > max_target,
        }
    )


def tokenize_pairs(
    df: DataFrame,
    tokenizer=BYTES,
    max_input: int | None = MAX_INPUT,
    max_target: int | None = MAX_TARGET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``input_ids, labels, length`` and the two truncation flags; other columns only if kept.

    Each text is tokenised once. A budget of None leaves the sequences whole.
    """
    ready_workers(df.sparkSession)
    encoded = df.select(
        *keep,
        tokenizer.encode(model_input(), max_input).alias("_input"),
        tokenizer.encode(F.col("clean"), max_target).alias("_target"),
    )

    def over(side: str, budget: int | None) -> Column:
        return F.lit(False) if budget is None else F.col(f"{side}.n") > budget

    length = F.col("_input.n") if max_input is None else F.least("_input.n", F.lit(max_input))
    return encoded.select(
        *keep,
        F.col("_input.ids").alias("input_ids"),
        F.col("_target.ids").alias("labels"),
        length.alias("length"),
        over("_input", max_input).alias("is_input_truncated"),
        over("_target", max_target).alias("is_target_truncated"),
    )


def pair_lengths(
    df: DataFrame,
    tokenizer=BYTES,
    max_input: int = MAX_INPUT,
    max_target: int = MAX_TARGET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``length, label_length`` that tokenised pairs would have: all a padding report needs."""
    return df.select(
        *keep,
        F.least(tokenizer.count(model_input()), F.lit(max_input)).alias("length"),
        F.least(tokenizer.count(F.col("clean")), F.lit(max_target)).alias("label_length"),
    )


def truncation_counts(flagged: DataFrame, by: str | None = "lang") -> DataFrame:
    """Rows and truncated inputs and targets: per language and, marked ``is_total``, over all."""
    counts = [
        F.count("*").alias("n_rows"),
        F.count_if("is_input_truncated").alias("input_truncated"),
        F.count_if("is_target_truncated").alias("target_truncated"),
    ]
    if by is None:
        return flagged.agg(*counts)
    # the marker tells the total from a group of rows whose language is null
    grouped = flagged.rollup(by).agg((F.grouping(by) == 1).alias("is_total"), *counts)
    return grouped.select(by, "is_total", "n_rows", "input_truncated", "target_truncated")


def skip_over_budget(flagged: DataFrame) -> DataFrame:
    """Only the pairs that fit both budgets."""
    return flagged.filter(~F.col("is_input_truncated") & ~F.col("is_target_truncated"))


def skipped_count(flagged: DataFrame) -> DataFrame:
    """How many pairs :func:`skip_over_budget` leaves out."""
    out = F.col("is_input_truncated") | F.col("is_target_truncated")
    return flagged.agg(F.count("*").alias("n_rows"), F.count_if(out).alias("n_skipped"))
