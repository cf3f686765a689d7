"""Train/validation split and seeded samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.ranking import cut_keys, first_rows, shuffle_key


def split_pairs(
    df: DataFrame, key: str, frac: float = 0.01, seed: int = 42, val_max: int | None = 4000
) -> DataFrame:
    """Add ``split``: ``val`` for ``ceil(frac * n)`` random rows, ``train`` for the others.

    Of more than ``val_max`` validation rows, the surplus goes to neither side: ``dropped``. The
    assignment compares each row's hash with two cut hashes, so the rows themselves are not
    shuffled. With a key shared by copies (``content_key``) all copies land on one side, and both
    cuts lie at the border of groups nearest to their target: a side differs from its target by at
    most half of the group there. Of two groups or more neither side stays empty, so a large first
    group can make ``val`` larger than its cap.
    """
    if not 0 <= frac <= 1:
        raise ValueError(f"frac must be between 0 and 1, got {frac}")
    keyed = df.withColumn("_k", shuffle_key(key, seed))
    wanted = F.ceil(F.col("_total").cast("double") * F.lit(float(frac)))
    kept = wanted if val_max is None else F.least(wanted, F.lit(val_max).cast("bigint"))
    cut = cut_keys(keyed, {"val": kept, "surplus": wanted}).select(F.struct("val", "surplus")).scalar()
    found = keyed.withColumn("_cut", cut)
    side = (
        F.when(F.col("_k") <= F.col("_cut.val"), "val")
        .when(F.col("_k") <= F.col("_cut.surplus"), "dropped")
        .otherwise("train")
    )
    return found.withColumn("split", side).drop("_k", "_cut")


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count("*").alias("n_rows"))


def shuffle_limit(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """The first ``k`` rows of the seeded random order, in that order. Equal keys follow in any order."""
    return first_rows(df, key, seed, k).orderBy("rank").drop("rank")
