"""The prepare job: pairs in, tokenised and split table out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pairloom.config import PAIR_COLUMNS, PrepareConfig
from pairloom.operators.chunks import chunk_pairs
from pairloom.operators.fingerprint import dataset_fingerprint, digest_columns
from pairloom.operators.prepare import budget_flags, skip_over_budget, tokenize_pairs
from pairloom.operators.split import split_pairs
from pairloom.operators.tokenizers import ByteTokenizer
from pairloom.operators.validate import raise_if_invalid, reason_counts, validate_pairs
from pairloom.sources.prepared import prepared_path, write_prepared

PREPARED_COLUMNS = ("input_ids", "labels", "length")


@dataclass(frozen=True)
class Prepared:
    """Where the table is, whether this run wrote it, and, if so, its counts.

    ``counts`` maps each language and ``all`` to rows and truncated inputs and targets, over both
    splits and the surplus; ``n_source`` is the number of pairs before any were skipped.
    """

    path: str
    fingerprint: str
    written: bool
    n_source: int
    counts: dict[str, tuple[int, int, int]] | None


def tokenised_split(
    pairs: DataFrame, key: str, config: PrepareConfig = PrepareConfig(), tokenizer=ByteTokenizer()
) -> DataFrame:
    """``key, lang, split``, the id sequences, their length and the truncation flags.

    Over-budget pairs are skipped or cut into chunks first if the config says so, as the split is of what
    remains; a plug-in tokenizer then runs in the passes that find the split, too. All chunks of a pair are on
    one side of the split, and have the pair's key with their number as key; what cannot be cut to fit is left
    out.
    """
    pairs = pairs.select(key, "lang", "raw", "clean")
    if config.oversized == "skip":
        pairs = skip_over_budget(budget_flags(pairs, tokenizer, config.max_input, config.max_target))
    if config.oversized == "chunk":
        pairs = chunk_pairs(pairs, key, config.max_input, config.max_target, tokenizer).filter("status = 'ok'")
    split = split_pairs(pairs, key, config.val_frac, config.seed, config.val_max)
    if config.oversized == "chunk":
        split = split.withColumn(key, F.concat_ws("#", key, "chunk_no"))
    return tokenize_pairs(split, tokenizer, config.max_input, config.max_target, keep=(key, "lang", "split"))


def prepare(
    pairs: DataFrame,
    key: str,
    root: str,
    config: PrepareConfig = PrepareConfig(),
    tokenizer=ByteTokenizer(),
    model_family: str = "",
    base_model: str = "",
) -> Prepared:
    """Validate, then write the prepared table under ``root``, or reuse an equal one there: equal in texts,
    keys and settings.

    The texts are read twice: once to validate and fingerprint them, once to write the table; the
    truncation counts are gathered while it is written.
    """
    identity = digest_columns((*PAIR_COLUMNS, key))
    checked = validate_pairs(pairs, config.languages).agg(*reason_counts(), *identity).first()
    raise_if_invalid(checked)
    fingerprint = dataset_fingerprint(
        checked,
        tokenizer.identity(),
        config.max_input,
        config.max_target,
        split=[key, config.val_frac, config.seed, config.val_max, config.oversized],
    )
    path = prepared_path(root, fingerprint, config.max_input, config.max_target)
    manifest = {
        "model_family": model_family,
        "base_model": base_model,
        "max_input": config.max_input,
        "max_target": config.max_target,
        "fingerprint": fingerprint,
    }
    seen = Observation("truncation")
    tokenised = tokenised_split(pairs, key, config, tokenizer).observe(seen, *_counts(config.languages))
    table = tokenised.filter("split <> 'dropped'").select(key, *PREPARED_COLUMNS, "split")
    written = write_prepared(table, path, manifest)
    counts = _by_language(seen.get, config.languages) if written else None
    return Prepared(path, fingerprint, written, checked["n_rows"], counts)


def _counts(languages: Sequence[str]) -> list[Column]:
    found = []
    for i, lang in enumerate(("all", *languages)):
        here = F.lit(True) if i == 0 else F.col("lang") == lang
        for name, wanted in (("rows", F.lit(True)), ("input", F.col("is_input_truncated")), ("target", F.col("is_target_truncated"))):
            found.append(F.count_if(here & wanted).alias(f"{name}_{i}"))
    return found


def _by_language(seen: dict[str, int], languages: Sequence[str]) -> dict[str, tuple[int, int, int]]:
    return {
        lang: (seen[f"rows_{i}"], seen[f"input_{i}"], seen[f"target_{i}"]) for i, lang in enumerate(("all", *languages))
    }
