"""One query per operator, each over whole tables and whole texts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.tables import (
    ALL_LANGUAGES,
    JUNK,
    broken_pairs,
    documents,
    footers,
    furnished,
    lexicon,
    listing,
    lossy_pairs,
    pairs,
)
from pairloom.config import IGNORED_LABEL, MAX_INPUT, PrepareConfig
from pairloom.functions import text as tx
from pairloom.functions.arrays import digest, digest_rows, pad_right
from pairloom.operators import accuracy, batches, chunks, cleaning, fidelity, repeats, shards, terms
from pairloom.operators import prepare as prep
from pairloom.operators import split as splits
from pairloom.operators import validate as valid
from pairloom.operators.fingerprint import content_digest
from pairloom.plans import audit
from pairloom.plans.prepare import prepare
from pairloom.session import shared_folder, ship_package
from pairloom.sources.files import list_files, read_footers, write_shards
from pairloom.sources.pairs import read_pairs
from pairloom.sources.prepared import read_prepared

BATCH, MEGA = 8, 10


# sources and sinks


def scan_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = F.trim(F.regexp_replace("text", F.lit(JUNK), ""))
    df = read_pairs(spark, f"{sf_dir}/documents.parquet", columns={"raw": F.col("text"), "clean": clean})
    return df.select("doc_id", "lang", F.md5("raw").alias("raw_md5"), F.md5("clean").alias("clean_md5"))


SHARD_ROWS = 500


def _shards(spark: SparkSession, sf_dir: str) -> str:
    """The pairs as a sharded dataset of about SHARD_ROWS rows a file; its folder."""
    table = pairs(spark, sf_dir).drop("doc_id")
    folder = f"{shared_folder(spark)}/shards/{uuid.uuid4().hex}"
    write_shards(table, folder, max(1, -(-table.count() // SHARD_ROWS)))
    return folder


def list_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_files(spark, _shards(spark, sf_dir)).select("name", "top_level")


def scan_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return read_footers(list_files(spark, sf_dir)).select(
        "name", "n_rows", F.size("cols").cast("bigint").alias("n_cols"), F.col("error").isNull().alias("readable")
    )


def write_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = PrepareConfig(languages=ALL_LANGUAGES, val_frac=0.3, val_max=200)
    done = prepare(pairs(spark, sf_dir), "doc_id", f"{shared_folder(spark)}/prepared", config)
    return read_prepared(spark, done.path).groupBy(F.col("split").cast("string").alias("split")).agg(
        F.count("*").alias("n_rows"),
        F.sum("length").cast("bigint").alias("input_tokens"),
        F.sum(F.array_size("labels")).cast("bigint").alias("label_tokens"),
    )


# rows


def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = valid.validate_pairs(broken_pairs(spark, sf_dir))
    return df.select("doc_id", "valid", F.array_join("reasons", ",").alias("reasons"))


def invalid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid.invalid_counts(valid.validate_pairs(broken_pairs(spark, sf_dir)))


def lang_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("doc_id", F.md5(prep.model_input()).alias("prefixed_md5"))


def _tokenised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.tokenize_pairs(pairs(spark, sf_dir), max_input=None, max_target=None, keep=("doc_id",))


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokenised(spark, sf_dir).select(
        "doc_id", digest(F.col("input_ids")).alias("input_digest"), digest(F.col("labels")).alias("label_digest")
    )


def _truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.tokenize_pairs(pairs(spark, sf_dir), keep=("doc_id",))


def token_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truncated(spark, sf_dir).select("doc_id", F.col("length").cast("bigint").alias("length"))


def budget_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.budget_flags(pairs(spark, sf_dir)).select("doc_id", "is_input_truncated", "is_target_truncated")


def truncate_to_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truncated(spark, sf_dir).select(
        "doc_id",
        F.array_size("input_ids").cast("bigint").alias("n_input"),
        F.array_size("labels").cast("bigint").alias("n_label"),
        digest(F.col("input_ids")).alias("input_digest"),
        digest(F.col("labels")).alias("label_digest"),
        "is_input_truncated",
        "is_target_truncated",
    )


def truncation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.truncation_counts(prep.budget_flags(pairs(spark, sf_dir)))


def skip_over_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = prep.skip_over_budget(prep.budget_flags(pairs(spark, sf_dir)))
    return kept.select("doc_id", F.md5("raw").alias("raw_md5"), F.md5("clean").alias("clean_md5"))


def reject_over_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("source") == "src1", "").when(F.col("source") != "src2", F.col("text"))
    df = documents(spark, sf_dir).select("doc_id", "lang", text.alias("raw"))
    return cleaning.clean_status(df, ("en", "fr", "de")).select("doc_id", "n_tokens", "status")


def chunk_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = chunks.chunk_pairs(_unaligned_pairs(spark, sf_dir), "doc_id", 1024, 768)
    return df.select(
        "doc_id",
        F.col("chunk_no").cast("bigint").alias("chunk_no"),
        "status",
        F.md5("raw").alias("raw_md5"),
        F.md5("clean").alias("clean_md5"),
    )


def _unaligned_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices are dropped in Spanish, so texts with notices lose lines there."""
    clean = F.when(F.col("lang") == "es", cleaning.drop_lines(F.col("clean"), "licen[sc]e|rights reserved"))
    return pairs(spark, sf_dir).withColumn("clean", clean.otherwise(F.col("clean")))


def strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit(" \u3000\n\x1c"), F.col("text"), F.lit("\u2029\x85\xa0"))
    return documents(spark, sf_dir).select("doc_id", F.md5(tx.strip_text(text)).alias("stripped_md5"))


def empty_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("lang") == "en", F.col("text")).when(F.col("lang") == "fr", " \t").otherwise("")
    df = documents(spark, sf_dir).select("doc_id", "lang", text.alias("raw"))
    cleaned = cleaning.clean_texts(df, cleaning.RuleCleaner({}), ALL_LANGUAGES, max_input=1 << 30)
    return cleaned.select("doc_id", "status", F.md5("cleaned").alias("cleaned_md5"))


def preview_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return df.select(
        "conv_id",
        "turn",
        tx.preview_text(F.col("text"), 110).alias("raw_preview"),
        tx.preview_text(F.col("text"), 220).alias("clean_preview"),
        tx.preview_text(F.col("text"), 200, "").alias("head"),
    )


def argmax_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    negated = F.transform("embedding", lambda x: -x)
    logits = F.array("embedding", negated).alias("logits")
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", logits)
    return accuracy.with_argmax(df).select(
        "vec_id", F.array_join(F.col("predictions").cast("array<string>"), ",").alias("predictions")
    )


# shard audits


def shard_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_names(listing(spark, sf_dir)).select("path", "valid", "idx", "of_m")


def shard_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.missing_indexes(shards.shard_gaps(shards.shard_names(listing(spark, sf_dir))))


def shard_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_duplicates(shards.shard_names(listing(spark, sf_dir)))


def shard_total_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_totals(shards.shard_names(listing(spark, sf_dir)))


def tmp_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.tmp_shards(listing(spark, sf_dir)).select("dataset", "path")


def stray_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.stray_files(listing(spark, sf_dir))


def classify_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.classify_schema(footers(spark, sf_dir)).select("path", "kind")


def corrupt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.corrupt_shards(footers(spark, sf_dir)).select("dataset", "path", "error")


def unknown_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = shards.unknown_schema(shards.classify_schema(footers(spark, sf_dir)))
    return df.select("dataset", "path", F.array_join(F.array_sort("cols"), ",").alias("cols"))


def mixed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.mixed_schema(shards.classify_schema(footers(spark, sf_dir)))


def shard_row_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_row_stats(footers(spark, sf_dir))


def expected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.expected_rows(shards.classify_schema(footers(spark, sf_dir)))


def _digit_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences that may be empty: the digits of both texts."""
    return lossy_pairs(spark, sf_dir).select(
        F.regexp_extract_all("raw", F.lit("[0-9]"), 0).cast("array<int>").alias("input_ids"),
        F.regexp_extract_all("clean", F.lit("[0-9]"), 0).cast("array<int>").alias("labels"),
    )


def sequence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = prep.tokenize_pairs(pairs(spark, sf_dir), max_input=None, max_target=None)
    stats = shards.sequence_stats(df)
    return stats.select(*[F.col(c).cast("bigint").alias(c) for c in stats.columns])


def empty_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.empty_sequences(_digit_sequences(spark, sf_dir))


def audit_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = audit.listing_findings(listing(spark, sf_dir)).unionByName(
        audit.footer_findings(footers(spark, sf_dir))
    )
    return audit.audit_verdict(findings)


def audit_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deep audit of the pairs as shards."""
    ship_package(spark)
    folder = _shards(spark, sf_dir)
    found = audit.audit_dataset(spark, folder, deep=True)
    return found.select("step", "check", "severity", F.replace("subject", F.lit(folder), F.lit("shards")).alias("subject"), "n")


def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict and row statistics for every dataset of the listing."""
    table = listing(spark, sf_dir)
    findings = audit.listing_findings(table).unionByName(audit.footer_findings(footers(spark, sf_dir)))
    return audit.audit_report(findings, table, footers(spark, sf_dir))


# scores, fingerprint


def masked_token_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw bytes as a prediction of the clean ones."""
    df = prep.tokenize_pairs(
        pairs(spark, sf_dir).withColumn("lang", F.lit("")), max_input=None, max_target=None, keep=("doc_id",)
    )
    # without the tag "<> ", so that positions match
    predictions = F.slice("input_ids", 4, F.array_size("input_ids"))
    labels = pad_right(F.col("labels"), F.array_size("input_ids") - 3, IGNORED_LABEL).cast("array<int>")
    rows = df.select(predictions.alias("predictions"), labels.alias("labels"))
    return accuracy.masked_token_accuracy(rows)


def dataset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_digest(pairs(spark, sf_dir))


# split, batches


def _split(spark: SparkSession, sf_dir: str, val_max: int | None) -> DataFrame:
    return splits.split_pairs(pairs(spark, sf_dir), "doc_id", 0.3, 42, val_max)


def train_val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, None).select("doc_id", "split")


def val_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, 200).select("doc_id", "split")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_counts(_split(spark, sf_dir, 200))


def shuffle_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    limited = splits.shuffle_limit(pairs(spark, sf_dir), "doc_id", 150)
    return limited.select("doc_id", "lang", F.md5("raw").alias("raw_md5"))


def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenised = prep.tokenize_pairs(pairs(spark, sf_dir), keep=("doc_id",))
    return batches.length_batches(tokenised, "doc_id", BATCH, MEGA)


def _batched_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.length_batches(prep.pair_lengths(pairs(spark, sf_dir), keep=("doc_id",)), "doc_id", BATCH, MEGA)


def length_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched_lengths(spark, sf_dir).select(
        "doc_id", F.col("length").cast("bigint").alias("length"), "mega_id", "batch_id", F.col("pos").cast("bigint").alias("pos")
    )


def batch_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = batches.batch_widths(_batched_lengths(spark, sf_dir))
    return df.select(*[F.col(c).cast("bigint").alias(c) for c in df.columns])


def pad_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = batches.pad_rows(_batched(spark, sf_dir))
    return df.select("doc_id", "batch_id", digest(F.col("input_ids")).alias("input_digest"))


def pad_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = batches.pad_rows(_batched(spark, sf_dir))
    return df.select("doc_id", "batch_id", digest(F.col("labels")).alias("label_digest"))


def attention_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = batches.pad_rows(_batched(spark, sf_dir))
    return df.select("doc_id", "batch_id", digest(F.col("attention_mask")).alias("mask_digest"))


def _collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches formed from lengths; the texts are tokenised behind the shuffle."""
    length = F.least(prep.BYTES.count(prep.model_input()), F.lit(MAX_INPUT))
    batched = batches.length_batches(pairs(spark, sf_dir).withColumn("length", length), "doc_id", BATCH, MEGA)
    return batches.collate_texts(batched)


def collate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collated(spark, sf_dir).select(
        "batch_id",
        F.size("input_ids").cast("bigint").alias("n_rows"),
        digest_rows(F.col("input_ids")).alias("input_digest"),
        digest_rows(F.col("attention_mask")).alias("mask_digest"),
        digest_rows(F.col("labels")).alias("label_digest"),
    )


def padding_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.padding_report(_batched_lengths(spark, sf_dir))


# cleaning


def clean_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cleaning.clean_texts(furnished(spark, sf_dir), cleaning.RuleCleaner(), ("en", "id", "de"))
    return cleaned.select("doc_id", "n_tokens", "status", F.md5("cleaned").alias("cleaned_md5"))


def eval_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = documents(spark, sf_dir).select(
        F.concat(F.lit("doc-"), "doc_id").alias("name"), "lang", F.col("text").alias("raw"), F.col("source").alias("expect")
    )
    return cleaning.run_cases(cases, cleaning.RuleCleaner({"en": "^the and "}), ALL_LANGUAGES)


def rule_bom(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\ufeff"))
    return documents(spark, sf_dir).select("doc_id", F.md5(cleaning.drop_bom(text)).alias("cleaned_md5"))


def rule_mojibake(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.replace(F.col("text"), F.lit(". "), F.lit(".\u00c2\u00a0"))
    return documents(spark, sf_dir).select("doc_id", F.md5(cleaning.fix_mojibake(text)).alias("cleaned_md5"))


def rule_hex_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.replace(F.col("text"), F.lit(", "), F.lit("0x00, "))
    return documents(spark, sf_dir).select("doc_id", F.md5(cleaning.drop_hex_artifact(text)).alias("cleaned_md5"))


def rule_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default patterns over the texts, with lines of furniture, and of furniture and content, among them."""
    df = furnished(spark, sf_dir)
    cleaned = cleaning.RuleCleaner().drop_boilerplate(F.col("raw"), F.col("lang"))
    return df.select("doc_id", F.md5(cleaned).alias("cleaned_md5"))


def no_duplication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two lines repeated at the end of the clean text."""
    repeated = F.concat("clean", F.lit("\n"), F.substring_index("clean", "\n", 2))
    df = pairs(spark, sf_dir).withColumn("clean", repeated)
    found = fidelity.duplicated_lines(df, "doc_id")
    return found.select("doc_id", F.md5("line").alias("line_md5"), "n_raw", "n_clean")


def repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 14 words repeated at the end of the last line."""
    first = F.array_join(F.slice(F.split("clean", r"\s+"), 1, 14), " ")
    df = pairs(spark, sf_dir).withColumn("clean", F.concat("clean", F.lit(" "), first))
    found = repeats.repeated_spans(df, "doc_id", 8)
    return found.select("doc_id", "start", "n_words", F.md5("span").alias("span_md5"))


# what cleaning lost


def number_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = fidelity.number_loss().cast("bigint").alias("lost")
    return lossy_pairs(spark, sf_dir).select("doc_id", F.size(tx.numbers(F.col("raw"))).cast("bigint").alias("n_raw"), lost)


def term_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.term_loss(lossy_pairs(spark, sf_dir), "doc_id", lexicon(spark), unspaced=("es",))


def structure_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fidelity.structure_loss(lossy_pairs(spark, sf_dir))
    names = ("items_raw", "items_clean", "rows_raw", "rows_clean", "items_lost", "rows_lost")
    return df.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in names])


def ending_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lossy_pairs(spark, sf_dir).select("doc_id", fidelity.ending_kept().alias("kept"))


def fidelity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fidelity.fidelity_summary(lossy_pairs(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        scan_pairs, list_shards, scan_footers, write_prepared, classify_schema, validate_rows, invalid_counts,
        lang_prefix, tokenize, token_length, budget_flags, truncate_to_budget, truncation_counts, skip_over_budget,
        reject_over_budget, chunk_pairs, strip_text, empty_passthrough, preview_text, argmax_ids, shard_names,
        shard_gaps, shard_duplicates, shard_total_mismatch, tmp_shards, stray_files, corrupt_shards, unknown_schema,
        mixed_schema, shard_row_stats, expected_rows, sequence_stats, empty_sequences, audit_verdict, audit_dataset,
        audit_report, masked_token_accuracy, dataset_fingerprint, split_counts, train_val_split, val_cap, shuffle_limit,
        length_groups, batch_widths, pad_inputs, pad_labels, attention_mask, collate, padding_report, clean_texts,
        eval_cases, rule_bom, rule_mojibake, rule_hex_artifact, rule_boilerplate, no_duplication, repeated_spans,
        number_loss, term_loss, structure_loss, ending_kept, fidelity_summary,
    )
}

#: The operators' own results, where the queries above only give checksums of them for the comparison with SQL.
PLAIN = {"tokenize": _tokenised, "truncate_to_budget": _truncated, "collate": _collated}
