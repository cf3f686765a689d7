"""The audit of sharded datasets: all checks as one table of findings, and a verdict.

``findings``: ``dataset, step, check, severity, subject, detail, n``. Severity ``fail`` decides the
verdict; ``warn`` and ``info`` do not. A checker that stops at the first failure would have stopped
at the finding with the smallest ``(step, subject)``; the verdict names it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.config import FULL_CORPUS_ROWS, LANGUAGES, PAIR_COLUMNS, TOKEN_COLUMNS
from pairloom.operators import shards
from pairloom.operators.validate import invalid_counts, validate_pairs
from pairloom.sources.files import FOOTER_SCHEMA, list_files, read_footers

STEP_TMP, STEP_STRAY, STEP_NAMES, STEP_ORDER, STEP_OPEN, STEP_MIXED, STEP_ROWS, STEP_VALUES = range(1, 9)


def _finding(
    df: DataFrame, step: int, check: str, severity: str | Column, subject: Column, detail: Column, n: Column
) -> DataFrame:
    return df.select(
        F.col("dataset"),
        F.lit(step).alias("step"),
        F.lit(check).alias("check"),
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
        subject.cast("string").alias("subject"),
        detail.cast("string").alias("detail"),
        n.cast("bigint").alias("n"),
    )


def listing_findings(listing: DataFrame) -> DataFrame:
    """Findings that need the file names only."""
    nothing, dataset = F.lit(None), F.col("dataset")
    names = shards.shard_names(listing)
    count = F.count("*").alias("n")
    tmp = shards.tmp_shards(listing).groupBy("dataset").agg(count)
    invalid = names.filter("not valid").groupBy("dataset").agg(count)
    gaps = shards.shard_gaps(names).groupBy("dataset").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    duplicates = shards.shard_duplicates(names).groupBy("dataset").agg(count, F.min("idx").alias("first"))
    totals = shards.shard_totals(names).filter("mismatch")
    return _union(
        [
            _finding(tmp, STEP_TMP, "tmp_shards", "fail", dataset, nothing, F.col("n")),
            _finding(
                shards.stray_files(listing), STEP_STRAY, "stray_files", "fail", F.col("name"), nothing,
                F.col("n_files"),
            ),
            _finding(invalid, STEP_NAMES, "shard_names", "fail", dataset, nothing, F.col("n")),
            _finding(
                gaps, STEP_ORDER, "shard_gaps", "fail", dataset, F.format_string("between %d and %d", "first", "last"),
                F.col("n"),
            ),
            _finding(
                duplicates, STEP_ORDER, "shard_duplicates", "fail", dataset, F.format_string("from %d", "first"),
                F.col("n"),
            ),
            _finding(
                totals, STEP_ORDER, "shard_total_mismatch", "fail", dataset,
                F.format_string("%d files name a total of %d, there are %d", "n_naming", "of_m", "n_files"),
                F.col("n_naming"),
            ),
        ]
    )


def footer_findings(footers: DataFrame, expected: int | None = FULL_CORPUS_ROWS) -> DataFrame:
    """Findings that need schemas and row counts."""
    dataset = F.col("dataset")
    classified = shards.classify_schema(footers)
    rows = shards.expected_rows(classified, expected)
    mixed = shards.mixed_schema(classified).filter("mixed")
    return _union(
        [
            _finding(
                shards.corrupt_shards(footers), STEP_OPEN, "corrupt_shards", "fail", F.col("path"), F.col("error"),
                F.lit(1),
            ),
            _finding(
                shards.unknown_schema(classified), STEP_OPEN, "unknown_schema", "fail", F.col("path"),
                F.array_join(F.array_sort("cols"), ","), F.lit(1),
            ),
            _finding(
                mixed, STEP_MIXED, "mixed_schema", "fail", dataset,
                F.format_string("%d tok, %d raw", "n_tok", "n_raw"), F.col("n_tok") + F.col("n_raw"),
            ),
            _finding(
                rows, STEP_ROWS, "expected_rows", F.col("severity"), dataset, F.col("kind"), F.col("total_rows")
            ).filter("severity <> 'ok'"),
        ]
    )


def value_findings(spark: SparkSession, dataset: str, kind: str, languages: Sequence[str]) -> DataFrame:
    """Findings from reading every row of a dataset whose files are sound."""
    df = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "train-*.parquet")
        .parquet(dataset)
    )
    named = F.lit(dataset).alias("dataset")
    if kind == "raw":
        counts = invalid_counts(validate_pairs(df.select(*PAIR_COLUMNS), languages)).select("*", named)
        return _finding(
            counts, STEP_VALUES, "invalid_values", "fail", F.col("reason"), F.lit(None), F.col("n_rows")
        )
    # one pass for the lengths and the empty sequences
    stats = df.agg(F.count("*").alias("rows"), *shards.length_range(), *shards.empty_counts()).select("*", named)
    lengths = F.format_string("input %d..%d, labels %d..%d", "input_min", "input_max", "label_min", "label_max")
    empty = F.format_string("%d in input_ids, %d in labels", "input_empty", "label_empty")
    told = F.struct(
        F.lit("sequence_stats").alias("check"), F.lit("info").alias("severity"), lengths.alias("detail"),
        F.col("rows").alias("n"),
    )
    failed = F.struct(
        F.lit("empty_sequences").alias("check"), F.lit("fail").alias("severity"), empty.alias("detail"),
        (F.col("input_empty") + F.col("label_empty")).alias("n"),
    )
    found = stats.select("dataset", F.explode(F.array(told, failed)).alias("f")).select("dataset", "f.*")
    return found.filter("severity = 'info' or n > 0").select(
        "dataset", F.lit(STEP_VALUES).alias("step"), "check", "severity", F.col("dataset").alias("subject"), "detail", "n"
    )


def audit_verdict(findings: DataFrame, datasets: DataFrame | None = None) -> DataFrame:
    """Per dataset: ``pass`` unless something failed, the counts, the first failure.

    Without ``datasets`` (column ``dataset``, further ones are kept) only datasets with findings have a row.
    """
    failed = F.col("severity") == "fail"
    judged = findings.groupBy("dataset").agg(
        F.when(F.count_if(failed) > 0, "fail").otherwise("pass").alias("verdict"),
        F.count_if(failed).alias("n_fail"),
        F.count_if(F.col("severity") == "warn").alias("n_warn"),
        F.min_by(
            F.when(failed, F.col("check")), F.when(failed, F.struct("step", "subject", "check"))
        ).alias("first_failure"),
    )
    if datasets is None:
        return judged
    return datasets.join(judged, "dataset", "left").fillna({"verdict": "pass", "n_fail": 0, "n_warn": 0})


def audit_report(findings: DataFrame, datasets: DataFrame, footers: DataFrame) -> DataFrame:
    """One row per audited dataset, sound ones included: the verdict, and files and rows of its readable shards."""
    stats = shards.shard_row_stats(footers)
    return audit_verdict(findings, datasets.select("dataset").distinct()).join(stats, "dataset", "left").fillna(
        {"n_files": 0, "total_rows": 0}
    )


@dataclass(frozen=True)
class Audit:
    """The findings of an audit and its report, one row per folder asked for."""

    findings: DataFrame
    report: DataFrame


def audit_dataset(
    spark: SparkSession,
    folders: str | Sequence[str],
    expected: int | None = FULL_CORPUS_ROWS,
    deep: bool = False,
    languages: Sequence[str] = LANGUAGES,
) -> DataFrame:
    """The findings of :func:`audit_folders`."""
    return audit_folders(spark, folders, expected, deep, languages).findings


def audit_folders(
    spark: SparkSession,
    folders: str | Sequence[str],
    expected: int | None = FULL_CORPUS_ROWS,
    deep: bool = False,
    languages: Sequence[str] = LANGUAGES,
) -> Audit:
    """All findings for one or more dataset folders, and a report on each.

    ``deep`` reads the values too, of datasets without a failure so far. A folder that does not
    exist or holds no parquet file gives an ``info`` finding.
    """
    folders = [folders] if isinstance(folders, str) else list(folders)
    present = [folder for folder in folders if _exists(spark, folder)]
    found = [_empty_findings(spark, [f for f in folders if f not in present], "no such folder")]
    footers = spark.createDataFrame([], FOOTER_SCHEMA)
    if present:
        listing = list_files(spark, present)
        # one row per file, read once and used by each check below
        footers = read_footers(shards.train_files(listing)).persist()
        shallow = listing_findings(listing).unionByName(footer_findings(footers, expected))
        filled = {row["dataset"] for row in listing.select("dataset").distinct().collect()}
        found += [shallow, _empty_findings(spark, [f for f in present if f not in filled], "no parquet file")]
        if deep:
            for dataset, kind in _sound(shallow, footers):
                found.append(value_findings(spark, dataset, kind, languages))
    findings = _union(found)
    asked = spark.createDataFrame([(f,) for f in folders], "dataset string")
    return Audit(findings, audit_report(findings, asked, footers))


def _sound(shallow: DataFrame, footers: DataFrame) -> list[tuple[str, str]]:
    """Datasets without a failure, with their kind: at most one row per folder asked for."""
    failed = shallow.filter("severity = 'fail'").select("dataset").distinct()
    kinds = shards.classify_schema(footers).groupBy("dataset").agg(F.min("kind").alias("kind"))
    return [(r["dataset"], r["kind"]) for r in kinds.join(failed, "dataset", "left_anti").collect()]


def _exists(spark: SparkSession, folder: str) -> bool:
    try:
        spark.read.format("binaryFile").load(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _empty_findings(spark: SparkSession, folders: Sequence[str], detail: str) -> DataFrame:
    rows = [(f, STEP_STRAY, "empty_dataset", "info", f, detail, 0) for f in folders]
    schema = "dataset string, step int, check string, severity string, subject string, detail string, n bigint"
    return spark.createDataFrame(rows, schema)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
