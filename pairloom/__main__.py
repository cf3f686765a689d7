"""Jobs from the command line: ``spark-submit`` or ``python -m pairloom <job> --help``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from dataclasses import fields
from importlib import import_module
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.config import FULL_CORPUS_ROWS, LANGUAGES, MAX_INPUT, OVERSIZED, CleanOptions, PrepareConfig
from pairloom.operators.accuracy import masked_token_accuracy, with_argmax
from pairloom.operators.batches import collate, length_batches, padding_report, padding_total, sequence_lengths
from pairloom.operators.chunks import chunk_pairs
from pairloom.operators.cleaning import RuleCleaner, WorkerCleaner, clean_texts, run_cases
from pairloom.operators.fidelity import fidelity_summary, term_summary
from pairloom.operators.repeats import repeated_spans
from pairloom.operators.split import split_counts
from pairloom.operators.terms import term_loss
from pairloom.operators.tokenizers import ByteTokenizer, WorkerTokenizer
from pairloom.plans.audit import audit_folders
from pairloom.plans.prepare import prepare
from pairloom.session import build_session, ship_package
from pairloom.sources.pairs import ROW_KEY, read_pairs
from pairloom.sources.prepared import input_budget, read_prepared

SHOWN = 1000  # rows of a report printed; all of them are written with --out


def _pairs(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, str]:
    own_key = args.key is None
    if own_key and args.table:
        raise ValueError("name the key column of the table with --key")
    df = read_pairs(spark, args.data_dir, args.table, args.glob, row_key=own_key)
    return df, ROW_KEY if own_key else args.key


def _loaded(name: str) -> Any:
    """What ``module:attribute`` names; the module must be importable on the executors, too."""
    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError(f"expected module:attribute, got {name!r}")
    return getattr(import_module(module), attribute)


def _tokenizer(args: argparse.Namespace) -> ByteTokenizer | WorkerTokenizer:
    if not args.tokenizer:
        return ByteTokenizer()
    if args.eos_id is None:
        raise ValueError("a plug-in tokenizer needs --eos-id")
    return WorkerTokenizer(_loaded(args.tokenizer), args.tokenizer, args.eos_id, args.pad_id, args.vocabulary)


def _cleaner(args: argparse.Namespace, tokenizer: ByteTokenizer | WorkerTokenizer) -> RuleCleaner | WorkerCleaner:
    if not args.cleaner:
        return RuleCleaner()
    options = CleanOptions(**{f.name: getattr(args, f.name) for f in fields(CleanOptions)})
    return WorkerCleaner(_loaded(args.cleaner), options, args.batch_tokens, tokenizer)


def _budget(spark: SparkSession, args: argparse.Namespace) -> int:
    return input_budget(spark, args.prepared, args.model_family, MAX_INPUT) if args.prepared else MAX_INPUT


def _tell(df: DataFrame, out: str | None, name: str, **how: Any) -> None:
    """Print a report, and write it where a folder is given; a report cut in print says so."""
    if out:
        df.write.parquet(f"{out.rstrip('/')}/{name}")
    df.show(SHOWN, truncate=False, **how)
    if not out and len(df.take(SHOWN + 1)) > SHOWN:
        print(f"these are the first {SHOWN} rows; --out writes all")


def run_audit(spark: SparkSession, args: argparse.Namespace) -> int:
    audit = audit_folders(spark, args.data_dir, args.expected_rows, args.deep, args.languages)
    findings = audit.findings.persist()
    _tell(findings.orderBy("dataset", "step", "subject"), args.out, "findings")
    _tell(audit.report.orderBy("dataset"), args.out, "report")
    return 1 if findings.filter("severity = 'fail'").limit(1).count() else 0


def run_prepare(spark: SparkSession, args: argparse.Namespace) -> int:
    config = PrepareConfig(
        tuple(args.languages), args.max_input, args.max_target, args.oversized, args.val_frac, args.val_max, args.seed
    )
    pairs, key = _pairs(spark, args)
    done = prepare(pairs, key, args.out, config, _tokenizer(args), args.model_family, args.base_model)
    print(f"{'written' if done.written else 'already there'}: {done.path}")
    print(f"pairs: {done.n_source}")
    for lang, (rows, inputs, targets) in (done.counts or {}).items():
        print(f"{lang}: rows {rows}, inputs truncated {inputs}, targets truncated {targets}")
    split_counts(read_prepared(spark, done.path)).show()
    return 0


def run_chunk(spark: SparkSession, args: argparse.Namespace) -> int:
    pairs, key = _pairs(spark, args)
    chunk_pairs(pairs, key, args.max_input, args.max_target, _tokenizer(args)).write.parquet(args.out)
    chunks = spark.read.parquet(args.out)
    chunks.groupBy("status").agg(F.count("*").alias("n_chunks"), F.count_distinct(key).alias("n_pairs")).show()
    return 0


def run_batches(spark: SparkSession, args: argparse.Namespace) -> int:
    table = read_prepared(spark, args.prepared, args.split)
    if args.out:
        collate(length_batches(table, args.key, args.batch, args.mega, args.seed)).write.parquet(args.out)
    lengths = length_batches(sequence_lengths(table, args.key), args.key, args.batch, args.mega, args.seed)
    padding_total(padding_report(lengths)).show()
    return 0


def run_clean(spark: SparkSession, args: argparse.Namespace) -> int:
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", args.glob).parquet(args.data_dir)
    tokenizer = _tokenizer(args)
    cleaned = clean_texts(
        df, _cleaner(args, tokenizer), args.languages, _budget(spark, args), args.text_column, args.lang_column,
        tokenizer, args.on_reject,
    )
    cleaned.write.parquet(args.out)
    spark.read.parquet(args.out).groupBy("status").agg(F.count("*").alias("n_rows")).show()
    return 0


def run_eval(spark: SparkSession, args: argparse.Namespace) -> int:
    tokenizer = _tokenizer(args)
    cases = spark.read.parquet(args.cases)
    results = run_cases(cases, _cleaner(args, tokenizer), args.languages, _budget(spark, args), tokenizer)
    _tell(results, args.out, "cases", vertical=True)
    return 0


def run_fidelity(spark: SparkSession, args: argparse.Namespace) -> int:
    pairs, key = _pairs(spark, args)
    _tell(fidelity_summary(pairs), args.out, "summary")
    if args.lexicon:
        losses = term_loss(pairs, key, spark.read.parquet(args.lexicon), args.unspaced)
        if args.out:
            losses.write.parquet(f"{args.out.rstrip('/')}/term_loss")
            losses = spark.read.parquet(f"{args.out.rstrip('/')}/term_loss")
        _tell(term_summary(losses), args.out, "terms")
    if args.repeats:
        _tell(repeated_spans(pairs, key, args.repeats, args.unspaced), args.out, "repeats")
    return 0


def run_score(spark: SparkSession, args: argparse.Namespace) -> int:
    rows = spark.read.parquet(args.predictions)
    if "logits" in rows.columns:
        rows = with_argmax(rows)
    _tell(masked_token_accuracy(rows), args.out, "accuracy")
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pairloom", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, text: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text, description=text)
        sub.set_defaults(run=run)
        return sub

    def languages(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--languages", nargs="+", default=list(LANGUAGES))

    def tokenizer(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--tokenizer", help="module:factory of a tokenizer library; by default UTF-8 bytes")
        sub.add_argument("--eos-id", type=int)
        sub.add_argument("--pad-id", type=int, default=0)
        sub.add_argument("--vocabulary", default="", help="a name for the vocabulary's version")

    def cleaner(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--cleaner", help="module:factory of a model; by default the rules")
        sub.add_argument("--batch-tokens", type=int, default=1 << 14, help="padded tokens of a model's batch")
        for option in fields(CleanOptions):
            kind = float if option.name == "repetition_penalty" else int
            sub.add_argument(f"--{option.name.replace('_', '-')}", type=kind, default=option.default)
        sub.add_argument("--prepared", help="folder (or JSON file) with the settings that set the budget")
        sub.add_argument("--model-family", default="")
        tokenizer(sub)

    def source(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--data-dir")
        sub.add_argument("--table")
        sub.add_argument("--glob", default="*.parquet")
        sub.add_argument("--key", help="unique column; by default the row's place in the files")

    audit = job("audit", run_audit, "Check sharded datasets; exit code 1 if one fails.")
    audit.add_argument("--data-dir", nargs="+", default=["dataset/tok", "dataset"])
    audit.add_argument("--deep", action="store_true", help="read the values too")
    audit.add_argument("--expected-rows", type=int, default=FULL_CORPUS_ROWS)
    audit.add_argument("--out", help="folder for all findings and the report")
    languages(audit)

    defaults = PrepareConfig()
    prep = job("prepare", run_prepare, "Validate, tokenise, split and write a pair table.")
    source(prep)
    languages(prep)
    prep.add_argument("--out", required=True)
    tokenizer(prep)
    prep.add_argument("--oversized", choices=OVERSIZED, default=defaults.oversized)
    prep.add_argument("--val-frac", type=float, default=defaults.val_frac)
    for name in ("max_input", "max_target", "val_max", "seed"):
        prep.add_argument(f"--{name.replace('_', '-')}", type=int, default=getattr(defaults, name))
    prep.add_argument("--model-family", default="")
    prep.add_argument("--base-model", default="")

    chunk = job("chunk", run_chunk, "Cut pairs over a budget into chunks at matching lines.")
    source(chunk)
    tokenizer(chunk)
    chunk.add_argument("--out", required=True)
    for name in ("max_input", "max_target"):
        chunk.add_argument(f"--{name.replace('_', '-')}", type=int, default=getattr(defaults, name))

    batch = job("batches", run_batches, "Form length-grouped batches of a prepared table and report the padding.")
    batch.add_argument("--prepared", required=True)
    batch.add_argument("--split", default="train")
    batch.add_argument("--key", default=ROW_KEY)
    batch.add_argument("--out")
    for name in ("batch", "mega", "seed"):
        batch.add_argument(f"--{name}", type=int, default=getattr(defaults, name))

    clean = job("clean", run_clean, "Clean a table of texts with the rules or a model.")
    cleaner(clean)
    clean.add_argument("--data-dir", required=True)
    clean.add_argument("--glob", default="*.parquet")
    clean.add_argument("--out", required=True)
    clean.add_argument("--text-column", default="raw")
    clean.add_argument("--lang-column", default="lang")
    clean.add_argument("--on-reject", choices=("status", "fail"), default="status")
    languages(clean)

    cases = job("eval", run_eval, "Clean a table of cases (name, lang, raw, expect) and show both texts.")
    cases.add_argument("--cases", required=True)
    cases.add_argument("--out")
    cleaner(cases)
    languages(cases)

    fidelity = job("fidelity", run_fidelity, "Report per language what cleaning lost and repeated.")
    source(fidelity)
    fidelity.add_argument("--lexicon", help="table of terms to watch: lang, kind, term")
    fidelity.add_argument("--unspaced", nargs="*", default=["zh"], help="languages written without spaces")
    fidelity.add_argument("--repeats", type=int, help="report repeated passages of so many words or more")
    fidelity.add_argument("--out", help="folder for the reports")

    score = job("score", run_score, "Token accuracy of stored predictions (or logits) against labels.")
    score.add_argument("--predictions", required=True, help="table with labels and predictions or logits")
    score.add_argument("--out")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    session = spark or build_session(f"pairloom-{args.job}")
    ship_package(session)
    return args.run(session, args)


if __name__ == "__main__":
    sys.exit(main())
