"""From raw documents to training ids: five stages, each one of the operators in ``pairloom.llm``.

1. Language ID: documents whose language cannot be told go; a missing `lang` is filled with the one found.
2. Near duplicates: of each group of linked texts the row with the least id stays (null ids last).
3. Decontamination: documents that hold a benchmark passage go.
4. Personal data: entities are replaced by surrogates, `n_chars` is counted anew.
5. Byte-level BPE: every text becomes token ids, which are decoded again as a check.

Each stage works on all its predecessor kept. Every stage but the last returns the columns it was given. Null
and empty texts have no language, so they leave in the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import bpe, contamination, language, similar_sets, surrogates
from pairloom.llm.queries import SURROGATE_KEY, bpe_digests
from pairloom.llm.shared import documents, spare_name, written


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = spare_name(docs, "found_language")
    judged = docs.withColumn(found, language.identify(docs, F.col("text"), language.learn(docs)))
    judged = judged.withColumn("lang", F.coalesce("lang", F.col(found)["lang_pred"]))
    return judged.where(~F.col(found)["rejected"]).select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of linked texts stays; ids decide only which one."""
    return similar_sets.first_of_groups(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = surrogates.replaced(docs, SURROGATE_KEY)
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, `n_tokens`, the ids, and digests of ids and decoded text."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = docs.select("doc_id", "text")
    coded = rows.select("doc_id", bpe.encode(rows, F.col("text"), path, public_tokenizers.PATTERN).alias("ids"))
    coded = coded.select("doc_id", "ids", bpe.decode(coded, F.col("ids"), path).alias("data"))
    return bpe_digests(coded, "ids")


STAGES = [
    ("language_id", identified),
    ("ngram_jaccard", without_near_copies),
    ("decontamination", decontaminated),
    ("surrogates", without_personal_data),
    ("byte_bpe", encoded),
]

#: Compression, set joins over hashes and tokenizers are beyond SQL: tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
