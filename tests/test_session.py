import os
from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F

from pairloom.operators.accuracy import masked_token_accuracy
from pairloom.operators.chunks import chunk_pairs
from pairloom.operators.prepare import tokenize_pairs
from pairloom.operators.tokenizers import WorkerTokenizer
from pairloom.session import BATCH_BYTES, ready_workers, shared_folder


def session(master, application, folder=None):
    """A session as far as the helper looks at it; the real one of the tests may have the key set."""
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: folder if name == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, applicationId=application),
    )


def test_the_named_folder_wins():
    assert shared_folder(session("spark://x", "a", "s3a://bucket/dir/")) == "s3a://bucket/dir"


def test_a_local_session_keeps_its_own_folder():
    first = shared_folder(session("local[8]", "app-1"))
    assert os.path.isdir(first) and shared_folder(session("local[8]", "app-1")) == first
    assert shared_folder(session("local", "app-2")) != first


def test_a_cluster_needs_a_named_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn", "app-3"))


def test_a_real_session_without_the_key(spark):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        assert os.path.isdir(shared_folder(spark))


BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


class BatchSize:
    """Every text has as many tokens, and as first id, as its batch has letters."""

    def encode_batch(self, texts):
        return [[sum(map(len, texts))] for _ in texts]

    def count_batch(self, texts):
        return [sum(map(len, texts)) for _ in texts]


def fresh(spark, rows, size):
    """A session with Spark's settings, and so many pairs of that size in one partition of it."""
    text = F.repeat(F.lit("x"), size)
    return spark.newSession().range(0, rows, 1, 1).select("id", F.lit("en").alias("lang"), text.alias("raw"), text.alias("clean"))


def test_texts_go_to_the_tokenizer_in_batches_of_bounded_bytes(spark):
    ids = tokenize_pairs(fresh(spark, 300, 60_000), WorkerTokenizer(BatchSize, "sizes", eos_id=1), None, None)
    largest = ids.agg(F.max(F.col("input_ids")[0] + F.col("labels")[0])).first()[0]
    assert largest < 9 << 20  # 36 MB in all


def test_pairs_are_cut_in_batches_of_bounded_bytes(spark):
    pairs = fresh(spark, 300, 60_000)
    chunk_pairs(pairs, "id")
    assert pairs.sparkSession.conf.get(BYTES) == BATCH_BYTES


def test_ids_are_scored_in_batches_of_bounded_bytes(spark):
    ids = fresh(spark, 2, 1).select(F.array("id").alias("predictions"), F.array("id").alias("labels"))
    assert masked_token_accuracy(ids).first()["n_hits"] == 2
    assert ids.sparkSession.conf.get(BYTES) == BATCH_BYTES


def test_a_batch_size_of_the_session_stays(spark):
    session = spark.newSession()
    session.conf.set(BYTES, "1m")
    ready_workers(session)
    assert session.conf.get(BYTES) == "1m"
