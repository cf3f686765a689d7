import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.functions import text as tx
from pairloom.functions import tokens
from pairloom.functions.arrays import argmax_ids
from pairloom.functions.tokens import byte_ids
from pairloom.operators import prepare as prep
from pairloom.operators.tokenizers import ByteTokenizer, WorkerTokenizer
from pairloom.operators.validate import invalid_counts, require_valid, validate_pairs


def test_validation_reasons(pairs_of):
    df = pairs_of(
        ("en", "a", "b"), ("EN", "a", "b"), (" en", "a", "b"), ("", "a", "b"), (None, "a", "b"), ("zh", None, "b"),
        ("id", "a", None), ("en", "", ""), (None, None, None),
    )
    checked = validate_pairs(df)
    reasons = {r["id"]: r["reasons"] for r in checked.collect()}
    assert reasons == {
        0: [], 1: ["lang_unsupported"], 2: ["lang_unsupported"], 3: ["lang_unsupported"], 4: ["lang_missing"],
        5: ["raw_missing"], 6: ["clean_missing"], 7: [], 8: ["lang_missing", "raw_missing", "clean_missing"],
    }
    assert {r["reason"]: r["n_rows"] for r in invalid_counts(checked).collect()} == {
        "lang_unsupported": 3, "lang_missing": 2, "raw_missing": 2, "clean_missing": 2,
    }
    with pytest.raises(ValueError, match="lang_unsupported"):
        require_valid(checked)
    require_valid(validate_pairs(pairs_of(("en", "a", ""))))


def test_columns_of_other_types_are_invalid(spark):
    df = spark.createDataFrame([("en", 1, "x")], "lang string, raw int, clean string")
    assert validate_pairs(df).first()["reasons"] == ["raw_missing"]


def python_ids(text, budget=None):
    body = [b + 3 for b in text.encode()]
    return (body if budget is None else body[: budget - 1]) + [1]


TEXTS = ["", "a", "aé中\n\x00😀", "\x1c \t", "x" * 30]


@pytest.mark.parametrize("budget", [None, 1, 2, 5, 31])
def test_byte_ids(spark, budget):
    df = spark.createDataFrame([(t,) for t in [None, *TEXTS, None]], "t string").coalesce(1)
    got = [r[0] for r in df.select(byte_ids(F.col("t"), budget)).collect()]
    assert got == [None, *(python_ids(t, budget) for t in TEXTS), None]


def test_byte_ids_of_slices():
    """Nulls over bytes, slices and empty batches."""
    whole = pa.Array.from_buffers(
        pa.binary(), 4, [pa.py_buffer(bytes([0b1011])), pa.py_buffer(np.array([0, 1, 2, 4, 4], np.int32)), pa.py_buffer(b"abcd")]
    )
    assert tokens.ids_of_bytes(whole).to_pylist() == [[100, 1], [101, 1], None, [1]]
    assert tokens.ids_of_bytes(whole.slice(1, 2)).to_pylist() == [[101, 1], None]
    assert tokens.ids_of_bytes(whole.slice(4)).to_pylist() == []


def test_budgets_at_their_border(pairs_of):
    # "<en> " and the end marker take 6 of the budget
    df = pairs_of(("en", "x" * 4, "y" * 9), ("en", "x" * 5, "y" * 10), ("en", "", ""))
    rows = prep.tokenize_pairs(df, max_input=10, max_target=10, keep=("id",)).orderBy("id").collect()
    assert [r["is_input_truncated"] for r in rows] == [False, True, False]
    assert [r["is_target_truncated"] for r in rows] == [False, True, False]
    assert [r["length"] for r in rows] == [10, 10, 6]
    assert rows[0]["input_ids"] == rows[1]["input_ids"] == python_ids("<en> xxxx")
    assert rows[1]["labels"] == python_ids("y" * 9)
    assert rows[2]["labels"] == [1]
    flags = prep.budget_flags(df, max_input=10, max_target=10)
    assert [r["is_input_truncated"] for r in flags.orderBy("id").collect()] == [False, True, False]
    assert [r["id"] for r in prep.skip_over_budget(flags).orderBy("id").collect()] == [0, 2]
    assert tuple(prep.skipped_count(flags).first()) == (3, 1)
    assert tuple(prep.truncation_counts(flags, by=None).first()) == (3, 1, 1)


def test_counts_tell_the_total_from_missing_languages(pairs_of):
    df = pairs_of(("en", "a", "b"), (None, "a", "b"))
    flags = prep.budget_flags(df)
    rows = {(r["lang"], r["is_total"]): r["n_rows"] for r in prep.truncation_counts(flags).collect()}
    assert rows == {("en", False): 1, (None, False): 1, (None, True): 2}


class Letters:
    """A stand-in for a tokenizer library: one id per letter."""

    def encode_batch(self, texts):
        assert all(isinstance(t, str) for t in texts)
        return [[ord(c) for c in t] for t in texts]


def letters():
    return Letters()


def test_plug_in_tokenizer_runs_in_the_workers(spark, pairs_of):
    tokenizer = WorkerTokenizer(letters, "letters", eos_id=9)
    df = pairs_of(("en", "abcd", "xy"), ("en", "", ""), ("zh", "中", None))
    out = prep.tokenize_pairs(df, tokenizer, max_input=8, max_target=3, keep=("id",))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1, plan
    rows = out.orderBy("id").collect()
    assert rows[0]["input_ids"] == [ord(c) for c in "<en> ab"] + [9] and rows[0]["is_input_truncated"]
    assert rows[0]["labels"] == [ord("x"), ord("y"), 9] and not rows[0]["is_target_truncated"]
    assert rows[1]["length"] == 6 and rows[1]["labels"] == [9]
    assert rows[2]["labels"] is None
    flags = prep.budget_flags(df, tokenizer, 8, 3).orderBy("id").collect()
    assert [r["input_length"] for r in flags] == [10, 6, 7]
    assert [r["is_input_truncated"] for r in flags] == [True, False, False]
    assert tokenizer.identity() != ByteTokenizer().identity()


def test_strip_matches_python(spark):
    texts = ["\xa0\u3000 a b \n\x1c", "\ufeffa ", "", " \t\n", "a\u200b", "\x85x "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(tx.strip_text(F.col("t"))).collect()]
    assert got == [t.strip() for t in texts]


@pytest.mark.parametrize("n", [109, 110, 111])
def test_preview_counts_characters(spark, n):
    text = "é😀" * 60
    df = spark.createDataFrame([(text[:n],)], "t string")
    want = text[:n][:110] + ("..." if n > 110 else "")
    assert df.select(tx.preview_text(F.col("t"), 110)).first()[0] == want


def test_argmax_on_ties_and_nan(spark):
    rows = [([[1.0, 3.0, 3.0], [1.0, float("nan"), 3.0], [-5.0, -1.0, -2.0]],)]
    df = spark.createDataFrame(rows, "logits array<array<float>>")
    assert df.select(argmax_ids(F.col("logits"))).first()[0] == [1, 1, 1]


@pytest.mark.parametrize(
    "a, b, want",
    [
        ([], [], 0), (["x"], [], 1), (["x", "x", "y"], ["x"], 2), (["x"], ["x", "x", "z"], 0),
        (["b", "a", "b", "c", "b"], ["b", "c", "c", "a"], 2), (["", ""], [""], 1),
    ],
)
def test_multiset_excess(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    assert df.select(tx.multiset_excess(F.col("a"), F.col("b"))).first()[0] == want
