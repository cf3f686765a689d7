import json

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from pairloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, lang string, sequence_id string, place string"
TEXTS = [
    None, "", " ", "word", "word", "don't we've\n\n  tabs\tand 123,456 <|endoftext|> done", "数据 mañana straße " * 40,
    "a" * 3000, " " * 5000, "One line.\n" * 900, "x y " * 3,
]


@pytest.fixture
def docs(spark):
    rows = [(i, t, None, "q", "p") for i, t in enumerate(TEXTS)] + [(None, "word", None, "q", "p"), (4, "word", None, "q", "p")]
    return spark.createDataFrame(rows, SCHEMA)


def test_lengths_are_the_binary_digits():
    for n in [*range(1, 70), 1023, 1024, 1025, 5000]:
        sizes = packing.cut(n)
        assert sum(sizes) == n and sizes == sorted(sizes, reverse=True)
        short = [s for s in sizes if s < 1024]
        assert len(set(short)) == len(short) and all(s & (s - 1) == 0 for s in sizes)


def test_pieces_join_back_to_the_library_ids(spark, docs):
    library = tokenizers.Tokenizer.from_file(PATH)
    found = {}
    for r in packing.pieces(docs, PATH).orderBy("id", "start").collect():
        assert r["length"] * 4 == len(r["ids"])
        found.setdefault((r["id"], r["doc_tokens"]), []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    for i, text in enumerate(TEXTS):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        copies = 2 if i == 4 else 1
        parts = found[i, len(ids)]
        assert sorted(parts) == sorted(
            [(a, ids[a : a + n]) for a, n in zip(np.cumsum([0, *packing.cut(len(ids))]).tolist(), packing.cut(len(ids)))] * copies
        )
    assert [ids for (i, _), ids in found.items() if i is None] == [[(0, [*library.encode("word").ids, 0])]]


def test_long_texts_are_cut_without_change(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = ["the", "naïve", "12", "!?", "don't", "数据", "\n", "  two", "x" * 50]
    text = " ".join(rng.choice(words, 4000)) + " " * 300 + "end"
    encoder = packing.Encoder(PATH)
    whole = encoder.library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(packing, "PART", 64)
    parts = encoder.encode(text)
    assert len(parts) > 50
    assert np.concatenate(parts).tolist() == whole


def test_only_plain_byte_files_are_read_as_ranks(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    assert packing._ranked(spec) is not None
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {**spec["pre_tokenizer"], "add_prefix_space": True}}):
        assert packing._ranked({**spec, **change}) is None
    swapped = {**spec["model"], "merges": spec["model"]["merges"][::-1]}
    assert packing._ranked({**spec, "model": swapped}) is None


def test_sequences_are_numbered_without_gaps(spark, docs):
    found = packing.pieces(docs, PATH)
    rows = packing.bucketed(found).collect()
    assert sorted(r["sequence_id"] for r in rows) == list(range(found.count()))
    for size in {r["length"] for r in rows}:
        bucket = [r for r in rows if r["length"] == size]
        assert sorted(r["place"] for r in bucket) == list(range(len(bucket)))
        assert len({r["sequence_id"] - r["place"] for r in bucket}) == 1


def test_clashing_names_and_empty_tables(spark, docs):
    named = packing.pieces(docs, PATH).withColumn("turn", F.lit("own")).withColumn("cell", F.lit("own"))
    rows = packing.bucketed(named).collect()
    assert {(r["turn"], r["cell"]) for r in rows} == {("own", "own")}
    none = packing.bucketed(packing.pieces(docs.limit(0), PATH))
    assert none.count() == 0 and "sequence_id" in none.columns


def test_longest_is_a_power_of_two(docs):
    with pytest.raises(ValueError, match="power of two"):
        packing.pieces(docs, PATH, longest=1000)
