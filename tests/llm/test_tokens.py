"""Token counts and byte-level BPE against the libraries, and the prefix table against merging."""

import base64
import random

import pyarrow as pa
import public_tokenizers as P
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairloom.llm import bpe, token_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
EDGES = [
    "", " ", "a", "\n\n  a", "a'll we're 's ''s  \n 's  x\n\n y\t z   ", " " * 3000 + "a", "=" * 3000, "\x00\x00", "aaaa" * 2000,
    "字字 １２ é́ ñ　x", "<|endoftext|>", "a<|endoftext|> b'll<|endoftext|>", "don't x" * 300, "\U0001f600 ok 12345",
]


def texts():
    draw = random.Random(3)
    return EDGES + ["".join(draw.choice(" \n\t'srtevlmdLAé1!- 　字") for _ in range(draw.randint(0, 80))) for _ in range(1500)]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.from_rank_file(RANKS)


def test_encoding_equals_the_library_and_decodes_back(library):
    rows = texts()
    ids = bpe.encode_batch(pa.array(rows), RANKS, P.PATTERN)
    assert ids.to_pylist() == [library.encode_ordinary(t) for t in rows]
    assert bpe.decode_batch(ids, RANKS).to_pylist() == [t.encode() for t in rows]


def test_fit_of_two_tokens_is_that_of_merging(vocabulary):
    draw = random.Random(5)
    ids = [i for i, data in vocabulary.of_id.items() if len(data) <= 6]
    for _ in range(20_000):
        a, b = draw.choice(ids), draw.choice(ids)
        assert vocabulary.fits(a, b) == (vocabulary.merge(vocabulary.of_id[a] + vocabulary.of_id[b]) == [a, b])


def test_prefix_table_appends_and_edits(vocabulary):
    draw = random.Random(7)
    some = lambda n: bytes(draw.choice(b"abther ") for _ in range(draw.randint(0, n)))
    for _ in range(150):
        data, more = some(200), some(8)
        table = bpe.PrefixTable(vocabulary, data)
        assert table.ids() == vocabulary.merge(data)
        table.append(more)
        assert table.ids() == vocabulary.merge(data + more)
        start = draw.randint(0, len(table.data))
        stop, new, before = min(len(table.data), start + draw.randint(0, 5)), some(5), table.data
        table.edit(start, stop, new)
        assert table.data == before[:start] + new + before[stop:] and table.ids() == vocabulary.merge(table.data)


def test_an_edit_far_from_the_end_computes_few_entries(vocabulary):
    table = bpe.PrefixTable(vocabulary, b"the other day they went there " * 400)
    assert table.edit(10, 12, b"xyz") < 2 * vocabulary.longest + 50


def test_counts_equal_the_library():
    rows = texts()
    library = Tokenizer.from_file(JSON)
    want = [len(e.ids) for e in library.encode_batch(rows, add_special_tokens=False)]
    assert token_counts.count_batch(pa.array(rows), JSON).to_pylist() == want


@pytest.mark.parametrize("chunk", [1, 2, 7, 256])
def test_chunk_maps_compose_to_the_same_borders(chunk):
    classes = token_counts._classes()[[ord(c) for c in "".join(texts()[:60]).replace("\U0001f600", "x")]]
    assert (token_counts.borders(classes, chunk) == token_counts.borders(classes, len(classes))).all()


def test_caches_that_start_again_change_nothing(monkeypatch):
    rows = texts()[:300]
    want = token_counts.count_batch(pa.array(rows), JSON).to_pylist()
    monkeypatch.setattr(token_counts, "KEPT", 50)
    ranks, specials = token_counts.read_json_vocabulary(JSON)
    assert token_counts.Counter(ranks, specials).counts(rows).tolist() == want
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    encoder = bpe.Encoder(bpe.Vocabulary.from_rank_file(RANKS), P.PATTERN)
    for _ in range(3):
        assert [r.tolist() for r in encoder.encode(rows)] == bpe.encode_batch(pa.array(rows), RANKS, P.PATTERN).to_pylist()


def test_nulls_empty_tables_and_other_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "", "y")], "doc_id int, text string, ids string")
    coded = df.withColumn("own", bpe.encode(df, F.col("text"), RANKS, P.PATTERN))
    rows = coded.withColumn("data", bpe.decode(coded, F.col("own"), RANKS)).withColumn(
        "n", token_counts.token_counts(df, F.col("text"), JSON)
    )
    assert [(r["ids"], r["own"], bytes(r["data"]), r["n"]) for r in rows.collect()] == [
        ("x", [], b"", 0), ("y", [], b"", 0), ("y", [], b"", 0)
    ]
    assert rows.where("doc_id > 9").count() == 0


def test_the_fast_matcher_equals_the_pattern():
    """Every character under U+0300 alone, and between letters, digits, blanks and marks."""
    find, exact = bpe.matcher(P.PATTERN), regex.compile(P.PATTERN).findall
    assert bpe._USUAL == P.PATTERN
    for c in map(chr, range(0x300)):
        for text in (c, f"a{c}b", f"1{c}2", f" {c} ", f"{c}{c}\n", f"x {c}", f"'{c}s", f"_{c}_", f"!{c}?"):
            assert find(text) == exact(text), repr(text)
    draw = random.Random(6)
    for _ in range(2000):
        text = "".join(draw.choices("ab'sdé1² _!\n\t\x1c\x85\xa0Ǆſ", k=draw.randrange(30)))
        assert find(text) == exact(text), repr(text)
