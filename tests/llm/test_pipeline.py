"""The stages of the corpus pipeline on rows whose ids are null or repeated."""

import base64
import hashlib
import random
import re

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from pairloom.llm import similar_sets

SCHEMA = "doc_id bigint, text string, row string, digest string"


def text_of(seed, words=30):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(words))


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, str(n), "d") for n, (i, t) in enumerate(rows)], SCHEMA).repartition(3)
    out = corpus_pipeline.without_near_copies(spark, docs, "")
    assert out.columns == docs.columns
    return sorted(int(r["row"]) for r in out.collect())


def test_rows_without_id_stay_one_a_group(spark):
    a, b, c, d = map(text_of, range(4))
    near = c + " more"
    # a: with an id and twice without; b: twice without; c: near copies without; d: alone without
    rows = [(None, a), (7, a), (None, a), (None, b), (None, b), (None, c), (None, near), (None, d)]
    got = kept(spark, rows)
    assert len(got) == 4 and 1 in got and 7 in got
    assert len({3, 4} & set(got)) == 1 and len({5, 6} & set(got)) == 1


def test_different_texts_under_one_id_stay(spark):
    a, b, c, d = map(text_of, range(4))
    # id 5 has three texts of its own, one of them twice, and a copy of id 2
    rows = [(5, a), (5, b), (5, b), (5, c), (2, c), (9, d), (9, d + " more")]
    got = kept(spark, rows)
    assert len(got) == 4 and {0, 4} < set(got)
    assert len({1, 2} & set(got)) == 1 and len({5, 6} & set(got)) == 1


def test_rows_with_an_empty_set_stay(spark):
    assert kept(spark, [(1, None), (1, ""), (None, " \t\n"), (None, ""), (2, "a b"), (3, "A  b")]) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("seed", [1])
def test_one_row_of_every_group_of_all_pairs(spark, seed):
    from tests.llm.test_sets import near_copies, shingles

    rows = near_copies(seed)[:120]
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= similar_sets.PERCENT * len(a | b) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    got = kept(spark, rows)
    full = [i for i in got if sets[i]]
    assert sorted(label[i] for i in full) == sorted({label[i] for i, s in enumerate(sets) if s})
    for i in full:
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        assert rows[i][0] == min(ids, default=None)
    assert [i for i in got if not sets[i]] == [i for i, s in enumerate(sets) if not s]


def writer(seed):
    """Texts of an invented language with words of its own."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdefghijklmnoprstuvyz") for _ in range(draw.randint(3, 9))) for _ in range(300)]
    return lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))


def test_all_stages_on_one_table(spark, tmp_path):
    """Null and repeated ids, copies, a benchmark passage, personal data, texts of no language."""
    one, two = writer(1), writer(2)
    rows = [(i, one(60) if i % 2 else two(60), "one" if i % 2 else "two", "s", 0) for i in range(60)]
    item = one(30)
    first, near = one(80), one(80)
    rows += [
        (100, first, "one", "hot", 0), (101, first, "one", "hot", 0), (None, first, None, "hot", 0), (99, first + " more", "one", "hot", 0),
        (None, near, None, "s", 0), (None, near, None, "s", 0), (102, two(20) + " " + item + " " + two(20), "two", "s", 0),
        (103, f"{one(30)} write to jo.doe@mail.org or Mr Smith {one(30)}", "one", "s", 0),
        (104, f"{one(30)} again jo.doe@mail.org {one(30)}", "one", "s", 0),
        (105, None, "one", "s", 0), (106, "", "one", "s", 0), (107, "12 34 56 !!", "one", "s", 0), (5, two(60), "two", "s", 0),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id int, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {}
    for r in out:
        text = library.decode(r["ids"])
        assert library.encode_ordinary(text) == r["ids"] and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
        texts.setdefault(r["doc_id"], []).append(text)
    kept = {i: sorted(t) for i, t in texts.items()}
    # the least id of the copies; one of the copies without id; both texts under id 5
    expect = {i: [t for j, t, *_ in rows if j == i] for i in [*range(60), 99, 103, 104]}
    expect[None] = [near]
    assert set(kept) == set(expect)
    for i, want in expect.items():
        if i not in (103, 104):
            assert kept[i] == sorted(want)
    (with_name,), (with_mail,) = kept[103], kept[104]
    assert "jo.doe@mail.org" not in with_name + with_mail and "Mr Smith" not in with_name
    mail = re.search(r"\S+@\S+", with_name).group()
    assert re.search(r"\S+@\S+", with_mail).group() == mail
    assert with_name.split()[:30] == rows[-6][1].split()[:30]


def test_all_stages_on_an_empty_table(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id int, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
