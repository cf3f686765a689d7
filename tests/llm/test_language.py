"""Language ID: what is learned, and what is told by it."""

import random

import zstandard
from pairloom.llm import language
from pyspark.sql import functions as F


def writer(seed):
    """Texts of an invented language with words of its own."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdefghijklmnoprstuvyz") for _ in range(draw.randint(3, 9))) for _ in range(40)]
    return lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))


def told(spark, rows, asked):
    learned = language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    docs = spark.createDataFrame([(t,) for t in asked], "text string")
    found = docs.select("text", language.identify(docs, F.col("text"), learned).alias("f")).collect()
    return learned, {r["text"]: r["f"]["lang_pred"] for r in found}


def test_languages_of_long_texts_only_are_learned(spark):
    short, book, numbers = writer(1), writer(2), writer(3)
    rows = [(i, short(60), "short") for i in range(30)] + [(100 + i, book(3000), "book") for i in range(5)]
    rows += [(200, "1 " * 9000 + numbers(900) + " 2" * 90000 + "\n" * 90000, "numbers")]
    asked = {short(40): "short", book(40): "book", numbers(40): "numbers"}
    learned, got = told(spark, rows, asked)
    assert list(learned) == ["short", "book", "numbers"] and got == asked
    assert max(map(len, learned.values())) <= language.DICTIONARY_BYTES
    assert set(told(spark, rows[30:35], [book(40)])[1].values()) == {"book"}


def test_rare_languages_are_learned(spark):
    writers = {f"l{i:02}": writer(i) for i in range(70)}
    rows = [(i, w(60), name) for name, w in writers.items() for i in range(3 if name < "l66" else 1)]
    asked = {w(40): name for name, w in list(writers.items())[60:]}
    learned, got = told(spark, rows, asked)
    assert set(learned) == set(writers) and got == asked


def test_rows_under_one_key_and_tiny_languages_are_learned(spark):
    text, other = writer(1), writer(2)
    same = other(50)
    rows = [(5, same, "same")] * 3000 + [(5, text(50), "text") for _ in range(500)] + [(6, "ok", "tiny"), (7, "12", "none")]
    assert set(language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))) == {"same", "text", "tiny"}


def test_nothing_to_learn_from(spark):
    rows = [(None, "some text", "en"), (1, None, "en"), (2, "text", None), (3, "12", "en")]
    learned, got = told(spark, rows, ["some text", ""])
    assert learned == {} and set(got.values()) == {"und"}


def test_predictions_equal_plain_compression(spark):
    """Every text is compressed on its own with every dictionary, block by block."""
    writers = {f"l{i}": writer(i) for i in range(4)}
    rows = [(i, w(60), name) for name, w in writers.items() for i in range(20)]
    learned = language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    draw = random.Random(7)
    texts = [None, "", "12 34 !?", "é", " \n"]
    for _ in range(40):
        parts = [draw.choice(list(writers.values()))(draw.choice((1, 3, 20, 900))) for _ in range(draw.choice((1, 1, 2)))]
        texts.append(draw.choice((" ", "\n", " 99 ")).join(parts).title())
    texts += texts[5:8]  # repeated rows
    docs = spark.createDataFrame([(t, "own", "o") for t in texts], "text string, lang_pred string, score string")
    got = docs.select("text", "lang_pred", language.identify(docs, F.col("text"), learned).alias("f")).collect()
    assert len(got) == len(texts) and {r["lang_pred"] for r in got} == {"own"}
    names = list(learned)
    for r in got:
        body = language.normal(r["text"] or "").encode()
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["f"]["lang_pred"], r["f"]["score"], r["f"]["rejected"]) == ("und", 0.0, True)
            continue
        sizes = []
        for name in names:
            content = zstandard.ZstdCompressionDict(learned[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=language.LEVEL)
            plain = zstandard.ZstdCompressor(dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes.append(sum(len(plain.compress(body[i : i + language.BLOCK])) for i in range(0, len(body), language.BLOCK)))
        best = min(range(len(names)), key=lambda i: sizes[i])
        second = min(s for i, s in enumerate(sizes) if i != best)
        assert r["f"]["lang_pred"] == names[best]
        assert r["f"]["rejected"] == ((second - sizes[best]) / sizes[best] < language.MARGIN)
        assert 0 < r["f"]["score"] <= 1
