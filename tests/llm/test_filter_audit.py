import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import filter_audit as audit

DOCS = "doc_id bigint, text string, lang string, mask string, part string"
LABELS = "doc_id bigint, quality int, toxic int, text string"


def brute(docs, labels):
    """All figures straight from their definitions, row by row."""
    quality, toxic = {}, {}
    for i, q, t in labels:
        if i is not None:
            quality[i] = max(quality.get(i, 0), q or 0)
            toxic[i] = max(toxic.get(i, 0), t or 0)
    rows = []
    for i, text, lang in docs:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        failed = ""
        failed += "A" * (len(words) < 100)
        failed += "B" * (100 * len(set(words)) < 80 * len(words))
        failed += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text))
        failed += "D" * bool(re.search(r"[#$%&*|]", text))
        failed += "E" * (i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in docs))
        rows.append((lang or "", failed, quality.get(i) == 1, toxic.get(i) == 1))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for step, own in enumerate(order, 1):
                before = set(order[: step - 1])
                fails = [r for r in mine if own in r[1]]
                removed = [r for r in fails if not before & set(r[1])]
                shapley[own] += len(removed)
                out[part, order, step] = [
                    sum(not (before | {own}) & set(r[1]) for r in mine), len(removed), len(fails) - len(removed),
                    sum(r[1] == own for r in mine), sum(r[2] for r in removed), sum(r[3] for r in removed),
                ]
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(shapley[order[step - 1]])
    return out


FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def run(spark, docs, labels):
    df = spark.createDataFrame([(*d, "m", "p") for d in docs], DOCS)
    found = audit.audit(df, spark.createDataFrame([(*r, "t") for r in labels], LABELS)).collect()
    assert len(found) == len({(r["part"], r["filter_order"], r["step"]) for r in found})
    return {(r["part"], r["filter_order"], r["step"]): [r[f] for f in FIGURES] for r in found}


def test_equals_brute_force(spark):
    rng = random.Random(5)
    long = " ".join(f"w{i}" for i in range(150))
    texts = [None, "", " \x0b", long, long + " #", long.upper(), "word " * 200, "Ünï cödé ABC", "a|b", "ß\x1cx y"]
    docs = [(rng.choice([None, *range(30)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(120)]
    docs += [(7, long, "en")] * 20
    labels = [(rng.choice([None, *range(40)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(40)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_no_labels_and_no_rows(spark):
    docs = [(1, "x", None), (2, "x", None)]
    assert run(spark, docs, []) == brute(docs, [])
    empty = audit.audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS))
    assert empty.collect() == []


def test_words_of_long_texts_are_counted_whole(monkeypatch):
    data = ("word other\t" * 50 + "third\n" + "x" * 300).encode()
    whole = audit.word_counts(data)
    monkeypatch.setattr(audit, "PART", 16)
    assert audit.word_counts(data) == whole == (102, 4)


def test_sketches_clear_unique_texts_only(spark):
    """Merged over tasks and ranges, no repeat is cleared, and nearly all unique texts are."""
    width = audit.counters_for(4000)
    rows = spark.range(4000).select("id", F.when(F.col("id") < 200, F.col("id") % 100).otherwise(F.col("id")).alias("t"))
    docs = rows.select("id", F.col("t").cast("string").alias("text"), F.lit("x").alias("lang")).repartition(7)
    masked = audit._masked(docs, "id", "text", "lang", width)
    bits = audit.crowded(masked.where("mask is null").select("range", "where", "counts"), width)
    keys = masked.where("mask is not null").select("id", "digest")
    left = {r["id"] for r in audit.possible_repeats(keys, "digest", bits, width).collect()}
    assert set(range(200)) <= left
    assert len(left) < 250


def test_sketches_add_up():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 50, (40, 3))
    parts = [audit.touched(rows[:15]), audit.touched(rows[15:])]
    where, counts = audit.added(*parts)
    expect = np.zeros(50, int)
    for row in rows:
        expect[np.unique(row)] += 1
    assert dict(zip(where.tolist(), counts.tolist())) == {i: min(n, 2) for i, n in enumerate(expect.tolist()) if n}


@pytest.mark.parametrize("rows", [0, 1, 10_000, 10**7, 10**12])
def test_the_sketch_is_bounded(rows):
    width = audit.counters_for(rows)
    assert audit.LEAST_COUNTERS <= width <= audit.MOST_COUNTERS and width & (width - 1) == 0
