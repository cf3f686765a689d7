"""Decontamination and the Jaccard join against brute force; shards by their law."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import contamination, sharding, similar_sets
from pairloom.llm import shingles as hashed

SCHEMA = "doc_id bigint, text string, n bigint, key string, digest string"


def table(spark, rows):
    """Documents with further columns by names that the operators use themselves."""
    return spark.createDataFrame([(i, t, 0, "k", "d") for i, t in rows], SCHEMA)


def shingles(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows):
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                label[root(i)] = root(j)
    best = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            best[root(i)] = min(best.get(root(i), key), key)
    return sorted(
        (str(key), len(s), key if not s else best.get(root(i))) for i, ((key, _), s) in enumerate(zip(rows, sets))
    )


def near_copies(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(3))
    passage = [word() for _ in range(40)]
    rows = [(None, "lonely text without id"), (0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one TWO"), (5, "one two three")]
    for base in range(12):
        text = [word() for _ in range(draw.choice((6, 20, 60, 150)))]
        if base % 3 == 0:
            text = passage + text[:30]
        for _ in range(draw.choice((1, 2, 6, 40))):
            copy = list(text)
            for _ in range(draw.choice((0, 0, 1, 2, 4))):
                copy[draw.randrange(len(copy))] = word()
            rows.append((len(rows) + 100, " ".join(copy)))
            if draw.random() < 0.2:
                rows.append(draw.choice((rows[-1], (None, rows[-1][1]), (len(rows) + 100, rows[-1][1].upper()))))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, long_list, share, most", [
    (1, 32, 1 / 200, 1000), (2, 2, 1 / 200, 1000), (3, 32, 1 / 20, 1000), (4, 2, 1 / 4, 1000), (5, 32, 1 / 200, 10), (6, 32, 1 / 200, 0),
])
def test_groups_equal_all_pairs(spark, monkeypatch, seed, long_list, share, most):
    monkeypatch.setattr(similar_sets, "MOST_STOPS", most)
    monkeypatch.setattr(similar_sets, "LONG_LIST", long_list)
    monkeypatch.setattr(similar_sets, "STOP_SHARE", share)
    monkeypatch.setattr(similar_sets, "RANGE_TOKENS", 500)
    rows = near_copies(seed)
    got = similar_sets.similar_groups(table(spark, rows).repartition(5)).collect()
    assert sorted((str(r["id"]), r["n_shingles"], r["component_id"]) for r in got) == brute_groups(rows)


def test_groups_of_an_empty_table(spark):
    assert similar_sets.similar_groups(table(spark, [])).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)], "a bigint, b bigint")
    assert {r["label"] for r in similar_sets.components(links).collect()} == {0}


def words(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute_contamination(docs, items):
    windows = []
    for key, text in items:
        w = words(text)
        if key is not None and w:
            windows += [(str(key), w[i : i + 10]) for i in range(max(1, len(w) - 9))]
    out = []
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for name, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    names.add(name)
        out.append((str(key), len(w), len(hit), sorted(names), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("slots", [1, 256])
def test_contamination_equals_brute_force(spark, monkeypatch, slots):
    monkeypatch.setattr(contamination, "SLOTS_EACH", slots)
    draw = random.Random(slots)
    vocabulary = ["the", "of", "An", "é", "zz9"] + [f"w{i}" for i in range(30)]
    some = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(draw.choice((1, 2, 4, 9, 10, 11, 25))))) for i in range(12)]
    items += [(None, "w1 w2"), (50, None), (51, "-- !"), (52, items[0][1]), (53, items[5][1].upper())]
    docs = [(None, items[6][1]), (1, None), (2, ""), (3, ",.;"), (4, items[7][1]), (4, items[7][1])]
    for i in range(40):
        text = some(draw.randint(1, 60))
        if draw.random() < 0.6:
            at = draw.randrange(len(text))
            text[at:at] = words(draw.choice(items)[1])
        docs.append((i + 10, draw.choice((" ", ", ")).join(text)))
    rows = spark.createDataFrame(items, "item_id int, text string")
    found = contamination.contamination(table(spark, docs), rows, ["doc_id", "n"])
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found.collect())
    assert got == brute_contamination(docs, items)
    kept = contamination.without_contaminated(table(spark, docs), rows)
    assert kept.count() == sum(not r[-1] for r in got) and kept.columns == table(spark, []).columns


def test_the_byte_map_is_small_and_lets_few_pass(spark):
    """The driver writes the plan's text, in which each byte of the map takes two letters."""
    shingles = spark.range(4000).select(F.xxhash64("id").alias("hash"))
    byte_map, slots, probes = contamination._byte_map(shingles)
    assert len(byte_map) == slots <= 32 * 4000
    slot = contamination._slots(F.xxhash64("id"), slots, probes)
    rows = spark.range(24000).select("id", slot.alias("at")).collect()
    passed = [all(byte_map[i] for i in r["at"]) for r in rows]
    assert all(passed[:4000]) and sum(passed[4000:]) < 20000 / 200


def test_contamination_of_empty_tables(spark):
    items = spark.createDataFrame([(1, None)], "item_id int, text string")
    found = contamination.contamination(table(spark, [(1, "a b"), (2, None)]), items, ["doc_id"]).collect()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in found] == [(2, 0, False), (0, 0, False)]
    full = spark.createDataFrame([(1, "a b c")], "item_id int, text string")
    assert contamination.contamination(table(spark, []), full, ["doc_id"]).count() == 0


@pytest.mark.parametrize("hot", [0, 900])
def test_shards_are_even_and_slots_gapless(spark, hot):
    draw = random.Random(hot)
    rows = [(i if i % 7 else None, "same text" if i < hot else "x" * draw.randint(0, 400)) for i in range(2700)]
    rows += [(5, None), (5, ""), (5, "")]
    got = sharding.pack(table(spark, rows).repartition(4)).collect()
    assert len(got) == len(rows)
    loads, slots = {}, {}
    for r in got:
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(loads) == set(range(24)) and max(loads.values()) < 1.02 * min(loads.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) < 1.5 * min(map(len, slots.values()))


@pytest.mark.parametrize("copies, groups, alone", [(5, 40, 800), (60, 80, 0), (3, 400, 3600), (100, 200, 80_000), (2400, 2, 0)])
def test_groups_are_cut_only_where_they_fit_nowhere(spark, copies, groups, alone):
    """Tables of 1,000, 4,800 and 100,000 rows. No group up to a tenth of a shard is cut; sizes differ by 3 %."""
    draw = random.Random(copies)
    rows = [f"group {g} " + "y" * (g * 7 % 90) for g in range(groups) for _ in range(copies)]
    rows += [f"{i} " + "x " * draw.randint(0, 60) for i in range(alone)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id bigint, text string").repartition(6)
    packed = sharding.pack(df).join(df.withColumnRenamed("doc_id", "id"), "id").groupBy("shard", "text").agg(
        F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    pieces, loads, counts = {}, [0] * 24, [0] * 24
    for r in packed:
        pieces[r["text"]] = pieces.get(r["text"], 0) + 1
        loads[r["shard"]] += r["size"]
        counts[r["shard"]] += r["n"]
    shard = len(rows) / 24
    cut = sum(n > 1 for n in pieces.values())
    assert cut == 0 if copies <= shard / 10 else cut <= groups / 4 + 2 * (copies > shard)
    assert max(loads) < 1.03 * min(loads) or copies > shard / 10
    assert max(loads) < 1.25 * min(loads) and max(counts) < 1.8 * min(counts)


def test_shards_of_few_rows(spark):
    assert sharding.pack(table(spark, [])).count() == 0
    assert [r["slot"] for r in sharding.pack(table(spark, [(1, "a")])).collect()] == [0]


def test_place_takes_the_highest_dot_product():
    import numpy as np

    shard = sharding.place(np.array([[4, 4], [4, 1], [1, 4], [1, 1]], float), 2)
    assert shard[0] != shard[1]
    assert len(set(shard)) == 2


def test_words_longer_than_a_piece_are_hashed_in_steps(monkeypatch):
    rng = np.random.default_rng(4)
    texts = ["", " ", "a" * 40, " " + "b" * 16 + " c", "x" * 15 + " ", "x" * 16 + "y"]
    texts += ["".join(rng.choice(list("ab \n"), 90)) for _ in range(200)]
    whole = [hashed.word_hashes(np.frombuffer(t.encode(), np.uint8)) for t in texts]
    monkeypatch.setattr(hashed, "PIECE", 16)
    for text, (starts, hashes) in zip(texts, whole):
        got = hashed.word_hashes(np.frombuffer(text.encode(), np.uint8))
        assert got[0].tolist() == starts.tolist() and got[1].tolist() == hashes.tolist()
        words = text.lower().split()
        assert len(starts) == len(words) and len(set(hashes.tolist())) == len(set(words))


@pytest.mark.parametrize("most", [0, 3, 1000])
def test_the_number_of_stop_shingles_is_bounded(spark, monkeypatch, most):
    monkeypatch.setattr(similar_sets, "MOST_STOPS", most)
    rows = spark.createDataFrame([(i, n) for i, n in enumerate([9, 9, 8, 7, 7, 7, 3])], "token bigint, n bigint")
    kept = {r["token"] for r in similar_sets._most_frequent(rows).collect()}
    assert kept == {0: set(), 3: {0, 1, 2}, 1000: set(range(7))}[most]
