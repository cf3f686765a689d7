import hashlib
import json
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom.operators import batches, ranking
from pairloom.operators import prepare as prep
from pairloom.operators.accuracy import count_batch, masked_token_accuracy, with_argmax
from pairloom.operators.ranking import zoned_rank
from pairloom.operators.split import shuffle_limit, split_pairs
from pairloom.sources.pairs import content_key


def order(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


@pytest.mark.parametrize("n, frac, cap", [(1, 0.01, 4000), (7, 0.3, None), (500, 0.07, 20), (500, 0.5, 4000)])
@pytest.mark.parametrize("parts", [1, 7, 64])
def test_split_is_exact_for_any_partitioning(spark, n, frac, cap, parts):
    df = spark.range(n).repartition(parts)
    got = {r["id"]: r["split"] for r in split_pairs(df, "id", frac, 42, cap).collect()}
    n_val = math.ceil(frac * n)
    kept = n_val if cap is None else min(n_val, cap)
    want = {}
    for place, key in enumerate(order(range(n))):
        want[key] = "val" if place < kept else "dropped" if place < n_val else "train"
    assert got == want


def nearest_border(sizes, target):
    """Rows up to the group border nearest to the target; neither side empty where it need not be."""
    borders = [0]
    for size in sizes:
        borders.append(borders[-1] + size)
    best = min(borders, key=lambda b: (abs(b - target), b))
    if len(sizes) > 1 and target > 0 and best == 0:
        best = borders[1]
    if len(sizes) > 1 and target < borders[-1] and best == borders[-1]:
        best = borders[-2]
    return best


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("n, hot", [(2, 0), (1998, 0), (2000, 666), (4000, 0), (6000, 2000)])
@pytest.mark.parametrize("frac, cap", [(0.3, None), (0.1, 100), (0.9, None)])
def test_split_keeps_copies_together(spark, seed, n, hot, frac, cap):
    """Pairs of copies, and in some cases a third of all rows alike."""
    rows = spark.range(n).select(F.when(F.col("id") < hot, -1).otherwise(F.expr("id div 2")).alias("n"))
    df = rows.select(F.lit("en").alias("lang"), F.col("n").cast("string").alias("raw"), F.lit("x").alias("clean"))
    split = split_pairs(df.withColumn("key", content_key()), "key", frac, seed, cap)
    got = {r["key"]: (r["split"], r["count"]) for r in split.groupBy("key", "split").count().collect()}
    assert sum(count for _, count in got.values()) == n and len(got) == (n - hot) // 2 + (hot > 0)
    keys = order(got, seed)
    sizes = [got[k][1] for k in keys]
    wanted = math.ceil(frac * n)
    val, surplus = nearest_border(sizes, wanted if cap is None else min(wanted, cap)), nearest_border(sizes, wanted)
    upto = 0
    for key, size in zip(keys, sizes):
        upto += size
        assert got[key][0] == ("val" if upto <= val else "dropped" if upto <= surplus else "train")
    if len(keys) > 1:
        assert {"val", "train"} <= {side for side, _ in got.values()}


def test_split_of_an_empty_table(spark):
    assert split_pairs(spark.range(0), "id").count() == 0


def test_shuffle_limit(spark):
    got = [r["id"] for r in shuffle_limit(spark.range(300).repartition(5), "id", 40, 1).collect()]
    assert got == order(range(300), 1)[:40]
    assert shuffle_limit(spark.range(30), "id", 400).count() == 30


@pytest.mark.parametrize("k", [0, 999, 1000, 1001])
def test_shuffle_limit_of_copies(spark, k):
    assert shuffle_limit(spark.range(3000).select(F.expr("id div 7").alias("id")), "id", k).count() == k


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("unit, zones", [(1, 1 << 18), (7, 3), (50, 1), (10, 1 << 18), (1, 5)])
def test_ranks_and_zones(spark, monkeypatch, digits, unit, zones):
    monkeypatch.setattr(ranking, "MAX_ZONES", zones)
    df = spark.range(503).repartition(6)
    rows = zoned_rank(df, "id", 42, unit=unit, digits=digits).collect()
    assert {r["id"]: r["rank"] for r in rows} == {k: i + 1 for i, k in enumerate(order(range(503)))}
    assert len({r["zone"] for r in rows}) <= zones
    run_zones = {}
    for r in rows:
        run_zones.setdefault((r["rank"] - 1) // unit, set()).add(r["zone"])
    assert all(len(z) == 1 for z in run_zones.values())


def tokens(spark, lengths, label=3):
    rows = [(i, list(range(1, n + 1)), list(range(1, label + 1)), n) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "id bigint, input_ids array<int>, labels array<int>, length int")


@pytest.mark.parametrize("parts", [1, 7])
def test_length_batches(spark, parts):
    lengths = [(i * 37) % 23 + 1 for i in range(101)]
    df = tokens(spark, lengths).repartition(parts)
    rows = batches.length_batches(df, "id", batch=4, mega=3).collect()
    want = {}
    ordered = order(range(101))
    for m in range(0, 101, 12):
        group = sorted(ordered[m : m + 12], key=lambda k: (-lengths[k], k))
        for p, key in enumerate(group):
            want[key] = (m // 12 * 3 + p // 4, p % 4)
    assert {r["id"]: (r["batch_id"], r["pos"]) for r in rows} == want


def test_collate_pads_to_multiples_of_eight(spark):
    df = batches.length_batches(tokens(spark, [8, 9, 3], label=9), "id", batch=2, mega=1)
    rows = batches.collate(df, pad_id=7).orderBy("batch_id").collect()
    assert sorted(len(r["input_ids"]) for r in rows) == [1, 2]
    seen = {}
    for r in rows:
        width = len(r["input_ids"][0])
        for ids, mask, labels in zip(r["input_ids"], r["attention_mask"], r["labels"]):
            n = sum(mask)
            seen[n] = width
            assert ids == list(range(1, n + 1)) + [7] * (width - n)
            assert mask == [1] * n + [0] * (width - n)
            assert labels == list(range(1, 10)) + [-100] * 7
        assert width == -(-max(sum(m) for m in r["attention_mask"]) // 8) * 8
    assert set(seen) == {8, 9, 3}
    types = dict(batches.collate(df).dtypes)
    assert types["input_ids"] == types["labels"] == types["attention_mask"] == "array<array<bigint>>"


def test_row_level_padding_agrees_with_collate(spark):
    df = batches.length_batches(tokens(spark, [(i * 7) % 19 + 1 for i in range(40)]), "id", batch=4, mega=2)
    padded = {(r["batch_id"], r["pos"]): r for r in batches.pad_rows(df).collect()}
    for r in batches.collate(df).collect():
        for pos, ids in enumerate(r["input_ids"]):
            row = padded[r["batch_id"], pos]
            assert row["input_ids"] == ids and row["attention_mask"] == r["attention_mask"][pos]
            assert row["labels"] == r["labels"][pos]


def test_texts_are_tokenised_behind_the_shuffle(spark, pairs_of):
    df = pairs_of(*[("en", "x" * (i * 13 % 40), "é" * (i % 7)) for i in range(50)])
    tokenised = prep.tokenize_pairs(df, max_input=30, max_target=9, keep=("id",))
    want = batches.collate(batches.length_batches(tokenised, "id", batch=4, mega=3)).orderBy("batch_id").collect()
    sized = df.withColumn("length", F.least(prep.BYTES.count(prep.model_input()), F.lit(30)))
    batched = batches.length_batches(sized, "id", batch=4, mega=3)
    got = batches.collate_texts(batched, max_input=30, max_target=9)
    assert got.orderBy("batch_id").collect() == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("FlatMapGroupsInArrow") :]
    assert below.count("Exchange hashpartitioning(zone") == 1 and "input_ids" not in below.split("\n", 1)[1]
    assert below.index("Window") < below.index("Exchange")  # nothing is moved after the batches are formed


def test_rows_out_of_order_are_refused():
    def part(*places):
        z, m, b, p = zip(*places)
        return pa.RecordBatch.from_pydict({"zone": z, "mega_id": m, "batch_id": b, "pos": p})

    def read(batch):
        return [(np.ones(2), np.ones(1))] * len(batch)

    fine = [part((0, 0, 0, 0), (0, 0, 0, 1)), part((0, 0, 1, 0))]
    (record,) = batches.assemble(iter(fine), read, 0, -100, 8)
    assert record.column(0).to_pylist() == [0, 1]
    with pytest.raises(RuntimeError, match="out of order"):
        list(batches.assemble(iter(fine[::-1]), read, 0, -100, 8))


@pytest.mark.parametrize("p, y", [
    ([[1, None], [2]], [[1, -100], None]), ([None, [1, 2]], [[3], [1, 5, 2]]), ([[1, 2, 3], []], [[1], [4]]), ([], []),
])
def test_counts_equal_a_loop(p, y):
    kind = pa.list_(pa.int32())
    got = count_batch(pa.array(p, kind), pa.array(y, kind), -100).to_pylist()
    for row, a, b in zip(got, p, y):
        assert row["c"] == (None if b is None else sum(v not in (None, -100) for v in b))
        right = None if a is None or b is None else sum(u == v != -100 for u, v in zip(a, b))
        assert row["h"] == right


@pytest.mark.parametrize("wrong", [[], None])
@pytest.mark.parametrize("column", ["input_ids", "labels"])
def test_empty_sequences_are_errors(spark, column, wrong):
    df = tokens(spark, [3, 4]).withColumn(
        column, F.when(F.col("id") == 1, F.lit(wrong).cast("array<int>")).otherwise(F.col(column))
    )
    batched = batches.length_batches(df, "id")
    for build in (batches.collate, batches.pad_rows):
        with pytest.raises(PySparkException, match="empty sequence"):
            build(batched).collect()


@pytest.mark.parametrize("lengths_only", [False, True])
def test_padding_report(spark, lengths_only):
    table = tokens(spark, [8, 9, 3])
    if lengths_only:
        table = batches.sequence_lengths(table, "id")
    df = batches.length_batches(table, "id", batch=2, mega=10)
    report = {r["n_rows"]: r for r in batches.padding_report(df).collect()}
    assert report[2]["input_cells"] == 17 and report[2]["input_padding"] == 15
    assert report[1]["input_cells"] == 3 and report[1]["input_padding"] == 5
    total = batches.padding_total(batches.padding_report(df)).first()
    assert (total["n_batches"], total["n_rows"], total["cells"], total["padding"]) == (2, 3, 64, 35)
    assert total["largest_batch"] == 48
    widths = {r["n_rows"]: (r["input_width"], r["label_width"]) for r in batches.batch_widths(df).collect()}
    assert widths == {2: (16, 8), 1: (8, 8)}


def test_lengths_without_tokenising(pairs_of):
    df = pairs_of(("en", "x" * 50, "y"), ("zh", "", "é" * 9))
    lengths = prep.pair_lengths(df, max_input=20, max_target=10, keep=("id",)).orderBy("id").collect()
    assert [tuple(r) for r in lengths] == [(0, 20, 2), (1, 6, 10)]


def test_the_rows_are_shuffled_once(spark):
    df = tokens(spark, [3, 4, 5, 6])
    plan = batches.collate(batches.length_batches(df, "id"))._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(zone" in line]
    assert len(wide) == 1, plan
    assert "Exchange hashpartitioning(mega_id" not in plan and "Exchange hashpartitioning(batch_id" not in plan


def scores(spark, *rows):
    return spark.createDataFrame(list(rows), "predictions array<int>, labels array<int>")


def test_masked_accuracy(spark):
    df = scores(spark, ([1, 2, 3], [1, 9, -100]), ([5, 5], [-100, -100]))
    assert tuple(masked_token_accuracy(df).first()) == (1, 2, 0, 0.5)


@pytest.mark.parametrize("rows", [[], [([1], [-100])]])
def test_accuracy_without_counting_positions_is_zero(spark, rows):
    assert masked_token_accuracy(scores(spark, *rows)).first()["token_accuracy"] == 0.0


def test_accuracy_reports_mismatched_lengths(spark):
    got = masked_token_accuracy(scores(spark, ([1], [1, 2]), ([1, 2, 3], [1]))).first()
    assert (got["n_hits"], got["n_counted"], got["mismatched"]) == (2, 3, 2)


def test_logits_to_predictions(spark):
    df = spark.createDataFrame([([[0.1, 0.9], [0.8, 0.2]], [1, 1])], "logits array<array<float>>, labels array<int>")
    assert masked_token_accuracy(with_argmax(df)).first()["token_accuracy"] == 0.5


@pytest.mark.parametrize("k", [0, 1, 9, 40, 119, 120, 500])
def test_a_sample_sorts_its_own_rows_only(spark, k):
    """Eighty rows share one key, among them copies."""
    rows = [(i if i < 40 else 7, f"t{i % 60}") for i in range(120)]
    df = spark.createDataFrame(rows, "key int, text string").repartition(5)
    picked = ranking.first_rows(df, "key", 3, k)
    got = sorted((r["rank"], r["key"], r["text"]) for r in picked.collect())

    def place(row):
        key, text = row
        whole = json.dumps({"key": key, "text": text}, separators=(",", ":"))
        return hashlib.md5(f"3:{key}".encode()).hexdigest(), hashlib.md5(whole.encode()).hexdigest()

    assert [g[1:] for g in got] == sorted(rows, key=place)[:k]
    assert [g[0] for g in got] == list(range(1, min(k, 120) + 1))
    assert ranking.first_rows(df, "key", 3, k).drop("rank").exceptAll(df).count() == 0
    again = ranking.first_rows(df.repartition(2), "key", 3, k).collect()
    assert sorted((r["rank"], r["key"], r["text"]) for r in again) == got


def test_a_hot_key_is_cut_before_it_is_sorted(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, -1, id) as key", "concat('text ', id) as text")
    picked = ranking.first_rows(df, "key", 1, 1500)
    assert picked.count() == 1500
    chosen = picked.drop("rank")
    assert chosen.exceptAll(df.select(*chosen.columns)).count() == 0
