import pytest
from pyspark.sql import functions as F

from pairloom.config import PrepareConfig
from pairloom.operators import prepare as prep
from pairloom.operators.cleaning import RuleCleaner, clean_texts
from pairloom.operators.fingerprint import content_digest, dataset_fingerprint
from pairloom.operators.tokenizers import ByteTokenizer
from pairloom.operators.validate import validate_pairs
from pairloom.plans.prepare import prepare
from pairloom.sources.prepared import read_manifest, read_prepared

SCHEMA = "id bigint, lang string, raw string, clean string"


def some_pairs(spark, n=60):
    return spark.createDataFrame([(i, "en", f"raw {'x' * i}", f"clean {i}") for i in range(n)], SCHEMA)


def test_prepare_writes_once_and_reuses(spark, tmp_path):
    config = PrepareConfig(max_input=40, max_target=8, val_frac=0.2, val_max=5)
    pairs = some_pairs(spark)
    done = prepare(pairs, "id", str(tmp_path), config, model_family="fam", base_model="base")
    assert done.written and done.path.endswith(f"tok_{done.fingerprint}_in40_out8")
    table = read_prepared(spark, done.path)
    assert {r["split"]: r["count"] for r in table.groupBy("split").count().collect()} == {"train": 48, "val": 5}
    assert read_prepared(spark, done.path, "val").count() == 5
    assert table.filter("length > 40 or size(input_ids) <> length or size(labels) > 8").count() == 0
    assert table.filter("element_at(input_ids, -1) <> 1 or element_at(labels, -1) <> 1").count() == 0
    manifest = read_manifest(spark, done.path)
    assert manifest == {
        "model_family": "fam", "base_model": "base", "max_input": 40, "max_target": 8, "fingerprint": done.fingerprint,
    }
    # "<en> raw " and the end marker take 10; "clean 0" and its end marker fit the 8
    assert done.n_source == 60
    assert done.counts["all"] == done.counts["en"] == (60, 29, 50) and done.counts["zh"] == (0, 0, 0)
    again = prepare(pairs.repartition(5), "id", str(tmp_path), config)
    assert again.path == done.path and not again.written and again.counts is None
    other = prepare(pairs, "id", str(tmp_path), PrepareConfig(max_input=41, max_target=8))
    assert other.path != done.path and other.written


def test_an_unfinished_copy_is_written_anew(spark, tmp_path):
    config = PrepareConfig(val_frac=0.2)
    done = prepare(some_pairs(spark), "id", str(tmp_path / "a"), config)
    broken = str(tmp_path / "b")
    target = done.path.replace(str(tmp_path / "a"), broken)
    spark.range(3).selectExpr("id", "'train' as split").write.partitionBy("split").parquet(f"{target}/data")
    again = prepare(some_pairs(spark), "id", broken, config)
    assert again.written and again.path == target
    assert read_prepared(spark, target).count() == 60


def test_skipping_leaves_long_pairs_out_before_the_split(spark, tmp_path):
    config = PrepareConfig(max_input=30, max_target=100, val_frac=0.5, oversized="skip")
    done = prepare(some_pairs(spark), "id", str(tmp_path), config)
    # "<en> raw " and the end marker take 10
    assert done.n_source == 60 and done.counts["all"] == (21, 0, 0)
    rows = read_prepared(spark, done.path).collect()
    assert sorted(r["id"] for r in rows) == list(range(21))
    assert sum(r["split"] == "val" for r in rows) == 11


def test_prepare_refuses_invalid_pairs(spark, tmp_path):
    bad = some_pairs(spark).withColumn("lang", F.when(F.col("id") == 3, "xx").otherwise("en"))
    with pytest.raises(ValueError, match="lang_unsupported"):
        prepare(bad, "id", str(tmp_path))


def test_fingerprint_depends_on_content_and_parameters_only(spark):
    pairs = some_pairs(spark)
    identity = ByteTokenizer().identity()

    def tag(df, **more):
        return dataset_fingerprint(content_digest(df).first(), **{
            "tokenizer": identity, "max_input": 10, "max_target": 5, **more
        })

    first = tag(pairs)
    assert len(first) == 16 and first == tag(pairs.repartition(9).orderBy("raw"))
    changed = [
        tag(pairs, max_input=11), tag(pairs, max_target=6), tag(pairs, tokenizer={**identity, "eos_id": 2}),
        tag(pairs.filter("id > 0")), tag(pairs.unionByName(pairs)), tag(pairs.withColumn("raw", F.col("clean"))),
        tag(pairs.filter("id = 0").unionByName(pairs.filter("id = 0")).unionByName(pairs)),
        tag(spark.createDataFrame([], SCHEMA)),
    ]
    assert len({first, *changed}) == len(changed) + 1


def test_row_operators_accept_a_stream(spark, tmp_path):
    source, out, mark = (str(tmp_path / name) for name in ("in", "out", "mark"))
    some_pairs(spark, 8).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    flagged = prep.budget_flags(validate_pairs(stream).filter("valid"), max_input=15)
    cleaned = clean_texts(flagged, RuleCleaner(), max_input=15)
    query = cleaned.writeStream.format("parquet").option("checkpointLocation", mark).trigger(availableNow=True).start(out)
    query.awaitTermination(120)
    rows = {r["id"]: r for r in spark.read.parquet(out).collect()}
    assert len(rows) == 8
    assert rows[5]["status"] == "ok" and rows[6]["status"] == "over_budget" and rows[6]["is_input_truncated"]


def test_long_pairs_are_cut_into_chunks_before_the_split(spark, tmp_path):
    lines = [[f"line {i} of {n}" for i in range(n)] for n in range(1, 31)]
    rows = [(n, "en", "\n".join(x), "\n".join(x)) for n, x in enumerate(lines)]
    rows.append((99, "en", "x" * 200, "y" * 200))  # cannot be cut
    config = PrepareConfig(max_input=120, max_target=100, val_frac=0.3, oversized="chunk")
    done = prepare(spark.createDataFrame(rows, SCHEMA), "id", str(tmp_path), config)
    table = read_prepared(spark, done.path).collect()
    assert done.counts["all"][1:] == (0, 0)  # nothing is truncated
    sides = {}
    texts = {}
    for r in table:
        pair, _, number = r["id"].partition("#")
        sides.setdefault(pair, set()).add(r["split"])
        texts.setdefault(int(pair), {})[int(number)] = bytes(i - 3 for i in r["labels"][:-1]).decode()
    assert all(len(s) == 1 for s in sides.values()) and len({r["id"] for r in table}) == len(table)
    assert {pair: "\n".join(parts[i] for i in range(len(parts))) for pair, parts in texts.items()} == {
        n: "\n".join(x) for n, x in enumerate(lines)
    }
