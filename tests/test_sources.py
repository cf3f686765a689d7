import io
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom.sources.files import _far_footers, _footer, list_files, read_footers, write_shards
from pairloom.sources.pairs import content_key, read_pairs
from pairloom.sources.prepared import input_budget, read_manifest, write_manifest


def write(path, rows, columns=("lang", "raw", "clean")):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    table = pa.table({c: pa.array([r[i] for r in rows], pa.string()) for i, c in enumerate(columns)})
    pq.write_table(table, path)


def test_reads_folders_at_any_depth_but_not_hidden_ones(spark, tmp_path):
    for name in ("a.parquet", "sub/b.parquet", "sub/deep er/ü.parquet", "_sub/c.parquet", ".sub/d.parquet"):
        write(str(tmp_path / name), [("en", name, "x")])
    (tmp_path / "note.txt").write_text("no parquet")
    found = {r["raw"] for r in read_pairs(spark, str(tmp_path)).collect()}
    assert found == {"a.parquet", "sub/b.parquet", "sub/deep er/ü.parquet"}


def test_position_key_is_unique_and_does_not_depend_on_the_split(spark, tmp_path):
    root = tmp_path / "daten+ä 100%"
    for name in ("a.parquet", "s/a.parquet"):
        write(str(root / name), [("en", "same", "same")] * 50)
    keys = sorted(r["row_key"] for r in read_pairs(spark, str(root), row_key=True).collect())
    assert len(set(keys)) == 100
    assert keys[0] == "/a.parquet#0" and keys[-1] == "/s/a.parquet#9"
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        again = sorted(r["row_key"] for r in read_pairs(spark, str(root), row_key=True).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert again == keys


def test_content_key_separates_columns(spark):
    df = spark.createDataFrame([("a", "b:c", "d"), ("a:b", "c", "d")], "lang string, raw string, clean string")
    assert df.select(content_key()).distinct().count() == 2


def test_wrong_sources_are_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="exactly one"):
        read_pairs(spark)
    with pytest.raises(ValueError, match="exactly one"):
        read_pairs(spark, path=str(tmp_path), table="t")
    with pytest.raises(ValueError, match="no file"):
        read_pairs(spark, path=str(tmp_path))
    write(str(tmp_path / "a.parquet"), [("en", "x")], ("lang", "raw"))
    with pytest.raises(ValueError, match="missing: clean"):
        read_pairs(spark, path=str(tmp_path))
    assert read_pairs(spark, path=str(tmp_path), columns={"clean": F.col("raw")}).count() == 1


def test_reads_a_table(spark, pairs_of):
    pairs_of(("en", "a", "b")).createOrReplaceTempView("some_pairs")
    assert read_pairs(spark, table="some_pairs").count() == 1


def test_listing_shows_empty_and_broken_files(spark, tmp_path):
    write(str(tmp_path / "train-0-of-3.parquet"), [("en", "a", "b")] * 3)
    write(str(tmp_path / "sub/train-1-of-3.parquet"), [])
    (tmp_path / "train-2-of-3.parquet").write_bytes(b"broken")
    (tmp_path / "zero.parquet").write_bytes(b"")
    files = list_files(spark, str(tmp_path))
    assert {(r["name"], r["top_level"]) for r in files.collect()} == {
        ("train-0-of-3.parquet", True), ("train-1-of-3.parquet", False), ("train-2-of-3.parquet", True),
        ("zero.parquet", True),
    }
    assert {r["top_level"] for r in list_files(spark, f"file://{tmp_path}").filter("name like 'train-2%'").collect()} == {True}
    footers = {r["name"]: r for r in read_footers(files).collect()}
    assert footers["train-0-of-3.parquet"]["n_rows"] == 3
    assert footers["train-0-of-3.parquet"]["cols"] == ["lang", "raw", "clean"]
    assert footers["train-1-of-3.parquet"]["n_rows"] == 0 and footers["train-1-of-3.parquet"]["error"] is None
    for name in ("train-2-of-3.parquet", "zero.parquet"):
        assert footers[name]["error"] and footers[name]["n_rows"] is None


def test_only_broken_data_is_a_finding(spark, tmp_path):
    write(str(tmp_path / "whole.parquet"), [("en", "a", "b")] * 50)
    whole = (tmp_path / "whole.parquet").read_bytes()
    for size in (4, 20, len(whole) // 2, len(whole) - 1, len(whole) - 9):
        (tmp_path / f"cut{size}.parquet").write_bytes(whole[:size])
    (tmp_path / "bad.parquet").write_bytes(whole[:-60] + b"\xff" * 40 + whole[-20:])
    footers = {r["name"]: r["error"] for r in read_footers(list_files(spark, str(tmp_path))).collect()}
    assert footers.pop("whole.parquet") is None and len(footers) == 6 and all(footers.values())


def test_a_file_that_went_away_fails_the_job(spark, tmp_path):
    write(str(tmp_path / "a.parquet"), [("en", "a", "b")])
    files = list_files(spark, str(tmp_path))
    gone = files.withColumn("path", F.concat(F.lit("file:"), F.lit(str(tmp_path)), F.lit("/gone.parquet")))
    with pytest.raises(PySparkException, match="gone.parquet"):
        read_footers(gone).collect()


@pytest.mark.parametrize("error", [PermissionError(13, "refused"), OSError("AWS Error ACCESS_DENIED")])
@pytest.mark.parametrize("at_once", [True, False])
def test_a_refused_file_is_no_finding(error, at_once):
    class Refusing(io.RawIOBase):
        def readable(self):
            return True

        def seekable(self):
            return True

        def seek(self, *how):
            raise error

    class Store:
        def open_input_file(self, path):
            if at_once:
                raise error
            return pa.PythonFile(Refusing(), mode="r")

    with pytest.raises(OSError):
        _footer(Store(), "x")


def test_stores_that_only_spark_opens_are_read_by_spark(spark, tmp_path):
    write(str(tmp_path / "train-0-of-1.parquet"), [("en", "a", "b")] * 3)
    (tmp_path / "train-1-of-1.parquet").write_bytes(b"no")
    found = {r["name"]: r for r in _far_footers(list_files(spark, str(tmp_path))).collect()}
    assert found["train-0-of-1.parquet"]["n_rows"] == 3 and found["train-1-of-1.parquet"]["error"]


@pytest.mark.parametrize("rows", [0, 2, 9])
def test_shards_are_written_under_their_names(spark, tmp_path, rows):
    df = spark.range(rows).selectExpr("id")
    write_shards(df, str(tmp_path / "out"), 3)
    names = {r["name"] for r in list_files(spark, str(tmp_path / "out")).collect()}
    assert names == {f"train-0000{i}-of-00003.parquet" for i in range(3)}
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(rows))


def test_manifest_as_one_file(spark, tmp_path):
    file = tmp_path / "cleaning_config.json"
    file.write_text('{"model_family": "fam", "max_input": 33}')
    assert input_budget(spark, str(tmp_path), "fam", 4096) == input_budget(spark, str(file), "fam", 4096) == 33
    assert input_budget(spark, str(tmp_path / "none.json"), "fam", 4096) == 4096


def test_manifest_round_trip(spark, tmp_path):
    path = str(tmp_path)
    assert read_manifest(spark, path) is None
    assert input_budget(spark, path, "fam", 4096) == 4096
    write_manifest(spark, path, {"model_family": "fam", "max_input": 100, "max_target": 10, "fingerprint": "f"})
    assert read_manifest(spark, path)["max_target"] == 10
    assert input_budget(spark, path, "fam", 4096) == 100
    with pytest.raises(ValueError, match="prepared for"):
        input_budget(spark, path, "other", 4096)


@pytest.mark.parametrize(
    "text",
    [
        '{"model_family": "fam"}', '{"model_family": "fam", "max_input": true}',
        '{"model_family": "fam", "max_input": 0}', '{"model_family": "fam", "max_input": "512"}',
        '{"model_family": "fam", "max_input": 1.5}', '[1, 2]', 'no json',
    ],
)
def test_bad_manifests_are_errors(spark, tmp_path, text):
    (tmp_path / "manifest").mkdir()
    (tmp_path / "manifest/part.json").write_text(text)
    with pytest.raises(ValueError):
        input_budget(spark, str(tmp_path), "fam", 4096)


def test_manifest_over_several_lines(spark, tmp_path):
    (tmp_path / "manifest").mkdir()
    (tmp_path / "manifest/part.json").write_text('{\n  "model_family": "fam",\n  "max_input": 77\n}')
    assert input_budget(spark, str(tmp_path), "fam", 4096) == 77
