import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pairloom.operators import shards
from pairloom.plans.audit import audit_dataset, audit_folders, audit_verdict
from pairloom.sources.files import list_files

RAW = pa.table({"lang": ["en", "id"], "raw": ["a", "b"], "clean": ["a", ""], "extra": [1, 2]})
TOK = pa.table({"input_ids": [[1, 2], [3]], "labels": [[1], [2, 3, 4]], "length": [2, 1]})


@pytest.fixture
def folder(tmp_path):
    def build(name, **files):
        root = tmp_path / name
        root.mkdir()
        for path, content in files.items():
            put(str(root), path, content)
        return str(root)

    return build


def put(root, path, content):
    path = os.path.join(root, path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if isinstance(content, bytes):
        with open(path, "wb") as handle:
            handle.write(content)
    else:
        pq.write_table(content, path)


def checks(findings, severity="fail"):
    return {r["check"] for r in findings.collect() if r["severity"] == severity}


CASES = {
    "sound": ({"train-0-of-2.parquet": RAW, "sub/train-1-of-2.parquet": RAW}, set(), None),
    "missing index": ({"train-0-of-2.parquet": RAW, "train-2-of-2.parquet": RAW}, {"shard_gaps"}, "shard_gaps"),
    "duplicate": (
        {"train-0-of-3.parquet": RAW, "sub/train-0-of-3.parquet": RAW, "train-1-of-3.parquet": RAW},
        {"shard_duplicates"}, "shard_duplicates",
    ),
    "wrong total": ({"train-0-of-5.parquet": RAW}, {"shard_total_mismatch"}, "shard_total_mismatch"),
    "bad name": ({"train-abc.parquet": RAW}, {"shard_names"}, "shard_names"),
    "too long a number": ({f"train-{'9' * 30}-of-1.parquet": RAW}, {"shard_names"}, "shard_names"),
    "interrupted": ({"train-0-of-1.parquet": RAW, "x/tmp-0.parquet": b""}, {"tmp_shards"}, "tmp_shards"),
    "strays": ({"part-1.parquet": RAW, "b/other.parquet": RAW}, {"stray_files"}, "stray_files"),
    "broken bytes": ({"train-0-of-1.parquet": b"PAR1 no more"}, {"corrupt_shards"}, "corrupt_shards"),
    "zero bytes": ({"train-0-of-2.parquet": b"", "train-1-of-2.parquet": RAW}, {"corrupt_shards"}, "corrupt_shards"),
    "no rows": ({"train-0-of-1.parquet": RAW.slice(0, 0)}, set(), None),
    "unknown columns": (
        {"train-0-of-1.parquet": RAW.drop_columns(["clean"])}, {"unknown_schema"}, "unknown_schema",
    ),
    "mixed": ({"train-0-of-2.parquet": RAW, "train-1-of-2.parquet": TOK}, {"mixed_schema"}, "mixed_schema"),
    "both kinds of columns": (
        {"train-0-of-1.parquet": TOK.append_column("lang", pa.array(["en", "en"]))
         .append_column("raw", pa.array(["", ""])).append_column("clean", pa.array(["", ""]))}, set(), None,
    ),
    "unknown before broken": (
        {"train-0-of-2.parquet": RAW.drop_columns(["raw"]), "train-1-of-2.parquet": b"no"},
        {"unknown_schema", "corrupt_shards"}, "unknown_schema",
    ),
    "several at once": (
        {"train-0-of-9.parquet": b"no", "train-2-of-9.parquet": TOK, "tmp-1.parquet": TOK},
        {"tmp_shards", "shard_gaps", "shard_total_mismatch", "corrupt_shards"}, "tmp_shards",
    ),
}


@pytest.fixture(scope="module")
def audited(spark, tmp_path_factory):
    """All cases as datasets of one audit."""
    folders = {}
    for name, (files, _, _) in CASES.items():
        folders[name] = str(tmp_path_factory.mktemp("case"))
        for path, content in files.items():
            put(folders[name], path, content)
    findings = audit_dataset(spark, list(folders.values()), expected=None, deep=True).persist()
    verdicts = {r["dataset"]: r for r in audit_verdict(findings).collect()}
    return folders, findings.collect(), verdicts


@pytest.mark.parametrize("name", CASES)
def test_faults_are_found(audited, name):
    folders, findings, verdicts = audited
    _, want, first = CASES[name]
    folder = folders[name]
    assert {r["check"] for r in findings if r["dataset"] == folder and r["severity"] == "fail"} == want
    verdict = verdicts.get(folder)
    if want:
        assert verdict["verdict"] == "fail" and verdict["first_failure"] == first
    else:
        assert verdict is None or verdict["verdict"] == "pass"


def test_row_total_is_a_warning_for_raw_and_told_for_tokenised(spark, folder):
    raw = folder("raw", **{"train-0-of-1.parquet": RAW})
    tok = folder("tok", **{"train-0-of-1.parquet": TOK})
    findings = audit_dataset(spark, [raw, tok], expected=5)
    rows = {r["dataset"]: (r["severity"], r["n"]) for r in findings.collect()}
    assert rows == {raw: ("warn", 2), tok: ("info", 2)}
    assert {r["verdict"] for r in audit_verdict(findings).collect()} == {"pass"}
    assert audit_dataset(spark, raw, expected=2).count() == 0


def test_empty_and_missing_folders_are_told(spark, folder, tmp_path):
    empty, missing = folder("empty"), str(tmp_path / "missing")
    findings = audit_dataset(spark, [empty, missing])
    assert {(r["dataset"], r["severity"]) for r in findings.collect()} == {(empty, "info"), (missing, "info")}


def test_stray_files_show_five_of_all(spark, folder):
    root = folder("strays", **{f"part-{i}.parquet": RAW for i in range(8)}, **{"sub/x.parquet": RAW})
    rows = shards.stray_files(list_files(spark, root)).collect()
    assert [r["name"] for r in sorted(rows)] == [f"part-{i}.parquet" for i in range(5)]
    assert {r["n_files"] for r in rows} == {8}


def test_values_of_raw_shards(spark, folder):
    bad = pa.table({"lang": ["en", "EN", None], "raw": ["a", "b", "c"], "clean": ["", None, "x"]})
    root = folder("values", **{"train-0-of-2.parquet": RAW, "s/train-1-of-2.parquet": bad})
    assert checks(audit_dataset(spark, root, None)) == set()
    deep = audit_dataset(spark, root, None, deep=True)
    assert {(r["subject"], r["n"]) for r in deep.collect()} == {
        ("lang_unsupported", 1), ("lang_missing", 1), ("clean_missing", 1)
    }
    assert checks(deep) == {"invalid_values"}


def test_values_of_tokenised_shards(spark, folder):
    odd = pa.table({"input_ids": [[], [1], None], "labels": [[1], [], [2, 2]]},)
    root = folder("values", **{"train-0-of-2.parquet": TOK, "train-1-of-2.parquet": odd})
    deep = audit_dataset(spark, root, None, deep=True)
    failed = deep.filter("severity = 'fail'").collect()
    assert [(r["check"], r["n"]) for r in failed] == [("empty_sequences", 2)]
    assert "1 in input_ids, 1 in labels" == failed[0]["detail"]
    told = deep.filter("check = 'sequence_stats'").first()
    assert (told["severity"], told["detail"], told["n"]) == ("info", "input 0..2, labels 0..3", 5)
    stats = shards.sequence_stats(spark.read.parquet(root)).first()
    assert tuple(stats) == (0, 2, 0, 3)


def test_gaps_are_runs(spark):
    rows = [("d", 0), ("d", 4095), ("d", 4096), ("d", 4096), ("d", 8193), ("e", 1), ("f", 0), ("f", 1)]
    names = spark.createDataFrame(rows, "dataset string, idx bigint").withColumn("valid", F.lit(True))
    got = {tuple(r) for r in shards.shard_gaps(names).collect()}
    assert got == {("d", 1, 4094, 4094), ("d", 4097, 8192, 4096), ("e", 0, 0, 1)}


def test_a_large_number_in_a_name_is_one_gap(spark, folder):
    root = folder("large", **{"train-0-of-2.parquet": RAW, f"train-{10**18}-of-2.parquet": RAW})
    found = audit_dataset(spark, root, None).filter("check = 'shard_gaps'").first()
    assert (found["n"], found["detail"]) == (10**18 - 1, f"between 1 and {10**18 - 1}")


def test_runs_are_listed_index_by_index(spark):
    top = 10**18
    rows = [("d", 1, 3), ("d", 5, 5), ("e", 0, 200_000), (None, 7, 8), ("f", top + 65_530, top + 65_540)]
    gaps = spark.createDataFrame(rows, "dataset string, first bigint, last bigint")
    got = sorted((tuple(r) for r in shards.missing_indexes(gaps).collect()), key=str)
    assert got == sorted(((d, i) for d, first, last in rows for i in range(first, last + 1)), key=str)


def test_every_folder_has_a_line_in_the_report(spark, folder, tmp_path):
    sound = folder("sound", **{"train-0-of-2.parquet": RAW, "train-1-of-2.parquet": RAW.slice(0, 1)})
    broken = folder("broken", **{"train-0-of-2.parquet": RAW, "train-1-of-2.parquet": b"no"})
    missing = str(tmp_path / "missing")
    report = {r["dataset"]: r.asDict() for r in audit_folders(spark, [sound, broken, missing], None).report.collect()}
    assert set(report) == {sound, broken, missing}
    assert report[sound] == {
        "dataset": sound, "verdict": "pass", "n_fail": 0, "n_warn": 0, "first_failure": None, "n_files": 2,
        "total_rows": 3, "min_rows": 1, "max_rows": 2,
    }
    assert (report[broken]["verdict"], report[broken]["first_failure"], report[broken]["n_files"]) == ("fail", "corrupt_shards", 1)
    assert (report[missing]["verdict"], report[missing]["n_files"]) == ("pass", 0)
