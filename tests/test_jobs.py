import pytest

from pairloom.__main__ import main
from pairloom.sources.prepared import read_prepared

SCHEMA = "lang string, raw string, clean string"


@pytest.fixture
def corpus(spark, tmp_path):
    rows = [("en" if i % 2 else "zh", f"Line {i}\nAll rights reserved.", f"Line {i}") for i in range(40)]
    path = str(tmp_path / "corpus")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return path


def test_prepare_then_batches(spark, corpus, tmp_path, capsys):
    out = str(tmp_path / "out")
    args = ["prepare", "--data-dir", corpus, "--out", out, "--val-frac", "0.1", "--max-target", "6"]
    assert main(args, spark) == 0
    path = capsys.readouterr().out.split("written: ")[1].split("\n")[0]
    assert read_prepared(spark, path, "train").count() == 36
    batches = str(tmp_path / "batches")
    assert main(["batches", "--prepared", path, "--out", batches, "--batch", "5"], spark) == 0
    assert spark.read.parquet(batches).count() == 8
    assert main(args, spark) == 0 and "already there" in capsys.readouterr().out


def test_audit_exit_codes(spark, corpus, tmp_path):
    assert main(["audit", "--data-dir", corpus], spark) == 1
    assert main(["audit", "--data-dir", str(tmp_path / "none")], spark) == 0


def test_clean_eval_and_fidelity(spark, corpus, tmp_path, capsys):
    out = str(tmp_path / "cleaned")
    assert main(["clean", "--data-dir", corpus, "--out", out], spark) == 0
    cleaned = spark.read.parquet(out)
    assert cleaned.filter("lang = 'en' and cleaned <> clean").count() == 0 and cleaned.count() == 40
    cases = str(tmp_path / "cases")
    spark.createDataFrame([("n", "en", "x", "y")], "name string, lang string, raw string, expect string").write.parquet(cases)
    assert main(["eval", "--cases", cases], spark) == 0
    assert main(["fidelity", "--data-dir", corpus], spark) == 0
    assert "lines_duplicated" in capsys.readouterr().out


def test_sources_are_checked(spark, corpus):
    with pytest.raises(ValueError, match="exactly one"):
        main(["fidelity", "--key", "raw"], spark)
    with pytest.raises(ValueError, match="--key"):
        main(["fidelity", "--table", "t"], spark)


class Letters:
    """A tokenizer library for the jobs: one id per letter."""

    def encode_batch(self, texts):
        return [[ord(c) for c in t] for t in texts]


class Shout:
    """A model for the jobs."""

    def __init__(self, options):
        self.beams = options.num_beams

    def __call__(self, texts):
        return [t.split("> ", 1)[1].upper() + "!" * self.beams for t in texts]


def test_plug_ins(spark, corpus, tmp_path):
    out = str(tmp_path / "cleaned")
    own = [f"--{name}=tests.test_jobs:{what}" for name, what in (("cleaner", "Shout"), ("tokenizer", "Letters"))]
    own += ["--eos-id=1", "--num-beams=2", "--batch-tokens=60"]
    assert main(["clean", "--data-dir", corpus, "--out", out, *own], spark) == 0
    assert spark.read.parquet(out).filter("cleaned <> concat(upper(raw), '!!')").count() == 0
    cases, sidecar = str(tmp_path / "cases"), tmp_path / "cleaning_config.json"
    spark.createDataFrame([("n", "en", "x", "y"), ("m", "en", "x" * 9, "")], "name string, lang string, raw string, expect string").write.parquet(cases)
    sidecar.write_text('{"model_family": "fam", "max_input": 10}')
    shown = str(tmp_path / "shown")
    assert main(["eval", "--cases", cases, "--out", shown, "--prepared", str(sidecar), "--model-family", "fam", *own], spark) == 0
    got = {r["name"]: (r["status"], r["clean_preview"]) for r in spark.read.parquet(f"{shown}/cases").collect()}
    assert got == {"n": ("ok", "X!!"), "m": ("over_budget", None)}
    prepared = str(tmp_path / "prepared")
    assert main(["prepare", "--data-dir", corpus, "--out", prepared, *own[1:3], "--oversized", "chunk"], spark) == 0
    with pytest.raises(ValueError, match="--eos-id"):
        main(["chunk", "--data-dir", corpus, "--out", out, own[1]], spark)


def test_chunk_job(spark, corpus, tmp_path):
    out = str(tmp_path / "chunks")
    assert main(["chunk", "--data-dir", corpus, "--out", out, "--max-input", "30"], spark) == 0
    assert {r["status"] for r in spark.read.parquet(out).collect()} <= {"ok", "over_budget", "unaligned"}


def test_reports_are_written_whole(spark, corpus, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr("pairloom.__main__.SHOWN", 1)
    audit, fidelity, lexicon = (str(tmp_path / n) for n in ("audit", "fidelity", "lexicon"))
    assert main(["audit", "--data-dir", corpus, str(tmp_path / "none"), "--out", audit], spark) == 1
    report = {r["dataset"]: r["verdict"] for r in spark.read.parquet(f"{audit}/report").collect()}
    assert report == {corpus: "fail", str(tmp_path / "none"): "pass"}
    assert spark.read.parquet(f"{audit}/findings").count() > 1
    assert main(["audit", "--data-dir", corpus], spark) == 1
    assert "--out writes all" in capsys.readouterr().out
    spark.createDataFrame([("en", "rights", "reserved")], "lang string, kind string, term string").write.parquet(lexicon)
    args = ["fidelity", "--data-dir", corpus, "--lexicon", lexicon, "--repeats", "2", "--out", fidelity]
    assert main(args, spark) == 0
    assert spark.read.parquet(f"{fidelity}/term_loss").agg({"lost": "sum"}).first()[0] == 20
    assert spark.read.parquet(f"{fidelity}/summary").count() == 3
    assert spark.read.parquet(f"{fidelity}/repeats").count() == 0
    assert spark.read.parquet(f"{fidelity}/terms").count() == 2


@pytest.mark.parametrize("column", ["predictions", "logits"])
def test_score_job(spark, tmp_path, column):
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    given = {"predictions": [1, 0, 1], "logits": [[0.1, 0.9], [0.9, 0.1], [0.2, 0.8]]}[column]
    kind = {"predictions": "array<int>", "logits": "array<array<float>>"}[column]
    spark.createDataFrame([(given, [1, 1, -100])], f"{column} {kind}, labels array<int>").write.parquet(table)
    assert main(["score", "--predictions", table, "--out", out], spark) == 0
    assert spark.read.parquet(f"{out}/accuracy").first()["token_accuracy"] == 0.5
