"""Registered queries on tables of their own."""

import pyarrow as pa
import pyarrow.parquet as pq

from catalog.queries import QUERIES


def test_a_table_of_several_files_is_scanned(spark, tmp_path):
    folder = tmp_path / "documents.parquet"
    folder.mkdir()
    rows = [{"doc_id": i, "lang": "en", "text": f"#%& text {i} "} for i in range(6)]
    for i in range(3):
        pq.write_table(pa.Table.from_pylist(rows[2 * i : 2 * i + 2]), folder / f"part-{i}.parquet")
    pq.write_table(pa.table({"doc_id": [9]}), tmp_path / "labels.parquet")
    several = {tuple(r) for r in QUERIES["scan_pairs"](spark, str(tmp_path)).collect()}
    single = tmp_path / "single"
    single.mkdir()
    pq.write_table(pa.Table.from_pylist(rows), single / "documents.parquet")
    assert len(several) == 6
    assert several == {tuple(r) for r in QUERIES["scan_pairs"](spark, str(single)).collect()}


def test_every_missing_index_has_a_row(spark, tmp_path):
    # English shards are numbered by n_chars: 2 and 5 of 0 to 5
    rows = [{"doc_id": i, "lang": "en", "text": "x", "source": "src0", "n_chars": n} for i, n in enumerate((2, 5, 5))]
    pq.write_table(pa.Table.from_pylist(rows), tmp_path / "documents.parquet")
    found = [tuple(r) for r in QUERIES["shard_gaps"](spark, str(tmp_path)).collect()]
    assert sorted(found) == [("en", 0), ("en", 1), ("en", 3), ("en", 4)]
