"""Time the headline queries: one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the data and the cores.
Each query runs once to warm up, then three times; its figure is the median.

The given table is one row group, which one core would read alone, as no large table is. So the same rows are
first written as ROW_GROUPS row groups to a new temporary folder, and read from there. What is timed are the
operators' results, without the checksums that the queries add for the comparison with SQL.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

import pyarrow.parquet as pq

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import PLAIN, QUERIES
from pairloom.session import build_session

HEADLINE = (
    "truncation_counts", "validate_rows", "tokenize", "truncate_to_budget", "train_val_split", "length_groups",
    "collate", "padding_report", "masked_token_accuracy", "dataset_fingerprint", "clean_texts", "chunk_pairs",
    "number_loss", "term_loss", "fidelity_summary",
)
ROW_GROUPS = 64


def spread(sf_dir: str) -> str:
    """A folder with the documents in many row groups."""
    folder = tempfile.mkdtemp(prefix="bench-")
    table = pq.read_table(f"{sf_dir}/documents.parquet")
    rows = max(1, -(-len(table) // ROW_GROUPS))
    pq.write_table(table, f"{folder}/documents.parquet", row_group_size=rows, compression="snappy")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    conf = {
        "spark.sql.shuffle.partitions": str(4 * int(cpus)),
        # one small file: split it so that every core has work
        "spark.sql.files.maxPartitionBytes": "2m",
        "spark.sql.files.openCostInBytes": "256k",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    folder, seconds = spread(sf_dir), {}
    for name in names:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            (PLAIN.get(name) or QUERIES[name])(spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
