"""Prepared data on disk, with a manifest beside it."""

from __future__ import annotations

import json
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Fixed value: the name of the file a model's settings are kept in beside the model.
SIDECAR = "cleaning_config.json"
MANIFEST_SCHEMA = "model_family string, base_model string, max_input int, max_target int, fingerprint string"


def prepared_path(root: str, fingerprint: str, max_input: int, max_target: int) -> str:
    return f"{root.rstrip('/')}/tok_{fingerprint}_in{max_input}_out{max_target}"


def write_manifest(spark: SparkSession, path: str, manifest: dict[str, Any]) -> None:
    row = [(tuple(manifest.get(f.split()[0]) for f in MANIFEST_SCHEMA.split(", ")))]
    spark.createDataFrame(row, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """The manifest's values, or None where there is none.

    ``path`` is a folder with a ``manifest`` folder or a ``cleaning_config.json`` file, or such a file itself.
    """
    places = [path] if path.endswith(".json") else [f"{path}/manifest", f"{path}/{SIDECAR}"]
    for place in places:
        found = _texts(spark, place)
        if found:
            break
    else:
        return None
    try:
        manifest = json.loads(found[0]) if len(found) == 1 else None
    except json.JSONDecodeError:
        manifest = None
    if not isinstance(manifest, dict):
        raise ValueError(f"the manifest in {path} must be one JSON object")
    return manifest


def _texts(spark: SparkSession, path: str) -> list[str]:
    try:
        return [r["value"] for r in spark.read.text(path, wholetext=True).take(2)]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def input_budget(spark: SparkSession, path: str, model_family: str, default: int) -> int:
    """The input budget the data was prepared with; it must be of the same model family."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        return default
    if manifest.get("model_family") != model_family:
        raise ValueError(f"{path} was prepared for {manifest.get('model_family')!r}, not {model_family!r}")
    budget = manifest.get("max_input")
    if type(budget) is not int or budget <= 0:
        raise ValueError(f"the manifest in {path} has no valid max_input: {budget!r}")
    return budget


def write_prepared(df: DataFrame, path: str, manifest: dict[str, Any]) -> bool:
    """Write the table by split, then the manifest; False if a finished copy was there already.

    The manifest comes last and marks the data as whole: what a broken run left is written anew.
    """
    spark = df.sparkSession
    if read_manifest(spark, path) is not None:
        return False
    df.write.mode("overwrite").partitionBy("split").parquet(f"{path}/data")
    write_manifest(spark, path, manifest)
    return True


def read_prepared(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """The table of a finished prepare job; data without its manifest may be half written and is refused."""
    if read_manifest(spark, path) is None:
        raise ValueError(f"{path} has no manifest: it is no finished prepared data")
    df = spark.read.parquet(f"{path}/data")
    return df if split is None else df.filter(df["split"] == split)
