"""Reading pair tables."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.config import PAIR_COLUMNS

ROW_KEY = "row_key"


def require_columns(df: DataFrame, columns: Sequence[str] = PAIR_COLUMNS) -> DataFrame:
    """Further columns are fine; a missing one is an error before any data is read."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"the table needs the columns {', '.join(columns)}; missing: {', '.join(missing)}")
    return df


def read_pairs(
    spark: SparkSession,
    path: str | None = None,
    table: str | None = None,
    glob: str = "*.parquet",
    columns: Mapping[str, Column] | None = None,
    row_key: bool = False,
) -> DataFrame:
    """All parquet files under a folder, or a catalog table: exactly one of the two.

    ``columns`` derives required columns from a table that names them otherwise. ``row_key`` adds a
    key made of the file's place under the folder and the row's position in it: unique even for
    identical rows, and the same on every read of the same files however Spark splits them.
    Folders starting with ``.`` or ``_`` are not read.
    """
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path and table")
    if table is not None:
        if row_key:
            raise ValueError("row_key needs files; name a key column of the table instead")
        df = spark.table(table)
    else:
        reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        try:
            df = reader.parquet(path)
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                raise ValueError(f"no file {glob} under {path}") from error
            raise
        if row_key:
            df = df.withColumn(ROW_KEY, _position_key(path))
    if columns:
        df = df.withColumns(dict(columns))
    return require_columns(df)


def _position_key(path: str) -> Column:
    root = path if "://" in path else os.path.abspath(path)
    # the path is a URI, in which a plus sign stands for itself
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    inside = F.substring_index(file, root.rstrip("/"), -1)
    return F.concat_ws("#", inside, F.col("_metadata.row_index"))


def content_key(columns: Sequence[str] = PAIR_COLUMNS) -> Column:
    """A key from the content: equal rows share it, so copies stay together. Null is told from every text."""
    return F.md5(F.concat_ws(":", *[F.coalesce(F.md5(F.col(c).cast("string")), F.lit("null")) for c in columns]))
