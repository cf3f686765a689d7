"""What the operators share: written intermediate tables and the words the contracts fix."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.session import shared_folder, ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again: later steps neither recompute it nor lose it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/pairloom-llm/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch, where the session does not say otherwise: whole texts are large.
BATCH_ROWS = "2000"
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def with_workers(df: DataFrame) -> SparkSession:
    """The session of ``df``, with this package importable in its Python workers and batches fit for texts."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(_ROWS) == "10000":  # Spark's default
        spark.conf.set(_ROWS, BATCH_ROWS)
    return spark


_kept: dict[tuple, object] = {}


def worker_table(operator: str, make: Callable, *key):
    """``make(*key)``, kept in a Python worker for the operator at work; the tables of others are let go.

    Workers live on from stage to stage, and all their tables together would outgrow them.
    """
    name = (operator, make.__name__, *key)
    if name not in _kept:
        let_go(operator, make.__name__)
        _kept[name] = make(*key)
    return _kept[name]


def let_go(operator: str, table: str = "") -> None:
    """Drop what a Python worker keeps for other operators, and the operator's ``table`` itself.

    Every worker function that has no table of its own calls it first.
    """
    others = [k for k in _kept if k[0] != operator or k[1] == table]
    for other in others:
        del _kept[other]
    if others:
        gc.collect()
        give_back()


def give_back() -> None:
    """Hand freed memory of a Python worker back to the machine, where its other workers and the JVM need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc(), "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


@lru_cache(maxsize=1)
def _libc() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL(None)
    except (OSError, TypeError):
        return None


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spare_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have, in any spelling."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
