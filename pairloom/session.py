"""Session helpers: the settings the jobs rely on, shipping code, shared scratch space."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_own_folders: dict[str, str] = {}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; a cluster's own settings win over these."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # Only a staging copy on the driver: addPyFile hands the archive to every executor.
    staging = tempfile.mkdtemp(prefix="pairloom-ship-")
    archive = shutil.make_archive(
        os.path.join(staging, "pairloom"), "zip", os.path.dirname(package), os.path.basename(package)
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


#: Bytes of an Arrow batch that goes to a Python worker, where the session does not say otherwise.
BATCH_BYTES = "8m"
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPARKS_BYTES = "67108864b"  # Spark's default


def ready_workers(spark: SparkSession) -> None:
    """:func:`ship_package`, and batches of bounded bytes for the Python workers.

    What a worker makes of a batch of texts (ids, counts, lines) is several times its size and lives as long as
    the batch, so it is the batch that bounds a worker's memory, whatever the table's size.
    """
    ship_package(spark)
    if spark.conf.get(_BYTES) == _SPARKS_BYTES:
        spark.conf.set(_BYTES, BATCH_BYTES)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session, whose executors are this machine, gets a folder of its own where none is named.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="pairloom-shared-")
    return _own_folders[context.applicationId]
