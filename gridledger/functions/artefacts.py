"""Intermediate tables in the folder that driver and executors share.

A table that several later steps read is written once and read back, so that each of them starts
from files: nothing is computed again, lineage ends there, and a lost executor costs its tasks only.
The files of a scope are deleted when it ends, also when its work fails::

    with artefacts(spark):
        ranked = cell_ranks(density)       # its intermediate tables belong to the scope
        ranked.write.parquet(target)

Tables kept outside any scope live as long as the shared folder does.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: ContextVar[tuple[str, ...]] = ContextVar("gridledger_artefact_folders", default=())

# Folders of local sessions that have none set.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or "cluster" in master:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    # The setting cannot be changed in a running session.
    session = spark.sparkContext.applicationId
    if session not in _OWN:
        _OWN[session] = "file://" + tempfile.mkdtemp(prefix="gridledger-")
    return _OWN[session]


@contextmanager
def artefacts(spark: SparkSession) -> Iterator[str]:
    """A scope for ``stored`` tables, given as its folder; they are gone after it. Scopes nest."""
    folder = f"{shared_folder(spark)}/scope-{uuid.uuid4().hex}"
    token = _FOLDERS.set((*_FOLDERS.get(), folder))
    try:
        yield folder
    finally:
        _FOLDERS.reset(token)
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder in whatever file system it lies; none is fine."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, label: str) -> str:
    """A path not in use, inside the innermost open scope."""
    folders = _FOLDERS.get()
    return f"{folders[-1] if folders else shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, by: list[str] | None = None, path: str | None = None, **options: str) -> DataFrame:
    """``df`` written once and read back, split into folders by the columns ``by`` if given: filters
    on these skip files. ``path``, from ``new_path``, places it in another scope than the innermost; ``options``
    are the writer's, with a double underscore for a dot."""
    spark = df.sparkSession
    path = path or new_path(spark, label)
    writer = df.write.options(**{key.replace("__", "."): value for key, value in options.items()})
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
