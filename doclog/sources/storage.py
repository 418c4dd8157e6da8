"""Folders of tables: look-up, scratch space and publishing.

All of it goes through the Hadoop file system of the path, so it works on any
store that Spark itself can read.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from .commits import LOG_FOLDER, Commits, files_below, hadoop_path, opened

_DONE = "_SUCCESS"

Prepare = Callable[[DataFrame], DataFrameWriter]
Renew = Callable[[DataFrame, list[str]], DataFrame]


def exists(spark: SparkSession, path: str) -> bool:
    java_path, fs = hadoop_path(spark, path)
    return fs.exists(java_path)


def delete(spark: SparkSession, path: str) -> None:
    java_path, fs = hadoop_path(spark, path)
    fs.delete(java_path, True)


def folders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and times of the ``name=value`` folders below ``path``."""
    java_path, fs = hadoop_path(spark, path)
    found = [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(java_path)]
    return [(name, time) for name, time in found if "=" in name]


def marks(spark: SparkSession, path: str, name: str) -> list[str]:
    """The values of the empty files ``_<name>=<value>`` in a folder."""
    java_path, fs = hadoop_path(spark, path)
    if not fs.exists(java_path):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(java_path)]
    return sorted(n.partition("=")[2] for n in found if n.startswith(f"_{name}="))


def mark(spark: SparkSession, path: str, name: str, value: str) -> None:
    java_path, fs = hadoop_path(spark, f"{path}/_{name}={value}")
    fs.create(java_path, True).close()


def is_published(spark: SparkSession, root: str, part: str) -> bool:
    """Whether files of the folder ``part`` of ``root`` are committed."""
    if not exists(spark, f"{root}/{part}"):
        return False
    # to open a log is to begin it, and a folder from before has none
    if not exists(spark, f"{root}/{LOG_FOLDER}"):
        return exists(spark, f"{root}/{part}/{_DONE}")
    return any(f"/{part}/" in path for path in Commits(spark, root).files())


def publish(
    rows: DataFrame,
    root: str,
    part: str,
    prepare: Prepare = lambda rows: rows.write,
    known: int | None = None,
    renew: Renew | None = None,
) -> bool:
    """Write rows into the folder ``part`` of ``root`` so that readers see all of them or none.

    The files get names of their own and count once they are committed. A part
    that was committed before, also by another writer meanwhile, is left as it
    is: the caller's second try changes nothing, and a streaming reader meets no
    new files.

    Rows that depend on what is stored were made from entry ``known`` of the log.
    If others have committed since, ``renew`` gets the rows as written and the
    files of the others, and its result is written in their place.
    """
    spark = rows.sparkSession
    log = opened(spark, root)
    known = log.version if known is None else known
    if is_published(spark, root, part):
        return False
    written = _write(rows, f"{root}/{part}", prepare)
    while not log.add(known + 1, written):
        others, known = log.files(known), log.version
        if is_published(spark, root, part):
            _drop(spark, written)
            return False
        if renew is not None and written and others:
            paths = [state.getPath().toString() for state in written]
            left = renew(spark.read.schema(rows.schema).parquet(*paths), others)
            again = _write(left, f"{root}/{part}", prepare)
            _drop(spark, written)
            written = again
    return True


def _write(rows: DataFrame, folder: str, prepare: Prepare) -> list:
    """Write rows under file names of their own and give the files' states."""
    name = f"part-{uuid.uuid4().hex}"
    prepare(rows).mode("append").option("mapreduce.output.basename", name).parquet(folder)
    return files_below(rows.sparkSession, folder, name)


def _drop(spark: SparkSession, states: list) -> None:
    for state in states:
        delete(spark, state.getPath().toString())


def remove_leftovers(spark: SparkSession, root: str, older_than: float) -> int:
    """Delete files that no entry of the log names and that are older than some seconds.

    They are left by appends that failed. The age must exceed the time of any
    append that is still running.
    """
    log = opened(spark, root)
    found = files_below(spark, root)
    committed = set(log.files())
    limit = (time.time() - older_than) * 1000
    left = [
        state for state in found
        if state.getPath().toString() not in committed and state.getModificationTime() < limit
    ]
    _drop(spark, left)
    return len(left)


# Fixed value: after this many rows the file format first looks at a page's size.
_FIRST_LOOK = 100


def grouped(writer: DataFrameWriter, batch_size: int) -> DataFrameWriter:
    """Set the writer to hand over its rows in groups of ``batch_size`` at most.

    A group becomes a data page of the file, not a file: at the small sizes
    that are usual here, a file per group would be unreadable in large numbers.
    """
    return writer.option("parquet.page.row.count.limit", batch_size).option(
        "parquet.page.size.row.check.min", min(batch_size, _FIRST_LOOK)
    )


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name in the space that all executors share.

    That space is the one named by ``spark.checkpoint.dir``. Only a local
    session, whose executors share the driver's disk, may do without: it is
    given one folder for all its scratch tables.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder shared by the cluster")
        shared = tempfile.mkdtemp(prefix="doclog-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/doclog-{uuid.uuid4().hex}"
