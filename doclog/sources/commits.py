"""Which files of a collection or a log count: the log of committed files.

Spark's streaming file sink keeps such a log beside its files, and Spark's file
source, in batch and as a stream, lists no other files where one is found. Appends
of this library add their entries to a log of that form: the files are written
first, under names of their own, and count from the moment the entry exists. No
file or folder is renamed to publish it, a reader never lists a folder, and what a
failed append left behind is named by nobody.

Entries are numbered without gaps and an entry is made only if its number is free,
so of two writers that commit at the same time one learns of the other. How an
entry is created is Spark's choice for the file system (as for the checkpoints of
streams, ``spark.sql.streaming.checkpointFileManagerClass``).
"""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# The folder of the log and the version of its form.
LOG_FOLDER, _FORM = "_spark_metadata", 1


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system."""
    java_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return java_path, java_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def files_below(spark: SparkSession, path: str, prefix: str = "") -> list:
    """The states of the visible files below a folder whose names start with ``prefix``.

    Hidden folders are not entered: others may be at work there.
    """
    java_path, fs = hadoop_path(spark, path)
    if not fs.exists(java_path):
        return []
    found = []
    for state in sorted(fs.listStatus(java_path), key=lambda s: s.getPath().getName()):
        name = state.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if state.isDirectory():
            found += files_below(spark, state.getPath().toString(), prefix)
        elif name.startswith(prefix):
            found.append(state)
    return found


class Commits:
    """The log of committed files of the folder ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, jvm = spark, spark.sparkContext._jvm
        sinks = jvm.org.apache.spark.sql.execution.streaming.sinks
        self._state_class = sinks.SinkFileStatus
        self._log = sinks.FileStreamSinkLog(
            _FORM, spark._jsparkSession, f"{root}/{LOG_FOLDER}", jvm.scala.Option.empty()
        )

    @property
    def version(self) -> int:
        """The number of the last entry, -1 if there is none."""
        last = self._log.getLatestBatchId()
        return last.get() if last.isDefined() else -1

    def files(self, after: int = -1) -> list[str]:
        """The files committed by entries after a number; earlier ones may be among them."""
        if after < 0:
            return self._paths(self._log.allFiles())
        found = []
        for number in range(after + 1, self.version + 1):
            entry = self._log.get(number)
            if not entry.isDefined():  # the entry was merged into a later one
                return self.files()
            found += self._paths(entry.get())
        return found

    def _paths(self, states) -> list[str]:
        return [state.toFileStatus().getPath().toString() for state in states]

    def add(self, number: int, states: list) -> bool:
        """Commit files as entry ``number``; False if another has that number.

        They get the time of the commit, so that a stream, which goes by times,
        reads commits in their order and the files of one in the order given.
        """
        entry = self._spark.sparkContext._gateway.new_array(self._state_class, len(states))
        now = int(time.time() * 1000)
        for i, state in enumerate(states):
            found = self._state_class.apply(state)
            entry[i] = self._state_class(
                found.path(), found.size(), found.isDir(), now,
                found.blockReplication(), found.blockSize(), found.action(),
            )
        try:
            return self._log.add(number, entry)
        except Py4JJavaError:
            # two writers reached the same number at the same time, or a real failure
            if self.version < number:
                raise
            return False


def opened(spark: SparkSession, root: str) -> Commits:
    """The log of a folder, begun if there is none with the files that are there."""
    log = Commits(spark, root)
    if log.version < 0:
        log.add(0, files_below(spark, root))
    return log
