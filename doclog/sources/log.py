"""Logs: append-only tables of JSON messages, read in batch and as streams.

A log is a folder of Parquet files with ``entry_id`` and ``payload`` below
``partition_index=<n>/ledger_id=<n>``, one writer per partition index and one
ledger per batch written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.offsets import EARLIEST, Offset, in_range, offset_struct
from ..operators.decode import NOT_BLANK, as_schema, decode_lenient
from ..operators.infer import first_message, schema_of_message
from .collection import DOCUMENT_SCHEMA
from .options import Options, collection_path, log_options, log_path
from .storage import exists, folders

LOG_SCHEMA = "entry_id BIGINT, payload BINARY, partition_index INT, ledger_id BIGINT"

# A search for the first message looks into this many ledgers, then eight
# times as many, and so on.
_FIRST_LEDGERS, _GROWTH = 1, 8
# Loads of a collection that one step of the search names, at most.
_MOST_LOADS = 4096


def _checked_path(spark: SparkSession, options: Options) -> str:
    if options.is_collection_stream:
        path = collection_path(options, options["stream"])
    else:
        path = log_path(options)
    if not exists(spark, path):
        raise ValueError(f"Stream {options['stream']} does not exist at {path}")
    return path


def messages(
    spark: SparkSession,
    options: Mapping[str, object],
    start: Offset | Mapping[int, Offset] | None = None,
    end: Offset | None = None,
) -> DataFrame:
    """The messages after ``start`` and up to ``end``, undecoded, in batch.

    ``start`` may be one offset for each partition index, as a cursor is.
    """
    checked = log_options(options)
    if checked.is_collection_stream:
        raise ValueError("A collection has no message offsets")
    log = spark.read.schema(LOG_SCHEMA).parquet(_checked_path(spark, checked))
    return log.where(in_range(start, end))


def offset_bounds(log: DataFrame) -> DataFrame:
    """One row with the first and last offset; an empty log gives the earliest."""
    least, greatest = F.min(offset_struct()), F.max(offset_struct())
    found = log.agg(least.alias("first"), greatest.alias("last"))
    names = Offset._fields
    return found.select(
        *[
            F.coalesce(F.col(f"{bound}.{name}"), F.lit(getattr(EARLIEST, name))).alias(
                f"{bound}_{name}"
            )
            for bound in ("first", "last")
            for name in names
        ]
    )


def _ledgers(spark: SparkSession, path: str) -> list[int]:
    """The ledger ids of a log, ascending, from the names of its folders."""
    found = set()
    for partition, _ in folders(spark, path):
        for ledger, _ in folders(spark, f"{path}/{partition}"):
            found.add(int(ledger.partition("=")[2]))
    return sorted(found)


def latest_offset(spark: SparkSession, options: Mapping[str, object]) -> Offset:
    """The offset of the last message. Only the last ledgers are scanned."""
    checked = log_options(options)
    log = messages(spark, checked)
    for ledger in reversed(_ledgers(spark, _checked_path(spark, checked))):
        bounds = offset_bounds(log.where(F.col("ledger_id") == ledger)).first()
        last = Offset(*[bounds[f"last_{name}"] for name in Offset._fields])
        if last != EARLIEST:
            return last
    return EARLIEST


def _first_of_log(spark: SparkSession, path: str) -> str | None:
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    ledgers = _ledgers(spark, path)
    width, at = _FIRST_LEDGERS, 0
    while at < len(ledgers):
        window = ledgers[at : at + width]
        text = first_message(log.where(F.col("ledger_id").between(window[0], window[-1])))
        if text is not None:
            return text
        at, width = at + width, width * _GROWTH
    return None


def _first_of_collection(spark: SparkSession, path: str) -> str | None:
    stored = spark.read.schema(DOCUMENT_SCHEMA).parquet(path).where(F.col("doc").rlike(NOT_BLANK))
    found = sorted(folders(spark, path), key=lambda f: f[1])
    loads = [name.partition("=")[2] for name, _ in found]
    width, at = _FIRST_LEDGERS, 0
    while at < len(loads):
        window = loads[at : at + width]
        firsts = stored.where(F.col("load").isin(window)).groupBy("load").agg(F.first("doc").alias("doc"))
        docs = {row.load: row.doc for row in firsts.collect()}
        if docs:
            return docs[min(docs, key=window.index)]
        at, width = at + width, min(width * _GROWTH, _MOST_LOADS)
    return None


def infer_log_schema(spark: SparkSession, options: Mapping[str, object]) -> T.StructType:
    """The schema of the first message that is not blank; none raises."""
    checked = log_options(options)
    path = _checked_path(spark, checked)
    first = _first_of_collection if checked.is_collection_stream else _first_of_log
    return schema_of_message(spark, first(spark, path))


def read_log(
    spark: SparkSession,
    options: Mapping[str, object],
    schema: T.StructType | str | None = None,
    start: Offset | Mapping[int, Offset] | None = None,
    end: Offset | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Read a range of a log in batch as typed rows."""
    wanted = infer_log_schema(spark, options) if schema is None else as_schema(schema)
    return decode_lenient(messages(spark, options, start, end), wanted, "payload", keep)


def stream_log(
    spark: SparkSession,
    options: Mapping[str, object],
    schema: T.StructType | str | None = None,
    keep: Sequence[str] = (),
    start: Offset | Mapping[int, Offset] | None = None,
    end: Offset | None = None,
) -> DataFrame:
    """Follow a log, or with ``isCollectionStream`` a collection, as typed rows.

    The options ``maxFilesPerTrigger`` and ``maxBytesPerTrigger`` bound a
    micro-batch. What was read is kept in the checkpoint of the query that is
    started on the result. Of a log, only messages after ``start`` (one offset,
    or one for each partition index) and up to ``end`` are read, from folders of
    ledgers in that range.
    """
    checked = log_options(options)
    path = _checked_path(spark, checked)
    wanted = infer_log_schema(spark, checked) if schema is None else as_schema(schema)
    if not checked.is_collection_stream:
        return decode_lenient(stream_messages(spark, checked, start, end), wanted, "payload", keep)
    if start is not None or end is not None:
        raise ValueError("A collection has no message offsets")
    return decode_lenient(_reader(spark, checked).schema(DOCUMENT_SCHEMA).parquet(path), wanted, "doc", keep)


def _reader(spark: SparkSession, options: Options):
    reader = spark.readStream
    for name in ("maxFilesPerTrigger", "maxBytesPerTrigger"):
        if options.get(name):
            reader = reader.option(name, options[name])
    return reader


def stream_messages(
    spark: SparkSession,
    options: Mapping[str, object],
    start: Offset | Mapping[int, Offset] | None = None,
    end: Offset | None = None,
) -> DataFrame:
    """The messages of a log as a stream, undecoded, with their offsets."""
    checked = log_options(options)
    log = _reader(spark, checked).schema(LOG_SCHEMA).parquet(_checked_path(spark, checked))
    return log.where(in_range(start, end))
