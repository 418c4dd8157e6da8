"""Streaming queries: logs and collections followed to their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.offsets import Offset
from ..sources import (
    append_collection,
    cursor,
    log_options,
    log_path,
    read_collection,
    read_log,
    stream_log,
)
from ..sources.storage import scratch_folder
from ..streaming import follow_log, write_collection, write_ledger, write_log
from .inputs import EVENT_LOG_SQL, stored_log
from .registry import query, table

_EVENT = "event_id BIGINT, symbol STRING, ma DOUBLE"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id", "event_type AS symbol", "value AS ma"
    )


def _log(root: str, stream: str, **more: object) -> dict[str, object]:
    return {
        "regionUrl": root,
        "fabric": "_system",
        "tenant": "tenant",
        "replication": "global",
        "stream": stream,
        "subscriptionName": "reader",
        **more,
    }


def _source_log(spark: SparkSession, folder: str, root: str) -> dict[str, object]:
    """Every event as a message of a new log."""
    source = _log(root, "source")
    rows = _events(spark, folder)
    write_ledger(rows, log_path(log_options(source)), partition_index=0, ledger_id=0)
    return source


def _drained(spark: SparkSession, stream: DataFrame, root: str) -> DataFrame:
    """What a stream has to give at this time, through a file sink."""
    started = (
        stream.writeStream.format("parquet")
        .option("path", f"{root}/drained")
        .option("checkpointLocation", f"{root}/checkpoint-drained")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/drained")


@query(
    "stream_scan_available_now",
    "SELECT event_id, event_type AS symbol, value AS ma FROM events",
)
def stream_scan_available_now(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_folder(spark)
    source = _source_log(spark, folder, root)
    return _drained(spark, stream_log(spark, source), root)


@query(
    "collection_as_stream",
    "SELECT event_id, event_type AS symbol, value AS ma FROM events",
)
def collection_as_stream(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_folder(spark)
    collection = {"regionUrl": root, "fabric": "_system", "collection": "events"}
    append_collection(_events(spark, folder), collection)
    changes = _log(root, "events", replication="local", isCollectionStream=True)
    return _drained(spark, stream_log(spark, changes, _EVENT), root)


@query(
    "stream_to_stream",
    "SELECT event_type AS symbol, value FROM events",
)
def stream_to_stream(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_folder(spark)
    source = _source_log(spark, folder, root)
    target = _log(root, "target", checkpointLocation=f"{root}/checkpoint")
    rows = stream_log(spark, source).select("symbol", "ma").withColumnRenamed("ma", "value")
    write_log(rows, target, availableNow=True).awaitTermination()
    return read_log(spark, target, "symbol STRING, value DOUBLE")


@query(
    "stream_to_collection",
    "SELECT event_id, event_type AS symbol, value AS ma FROM events",
)
def stream_to_collection(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_folder(spark)
    source = _source_log(spark, folder, root)
    target = {
        "regionUrl": root,
        "fabric": "_system",
        "collection": "events",
        "batchSize": 100,
        "checkpointLocation": f"{root}/checkpoint",
    }
    rows = stream_log(spark, source, _EVENT)
    write_collection(rows, target, availableNow=True).awaitTermination()
    return read_collection(spark, target, _EVENT)


@query(
    "stream_to_keyed_collection",
    """SELECT user_id, CAST(json_extract(doc, '$.event_id') AS BIGINT) AS event_id
    FROM (SELECT user_id, min(CAST(to_json({'user_id': user_id, 'event_id': event_id})
        AS VARCHAR)) AS doc FROM events GROUP BY user_id)"""
)
def stream_to_keyed_collection(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_folder(spark)
    source = _log(root, "source")
    rows = table(spark, folder, "events").select("user_id", F.col("event_id"))
    write_ledger(rows, log_path(log_options(source)), partition_index=0, ledger_id=0)
    target = {
        "regionUrl": root,
        "fabric": "_system",
        "collection": "users",
        "primaryKey": "user_id",
        "checkpointLocation": f"{root}/checkpoint",
    }
    schema = "user_id BIGINT, event_id BIGINT"
    started = write_collection(stream_log(spark, source, schema), target, availableNow=True)
    started.awaitTermination()
    return read_collection(spark, target, schema)


@query(
    "stream_to_collection_keys_in_state",
    "SELECT DISTINCT user_id, user_id % 2 = 0 AS was_stored FROM events",
)
def stream_to_collection_keys_in_state(spark: SparkSession, folder: str) -> DataFrame:
    """Every other user is stored before; the stream adds the rest, each once."""
    root = scratch_folder(spark)
    source = _log(root, "source")
    users = table(spark, folder, "events").select("user_id")
    rows = users.withColumn("was_stored", F.lit(False))
    write_ledger(rows, log_path(log_options(source)), partition_index=0, ledger_id=0)
    target = {
        "regionUrl": root,
        "fabric": "_system",
        "collection": "users",
        "primaryKey": "user_id",
        "keysInState": True,
        "checkpointLocation": f"{root}/checkpoint",
    }
    append_collection(users.where("user_id % 2 = 0").withColumn("was_stored", F.lit(True)), target)
    schema = "user_id BIGINT, was_stored BOOLEAN"
    started = write_collection(stream_log(spark, source, schema), target, availableNow=True)
    started.awaitTermination()
    return read_collection(spark, target, schema)


# Inside the first ledger of the stored log.
_STOP = Offset(0, 499, 0)


@query(
    "log_resume_at_cursor",
    f"""WITH log AS ({EVENT_LOG_SQL})
    SELECT ledger_id, entry_id, CAST(json_extract(text, '$.k') AS BIGINT) AS k FROM log
    WHERE (ledger_id, entry_id, partition_index) > {tuple(_STOP)}""",
)
def log_resume_at_cursor(spark: SparkSession, folder: str) -> DataFrame:
    """A stream that stops at an offset, and a batch read from its subscription's cursor."""
    options = {**stored_log(spark, folder), "checkpointLocation": f"{scratch_folder(spark)}/checkpoint"}
    started = follow_log(
        spark, options, lambda rows, batch: None, "k BIGINT", end=_STOP, availableNow=True
    )
    started.awaitTermination()
    keep = ["ledger_id", "entry_id"]
    return read_log(spark, options, "k BIGINT", start=cursor(spark, options), keep=keep)
