"""Streaming writes: into a log, and into a collection.

Each micro-batch is published under a name made from its number, so a batch
that is run again after a failure is recognised and not written twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.encode import check_encodable
from ..functions.offsets import Offset
from ..operators.decode import as_schema, decode_lenient
from ..operators.encode import encode_messages
from ..operators.keyed import first_of_batch, with_key
from ..sources.collection import DOCUMENT_SCHEMA, append_collection, append_new_documents, staged
from ..sources.commits import opened
from ..sources.cursors import acknowledge, covered_by, cursor
from ..sources.log import infer_log_schema, stream_messages
from ..sources.options import (
    Options,
    collection_options,
    collection_path,
    log_options,
    log_path,
)
from ..sources.storage import exists, folders, publish


def write_ledger(batch: DataFrame, path: str, partition_index: int, ledger_id: int) -> bool:
    """Write the rows of ``batch`` as one ledger of a log, unless it is there."""
    rows = encode_messages(batch).select(
        F.monotonically_increasing_id().alias("entry_id"), "payload"
    )
    part = f"partition_index={partition_index}/ledger_id={ledger_id}"
    return publish(rows, path, part)


def _checkpoint(spark: SparkSession, options: Options, target: str, prefix: str) -> str:
    """The checkpoint of a query whose batches are named ``prefix`` and a number.

    The numbers of a new checkpoint start at 0. If there are batches of that
    name already, those of the new query would be taken for them and skipped,
    so that is refused.
    """
    options.require(("checkpointLocation",))
    checkpoint = options["checkpointLocation"]
    if not exists(spark, f"{checkpoint}/metadata") and exists(spark, target):
        if any(name.startswith(prefix) for name, _ in folders(spark, target)):
            raise ValueError(f"{target} holds batches {prefix}... of another checkpoint")
    return checkpoint


def _start(df: DataFrame, checkpoint: str, trigger: Mapping[str, object], each) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def write_log(
    df: DataFrame,
    options: Mapping[str, object],
    partition_index: int = 0,
    **trigger: object,
) -> StreamingQuery:
    """Start a query that appends each row of a stream to a log as a message.

    A partition index belongs to one query and its checkpoint: two queries that
    write one log need two indexes, and so does a query with a new checkpoint.
    ``trigger`` is passed on, for example ``availableNow=True``.
    """
    checked = log_options(options, write=True)
    check_encodable(df.schema)
    path = log_path(checked)
    part = f"{path}/partition_index={partition_index}"
    checkpoint = _checkpoint(df.sparkSession, checked, part, "ledger_id=")

    def each(batch: DataFrame, batch_id: int) -> None:
        write_ledger(batch, path, partition_index, batch_id)

    return _start(df, checkpoint, trigger, each)


def write_collection(
    df: DataFrame,
    options: Mapping[str, object],
    query_name: str | None = None,
    **trigger: object,
) -> StreamingQuery:
    """Start a query that appends each row of a stream to a collection.

    The appends are named by the query and the number of the batch. A query
    name belongs to one checkpoint; one is made from its location if not given.

    With the option ``keysInState`` the keys that are stored are held in the
    query's state, so a micro-batch does not read them again; see
    ``_with_new_keys``. Of rows of one key in a micro-batch any one is kept then.
    """
    checked = collection_options(options)
    checked.batch_size  # noqa: B018 - raises on a bad value
    check_encodable(df.schema)
    checked.require(("checkpointLocation",))
    location = checked["checkpointLocation"].rstrip("/")
    name = query_name or hashlib.sha256(location.encode()).hexdigest()[:16]
    target = collection_path(checked)
    checkpoint = _checkpoint(df.sparkSession, checked, target, f"load={name}-")

    def each(batch: DataFrame, batch_id: int) -> None:
        append_collection(batch, checked, load=f"{name}-{batch_id}")

    if checked.get("primaryKey") and checked.get("keysInState", "false").lower() == "true":
        df, each = _with_new_keys(df, checked, name, not {"availableNow", "once"} & trigger.keys())
    return _start(df, checkpoint, trigger, each)


def _with_new_keys(df: DataFrame, options: Options, name: str, lists_each_time: bool):
    """A stream of the documents whose keys are new to its state, and its sink.

    The state holds the keys that the stream has seen, in the store that the
    session names. The collection's own keys are followed as a second stream, so
    that each enters the state once: those that are stored when the query starts
    for the first time, and later what any writer appends.

    What another writer commits after a micro-batch was planned is not in the
    state: the append looks at commits since ``known``. The first batch after a
    start may have been planned long before, so it looks at all stored keys.
    """
    spark, target = df.sparkSession, collection_path(options)
    log = opened(spark, target)
    known = log.version
    looked_at_all = False
    rows = with_key(df, options["primaryKey"]).withColumn("seed", F.lit(False))
    seeds = spark.readStream.schema(DOCUMENT_SCHEMA).parquet(target)
    seeds = seeds.select(F.lit("").alias("doc"), "_key", F.lit(True).alias("seed"))
    keyed = rows.where("_key IS NOT NULL").mapInArrow(first_of_batch, rows.schema)
    keyed = keyed.unionByName(seeds.where("_key IS NOT NULL")).dropDuplicates(["_key"])
    stream = keyed.unionByName(rows.where("_key IS NULL"))

    def each(batch: DataFrame, batch_id: int) -> None:
        nonlocal known, looked_at_all
        load = f"{name}-{batch_id}"
        with staged(batch.where("NOT seed")) as fresh:
            if not fresh.isEmpty():
                since = known if looked_at_all else -1
                append_new_documents(fresh, options, load, since, f"/load={name}-")
        looked_at_all = True
        if lists_each_time:  # the next batch is planned after this, with all that is stored now
            known = log.version

    return stream, each


def follow_log(
    spark: SparkSession,
    options: Mapping[str, object],
    each: Callable[[DataFrame, int], None],
    schema: T.StructType | str | None = None,
    start: Offset | Mapping[int, Offset] | None = None,
    end: Offset | None = None,
    keep: Sequence[str] = (),
    **trigger: object,
) -> StreamingQuery:
    """Start a query that hands each micro-batch of a log to ``each``, as typed rows.

    When ``each`` returns, the range of messages that the batch covered is
    acknowledged to the subscription: ``cursor`` gives the last of them, and a
    later query, with another checkpoint or in batch, goes on from there, which is
    where it starts if no ``start`` is given. A query that is started again from
    its checkpoint with a ``start`` needs the same one. A batch whose ``each``
    failed is given again; one that was acknowledged is not, unless ``start`` says.
    """
    checked = log_options(options)
    checked.require(("checkpointLocation",))
    wanted = infer_log_schema(spark, checked) if schema is None else as_schema(schema)
    if start is None:
        start = cursor(spark, checked)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        ranges = covered_by(batch)
        each(decode_lenient(batch, wanted, "payload", keep), batch_id)
        acknowledge(spark, checked, ranges)

    log = stream_messages(spark, checked, start, end)
    return _start(log, checked["checkpointLocation"], trigger, on_batch)
