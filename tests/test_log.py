from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from doclog import (
    EARLIEST,
    Offset,
    append_collection,
    documents,
    infer_log_schema,
    latest_offset,
    messages,
    read_collection,
    read_log,
    stream_log,
    write_collection,
    write_log,
)
from doclog.functions import offset_from_json, offset_to_json
from doclog.sources import log_options, log_path, offset_bounds
from doclog.sources.storage import publish
from doclog.streaming import write_ledger


@pytest.fixture
def options(tmp_path):
    return {"regionUrl": str(tmp_path), "fabric": "_system", "tenant": "t", "stream": "s",
            "replication": "global", "subscriptionName": "me"}


def put(spark, options, ledger, rows, partition=0):
    return write_ledger(rows, log_path(log_options(options)), partition, ledger)


def put_text(spark, options, ledger, texts, partition=0):
    rows = [(i, bytearray(t.encode())) for i, t in enumerate(texts)]
    rows = spark.createDataFrame(rows, "entry_id bigint, payload binary").coalesce(1)
    publish(rows, log_path(log_options(options)), f"partition_index={partition}/ledger_id={ledger}")


def ids(log):
    return sorted(tuple(r) for r in log.select("ledger_id", "entry_id", "partition_index").collect())


def test_ranges(spark, options):
    for ledger in (1, 2, 3):
        put_text(spark, options, ledger, ['{"k":1}', '{"k":2}'])
    put_text(spark, options, 2, ['{"k":3}'], partition=1)
    every = ids(messages(spark, options))
    assert every == [(1, 0, 0), (1, 1, 0), (2, 0, 0), (2, 0, 1), (2, 1, 0), (3, 0, 0), (3, 1, 0)]
    bounds = [EARLIEST] + [Offset(*i) for i in every]
    for a in bounds:
        for b in (bounds[1], bounds[4], bounds[5], bounds[7]):
            assert ids(messages(spark, options, a, b)) == [i for i in every if a < i <= b]
    assert latest_offset(spark, options) == (3, 1, 0)
    assert tuple(offset_bounds(messages(spark, options)).first()) == (1, 0, 0, 3, 1, 0)
    rows = read_log(spark, options, "k INT", Offset(2, 0, 0), Offset(2, 1, 0), keep=["entry_id"])
    assert sorted(map(tuple, rows.collect())) == [(0, 3), (1, 2)]


def test_a_range_prunes_ledgers(spark, options):
    for ledger in range(4):
        put_text(spark, options, ledger, ['{"k":1}'])
    log = messages(spark, options, Offset(1, 0, 0), Offset(2, 0, 0))
    plan = log._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    assert "(ledger_id" in filters and ">= 1" in filters and "<= 2" in filters
    assert log.count() == 1


def test_empty_log(spark, options):
    put_text(spark, options, 0, [])
    assert latest_offset(spark, options) == EARLIEST
    with pytest.raises(ValueError, match="no message"):
        infer_log_schema(spark, options)


def test_missing_stream(spark, options):
    for schema in (None, "k INT"):
        with pytest.raises(ValueError, match="does not exist"):
            stream_log(spark, options, schema)


def test_offset_text(spark):
    rows = spark.createDataFrame([(5, 7, 1), (-1, -1, -1)], "l bigint, e bigint, p int").coalesce(1)
    texts = rows.select(offset_to_json(F.col("l"), F.col("e"), F.col("p")).alias("t"))
    assert [r.t for r in texts.collect()] == [
        '{"ledgerId":5,"entryId":7,"partitionIndex":1}',
        '{"ledgerId":-1,"entryId":-1,"partitionIndex":-1}']
    back = texts.select(offset_from_json(F.col("t")).alias("o")).select("o.*")
    assert [tuple(r) for r in back.collect()] == [(5, 7, 1), (-1, -1, -1)]


@pytest.mark.parametrize("text", ["no", "{}", '{"ledgerId":1,"entryId":2}', '{"ledgerId":"x",'
                                  '"entryId":2,"partitionIndex":0}'])
def test_bad_offset_text_raises(spark, text):
    rows = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="Not an offset|MALFORMED_RECORD"):
        rows.select(offset_from_json(F.col("t"))).collect()


def test_first_message_is_found_ledger_by_ledger(spark, options):
    for ledger in range(11):
        put_text(spark, options, ledger, ["", " "])
    put_text(spark, options, 11, [" ", '{"b":1.5,"a":"x"}', '{"c":1}'])
    put_text(spark, options, 12, ['{"c":1}'])
    assert infer_log_schema(spark, options) == StructType.fromDDL("a STRING, b DOUBLE")
    # inference takes nothing away: the message is still there to be read
    assert read_log(spark, options).collect() == [("x", 1.5)]


def drain(stream, path):
    query = (stream.writeStream.format("parquet").option("path", path)
             .option("checkpointLocation", path + "-checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def test_stream_scan_in_several_batches(spark, options, tmp_path):
    for ledger in range(5):
        put(spark, options, ledger, spark.range(ledger * 10, ledger * 10 + 10))
    put_text(spark, options, 9, ["", '{"other":1}', '{"id":null}', '{"id":"77"}'])
    stream = stream_log(spark, {**options, "maxFilesPerTrigger": 2}, "id BIGINT")
    query = drain(stream, str(tmp_path / "out"))
    assert len(query.recentProgress) > 1
    got = [r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(i for i in got if i is not None) == list(range(50)) + [77]
    assert got.count(None) == 1
    # a new ledger is all that the next run reads
    put(spark, options, 20, spark.range(100, 103))
    drain(stream, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 55


def test_program_stream_to_stream(spark, options, tmp_path):
    """Read a stream, select and rename, write a stream."""
    rows = spark.range(100).selectExpr("concat('S', id % 7) AS symbol", "id / 4 AS ma", "id")
    put(spark, options, 0, rows)
    target = {**options, "stream": "target", "checkpointLocation": str(tmp_path / "checkpoint")}
    stream = stream_log(spark, options).select("symbol", "ma").withColumnRenamed("ma", "value")
    write_log(stream, target, availableNow=True).awaitTermination()
    back = read_log(spark, target)
    assert back.schema == StructType.fromDDL("symbol STRING, value DOUBLE")
    assert sorted(map(tuple, back.collect())) == sorted(
        tuple(r) for r in rows.select("symbol", "ma").collect())
    assert messages(spark, target).select("ledger_id", "entry_id").distinct().count() == 100


def test_program_stream_to_collection(spark, options, tmp_path):
    """Read a stream, append each micro-batch to a collection."""
    put(spark, options, 0, spark.range(10).selectExpr("id", "'x' AS s"))
    target = {"regionUrl": str(tmp_path), "fabric": "_system", "collection": "c", "batchSize": 100,
              "checkpointLocation": str(tmp_path / "checkpoint")}
    for _ in range(2):
        write_collection(stream_log(spark, options), target, availableNow=True).awaitTermination()
    assert read_collection(spark, target, "id BIGINT, s STRING").count() == 10
    put(spark, options, 1, spark.range(10, 15).selectExpr("id", "'y' AS s"))
    write_collection(stream_log(spark, options), target, availableNow=True).awaitTermination()
    assert read_collection(spark, target, "id BIGINT, s STRING").count() == 15


def forget_last_commit(checkpoint):
    """What a driver leaves that dies after a batch was written, before it is committed."""
    commits = sorted(glob.glob(f"{checkpoint}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for path in (commits[-1], f"{os.path.dirname(commits[-1])}/.{os.path.basename(commits[-1])}.crc"):
        if os.path.exists(path):
            os.remove(path)


@pytest.mark.parametrize("key", [None, "id"])
def test_a_batch_that_runs_again_is_not_written_twice(spark, options, tmp_path, key):
    checkpoint = str(tmp_path / "checkpoint")
    collection = {"regionUrl": str(tmp_path), "fabric": "_system", "collection": "c",
                  "checkpointLocation": checkpoint + "-c", **({"primaryKey": key} if key else {})}
    target = {**options, "stream": "target", "checkpointLocation": checkpoint}
    for ledger in (0, 1):
        put(spark, options, ledger, spark.range(ledger * 50, ledger * 50 + 50))
        stream = stream_log(spark, options, "id BIGINT")
        for _ in range(2):
            write_log(stream, target, availableNow=True).awaitTermination()
            write_collection(stream, collection, availableNow=True).awaitTermination()
            forget_last_commit(checkpoint)
            forget_last_commit(checkpoint + "-c")
    log = read_log(spark, target, "id BIGINT")
    assert sorted(r.id for r in log.collect()) == list(range(100))
    assert sorted(r.id for r in read_collection(spark, collection, "id BIGINT").collect()) == list(
        range(100))
    # a follower of the target saw no message twice either
    drain(stream_log(spark, target, "id BIGINT"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100


def test_a_half_written_ledger_is_never_seen(spark, options):
    put(spark, options, 0, spark.range(5))
    bad = spark.range(0, 100, 1, 4).selectExpr("IF(id = 99, raise_error('stop'), id) AS id")
    with pytest.raises(Exception, match="stop"):
        put(spark, options, 1, bad)
    assert messages(spark, options).count() == 5
    assert put(spark, options, 1, spark.range(7)) is True
    assert put(spark, options, 1, spark.range(9)) is False
    assert messages(spark, options).count() == 12


def test_two_writers_of_one_log(spark, options, tmp_path):
    put(spark, options, 0, spark.range(10))
    stream = stream_log(spark, options, "id BIGINT")
    for index in (0, 1):
        target = {**options, "stream": "t", "checkpointLocation": str(tmp_path / f"c{index}")}
        write_log(stream, target, partition_index=index, availableNow=True).awaitTermination()
    log = messages(spark, target)
    assert log.count() == 20 and log.select("partition_index").distinct().count() == 2


def test_a_new_checkpoint_cannot_take_the_place_of_another(spark, options, tmp_path):
    put(spark, options, 0, spark.range(10))
    stream = stream_log(spark, options, "id BIGINT")
    target = {**options, "stream": "t", "checkpointLocation": str(tmp_path / "a")}
    collection = {"regionUrl": str(tmp_path), "fabric": "f", "collection": "c",
                  "checkpointLocation": str(tmp_path / "b")}
    write_log(stream, target, availableNow=True).awaitTermination()
    write_collection(stream, collection, "q", availableNow=True).awaitTermination()
    other = str(tmp_path / "other")
    with pytest.raises(ValueError, match="another checkpoint"):
        write_log(stream, {**target, "checkpointLocation": other})
    with pytest.raises(ValueError, match="another checkpoint"):
        write_collection(stream, {**collection, "checkpointLocation": other}, "q")
    for write, to in ((write_log, target), (write_collection, collection)):
        with pytest.raises(ValueError, match="checkpointLocation"):
            write(stream, {**to, "checkpointLocation": ""})
    # a name of its own is made for another checkpoint of a collection
    write_collection(stream, {**collection, "checkpointLocation": other},
                     availableNow=True).awaitTermination()
    assert documents(spark, collection).count() == 20


def test_collection_as_stream(spark, options, tmp_path):
    collection = {"regionUrl": str(tmp_path), "fabric": "_system", "collection": "c"}
    append_collection(spark.range(3).selectExpr("id", "'a' AS s"), collection)
    changes = {**options, "replication": "local", "stream": "c", "isCollectionStream": "true"}
    stream = stream_log(spark, changes)
    assert stream.schema == StructType.fromDDL("id BIGINT, s STRING")
    drain(stream, str(tmp_path / "out"))
    # the stream's rule is the lenient one, and its schema stays
    append_collection(spark.range(3, 5).selectExpr("CAST(id AS STRING) AS id", "1 AS s"), collection)
    drain(stream, str(tmp_path / "out"))
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == [(0, "a"), (1, "a"), (2, "a"), (3, "1"), (4, "1")]
    assert documents(spark, collection).count() == 5
    with pytest.raises(ValueError, match="only be read"):
        write_log(stream, changes)


def test_rows_without_a_json_form_are_refused_at_start(spark, options, tmp_path):
    put(spark, options, 0, spark.range(1))
    stream = stream_log(spark, options, "id BIGINT").selectExpr("current_date() AS d")
    with pytest.raises(TypeError, match="Unsupported"):
        write_log(stream, {**options, "stream": "t"})
    with pytest.raises(TypeError, match="Unsupported"):
        write_collection(stream, {"regionUrl": str(tmp_path), "fabric": "f", "collection": "c"})
