"""Starting, stopping and resuming at offsets; cursors; keys held in a stream's state."""

from __future__ import annotations

import glob
import os

import pytest

from doclog import (
    Offset,
    append_collection,
    covered,
    cursor,
    documents,
    follow_log,
    read_collection,
    read_log,
    stream_log,
    write_collection,
)
from doclog.sources import log_options, log_path
from doclog.streaming import write_ledger


@pytest.fixture
def log(tmp_path):
    return {"regionUrl": str(tmp_path), "fabric": "_system", "tenant": "t", "stream": "s",
            "replication": "global", "subscriptionName": "me", "checkpointLocation": str(tmp_path / "ck")}


def put(spark, options, ledger, rows, partition=0):
    return write_ledger(rows, log_path(log_options(options)), partition, ledger)


def follow(spark, options, got, **more):
    def each(rows, batch_id):
        got.append(sorted(r.id for r in rows.collect()))

    query = follow_log(spark, options, each, "id BIGINT", availableNow=True, **more)
    query.awaitTermination()
    assert query.exception() is None


def test_a_subscription_goes_on_with_another_checkpoint(spark, log, tmp_path):
    for ledger in range(4):
        put(spark, log, ledger, spark.range(ledger * 10, ledger * 10 + 10, 1, 3))
    got = []
    # one file at a time, up to an offset inside the third ledger
    stop = Offset(2, 1, 0)
    follow(spark, {**log, "maxFilesPerTrigger": 1}, got, end=stop)
    assert len(got) > 4
    first = [i for batch in got for i in batch]
    assert first == sorted(first) and first == list(range(22))
    assert cursor(spark, log) == {0: stop}
    ranges = covered(spark, log)
    assert ranges[0].first == Offset(0, 0, 0) and ranges[-1].last == stop
    assert all(a.last < b.first for a, b in zip(ranges[:-1], ranges[1:], strict=True))
    # a batch read of what is left, then a stream with a new checkpoint
    left = read_log(spark, log, "id BIGINT", start=cursor(spark, log))
    assert sorted(r.id for r in left.collect()) == list(range(22, 40))
    put(spark, log, 4, spark.range(40, 45))
    got = []
    follow(spark, {**log, "checkpointLocation": str(tmp_path / "other"), "maxFilesPerTrigger": 2}, got)
    assert sorted(i for batch in got for i in batch) == list(range(22, 45))
    # another subscription has a place of its own
    got = []
    other = {**log, "subscriptionName": "you", "checkpointLocation": str(tmp_path / "you")}
    follow(spark, other, got)
    assert sorted(i for batch in got for i in batch) == list(range(45))
    assert cursor(spark, other) == cursor(spark, log)


def test_a_slow_partition_is_not_skipped(spark, log, tmp_path):
    put(spark, log, 50, spark.range(5), partition=0)
    got = []
    follow(spark, log, got)
    put(spark, log, 1, spark.range(5, 8), partition=1)
    put(spark, log, 51, spark.range(8, 10), partition=0)
    follow(spark, {**log, "checkpointLocation": str(tmp_path / "other")}, got)
    assert sorted(i for batch in got for i in batch) == list(range(10))
    found = cursor(spark, log)
    assert set(found) == {0, 1} and found[1].ledger_id == 1 and found[0].ledger_id == 51


def test_a_failed_batch_is_given_again(spark, log):
    put(spark, log, 0, spark.range(6))
    query = follow_log(spark, log, lambda rows, i: 1 / 0, "id BIGINT", availableNow=True)
    with pytest.raises(Exception, match="division by zero"):
        query.awaitTermination()
    assert cursor(spark, log) == {}
    got = []
    follow(spark, log, got)
    assert got == [list(range(6))]


def test_a_stream_between_two_offsets(spark, log, tmp_path):
    for ledger in range(5):
        put(spark, log, ledger, spark.range(ledger * 10, ledger * 10 + 10, 1, 1))
    rows = stream_log(spark, log, "id BIGINT", start=Offset(1, 4, 0), end=Offset(3, 2, 0))
    query = (rows.writeStream.format("memory").queryName("between")
             .option("checkpointLocation", str(tmp_path / "between")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(r.id for r in spark.table("between").collect()) == list(range(15, 33))
    changes = {**log, "replication": "local", "stream": "c", "isCollectionStream": True}
    append_collection(spark.range(1), {**log, "collection": "c"})
    with pytest.raises(ValueError, match="no message offsets"):
        stream_log(spark, changes, "id BIGINT", end=Offset(3, 2, 0))
    with pytest.raises(ValueError, match="cannot be named"):
        cursor(spark, {**log, "subscriptionName": "../x"})


def test_old_ranges_are_removed(spark, log, monkeypatch):
    from doclog.sources import cursors

    monkeypatch.setattr(cursors, "KEPT_RANGES", 3)
    for i in range(8):
        cursors.acknowledge(spark, log, [cursors.Covered(Offset(i, 0, 0), Offset(i, 5, 0))])
    cursors.acknowledge(spark, log, [cursors.Covered(Offset(2, 0, 0), Offset(2, 5, 0))])
    assert [c.last.ledger_id for c in covered(spark, log)] == [5, 6, 7]
    assert cursor(spark, log) == {0: Offset(7, 5, 0)}


def _target(tmp_path, **more):
    return {"regionUrl": str(tmp_path), "fabric": "f", "collection": "c", "primaryKey": "id",
            "keysInState": True, "checkpointLocation": str(tmp_path / "keyed"), **more}


def _forget_last_commit(checkpoint):
    last = max(glob.glob(f"{checkpoint}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for path in (last, f"{os.path.dirname(last)}/.{os.path.basename(last)}.crc"):
        if os.path.exists(path):
            os.remove(path)


@pytest.mark.parametrize("buckets", [None, 4])
def test_keys_in_state(spark, log, tmp_path, buckets):
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    try:
        target = _target(tmp_path, keyBuckets=buckets)
        append_collection(spark.range(0, 300, 2).selectExpr("id", "'stored' AS v"), target)
        schema = "id BIGINT, v STRING"

        def run(ledger, first, last):
            rows = spark.range(first, last).selectExpr("id", f"'{ledger}' AS v")
            rows = rows.unionAll(rows).unionAll(spark.sql(f"SELECT CAST(NULL AS BIGINT), 'none{ledger}'"))
            put(spark, log, ledger, rows)
            query = write_collection(stream_log(spark, log, schema), target, availableNow=True)
            query.awaitTermination()
            return [p for p in query.recentProgress if p["numInputRows"]]

        run(0, 250, 310)
        # another writer, between two runs
        append_collection(spark.range(400, 405).selectExpr("id", "'other' AS v"), target)
        progress = run(1, 305, 410)
        # the second run reads what was appended since, not the 150 keys stored at first
        own = [s["numInputRows"] for p in progress for s in p["sources"] if "fabric/f/c" in s["description"]]
        assert 0 < sum(own) <= 30 + 5 + 5
        wanted = {i: "stored" for i in range(0, 300, 2)} | {i: "other" for i in range(400, 405)}
        wanted = {i: "0" for i in range(250, 310)} | {i: "1" for i in range(310, 410)} | wanted
        rows = read_collection(spark, target, schema).collect()
        assert sorted((r.id, r.v) for r in rows if r.id is not None) == sorted(wanted.items())
        assert sorted(r.v for r in rows if r.id is None) == ["none0", "none1"]
        # a batch that runs again writes nothing twice
        _forget_last_commit(target["checkpointLocation"])
        run(2, 0, 20)
        rows = read_collection(spark, target, schema).collect()
        keys = [r.id for r in rows if r.id is not None]
        assert sorted(keys) == sorted({*wanted, *range(20)}) and len(rows) == len(keys) + 3
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_another_writer_while_the_stream_runs(spark, log, tmp_path):
    target = _target(tmp_path)
    put(spark, log, 0, spark.range(5).selectExpr("id", "'a' AS v"))
    query = write_collection(stream_log(spark, log, "id BIGINT, v STRING"), target, "q", processingTime="0 seconds")
    try:
        query.processAllAvailable()
        for n in range(1, 5):
            append_collection(spark.range(n * 10, n * 10 + 5).selectExpr("id", "'other' AS v"), target)
            put(spark, log, n, spark.range(n * 10 - 5, n * 10 + 8).selectExpr("id", "'a' AS v"))
            query.processAllAvailable()
        batches = len(query.recentProgress)
    finally:
        query.stop()
    keys = [int(r._key) for r in documents(spark, target).collect()]
    wanted = {*range(5), *[i for n in range(1, 5) for i in range(n * 10 - 5, n * 10 + 8)]}
    assert sorted(keys) == sorted(wanted)
    # reading its own appends back must not keep the stream busy for ever
    assert batches < 40
