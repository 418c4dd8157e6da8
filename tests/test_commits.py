"""Publishing by a log of committed files: half-written parts, retries, two writers at once."""

from __future__ import annotations

import os
import threading

import pytest

from doclog import append_collection, documents, latest_offset, messages, read_collection, stream_log
from doclog.sources import collection_options, collection_path, log_options, log_path
from doclog.sources import commits
from doclog.sources.commits import Commits
from doclog.sources.storage import remove_leftovers
from doclog.streaming import write_ledger


@pytest.fixture
def log(tmp_path):
    return {"regionUrl": str(tmp_path), "fabric": "_system", "tenant": "t", "stream": "s",
            "replication": "global", "subscriptionName": "me"}


@pytest.fixture
def keyed(tmp_path):
    return {"regionUrl": str(tmp_path), "fabric": "f", "collection": "c", "primaryKey": "k"}


def put(spark, options, ledger, rows):
    return write_ledger(rows, log_path(log_options(options)), 0, ledger)


def in_threads(*functions):
    failed = []

    def run(function):
        try:
            function()
        except Exception as e:  # noqa: BLE001 - shown by the assertion below
            failed.append(e)

    threads = [threading.Thread(target=run, args=(f,)) for f in functions]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed


def test_a_half_written_ledger_under_a_running_stream(spark, log, tmp_path):
    put(spark, log, 0, spark.range(10))
    query = (
        stream_log(spark, log, "id BIGINT").writeStream.format("memory").queryName("seen")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).start()
    )
    try:
        query.processAllAvailable()
        # what a writer leaves that dies before it commits: files in place of the ledger
        place = f"{log_path(log_options(log))}/partition_index=0/ledger_id=1"
        half = spark.range(10, 15).selectExpr("id AS entry_id", "CAST(to_json(struct(id)) AS BINARY) AS payload")
        half.write.parquet(place)
        query.processAllAvailable()
        assert spark.table("seen").count() == messages(spark, log).count() == 10
        assert latest_offset(spark, log).ledger_id == 0
        assert put(spark, log, 1, spark.range(10, 20)) is True
        query.processAllAvailable()
        assert put(spark, log, 1, spark.range(10, 20)) is False
        query.processAllAvailable()
        assert sorted(r.id for r in spark.table("seen").collect()) == list(range(20))
        assert messages(spark, log).count() == 20
    finally:
        query.stop()
    # the ledger was not moved into its place, and nothing waits elsewhere
    assert sorted(os.listdir(log_path(log_options(log)))) == ["_spark_metadata", "partition_index=0"]
    left = len([f for f in os.listdir(place) if f.endswith(".parquet")])
    assert remove_leftovers(spark, log_path(log_options(log)), older_than=3600) == 0
    assert remove_leftovers(spark, log_path(log_options(log)), older_than=-60) > 0
    assert 0 < len([f for f in os.listdir(place) if f.endswith(".parquet")]) < left
    assert messages(spark, log).count() == 20


def test_a_batch_plan_lists_only_committed_files(spark, log):
    put(spark, log, 0, spark.range(3))
    plan = messages(spark, log)._jdf.queryExecution().executedPlan().toString()
    assert "MetadataLogFileIndex" in plan


@pytest.mark.parametrize("extra", [0, 30000])
def test_two_writers_append_the_same_keys(spark, keyed, extra):
    def append(name, first):
        rows = spark.range(first, first + 2000).selectExpr("IF(id % 10 = 0, NULL, id) AS k", f"'{name}' AS v")
        return lambda: append_collection(rows, keyed, load=name)

    if extra:
        append_collection(spark.range(10000, 10000 + extra).selectExpr("id AS k", "'old' AS v"), keyed)
    in_threads(*[append(f"w{i}", i * 500) for i in range(4)])
    found = documents(spark, keyed)
    keys = [r._key for r in found.where("_key IS NOT NULL").collect()]
    assert len(keys) == len(set(keys))
    assert {int(k) for k in keys if int(k) < 10000} == {i for i in range(3500) if i % 10}
    assert found.where("_key IS NULL").count() == 4 * 200


def test_a_key_committed_meanwhile_is_left_out(spark, keyed, monkeypatch):
    append_collection(spark.range(5).selectExpr("id AS k", "'first' AS v"), keyed)
    add, meanwhile = Commits.add, []

    def late(self, number, states):
        if not meanwhile:
            meanwhile.append(number)
            append_collection(spark.range(3, 8).selectExpr("id AS k", "'other' AS v"), keyed)
        return add(self, number, states)

    monkeypatch.setattr(commits.Commits, "add", late)
    rows = spark.range(12).selectExpr("IF(id = 11, NULL, id) AS k", "'mine' AS v")
    assert append_collection(rows, keyed)
    found = read_collection(spark, keyed, "k BIGINT, v STRING").collect()
    assert sorted((r.k, r.v) for r in found if r.k is not None) == [
        *[(i, "first") for i in range(5)], *[(i, "other") for i in range(5, 8)], *[(i, "mine") for i in range(8, 11)]]
    assert [r.v for r in found if r.k is None] == ["mine"]


def test_one_part_by_two_writers_counts_once(spark, log):
    results = []
    in_threads(*[lambda: results.append(put(spark, log, 7, spark.range(50))) for _ in range(2)])
    assert sorted(results) == [False, True]
    assert messages(spark, log).count() == 50


def test_many_commits(spark, log):
    """Beyond the entries that are merged into one."""
    root = log_path(log_options(log))
    for ledger in range(13):
        put(spark, log, ledger, spark.range(2))
    found = Commits(spark, root)
    assert found.version == 13 and len(set(found.files())) == len(found.files())
    assert messages(spark, log).count() == 26
    assert {p.split("ledger_id=")[1].split("/")[0] for p in found.files(after=11)} == {"11", "12"}
    assert found.add(13, []) is False
    assert put(spark, log, 3, spark.range(9)) is False


def test_a_folder_from_before_the_log_stays_readable(spark, tmp_path):
    options = {"regionUrl": str(tmp_path), "fabric": "f", "collection": "old"}
    path = collection_path(collection_options(options))
    old = spark.range(4).selectExpr("CAST(id AS STRING) AS doc", "CAST(NULL AS STRING) AS _key")
    old.write.parquet(f"{path}/load=a")
    assert append_collection(spark.range(9).selectExpr("id AS v"), options, load="a") is False
    assert documents(spark, options).count() == 4
    assert append_collection(spark.range(3).selectExpr("id AS v"), options, load="b") is True
    assert append_collection(spark.range(9).selectExpr("id AS v"), options, load="a") is False
    assert documents(spark, options).count() == 7
