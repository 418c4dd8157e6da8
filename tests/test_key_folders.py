"""Keyed collections whose keys lie in folders by hash."""

from __future__ import annotations

import os
import random
import threading

import pytest

from doclog import append_collection, documents, read_collection, stream_log
from doclog.operators import keyed
from doclog.sources import collection_options, collection_path
from doclog.sources.collection import stored_key_buckets


@pytest.fixture
def options(tmp_path):
    return {"regionUrl": str(tmp_path), "fabric": "_system", "collection": "c", "primaryKey": "k", "keyBuckets": 8}


def path(options):
    return collection_path(collection_options(options))


def test_same_rows_as_without_folders(spark, options, tmp_path):
    draw = random.Random(1)
    plain = {**options, "collection": "plain", "keyBuckets": None}
    for n in (40, 1, 60, 0, 25):
        rows = [(draw.choice([None, *range(50)]), draw.choice("abc")) for _ in range(n)]
        frame = spark.createDataFrame(rows, "k int, v string")
        for to in (options, plain):
            append_collection(frame, to)
    found = [sorted((r._key or "", r.doc) for r in documents(spark, o).collect()) for o in (options, plain)]
    assert found[0] == found[1]
    assert documents(spark, options).columns == ["doc", "_key", "load"]
    assert read_collection(spark, options, "k BIGINT, v STRING").count() == len(found[0])
    # an append without a key column is stored beside, and is no key
    append_collection(spark.range(3).selectExpr("id AS k"), {**options, "primaryKey": None})
    append_collection(spark.range(3).selectExpr("id + 1000 AS k"), options)
    assert documents(spark, options).count() == len(found[0]) + 6


def test_layout(spark, options):
    rows = spark.range(500).selectExpr("IF(id < 50, NULL, id) AS k", "id AS v").repartition(4)
    append_collection(rows, options, load="a")
    found = [b for b in os.listdir(f"{path(options)}/load=a") if b.startswith("bucket")]
    assert sorted(found) == sorted(f"bucket={i}" for i in range(-1, 8))
    for b in range(8):
        files = [f for f in os.listdir(f"{path(options)}/load=a/bucket={b}") if f.endswith(".parquet")]
        assert len(files) == 1
    assert stored_key_buckets(spark, path(options)) == 8
    # the number is a property of the collection
    append_collection(spark.range(490, 510).selectExpr("id AS k", "id AS v"), {**options, "keyBuckets": None})
    assert documents(spark, options).count() == 510
    with pytest.raises(ValueError, match="cannot be changed"):
        append_collection(rows, {**options, "keyBuckets": 16})
    with pytest.raises(ValueError, match="cannot be changed"):
        old = {**options, "collection": "old", "keyBuckets": None}
        append_collection(rows, old)
        append_collection(rows, {**old, "keyBuckets": 4})
    with pytest.raises(ValueError, match="from 1 to"):
        append_collection(rows, {**options, "collection": "bad", "keyBuckets": 0})


def _stored(spark, options):
    schema = "doc STRING, _key STRING, load STRING, bucket INT"
    return spark.read.schema(schema).parquet(path(options)).where("_key IS NOT NULL")


def test_only_touched_folders_are_read(spark, options):
    append_collection(spark.range(400).selectExpr("id AS k", "id AS v"), options)
    batch = spark.createDataFrame([("{}", "5"), ("{}", "x5")], "doc string, _key string")
    touched = {r[0] for r in batch.select(keyed.key_bucket(8)).collect()}
    fresh = keyed.new_keys_in_buckets(batch, _stored(spark, options), 8)
    assert [r._key for r in fresh.collect()] == ["x5"]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    wanted = [str(b) for b in sorted(touched)]
    assert any("bucket" in line and all(b in line for b in wanted) for line in filters)
    read = _stored(spark, options).where(f"bucket IN ({','.join(wanted)})").select("_metadata.file_path").distinct()
    assert read.count() == len(touched)


@pytest.mark.parametrize("limit", [400, 4000, 10**6])
def test_stored_keys_are_not_shuffled(spark, options, limit):
    append_collection(spark.range(0, 500, 2).selectExpr("id AS k", "id AS v"), options)
    batch = spark.range(0, 200, 3).selectExpr("concat('{', id, '}') AS doc", "CAST(id AS STRING) AS _key")
    fresh = keyed.new_keys_in_buckets(batch, _stored(spark, options), 8, limit)
    assert sorted(int(r._key) for r in fresh.collect()) == [i for i in range(0, 200, 3) if i % 2]
    plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    joins = plan.count("LeftSemi")
    if limit == 400:  # a folder's keys alone are too many to be sent
        assert joins == 0
    else:
        assert joins >= 1 + (limit == 4000)
        # every scan of stored keys is the streamed side of a broadcast join
        executed = fresh._jdf.queryExecution().sparkPlan().toString()
        lines = executed.splitlines()
        for i, line in enumerate(lines):
            if "FileScan" in line and "bucket" in line:
                above = [x for x in lines[:i] if "Join" in x]
                assert "BroadcastHashJoin" in above[-1] and "LeftSemi" in above[-1]


def test_groups_of_folders():
    assert keyed.bucket_groups({}, 10) == []
    assert keyed.bucket_groups({0: 4, 1: 6, 2: 1, 5: 20, 6: 3}, 10) == [[0, 1], [2], [5], [6]]


def test_two_writers(spark, options):
    def append(name, first):
        rows = spark.range(first, first + 300).selectExpr("id AS k", f"'{name}' AS v")
        append_collection(rows, options, load=name)

    append_collection(spark.range(1).selectExpr("id AS k", "'old' AS v"), options)
    threads = [threading.Thread(target=append, args=(f"w{i}", i * 100)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    keys = [int(r._key) for r in documents(spark, options).collect()]
    assert sorted(keys) == list(range(500))


def test_followed_as_a_stream(spark, options, tmp_path):
    append_collection(spark.range(30).selectExpr("id AS k", "'x' AS v"), options)
    changes = {"regionUrl": str(tmp_path), "fabric": "_system", "tenant": "t", "replication": "local",
               "stream": "c", "subscriptionName": "me", "isCollectionStream": True}
    query = (stream_log(spark, changes).writeStream.format("memory").queryName("followed")
             .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.table("followed").count() == 30
