from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from doclog import append_collection, documents, infer_majority_schema, read_collection
from doclog.operators import keyed
from doclog.sources import collection_options, collection_path, decode_results


@pytest.fixture
def options(tmp_path):
    return {"regionUrl": str(tmp_path), "fabric": "_system", "collection": "c"}


def stored(spark, options):
    rows = documents(spark, options).collect()
    return sorted((r._key, r.doc) for r in rows)


def test_program_read_rename_add_append(spark, options):
    """Read, select, rename, add a random column, append by key, read again."""
    values = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "value string")
    append_collection(values, options)
    source = read_collection(spark, {**options, "batchSize": 10000})
    assert source.schema == StructType.fromDDL("value STRING")
    modified = (
        source.select("value").withColumnRenamed("value", "number")
        .withColumn("randomNumber", F.rand())
    )
    target = {**options, "collection": "target", "batchSize": 10000, "primaryKey": "number"}
    append_collection(modified, target)
    back = read_collection(spark, target, "number STRING, randomNumber DOUBLE").collect()
    assert sorted(str(r.number) for r in back) == ["None", "a", "b"]
    assert all(0 <= r.randomNumber < 1 for r in back)


def test_user_schema_and_drop_rule(spark, options):
    append_collection(spark.range(3).selectExpr("id AS value"), options)
    append_collection(spark.range(2).selectExpr("CAST(id AS STRING) AS value"), options)
    assert read_collection(spark, options, "value STRING").count() == 2
    assert read_collection(spark, options, "value BIGINT").count() == 3
    assert read_collection(spark, options, "value BIGINT, other BIGINT").count() == 0


def test_query_takes_the_place_of_every_document(spark, options):
    append_collection(spark.range(10).selectExpr("id AS value", "id % 2 AS odd"), options)
    text = "SELECT doc FROM {collection} WHERE get_json_object(doc, '$.odd') = '1'"
    rows = read_collection(spark, {**options, "query": text}, "value BIGINT")
    assert sorted(r.value for r in rows.collect()) == [1, 3, 5, 7, 9]
    text = "SELECT parse_json(doc) AS v FROM {collection}"
    assert read_collection(spark, {**options, "query": text}).count() == 10
    text = "SELECT get_json_object(doc, '$.odd') AS odd, count(*) AS n FROM {collection} GROUP BY 1"
    rows = read_collection(spark, {**options, "query": text}).collect()
    assert sorted(map(tuple, rows)) == [("0", 5), ("1", 5)]
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN|PARSE_SYNTAX_ERROR"):
        read_collection(spark, {**options, "query": "SELECT nothing FROM {collection}"})


def test_query_rows_are_decoded_like_documents(spark):
    rows = spark.range(2).selectExpr("id", "IF(id = 0, NULL, 'x') AS s")
    assert decode_results(rows) is rows
    assert sorted(map(tuple, decode_results(rows, "id BIGINT, s STRING").collect())) == [
        (0, None), (1, "x")]
    assert decode_results(rows, "id STRING").count() == 0


def test_missing_collection(spark, options):
    for schema in (None, "value BIGINT"):
        with pytest.raises(ValueError, match="does not exist"):
            read_collection(spark, options, schema)


def test_one_document_per_key(spark, options):
    keyed_options = {**options, "primaryKey": "k"}
    rows = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    append_collection(rows, keyed_options)
    assert stored(spark, options) == [("1", '{"k":1,"v":"a"}'), ("2", '{"k":2,"v":"c"}')]
    # a stored key keeps its document; the batch is reduced by itself first
    more = spark.createDataFrame([(2, "A"), (3, "z"), (3, "y")], "k int, v string")
    append_collection(more, keyed_options)
    assert stored(spark, options) == [
        ("1", '{"k":1,"v":"a"}'), ("2", '{"k":2,"v":"c"}'), ("3", '{"k":3,"v":"y"}')]


def test_rows_without_a_key_are_all_kept(spark, options):
    keyed_options = {**options, "primaryKey": "k"}
    rows = spark.createDataFrame([(None, "x"), (None, "x"), (1, "a")], "k int, v string")
    for _ in range(2):
        append_collection(rows, keyed_options)
    keys = [r._key for r in documents(spark, options).collect()]
    assert keys.count(None) == 4 and keys.count("1") == 1


@pytest.mark.parametrize("limit", [0, keyed.BROADCAST_KEY_BYTES])
def test_both_ways_to_find_new_keys_agree(spark, limit):
    docs = ["CAST(id AS STRING) AS _key", "'d' AS doc"]
    batch = spark.range(0, 200, 3).selectExpr(*docs)
    old = spark.range(0, 500, 2).selectExpr(*docs)
    fresh = keyed.new_keys_only(batch, old, limit)
    assert sorted(int(r._key) for r in fresh.collect()) == [i for i in range(0, 200, 3) if i % 2]
    plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    assert ("LeftSemi" in plan) == (limit > 0)


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    rows = spark.range(0, 30000, 1, 6).selectExpr("IF(id % 3 < 2, 0, id) AS k", "id AS v")
    reduced = keyed.one_per_key(keyed.with_key(rows, "k"))
    assert reduced.count() == 10001  # every third id, and 0
    assert "partial_min" in reduced._jdf.queryExecution().executedPlan().toString()


def test_a_load_is_done_once(spark, options):
    rows = spark.range(5).selectExpr("id AS value")
    assert append_collection(rows, options, load="a-0") is True
    files = sorted(os.listdir(f"{collection_path(collection_options(options))}/load=a-0"))
    assert append_collection(rows, options, load="a-0") is False
    assert sorted(os.listdir(f"{collection_path(collection_options(options))}/load=a-0")) == files
    assert documents(spark, options).count() == 5


def test_an_append_that_fails_shows_nothing(spark, options):
    append_collection(spark.range(3).selectExpr("id AS value"), options, load="a")
    bad = spark.range(100).selectExpr("IF(id = 99, raise_error('stop'), id) AS value")
    with pytest.raises(Exception, match="stop"):
        append_collection(bad, options, load="b")
    assert documents(spark, options).count() == 3
    assert append_collection(spark.range(4).selectExpr("id AS value"), options, load="b")
    assert documents(spark, options).count() == 7


def test_groups_of_documents_are_pages_not_files(spark, options):
    rows = spark.range(0, 1000, 1, 1).selectExpr("id AS value")
    append_collection(rows, {**options, "batchSize": 50}, load="a")
    folder = f"{collection_path(collection_options(options))}/load=a"
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert len(files) == 1
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{files[0]}")
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    block = reader.getFooter().getBlocks().get(0)
    assert reader.readOffsetIndex(block.getColumns().get(0)).getPageCount() == 20
    reader.close()


def test_batch_size_is_checked_before_writing(spark, options):
    with pytest.raises(ValueError, match="Batch size"):
        append_collection(spark.range(1), {**options, "batchSize": 0})
    with pytest.raises(TypeError, match="Unsupported"):
        append_collection(spark.sql("SELECT current_date() AS d"), options)
    assert not os.path.exists(collection_path(collection_options(options)))


def test_inference_reads_the_collection(spark, options):
    rows = spark.sql("SELECT 1.5D AS d, array(1L, 2L) AS a, named_struct('x', true) AS o")
    append_collection(rows, options)
    assert infer_majority_schema(documents(spark, options)) == StructType.fromDDL(
        "a ARRAY<BIGINT>, d DOUBLE, o STRUCT<x: BOOLEAN>")
    row = read_collection(spark, options).first()
    assert json.loads(json.dumps(row.asDict(True))) == {"a": [1, 2], "d": 1.5, "o": {"x": True}}


def test_keyed_append_reads_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    options = {
        "regionUrl": str(tmp_path), "fabric": "f", "collection": "once", "apiKey": "k", "primaryKey": "k",
    }

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).selectExpr("CASE WHEN id % 10 > 0 THEN id END AS k", "id AS v")
    append_collection(rows.mapInArrow(count, rows.schema), options)
    assert seen.value == 1000
    append_collection(rows.mapInArrow(count, rows.schema), options)
    assert seen.value == 2000
    assert documents(spark, options).count() == 1000 + 100


def test_keyed_append_of_unstable_keys_loses_no_row(spark, tmp_path):
    options = {
        "regionUrl": str(tmp_path), "fabric": "f", "collection": "unstable", "apiKey": "k", "primaryKey": "k",
    }
    rows = spark.range(20000).selectExpr("CASE WHEN rand() < 0.5 THEN uuid() END AS k", "id AS v")
    append_collection(rows, options)
    assert documents(spark, options).count() == 20000


def test_known_keys_move_no_documents(spark):
    batch = spark.createDataFrame([("{}", str(i % 5)) for i in range(20)], "doc string, _key string")
    stored = batch.where("_key < '3'")
    fresh = keyed.new_keys_only(batch, stored)
    assert sorted(r._key for r in fresh.collect()) == ["3", "4"]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
