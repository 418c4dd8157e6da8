"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

import pytest

from doclog import decode_lenient, decode_strict, encode_documents

TABLES = "/root/testdata/sf0.001"
BOTH = [decode_strict, decode_lenient]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("decode", BOTH)
def test_decoding_is_one_narrow_stage(spark, decode):
    events = spark.read.parquet(f"{TABLES}/events.parquet")
    text = plan(decode(events, "k BIGINT, s STRING", "props", keep=["event_id"]))
    for operator in ("Exchange", "Python", "Arrow", "Sort"):
        assert operator not in text
    # a document is read once by each parser, however many fields use it
    assert text.count("from_json") == 1 and text.count("parseJson") == 1
    assert "ReadSchema: struct<event_id:bigint,props:string>" in text


@pytest.mark.parametrize("decode", BOTH)
def test_filters_on_carried_columns_reach_the_scan(spark, decode):
    events = spark.read.parquet(f"{TABLES}/events.parquet")
    rows = decode(events, "k BIGINT", "props", keep=["event_id"]).where("event_id > 10 AND k > 3")
    assert "GreaterThan(event_id,10)" in plan(rows)


@pytest.mark.parametrize("decode", BOTH)
def test_dropping_columns_does_not_change_the_rows(spark, decode):
    docs = spark.createDataFrame([('{"a":1,"b":2}',), ('{"a":1}',)], "doc string")
    rows = decode(docs, "a BIGINT, b BIGINT", "doc")
    assert rows.select("a").count() == rows.count() == 1


def test_encoding_is_one_projection(spark):
    parts = spark.read.parquet(f"{TABLES}/part.parquet")
    text = plan(encode_documents(parts.select("p_partkey", "p_name", "p_retailprice")))
    assert "Exchange" not in text and "Python" not in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_retailprice:double>" in text
