from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from doclog import decode_strict, encode_documents, encode_messages


def test_order_nulls_and_text(spark):
    rows = spark.createDataFrame(
        [(2, "é\"\\\n\t", None, True, 1.5)],
        "z int, `a.b` string, n bigint, t boolean, d double",
    )
    assert encode_documents(rows).first().doc == (
        '{"z":2,"a.b":"é\\"\\\\\\n\\t","n":null,"t":true,"d":1.5}'
    )
    assert bytes(encode_messages(rows).first().payload).decode() == encode_documents(rows).first().doc


def test_nonfinite_numbers_are_null_at_every_depth(spark):
    nan, inf = float("nan"), float("inf")
    rows = spark.createDataFrame(
        [(nan, [1.0, nan, None, -inf], (inf, [(nan, 1)]), "NaN"), (2.0, None, None, None)],
        "d double, a array<double>, o struct<f: float, x: array<struct<g: double, i: int>>>, s string",
    ).coalesce(1)
    docs = [json.loads(r.doc) for r in encode_documents(rows).collect()]
    assert docs == [
        {"d": None, "a": [1.0, None, None, None], "o": {"f": None, "x": [{"g": None, "i": 1}]},
         "s": "NaN"},
        {"d": 2.0, "a": None, "o": None, "s": None},
    ]


def test_a_column_of_nothing_but_nulls(spark):
    rows = spark.range(1).select(F.lit(None).alias("v"), "id")
    assert encode_documents(rows).first().doc == '{"v":null,"id":0}'


@pytest.mark.parametrize(
    "type_", ["date", "timestamp_ntz", "decimal(5,2)", "binary", "map<string,int>", "tinyint",
              "array<date>", "struct<x: smallint>"])
def test_types_without_a_json_form_raise_before_any_job(spark, type_):
    rows = spark.createDataFrame([], f"ok int, v {type_}")
    with pytest.raises(TypeError, match="Unsupported data type"):
        encode_documents(rows)


def test_round_trip(spark):
    schema = "n BIGINT, s STRING, b BOOLEAN, d DOUBLE, a ARRAY<STRING>, o STRUCT<p: BIGINT>"
    rows = spark.createDataFrame(
        [(1, "x", True, 0.1, ["y", None], (5,)), (None, None, None, None, None, None),
         (-(2**63), "", False, -1e-300, [], (None,))], schema)
    back = decode_strict(encode_documents(rows), schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))
