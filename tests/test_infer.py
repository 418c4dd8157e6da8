from __future__ import annotations

import pytest
from pyspark.sql.types import StructType

from doclog import infer_first_message_schema, infer_majority_schema


def frame(spark, docs):
    return spark.createDataFrame([(d,) for d in docs], "doc string").coalesce(1)


def schema(ddl):
    return StructType.fromDDL(ddl)


@pytest.mark.parametrize("docs, ddl", [
    (['{"k":1}', '{"k":"a"}', '{"k":"b"}'], "k STRING"),
    (['{"k":1.5}', '{"k":1}', '{"k":2.5}', '{"k":1}'], "k DOUBLE"),  # a tie: seen first
    (['{"k":null}'], "k STRING"),
    (['{"b":1,"a":{"y":true,"x":[1,2]}}'], "a STRUCT<x: ARRAY<BIGINT>, y: BOOLEAN>, b BIGINT"),
    (['7', '"s"', '7', '{"k":1}'], "k BIGINT"),
    (['[{"k":1},{"k":2}]'], "k BIGINT"),
])
def test_majority(spark, docs, ddl):
    assert infer_majority_schema(frame(spark, docs)) == schema(ddl)


def test_nothing_to_vote(spark):
    assert infer_majority_schema(frame(spark, []).where("doc IS NOT NULL")) == StructType()
    assert infer_majority_schema(frame(spark, ["7"])) == StructType()


def test_only_the_first_fifty_vote(spark):
    docs = ['{"k":1}'] * 50 + ['{"k":"a"}'] * 100
    assert infer_majority_schema(frame(spark, docs)) == schema("k BIGINT")


def log(spark, rows):
    return spark.createDataFrame(
        [(p, l, e, bytearray(t.encode())) for p, l, e, t in rows],
        "partition_index int, ledger_id bigint, entry_id bigint, payload binary")


def test_first_message_by_offset(spark):
    rows = [(0, 2, 0, '{"late":1}'), (1, 1, 5, '{"k":"a"}'), (0, 1, 5, " \n"), (0, 1, 4, ""),
            (0, 1, 6, '{"later":1}')]
    assert infer_first_message_schema(log(spark, rows)) == schema("k STRING")


def test_a_log_without_messages_raises(spark):
    with pytest.raises(ValueError, match="no message"):
        infer_first_message_schema(log(spark, [(0, 1, 4, "")]))
