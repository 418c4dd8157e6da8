"""Documents and messages derived from the given tables.

The texts are valid in Spark SQL and in the SQL of the checks alike, so both
sides start from the same documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import log_options, log_path
from ..sources.storage import scratch_folder
from .registry import table

_EVENT, _USER = "cast(event_id AS string)", "cast(user_id AS string)"
_TRUTH = "CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END"

# One field k, in every state that the decoders tell apart, with the row's own values.
DOC = f"""CASE event_id % 10
    WHEN 0 THEN '{{"k":null}}'
    WHEN 1 THEN concat('{{"j":', {_USER}, '}}')
    WHEN 2 THEN concat('{{"k":"', {_USER}, '"}}')
    WHEN 3 THEN concat('{{"k":', {_USER}, '.9}}')
    WHEN 4 THEN concat('{{"k":', {_USER}, '.0}}')
    WHEN 5 THEN concat('[{{"k":', {_EVENT}, '}},{{"k":', {_USER}, '}}]')
    WHEN 6 THEN {_USER}
    WHEN 7 THEN concat('{{"k":', {_TRUTH}, '}}')
    WHEN 8 THEN concat('{{"k":"', event_type, '"}}')
    ELSE props END"""

# The same with more kinds of value, for the types other than Long.
DOC_KINDS = f"""CASE event_id % 14
    WHEN 0 THEN '{{"k":null}}'
    WHEN 1 THEN concat('{{"j":', {_USER}, '}}')
    WHEN 2 THEN concat('{{"k":"', {_USER}, '"}}')
    WHEN 3 THEN concat('{{"k":', {_USER}, '.9}}')
    WHEN 4 THEN concat('{{"k":', {_USER}, '.0}}')
    WHEN 5 THEN concat('[{{"k":', {_EVENT}, '}},{{"k":"', event_type, '"}},{{"k":', {_TRUTH}, '}},',
                       {_USER}, ']')
    WHEN 6 THEN concat('"', event_type, '"')
    WHEN 7 THEN concat('{{"k":', {_TRUTH}, '}}')
    WHEN 8 THEN concat('{{"k":"', event_type, '"}}')
    WHEN 9 THEN concat('{{"k":{{"x":', {_USER}, '}}}}')
    WHEN 10 THEN concat('{{"k":[', {_EVENT}, ',', {_USER}, ']}}')
    WHEN 11 THEN concat('{{"k":-', {_EVENT}, '}}')
    WHEN 12 THEN concat('{{"k":"', {_TRUTH}, '"}}')
    ELSE props END"""

# An object and an array below the top level.
DOC_NESTED = f"""CASE event_id % 12
    WHEN 0 THEN concat('{{"o":{{"p":"', event_type, '","q":1}},"a":[', {_EVENT}, ',2,', {_USER}, ']}}')
    WHEN 1 THEN concat('{{"o":{{"p":"', event_type, '"}},"a":[', {_USER}, ']}}')
    WHEN 2 THEN concat('{{"o":{{"p":null,"q":', {_USER}, '}},"a":[]}}')
    WHEN 3 THEN concat('{{"o":{{"p":', {_EVENT}, ',"q":"', {_USER}, '"}},"a":[', {_EVENT}, ',"', {_USER},
                       '",null,', {_USER}, '.5,', {_TRUTH}, ']}}')
    WHEN 4 THEN '{{"o":null,"a":null}}'
    WHEN 5 THEN concat('{{"o":', {_USER}, ',"a":[', {_EVENT}, ']}}')
    WHEN 6 THEN concat('{{"o":{{}},"a":{{"z":', {_USER}, '}}}}')
    WHEN 7 THEN concat('{{"a":[', {_USER}, ']}}')
    WHEN 8 THEN concat('[{{"o":{{"p":"', event_type, '","q":', {_USER}, '}},"a":[', {_EVENT}, ']}},',
                       '{{"o":{{"p":"n","q":', {_EVENT}, '}},"a":[', {_USER}, ',7]}}]')
    WHEN 9 THEN concat('{{"o":{{"p":', {_TRUTH}, ',"q":', {_USER}, '.0}},"a":[[', {_EVENT}, '],{{"b":2}},',
                       {_USER}, ']}}')
    WHEN 10 THEN concat('{{"o":{{"p":"', event_type, '","q":', {_USER}, '}},"a":[', {_EVENT}, ',',
                        {_USER}, ']}}')
    ELSE concat('{{"o":', props, ',"a":[', {_EVENT}, ']}}') END"""

# Numbers at the edges of their types: near the ends of a long, with an exponent,
# with many digits.
DOC_EDGES = f"""concat('{{"whole":', CASE event_id % 4
      WHEN 0 THEN cast(9223372036854775807 - event_id AS string)
      WHEN 1 THEN cast(event_id - 9223372036854775807 AS string)
      WHEN 2 THEN concat({_USER}, 'e2') ELSE concat({_EVENT}, '.000') END,
    ',"real":', CASE event_id % 3
      WHEN 0 THEN concat({_USER}, 'e-7') WHEN 1 THEN concat('-', {_EVENT}, '.5e10')
      ELSE concat({_EVENT}, {_USER}, '.25') END, '}}')"""

# Three fields, one of which may be missing, null or of another type.
DOC_RECORD = """CASE event_id % 6
    WHEN 0 THEN concat('{"id":', cast(event_id AS string), ',"type":"', event_type, '"}')
    WHEN 1 THEN concat('{"id":', cast(event_id AS string), ',"type":null,"user":',
                       cast(user_id AS string), '}')
    WHEN 2 THEN concat('{"id":"', cast(event_id AS string), '","type":"', event_type,
                       '","user":', cast(user_id AS string), '}')
    WHEN 3 THEN concat('{"type":"', event_type, '","user":', cast(user_id AS string),
                       ',"id":', cast(event_id AS string), ',"more":[{}]}')
    ELSE concat('{"id":', cast(event_id AS string), ',"type":"', event_type, '","user":',
                cast(user_id AS string), '}') END"""


def derived(spark: SparkSession, folder: str, doc: str) -> DataFrame:
    """``event_id`` and one of the documents above, for every event."""
    return table(spark, folder, "events").selectExpr("event_id", f"{doc} AS doc")


def derived_sql(doc: str) -> str:
    return f"SELECT event_id, {doc} AS doc FROM events"


# A log whose first message is blank; 1,000 messages make a ledger.
MESSAGES_PER_LEDGER = 1000


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "CAST(0 AS INT) AS partition_index",
        f"event_id DIV {MESSAGES_PER_LEDGER} AS ledger_id",
        f"event_id % {MESSAGES_PER_LEDGER} AS entry_id",
        "CAST(CASE WHEN event_id = 0 THEN ' ' ELSE props END AS BINARY) AS payload",
    )


def stored_log(spark: SparkSession, folder: str) -> dict[str, object]:
    """The options of a stored log of the same messages, a folder per ledger."""
    options = {
        "regionUrl": scratch_folder(spark), "fabric": "_system", "tenant": "tenant",
        "replication": "global", "stream": "events", "subscriptionName": "reader",
    }
    parts = ("partition_index", "ledger_id")
    writer = event_log(spark, folder).repartition(*parts).write.partitionBy(*parts)
    writer.parquet(log_path(log_options(options)))
    return options


def stored_log_of_two(spark: SparkSession, folder: str) -> dict[str, object]:
    """The options of a log of the same messages that two writers share."""
    options = {
        "regionUrl": scratch_folder(spark), "fabric": "_system", "tenant": "tenant",
        "replication": "global", "stream": "two", "subscriptionName": "reader",
    }
    log = event_log(spark, folder).withColumn("partition_index", F.expr("CAST(entry_id % 2 AS INT)"))
    parts = ("partition_index", "ledger_id")
    log.repartition(*parts).write.partitionBy(*parts).parquet(log_path(log_options(options)))
    return options


EVENT_LOG_OF_TWO_SQL = f"""SELECT CAST(event_id % {MESSAGES_PER_LEDGER} % 2 AS INTEGER) AS partition_index,
    event_id // {MESSAGES_PER_LEDGER} AS ledger_id, event_id % {MESSAGES_PER_LEDGER} AS entry_id,
    CASE WHEN event_id = 0 THEN ' ' ELSE props END AS text FROM events"""
EVENT_LOG_SQL = f"""SELECT 0 AS partition_index, event_id // {MESSAGES_PER_LEDGER} AS ledger_id,
    event_id % {MESSAGES_PER_LEDGER} AS entry_id,
    CASE WHEN event_id = 0 THEN ' ' ELSE props END AS text FROM events"""
