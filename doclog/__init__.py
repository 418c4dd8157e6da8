"""Collections of JSON documents and logs of JSON messages, on Spark."""

from .functions import EARLIEST, Offset
from .operators import (
    array_results,
    decode_lenient,
    decode_strict,
    encode_documents,
    encode_messages,
    infer_first_message_schema,
    infer_majority_schema,
)
from .sources import (
    Covered,
    acknowledge,
    append_collection,
    covered,
    cursor,
    documents,
    infer_log_schema,
    latest_offset,
    messages,
    read_collection,
    read_log,
    stream_log,
)
from .streaming import follow_log, write_collection, write_log

__all__ = [
    "Covered",
    "EARLIEST",
    "Offset",
    "acknowledge",
    "append_collection",
    "array_results",
    "covered",
    "cursor",
    "decode_lenient",
    "decode_strict",
    "documents",
    "encode_documents",
    "encode_messages",
    "follow_log",
    "infer_first_message_schema",
    "infer_log_schema",
    "infer_majority_schema",
    "latest_offset",
    "messages",
    "read_collection",
    "read_log",
    "stream_log",
    "write_collection",
    "write_log",
]
