"""Collections and logs as tables in folders."""

from .collection import (
    append_collection,
    decode_results,
    documents,
    query_results,
    read_collection,
)
from .cursors import Covered, acknowledge, covered, cursor
from .log import (
    infer_log_schema,
    latest_offset,
    messages,
    offset_bounds,
    read_log,
    stream_log,
    stream_messages,
)
from .options import (
    Options,
    collection_options,
    collection_path,
    log_options,
    log_path,
    topic_address,
)

__all__ = [
    "Covered",
    "Options",
    "acknowledge",
    "append_collection",
    "collection_options",
    "collection_path",
    "covered",
    "cursor",
    "decode_results",
    "documents",
    "infer_log_schema",
    "latest_offset",
    "log_options",
    "log_path",
    "messages",
    "offset_bounds",
    "query_results",
    "read_collection",
    "read_log",
    "stream_log",
    "stream_messages",
    "topic_address",
]
