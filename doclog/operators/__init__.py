"""DataFrame operators: decode, encode, infer, keyed documents."""

from .decode import array_results, as_schema, decode_lenient, decode_strict
from .encode import encode_documents, encode_messages
from .infer import (
    first_message,
    infer_first_message_schema,
    infer_majority_schema,
    schema_of_message,
)
from .keyed import new_keys_only, one_per_key, with_key

__all__ = [
    "array_results",
    "as_schema",
    "decode_lenient",
    "decode_strict",
    "encode_documents",
    "encode_messages",
    "first_message",
    "infer_first_message_schema",
    "infer_majority_schema",
    "new_keys_only",
    "one_per_key",
    "schema_of_message",
    "with_key",
]
