"""Rows to documents and to messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.encode import quoted, row_to_json


def encode_documents(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A column ``doc`` with one JSON object per row of ``df``."""
    return df.select(*[quoted(c) for c in keep], row_to_json(df).alias("doc"))


def encode_messages(df: DataFrame) -> DataFrame:
    """A column ``payload`` with the UTF-8 bytes of one JSON object per row."""
    return df.select(row_to_json(df).cast("binary").alias("payload"))
