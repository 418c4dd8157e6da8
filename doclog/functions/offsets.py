"""Message offsets: their order, their bounds and their text form."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Offset(NamedTuple):
    """A message's place in a log; offsets compare in this field order."""

    ledger_id: int
    entry_id: int
    partition_index: int


# Fixed value: the offset before every message.
EARLIEST = Offset(-1, -1, -1)

# Field names and types of the text form.
_TEXT_SCHEMA = "ledgerId BIGINT, entryId BIGINT, partitionIndex INT"


def offset_struct() -> Column:
    """The offset of each row of a log, as one comparable column."""
    return F.struct("ledger_id", "entry_id", "partition_index")


def _literal(offset: Offset) -> Column:
    return F.struct(
        F.lit(offset.ledger_id).cast("bigint").alias("ledger_id"),
        F.lit(offset.entry_id).cast("bigint").alias("entry_id"),
        F.lit(offset.partition_index).cast("int").alias("partition_index"),
    )


def after_each(cursor: Mapping[int, Offset]) -> Column:
    """True for messages after the offset of their partition index, if it has one.

    Ledgers of two partition indexes are numbered apart, so one offset for all
    would leave out messages of the slower one.
    """
    index, ledger = F.col("partition_index"), F.col("ledger_id")
    condition = ~index.isin([int(p) for p in cursor])
    for partition, last in cursor.items():
        after = (ledger > last.ledger_id) | (
            (ledger == last.ledger_id) & (F.col("entry_id") > last.entry_id)
        )
        # the bound on the ledger alone is for the scan
        condition = condition | ((index == partition) & (ledger >= last.ledger_id) & after)
    return condition


def in_range(start: Offset | Mapping[int, Offset] | None, end: Offset | None) -> Column:
    """True for messages after ``start`` and up to ``end``.

    The bounds on ``ledger_id`` alone say nothing new about the rows; they are
    there for the scan, which prunes ledger directories by them.
    """
    condition = F.lit(True)
    if isinstance(start, Mapping):
        condition = condition & after_each(start)
    elif start is not None:
        condition = (
            condition
            & (F.col("ledger_id") >= start.ledger_id)
            & (offset_struct() > _literal(start))
        )
    if end is not None:
        condition = (
            condition
            & (F.col("ledger_id") <= end.ledger_id)
            & (offset_struct() <= _literal(end))
        )
    return condition


def offset_to_json(ledger_id: Column, entry_id: Column, partition_index: Column) -> Column:
    """The text form of an offset."""
    return F.to_json(
        F.struct(
            ledger_id.cast("bigint").alias("ledgerId"),
            entry_id.cast("bigint").alias("entryId"),
            partition_index.cast("int").alias("partitionIndex"),
        )
    )


_OFFSET_TYPE = "struct<ledger_id:bigint,entry_id:bigint,partition_index:int>"


def offset_from_json(text: Column) -> Column:
    """The offset in a text; text that is not a whole offset raises."""
    bad = F.raise_error(F.concat(F.lit("Not an offset: "), text)).cast(_OFFSET_TYPE)

    def checked(parts: Column) -> Column:
        ledger, entry, partition = (
            parts.getField(name) for name in ("ledgerId", "entryId", "partitionIndex")
        )
        whole = ledger.isNotNull() & entry.isNotNull() & partition.isNotNull()
        offset = F.struct(
            ledger.alias("ledger_id"),
            entry.alias("entry_id"),
            partition.alias("partition_index"),
        )
        return F.when(whole, offset).otherwise(bad)

    # the variable of a lambda holds the parsed text, which is so parsed once
    parts = F.from_json(text, _TEXT_SCHEMA, {"mode": "FAILFAST"})
    return F.when(text.isNotNull(), F.transform(F.array(parts), checked)[0])
