"""Cursors: how far a subscription has read a log, for each partition index.

A cursor is kept beside the log, as the names of empty files: the range of
messages that a micro-batch covered, written when the batch is done. A name is
made in one step on any store, so a cursor is never half there. The last ranges
of a partition index are kept, older ones are removed.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.offsets import Offset
from .commits import hadoop_path
from .options import Options, log_options, log_path

FOLDER = "_cursors"
# Ranges kept of each partition index.
KEPT_RANGES = 100

_NAME = re.compile(r"(\d+)-(\d+)-(\d+)-from-(\d+)-(\d+)")


class Covered(NamedTuple):
    """The first and the last message of one partition index in a micro-batch."""

    first: Offset
    last: Offset


def _place(options: Options) -> str:
    name = options["subscriptionName"]
    if not re.fullmatch(r"[A-Za-z0-9._ -]+", name) or name.startswith("."):
        raise ValueError(f"A subscription with a cursor cannot be named {name!r}")
    return f"{log_path(options)}/{FOLDER}/{name}"


def covered(spark: SparkSession, options: Mapping[str, object]) -> list[Covered]:
    """The recorded ranges of the subscription, in order of their last messages."""
    place, fs = hadoop_path(spark, _place(log_options(options)))
    if not fs.exists(place):
        return []
    found = []
    for state in fs.listStatus(place):
        match = _NAME.fullmatch(state.getPath().getName())
        if match:
            ledger, entry, partition, first_ledger, first_entry = map(int, match.groups())
            found.append(
                Covered(Offset(first_ledger, first_entry, partition), Offset(ledger, entry, partition))
            )
    return sorted(found, key=lambda c: c.last)


def cursor(spark: SparkSession, options: Mapping[str, object]) -> dict[int, Offset]:
    """The last acknowledged message of each partition index; empty at first."""
    return {c.last.partition_index: c.last for c in covered(spark, options)}


def covered_by(messages: DataFrame) -> list[Covered]:
    """The ranges of some messages, one for each partition index."""
    place = F.struct("ledger_id", "entry_id")
    found = messages.groupBy("partition_index").agg(F.min(place).alias("a"), F.max(place).alias("z"))
    return [
        Covered(Offset(*r.a, r.partition_index), Offset(*r.z, r.partition_index))
        for r in found.collect()
    ]


def acknowledge(spark: SparkSession, options: Mapping[str, object], ranges: list[Covered]) -> None:
    """Move the subscription's cursor past some ranges; it never moves back."""
    checked = log_options(options)
    place = _place(checked)
    for first, last in ranges:
        name = f"{last.ledger_id}-{last.entry_id}-{last.partition_index}"
        path, fs = hadoop_path(spark, f"{place}/{name}-from-{first.ledger_id}-{first.entry_id}")
        fs.create(path, True).close()
    partitions = {last.partition_index for _, last in ranges}
    for partition in partitions:
        known = [c for c in covered(spark, checked) if c.last.partition_index == partition]
        for first, last in known[:-KEPT_RANGES]:
            name = f"{last.ledger_id}-{last.entry_id}-{last.partition_index}"
            path, fs = hadoop_path(spark, f"{place}/{name}-from-{first.ledger_id}-{first.entry_id}")
            fs.delete(path, False)
