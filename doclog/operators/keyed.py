"""Keyed documents: one per key in a batch, and only keys not yet stored."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encode import quoted, row_to_json

# Keys that are sent to every task may take this much memory, no more.
BROADCAST_KEY_BYTES = 32 * 1024 * 1024
# Groups of key folders that one append looks up one by one, at most.
MOST_GROUPS = 4


def with_key(df: DataFrame, primary_key: str | None) -> DataFrame:
    """Columns ``doc`` and ``_key`` of each row; no key column gives null keys."""
    key = quoted(primary_key) if primary_key else F.lit(None)
    return df.select(row_to_json(df).alias("doc"), key.cast("string").alias("_key"))


def one_per_key(keyed: DataFrame) -> DataFrame:
    """The least document of each key.

    ``min`` is combined before the shuffle, so a key that holds a large share
    of the batch leaves each task as one row.
    """
    return keyed.groupBy("_key").agg(F.min("doc").alias("doc")).select("doc", "_key")


def key_bytes(keyed: DataFrame) -> int:
    """An upper estimate of the memory that the keys take as a hash table."""
    measured = keyed.agg(
        F.coalesce(F.sum(F.octet_length("_key") + F.lit(64)), F.lit(0)).alias("n")
    )
    return measured.first().n


def new_keys_only(
    batch: DataFrame, stored: DataFrame, broadcast_limit: int = BROADCAST_KEY_BYTES
) -> DataFrame:
    """One row for each ``_key`` of ``batch`` that is not in ``stored``.

    ``batch`` must be cheap to read again. When its keys are measured to be few,
    they are sent to the scan of the stored keys, and those that both sides have
    are sent back: no document moves but to meet others of its key. Otherwise
    both sides are shuffled by key, each key once on each side.
    """
    keys, known = batch.select("_key").distinct(), stored.select("_key")
    if key_bytes(keys) <= broadcast_limit:
        common = known.join(F.broadcast(keys), "_key", "left_semi").distinct()
        return one_per_key(batch.join(F.broadcast(common), "_key", "left_anti"))
    return one_per_key(batch).join(known, "_key", "left_anti").select("doc", "_key")


def key_bucket(buckets: int) -> Column:
    """The folder of a ``_key`` among ``buckets`` folders; -1 for rows without a key."""
    place = F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int")
    return F.when(F.col("_key").isNotNull(), place).otherwise(-1)


def in_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    """Add ``bucket`` and move keyed rows so that each folder is written by one task.

    Rows without a key, which may be most of all rows, stay where they are.
    """
    rows = rows.withColumn("bucket", key_bucket(buckets))
    return rows.where("bucket >= 0").repartition("bucket").unionByName(rows.where("bucket < 0"))


def bucket_groups(key_bytes_of: dict[int, int], limit: int) -> list[list[int]]:
    """Buckets in groups whose keys take ``limit`` bytes at most, or single ones that take more."""
    groups, room = [], 0
    for bucket in sorted(key_bytes_of):
        size = key_bytes_of[bucket]
        if not groups or size > room:
            groups.append([])
            room = limit
        groups[-1].append(bucket)
        room -= size
    return groups


def new_keys_in_buckets(
    batch: DataFrame, stored: DataFrame, buckets: int, broadcast_limit: int = BROADCAST_KEY_BYTES
) -> DataFrame:
    """The same as ``new_keys_only`` where stored keys lie in folders by ``bucket``.

    Only folders in which the batch has keys are read. The batch's keys go to
    them group by group of folders, so stored keys are not shuffled however many
    keys the batch has, up to ``MOST_GROUPS`` groups. A folder alone whose keys
    are too many to be sent, and batches of more groups, are joined by shuffle.
    """
    batch = batch.withColumn("bucket", key_bucket(buckets))
    size = F.sum(F.octet_length("_key") + F.lit(64)).alias("size")
    found = {row.bucket: row.size for row in batch.groupBy("bucket").agg(size).collect()}
    if not found:
        return one_per_key(batch)
    known = stored.where(F.col("bucket").isin(sorted(found))).select("_key", "bucket")
    groups = bucket_groups(found, broadcast_limit)
    large = [g[0] for g in groups if len(g) == 1 and found[g[0]] > broadcast_limit]
    if large or len(groups) > MOST_GROUPS:
        fresh = one_per_key(batch).join(known.select("_key"), "_key", "left_anti")
        return fresh.select("doc", "_key")
    common = None
    for group in groups:
        inside = F.col("bucket").isin(group)
        keys = batch.where(inside).select("_key").distinct()
        part = known.where(inside).select("_key").join(F.broadcast(keys), "_key", "left_semi").distinct()
        common = part if common is None else common.unionByName(part)
    common = F.broadcast(common) if len(groups) == 1 else common
    return one_per_key(batch.join(common, "_key", "left_anti"))


def without_keys_of(rows: DataFrame, files: list[str]) -> DataFrame:
    """The rows whose ``_key`` is in none of some files of documents."""
    keys = rows.sparkSession.read.schema("_key STRING").parquet(*files).where("_key IS NOT NULL")
    keyed, keyless = rows.where("_key IS NOT NULL"), rows.where("_key IS NULL")
    return keyed.join(keys, "_key", "left_anti").select(*rows.columns).unionByName(keyless)


def first_of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of a key in each Arrow batch the first, so a hot key is thinned out early."""
    for batch in batches:
        keys = batch.column(batch.schema.get_field_index("_key"))
        numbered = pa.table({"key": keys, "row": pa.array(range(len(batch)), pa.int64())})
        first = numbered.group_by("key").aggregate([("row", "min")]).column("row_min")
        yield batch.take(first.combine_chunks())
