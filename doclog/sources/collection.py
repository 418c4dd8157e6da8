"""Collections: tables of JSON documents, read and appended to.

A collection is a folder of Parquet files with ``doc`` (the JSON text) and
``_key`` (its key, or null), in one sub-folder ``load=<name>`` per append. A
collection begun with the option ``keyBuckets`` deals the files of each append
into folders ``bucket=<n>`` by a hash of the key; the number stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.decode import as_schema, decode_strict
from ..operators.infer import infer_majority_schema
from ..operators.keyed import (
    in_buckets,
    new_keys_in_buckets,
    new_keys_only,
    with_key,
    without_keys_of,
)
from .commits import opened
from .options import Options, collection_options, collection_path
from .storage import (
    delete,
    exists,
    folders,
    grouped,
    is_published,
    mark,
    marks,
    publish,
    scratch_folder,
)

DOCUMENT_SCHEMA = "doc STRING, _key STRING, load STRING"
_HAS_KEY, _NO_KEY = "_key IS NOT NULL", "_key IS NULL"


def documents(spark: SparkSession, options: Mapping[str, object]) -> DataFrame:
    """The stored documents as they are: ``doc``, ``_key`` and ``load``."""
    checked = collection_options(options)
    path = collection_path(checked)
    if not exists(spark, path):
        raise ValueError(f"Collection {checked['collection']} does not exist at {path}")
    return spark.read.schema(DOCUMENT_SCHEMA).parquet(path).select("doc", "_key", "load")


def query_results(spark: SparkSession, query: str, collection: DataFrame) -> DataFrame:
    """The results of a Spark SQL text in which ``{collection}`` is a table.

    The text is analysed here, so a wrong one raises before any job runs.
    """
    return spark.sql(query, collection=collection)


def _document_column(results: DataFrame) -> str | None:
    """The column of a result that consists of JSON values; None if rows are typed."""
    if len(results.schema) != 1:
        return None
    field = results.schema[0]
    is_text = isinstance(field.dataType, T.StringType) and field.name == "doc"
    return field.name if is_text or isinstance(field.dataType, T.VariantType) else None


def decode_results(
    results: DataFrame, schema: T.StructType | str | None = None
) -> DataFrame:
    """Typed rows from query results.

    A single column that is a variant, or a text called ``doc``, holds JSON
    values and is decoded strictly, to ``schema`` or to the schema that most of
    its first results have. Results with other columns are rows already: they
    stay as they are, or are decoded as objects when a schema is given.
    """
    doc = _document_column(results)
    if doc is None:
        if schema is None:
            return results
        results = results.select(F.to_variant_object(F.struct("*")).alias("doc"))
        doc = "doc"
    if schema is None:
        sample = results
        if isinstance(results.schema[0].dataType, T.VariantType):
            sample = results.select(F.to_json(doc).alias(doc))
        schema = infer_majority_schema(sample, doc)
    return decode_strict(results, schema, doc)


def read_collection(
    spark: SparkSession,
    options: Mapping[str, object],
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read a collection, or what the option ``query`` makes of it, as typed rows."""
    checked = collection_options(options)
    results = query_results(spark, checked.query, documents(spark, checked))
    return decode_results(results, as_schema(schema) if schema is not None else None)


_BUCKETS = "keyBuckets"


def stored_key_buckets(spark: SparkSession, path: str) -> int | None:
    """The number of key folders of a collection, a property of it; None if it has none."""
    found = marks(spark, path, _BUCKETS)
    if len(found) > 1:
        raise ValueError(f"{path} was begun twice, with {' and '.join(found)} key folders")
    return int(found[0]) if found else None


def _key_buckets(spark: SparkSession, path: str, options: Options) -> int | None:
    """The same, set from the options if the collection is new."""
    wanted, stored = options.key_buckets, stored_key_buckets(spark, path)
    if wanted is None or wanted == stored:
        return stored
    if stored is None and not (exists(spark, path) and folders(spark, path)):
        mark(spark, path, _BUCKETS, str(wanted))
        return stored_key_buckets(spark, path)
    raise ValueError(f"{path} has {stored or 'no'} key folders, which cannot be changed")


def _writer(options: Options, buckets: int | None):
    """How the rows of an append are written."""

    def prepare(rows: DataFrame):
        writer = rows.write if buckets is None else in_buckets(rows, buckets).write.partitionBy("bucket")
        if options.get("batchSize") is None:
            return writer
        return grouped(writer, options.batch_size)

    return prepare


def append_collection(
    df: DataFrame, options: Mapping[str, object], load: str | None = None
) -> bool:
    """Append the rows of ``df`` to a collection, each as one JSON document.

    With the option ``primaryKey`` that column becomes the key: of rows with
    the same key one is kept, a key that is stored already keeps its stored
    document, and rows without a key are appended like unkeyed ones. This holds
    for writers that append at the same time, too: what another has committed
    meanwhile is left out before the append counts. ``load`` names the append;
    one that was done before is not done again, and False is returned.
    """
    spark = df.sparkSession
    checked = collection_options(options)
    checked.batch_size  # noqa: B018 - raises on a bad value
    part = _part(load)
    path = collection_path(checked)
    primary_key = checked.get("primaryKey") or None
    rows = with_key(df, primary_key)
    if is_published(spark, path, part):
        return False
    buckets = _key_buckets(spark, path, checked)
    if primary_key is None:
        return publish(rows, path, part, _writer(checked, buckets))
    # The batch is used several times, and may be costly or give other rows when
    # it is read again: write it once where every executor can read it.
    with staged(rows) as batch:
        known = opened(spark, path).version
        stored = spark.read.schema(DOCUMENT_SCHEMA + ", bucket INT").parquet(path).where(_HAS_KEY)
        keyed = batch.where(_HAS_KEY)
        if buckets is None:
            fresh = new_keys_only(keyed, stored)
        else:
            fresh = new_keys_in_buckets(keyed, stored, buckets)
        rows = fresh.unionByName(batch.where(_NO_KEY))
        return publish(rows, path, part, _writer(checked, buckets), known, without_keys_of)


def append_new_documents(
    rows: DataFrame, options: Mapping[str, object], load: str, known: int, others: str
) -> bool:
    """Append ``doc, _key`` rows whose keys are known to be new up to entry ``known``.

    Later entries are looked at, but for those with ``others`` in their files'
    paths, which are the caller's own and share no key with the rows.
    """
    spark = rows.sparkSession
    checked = collection_options(options)
    path = collection_path(checked)
    log = opened(spark, path)
    latest = log.version
    later = [f for f in log.files(known) if others not in f] if latest > known else []
    fresh = without_keys_of(rows, later) if later else rows
    prepare = _writer(checked, _key_buckets(spark, path, checked))
    return publish(fresh, path, _part(load), prepare, latest, without_keys_of)


def _part(load: str | None) -> str:
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"load={load or f'{stamp}-{uuid.uuid4().hex[:8]}'}"


@contextmanager
def staged(rows: DataFrame) -> Iterator[DataFrame]:
    """Rows of documents written once to scratch space, and deleted afterwards."""
    spark = rows.sparkSession
    place = scratch_folder(spark)
    try:
        rows.select("doc", "_key").write.parquet(place)
        yield spark.read.schema("doc STRING, _key STRING").parquet(place)
    finally:
        delete(spark, place)
