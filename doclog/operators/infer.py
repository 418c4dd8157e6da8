"""Schema inference: a vote among sample documents, or the first message."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.encode import quoted
from ..functions.offsets import offset_struct
from .decode import NOT_BLANK

# Fixed value: the number of results that take part in the vote.
SAMPLE_SIZE = 50


def _schemas(spark: SparkSession, texts: list[str]) -> list[T.StructType | None]:
    """The schema of each text; None for a scalar, which is no document."""
    columns = [F.schema_of_json(F.lit(t)).alias(f"s{i}") for i, t in enumerate(texts)]
    found = spark.range(1).select(*columns).first()
    schemas: list[T.StructType | None] = []
    for ddl in found:
        data_type = T.DataType.fromDDL(ddl)
        if isinstance(data_type, T.ArrayType):
            data_type = data_type.elementType
        schemas.append(data_type if isinstance(data_type, T.StructType) else None)
    return schemas


def infer_majority_schema(df: DataFrame, doc: str = "doc") -> T.StructType:
    """The most frequent schema among the first 50 documents.

    Each document votes for its own exact schema; on a tie the schema seen
    first wins. No documents give an empty schema.
    """
    rows = df.select(quoted(doc).cast("string").alias("doc")).where("doc IS NOT NULL")
    texts = [r.doc for r in rows.limit(SAMPLE_SIZE).collect()]
    if not texts:
        return T.StructType()
    votes = [s for s in _schemas(df.sparkSession, texts) if s is not None]
    if not votes:
        return T.StructType()
    winner = Counter(s.json() for s in votes).most_common(1)[0][0]
    return next(s for s in votes if s.json() == winner)


def first_message(log: DataFrame) -> str | None:
    """The first message of a log that is not blank, by offset."""
    text = F.col("payload").cast("string")
    return (
        log.where(text.rlike(NOT_BLANK))
        .agg(F.min_by(text, offset_struct()).alias("text"))
        .first()
        .text
    )


def schema_of_message(spark: SparkSession, text: str | None) -> T.StructType:
    if text is None:
        raise ValueError("The log holds no message to infer a schema from")
    return _schemas(spark, [text])[0] or T.StructType()


def infer_first_message_schema(log: DataFrame) -> T.StructType:
    """The schema of the first message that is not blank; none raises."""
    return schema_of_message(log.sparkSession, first_message(log))
