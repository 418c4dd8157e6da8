"""Rows to JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The types that have a JSON form.
_SCALARS = (
    T.StringType,
    T.IntegerType,
    T.LongType,
    T.DoubleType,
    T.FloatType,
    T.BooleanType,
    T.NullType,
)
_REALS = (T.DoubleType, T.FloatType)


def quoted(name: str) -> Column:
    """The column called ``name``, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def check_encodable(data_type: T.DataType) -> None:
    """Raise ``TypeError`` if rows of this type have no JSON form."""
    if isinstance(data_type, T.StructType):
        for field in data_type.fields:
            check_encodable(field.dataType)
    elif isinstance(data_type, T.ArrayType):
        check_encodable(data_type.elementType)
    elif not isinstance(data_type, _SCALARS):
        raise TypeError(f"Unsupported data type: {data_type.simpleString()}")


def _holds_reals(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return any(_holds_reals(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _holds_reals(data_type.elementType)
    return isinstance(data_type, _REALS)


def finite_or_null(value: Column, data_type: T.DataType) -> Column:
    """``value`` with NaN and the infinities set to null at every depth."""
    if not _holds_reals(data_type):
        return value
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda e: finite_or_null(e, data_type.elementType))
    if isinstance(data_type, T.StructType):
        fields = [
            finite_or_null(value.getField(f.name), f.dataType).alias(f.name)
            for f in data_type.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    # NaN compares above every number in Spark, so this drops it as well
    return F.when(F.abs(value) < F.lit(float("inf")).cast(data_type), value)


def row_to_json(df: DataFrame) -> Column:
    """One JSON object per row, fields in the order of the schema, nulls kept."""
    check_encodable(df.schema)
    columns = [
        finite_or_null(quoted(f.name), f.dataType).alias(f.name) for f in df.schema.fields
    ]
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
