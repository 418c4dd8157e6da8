"""Typed values from JSON variants, under the strict and the lenient rule.

Strict: a value must already be of the wanted type. Lenient: a value is
converted, with a default where that fails. Both are built recursively from the
wanted type and give one SQL expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import types as T

from .variant import BOOLEAN, NESTED, NUMERIC, TEXT, VOID, Place, one_of, sql_name, sql_text

# The scalar types each rule can produce.
STRICT_SCALARS = (T.StringType, T.LongType, T.DoubleType, T.FloatType, T.BooleanType)
LENIENT_SCALARS = (*STRICT_SCALARS, T.IntegerType)

# The words that a text may hold in place of a number.
NUMBER_WORDS = ("NaN", "Infinity", "+Infinity", "-Infinity")

INFINITY = "double('Infinity')"


def sql_type(data_type: T.DataType) -> str:
    """The type as SQL text, with quoted field names."""
    if isinstance(data_type, T.ArrayType):
        return f"array<{sql_type(data_type.elementType)}>"
    if isinstance(data_type, T.StructType):
        parts = [f"{sql_name(f.name)}: {sql_type(f.dataType)}" for f in data_type.fields]
        return f"struct<{', '.join(parts)}>"
    return data_type.simpleString()


def direct_type(data_type: T.DataType, lenient: bool) -> str | None:
    """The type from_json() reads a top-level field as, if it is a scalar it can read.

    Where that gives a value that ``direct_value`` lets pass, it is the value
    that the rule gives too. Strict texts are not among them, for from_json()
    takes a number for a text as well. The choice depends on the type alone.
    """
    if isinstance(data_type, (T.LongType, T.DoubleType, T.BooleanType)):
        return data_type.simpleString()
    if isinstance(data_type, T.FloatType):
        # the lenient rule rounds to a double first
        return "double" if lenient else "float"
    if isinstance(data_type, T.IntegerType) and lenient:
        return "int"
    if isinstance(data_type, T.StringType) and lenient:
        return "string"
    return None


# Texts that may come from a number which the two parsers write differently: zero
# with a sign, the infinities (in quotes), and numbers of many digits.
_UNSURE_TEXT = r'^(-0(\\.0)?|"-?Infinity"|"NaN"|-?[0-9][0-9.eE+-]{14,})$'


def direct_value(name: str, data_type: T.DataType) -> str:
    """The column ``name`` that from_json() read, or NULL where it needs a second look.

    A text may stand for an object or an array, which have another text under
    the lenient rule, or for a number that is not written as it was.
    """
    if isinstance(data_type, T.StringType):
        sure = f"substring({name}, 1, 1) NOT IN ('{{', '[') AND NOT {name} RLIKE '{_UNSURE_TEXT}'"
        return f"CASE WHEN {sure} THEN {name} END"
    return unsigned_zero(name, data_type)


def unsigned_zero(value: str, data_type: T.DataType) -> str:
    """A number with zero as it is without a sign, which a variant does not keep."""
    if isinstance(data_type, T.DoubleType):
        return f"({value} + 0D)"
    if isinstance(data_type, T.FloatType):
        return f"({value} + 0F)"
    return value


def _null(data_type: T.DataType) -> str:
    return f"CAST(NULL AS {sql_type(data_type)})"


def _array(place: Place, value: Callable[[Place], str]) -> str:
    # an array inside an array needs a name of its own for its element
    name = f"{place.root}_e" if place.root.isidentifier() else "e"
    return f"transform({place.elements}, {name} -> {value(Place(name))})"


def _struct(place: Place, fields: list[T.StructField], value: Callable) -> str:
    parts = [
        f"{sql_text(f.name)}, {value(place.child(f.name), f.dataType)}" for f in fields
    ]
    return f"CASE WHEN {place.is_object} THEN named_struct({', '.join(parts)}) END"


# ---------------------------------------------------------------- strict


def _strict_kind(place: Place, data_type: T.DataType) -> str:
    """True where a scalar is of ``data_type`` or JSON null; NULL where it is missing."""
    if isinstance(data_type, T.StringType):
        return one_of(place.kind, TEXT, VOID)
    if isinstance(data_type, T.BooleanType):
        return one_of(place.kind, BOOLEAN, VOID)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return one_of(place.kind, VOID, *NUMERIC)
    # Long: a number without a fraction, inside the range of a long
    unfractioned = f"{place.kind_name} RLIKE '^(DECIMAL.*,0[)]|DOUBLE|FLOAT)$'"
    return (
        f"({one_of(place.kind, 'BIG', VOID)} OR ({unfractioned}"
        f" AND {place.get('double')} % 1 = 0 AND {place.get('bigint')} IS NOT NULL))"
    )


def strict_fits(place: Place, data_type: T.DataType) -> str:
    """True where the field is present and its value is null or of the type."""
    if isinstance(data_type, T.NullType):
        return place.is_json_null
    if isinstance(data_type, T.ArrayType):
        return f"({place.is_json_null} OR {place.is_array})"
    if isinstance(data_type, T.StructType):
        return f"({place.is_json_null} OR {place.is_object})"
    if isinstance(data_type, STRICT_SCALARS):
        return _strict_kind(place, data_type)
    return "FALSE"


def strict_value(place: Place, data_type: T.DataType, known_to_fit: bool = False) -> str:
    """The value, or null where it does not fit.

    ``known_to_fit`` leaves out the test where a filter has made it before.
    """
    if isinstance(data_type, T.ArrayType):
        return _array(place, lambda e: strict_value(e, data_type.elementType))
    if isinstance(data_type, T.StructType):
        return _struct(place, data_type.fields, strict_value)
    if not isinstance(data_type, STRICT_SCALARS):
        return _null(data_type)
    value = unsigned_zero(place.get(data_type.simpleString()), data_type)
    if known_to_fit:
        return value
    return f"CASE WHEN {_strict_kind(place, data_type)} THEN {value} END"


# ---------------------------------------------------------------- lenient


def _text_number(place: Place) -> str:
    """The number a text stands for; null if it is no number."""
    text = f"trim({place.get('string')})"
    return (
        f"CASE WHEN {text} RLIKE '[0-9]' OR {one_of(text, *NUMBER_WORDS)}"
        f" THEN {place.get('double')} END"
    )


def _lenient_whole(place: Place, sql_type: str) -> str:
    # The first branch serves numbers, booleans and plain texts. What is left:
    # texts with a fraction or no number, arrays and objects, and (null) JSON
    # null, a missing field and numbers out of range.
    return (
        f"coalesce({place.get(sql_type)}, CASE WHEN {one_of(place.kind, TEXT, *NESTED)}"
        f" THEN coalesce(try_cast({_text_number(place)} AS {sql_type}), CAST(0 AS {sql_type}))"
        " END)"
    )


def _lenient_double(place: Place) -> str:
    # a finite number needs no look at its kind; "inf" as a text does
    number = place.get("double")
    return (
        f"CASE WHEN abs({number}) < {INFINITY} THEN {number}"
        f" WHEN {one_of(place.kind, TEXT, *NESTED)}"
        f" THEN coalesce({_text_number(place)}, double(0)) ELSE {number} END"
    )


def _beyond_long(place: Place) -> str:
    """True for a whole decimal outside the range of a long.

    Inside that range a number written without a fraction is a BIGINT, so a
    DECIMAL there was written with one.
    """
    return f"({place.kind_name} LIKE 'DECIMAL%,0)' AND {place.get('bigint')} IS NULL)"


def _lenient_string(place: Place) -> str:
    # A number with a fraction or an exponent has the text of its double, as in
    # 2.0; the variant itself would write 2.
    text = place.get("string")
    return (
        f"CASE WHEN {one_of(place.kind, TEXT, 'BIG', BOOLEAN, VOID)} THEN {text}"
        f" WHEN {one_of(place.kind, *NESTED)} THEN ''"
        f" WHEN {_beyond_long(place)} THEN {text}"
        f" ELSE CAST({place.get('double')} AS STRING) END"
    )


def _lenient_boolean(place: Place) -> str:
    # whole numbers are true unless zero; numbers with a fraction are false
    value = place.get("boolean")
    return (
        f"CASE WHEN {one_of(place.kind, BOOLEAN, VOID, 'BIG')} THEN {value}"
        f" WHEN {place.kind} = '{TEXT}' THEN trim({place.get('string')}) = 'true'"
        f" WHEN {_beyond_long(place)} THEN {value}"
        f" WHEN {place.value} IS NOT NULL THEN FALSE END"
    )


def lenient_value(place: Place, data_type: T.DataType, top: bool = False) -> str:
    """The value converted to the type; null for JSON null or a missing field."""
    if isinstance(data_type, T.NullType):
        return _null(data_type)
    if isinstance(data_type, T.ArrayType):
        return _array(place, lambda e: lenient_value(e, data_type.elementType))
    if isinstance(data_type, T.StructType):
        return _struct(place, data_type.fields, lenient_value)
    if isinstance(data_type, (T.IntegerType, T.LongType)):
        return _lenient_whole(place, data_type.simpleString())
    if isinstance(data_type, T.DoubleType):
        return unsigned_zero(_lenient_double(place), data_type)
    if isinstance(data_type, T.FloatType):
        return unsigned_zero(f"CAST({_lenient_double(place)} AS FLOAT)", data_type)
    if isinstance(data_type, T.StringType):
        return _lenient_string(place)
    if isinstance(data_type, T.BooleanType):
        return _lenient_boolean(place)
    message = sql_text("Unsupported data type: " + data_type.simpleString())
    refuse = f"CAST(raise_error({message}) AS {sql_type(data_type)})"
    return f"CASE WHEN NOT {place.is_json_null} THEN {refuse} END" if top else refuse
