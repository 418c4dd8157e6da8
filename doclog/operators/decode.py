"""Documents and messages to typed rows, with the drop rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.decode import (
    direct_type,
    direct_value,
    lenient_value,
    sql_type,
    strict_fits,
    strict_value,
)
from ..functions.variant import Place, sql_name, sql_text

# A text with at least one character above the blank and control characters.
NOT_BLANK = r"[^\x00-\x20]"


def as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


# from_json() as strict about the text as parse_json().
_JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _text(df: DataFrame, doc: str) -> str:
    """The JSON text in a column; bytes are kept, the parser replaces malformed ones."""
    is_text = isinstance(df.schema[doc].dataType, T.StringType)
    return sql_name(doc) if is_text else f"CAST({sql_name(doc)} AS STRING)"


def _allow_repeated_names(df: DataFrame) -> None:
    """Let a document name a field twice, the last one counting, in this session."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _is_variant(df: DataFrame, doc: str) -> bool:
    return isinstance(df.schema[doc].dataType, T.VariantType)


def _once(df: DataFrame, kept: list[str], value: str, name: str) -> DataFrame:
    """Add ``value`` as a column that is computed once per row.

    A column made by a projection would be copied by the optimizer into each
    filter and projection that names it, and so a document would be parsed many
    times. The output of a generator is not copied, and generators over an array
    of one take part in code generation like a projection.
    """
    return df.selectExpr(*kept, f"explode(array({value})) AS {name}")


def _one_value(text: str) -> str:
    """True where a text is one JSON value and nothing but blanks after it."""
    return f"json_array_length(concat('[', {text}, ']')) <=> 1"


def _one_object(text: str) -> str:
    """The same for a text that begins with a whole JSON object.

    If its first closing brace is its last character, nothing can follow; only
    for other texts, as those with objects inside, it is parsed for that.
    """
    return f"(instr({text}, '}}') = length({text}) OR {_one_value(text)})"


def _whole_value(text: str) -> str:
    """The variant of a text; raises where it is no JSON, or more than one value."""
    return f"parse_json(CASE WHEN {_one_value(text)} THEN {text} ELSE concat('[', {text}, ',') END)"


def _elements(df: DataFrame, kept: list[str]) -> DataFrame:
    """The variant ``__parsed`` as ``__item``, or its elements if it is an array."""
    elements = "coalesce(try_cast(__parsed AS ARRAY<VARIANT>), array(__parsed))"
    return df.selectExpr(*kept, f"explode({elements}) AS __item")


def array_results(df: DataFrame, doc: str = "doc", keep: Sequence[str] = ()) -> DataFrame:
    """One row ``result`` (a variant) per result: an array gives its elements."""
    _allow_repeated_names(df)
    kept = [sql_name(c) for c in keep]
    parsed = sql_name(doc) if _is_variant(df, doc) else _whole_value(_text(df, doc))
    items = _elements(_once(df, kept, parsed, "__parsed"), kept)
    return items.withColumnRenamed("__item", "result")


# Schemas with fewer top-level fields are read as variants throughout. For a few
# fields that takes as long as reading them by type, and a third of the time where
# values are of other types, each of which costs from_json() an exception.
DIRECT_FROM = 6


class _Fields:
    """The top-level fields of a schema, as the two decoders take them.

    Most documents are read in one pass by from_json(), which skips what the
    schema does not name: in wide schemas some types as such (``__t<i>`` is NULL
    for anything else, and in a document with any such value), the others as
    variants. Only
    a document that leaves one of these columns NULL is parsed as a whole, and
    its fields (``__f<i>``) are looked at: there a field may be missing, null or
    of another type, the document may be an array or a scalar, or the text may
    be no JSON at all.
    """

    def __init__(self, df: DataFrame, schema: T.StructType, doc: str, lenient: bool):
        self.fields = schema.fields
        self.in_one_pass = not _is_variant(df, doc) and bool(self.fields)
        by_type = self.in_one_pass and len(self.fields) >= DIRECT_FROM
        self.direct = [direct_type(f.dataType, lenient) if by_type else None for f in self.fields]
        self.lenient = lenient
        self.read = [f"__t{i}" for i in range(len(self.fields))] if self.in_one_pass else []
        self.text = _text(df, doc)

    def parsed(self, df: DataFrame, kept: list[str], doc: str) -> DataFrame:
        """Add what one pass reads, and ``__parsed``, NULL where that was enough."""
        if _is_variant(df, doc):
            return _once(df, kept, sql_name(doc), "__parsed")
        if not self.in_one_pass:
            parsed = f"parse_json({self.text})" if self.lenient else _whole_value(self.text)
            return _once(df, kept, parsed, "__parsed")
        types = [
            f"{sql_name(f.name)}: {t or 'variant'}" for f, t in zip(self.fields, self.direct)
        ]
        # a name that no field has, for the text of documents with a bad value
        bad = max((f.name for f in self.fields), key=len) + "_"
        options = {**_JSON_OPTIONS, "columnNameOfCorruptRecord": bad}
        option_map = ", ".join(sql_text(t) for pair in options.items() for t in pair)
        schema = sql_text(f"struct<{', '.join([*types, sql_name(bad) + ': string'])}>")
        # only objects: for other documents from_json() would raise inside
        item = "CASE WHEN startswith(__text, '{') THEN __text END"
        read = f"from_json({item}, {schema}, map({option_map}))"
        df = df.selectExpr(*kept, f"{self.text} AS __text").selectExpr(
            *kept, "__text", f"inline(array({read})) AS ({', '.join([*self.read, '__bad'])})"
        )
        checks = {
            t: f"CASE WHEN __bad IS NULL THEN {direct_value(t, f.dataType)} END"
            for t, f, direct in zip(self.read, self.fields, self.direct)
            if direct
        }
        if checks:
            same = [t for t in self.read if t not in checks]
            values = ", ".join(f"'{t}', {check}" for t, check in checks.items())
            df = df.selectExpr(*kept, "__text", *same, f"inline(array(named_struct({values})))")
        complete = _all([f"{t} IS NOT NULL" for t in self.read])
        if self.lenient:
            rest = f"CASE WHEN {complete} THEN NULL ELSE parse_json(__text) END"
        else:
            complete = f"({complete}) AND {_one_object('__text')}"
            rest = f"CASE WHEN {complete} THEN NULL ELSE {_whole_value('__text')} END"
        return _once(df, [*kept, *self.read], rest, "__parsed")

    def taken(self, df: DataFrame, kept: list[str], root: str) -> DataFrame:
        """Take each field out of the variant ``root``, once."""
        if not self.fields:
            return df.selectExpr(*kept)
        values = [
            f"'__f{i}', {Place(root).child(f.name).value}" for i, f in enumerate(self.fields)
        ]
        return df.selectExpr(*kept, *self.read, f"inline(array(named_struct({', '.join(values)})))")

    def place(self, i: int) -> Place:
        if self.in_one_pass and not self.direct[i]:
            return Place(f"coalesce(__t{i}, __f{i})")
        return Place(f"__f{i}")

    def condition(self, i: int, otherwise: str) -> str:
        return f"(__t{i} IS NOT NULL OR {otherwise})" if self.direct[i] else otherwise

    def value(self, i: int, otherwise: str) -> str:
        field = self.fields[i]
        if self.direct[i]:
            direct = f"CAST(__t{i} AS {sql_type(field.dataType)})"
            otherwise = f"coalesce({direct}, {otherwise})"
        return f"{otherwise} AS {sql_name(field.name)}"


def _all(conditions: list[str]) -> str:
    return " AND ".join(conditions) or "TRUE"


def decode_strict(
    df: DataFrame,
    schema: T.StructType | str,
    doc: str = "doc",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Documents to rows of ``schema``; a value must be of its field's type.

    A document that is an array gives a row per element. A row is dropped when
    a top-level field is missing or of another type; JSON null fits any type.
    Below the top level a value that does not fit becomes null. Text that is
    not JSON raises. ``keep`` names columns of ``df`` to carry along.
    """
    _allow_repeated_names(df)
    kept = [sql_name(c) for c in keep]
    take = _Fields(df, as_schema(schema), doc, lenient=False)
    rows = _elements(take.parsed(df, kept, doc), [*kept, *take.read])
    rows = take.taken(rows, kept, "__item")
    conditions, values = [], []
    for i, field in enumerate(take.fields):
        place, data_type = take.place(i), field.dataType
        conditions.append(take.condition(i, strict_fits(place, data_type)))
        values.append(take.value(i, strict_value(place, data_type, known_to_fit=True)))
    return rows.where(_all(conditions)).selectExpr(*kept, *values)


def decode_lenient(
    df: DataFrame,
    schema: T.StructType | str,
    doc: str = "payload",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Messages to rows of ``schema``; a value is converted to its field's type.

    A message is dropped when it is blank, is no object or misses a top-level
    field; an explicit JSON null stays as null. Text that is not JSON raises.
    ``keep`` names columns of ``df`` to carry along.
    """
    _allow_repeated_names(df)
    kept = [sql_name(c) for c in keep]
    take = _Fields(df, as_schema(schema), doc, lenient=True)
    if not _is_variant(df, doc):
        df = df.where(f"{take.text} RLIKE {sql_text(NOT_BLANK)}")
    rows = take.taken(take.parsed(df, kept, doc), kept, "__parsed")
    conditions, values = [], []
    for i, field in enumerate(take.fields):
        place, data_type = take.place(i), field.dataType
        conditions.append(take.condition(i, f"{place.value} IS NOT NULL"))
        values.append(take.value(i, lenient_value(place, data_type, top=True)))
    return rows.where(_all(conditions)).selectExpr(*kept, *values)
