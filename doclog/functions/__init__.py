"""Column expressions: decode, encode, offsets."""

from .decode import lenient_value, strict_fits, strict_value
from .encode import check_encodable, finite_or_null, quoted, row_to_json
from .offsets import (
    EARLIEST,
    Offset,
    in_range,
    offset_from_json,
    offset_struct,
    offset_to_json,
)
from .variant import Place, sql_name, sql_text

__all__ = [
    "EARLIEST",
    "Offset",
    "Place",
    "check_encodable",
    "finite_or_null",
    "in_range",
    "lenient_value",
    "offset_from_json",
    "offset_struct",
    "offset_to_json",
    "quoted",
    "row_to_json",
    "sql_name",
    "sql_text",
    "strict_fits",
    "strict_value",
]
