"""A place inside a JSON variant, and the questions asked of it.

The answers are SQL expressions as text: for a schema of hundreds of fields one
text per field is far quicker to hand to Spark than thousands of column
objects. All of them are native expressions, so a projection built from them
can take part in whole-stage code generation.
"""

from __future__ import annotations

from dataclasses import dataclass

# The first three letters of the kinds schema_of_variant() names.
NUMERIC = ("BIG", "DEC", "DOU", "FLO")
TEXT = "STR"
BOOLEAN = "BOO"
VOID = "VOI"
NESTED = ("OBJ", "ARR")


def sql_text(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_name(name: str) -> str:
    """A column name, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def one_of(value: str, *texts: str) -> str:
    return f"{value} IN ({', '.join(map(sql_text, texts))})"


@dataclass(frozen=True)
class Place:
    """The value at ``path`` below the variant expression ``root``."""

    root: str
    path: str = "$"

    def get(self, sql_type: str) -> str:
        """The value as ``sql_type``, NULL where it cannot be cast."""
        return f"try_variant_get({self.root}, {sql_text(self.path)}, '{sql_type}')"

    def child(self, name: str) -> "Place":
        """The field ``name``, addressed from the same root.

        Keeping the root and growing the path keeps the expression of a deeply
        nested field as small as that of a shallow one.
        """
        if '"' not in name:
            return Place(self.root, f'{self.path}["{name}"]')
        if "'" not in name:
            return Place(self.root, f"{self.path}['{name}']")
        fields = self.get("map<string,variant>")
        return Place(f"try_element_at({fields}, {sql_text(name)})")

    @property
    def value(self) -> str:
        return self.root if self.path == "$" else self.get("variant")

    @property
    def kind_name(self) -> str:
        return f"schema_of_variant({self.value})"

    @property
    def kind(self) -> str:
        """First three letters of the kind; NULL where there is no value."""
        return f"substring({self.kind_name}, 1, 3)"

    @property
    def is_json_null(self) -> str:
        return f"is_variant_null({self.value})"

    @property
    def is_object(self) -> str:
        # a cast to a struct of no fields succeeds for objects only, and copies nothing
        return f"{self.get('struct<>')} IS NOT NULL"

    @property
    def is_array(self) -> str:
        # likewise: elements that are no booleans become null, the array stays
        return f"{self.get('array<boolean>')} IS NOT NULL"

    @property
    def elements(self) -> str:
        return self.get("array<variant>")
