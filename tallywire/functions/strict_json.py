"""Whole-payload JSON parsing into VARIANT, and the JSON type of each field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_strict(text: Column) -> Column:
    """The JSON value of the whole text as VARIANT, null when the text is not exactly one JSON value.

    `try_parse_json` stops after the first value and ignores what follows. Inside brackets the text must give an
    array of exactly one element, and whatever follows is then inside the array too - unless the text closes the
    bracket itself, so only text with a `]` pays for a second parse in a different wrapping.
    """
    boxed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    value = F.variant_get(boxed, "$[0]", "variant")
    alone = F.variant_get(boxed, "$[1]", "variant").isNull()
    wrapped = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit(',"_end":1}')))
    closes_itself = F.contains(text, F.lit("]")) & wrapped.isNull()
    return F.when(alone & ~closes_itself, value)


def is_object(text: Column) -> Column:
    """Whether text that parsed as JSON holds an object: the first character after blanks decides."""
    return F.ltrim(text, F.lit(" \t\r\n")).startswith("{")


def field(value: Column, name: str, as_type: str = "variant") -> Column:
    return F.try_variant_get(value, f"$.{name}", as_type)


def json_type(shape: Column) -> Column:
    """JSON type behind a `schema_of_variant`: number, string, boolean or object (arrays too); null for JSON null."""
    return (
        F.when(shape == "STRING", "string")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape.startswith("OBJECT") | shape.startswith("ARRAY"), "object")
        .when(shape != "VOID", "number")
    )
