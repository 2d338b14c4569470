"""Text helpers: UTF-8 decoding, lengths in UTF-16 units, padding that never cuts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf8_text(payload: Column) -> Column:
    """Bytes as text; invalid bytes become U+FFFD, a missing payload becomes the empty text."""
    return F.coalesce(F.make_valid_utf8(payload.cast("string")), F.lit(""))


def utf16_length(text: Column) -> Column:
    """Number of UTF-16 units (a character outside the basic plane counts twice)."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def utf16_prefix(text: Column, units: int) -> Column:
    """The first `units` UTF-16 units; half of a pair at the cut becomes U+FFFD, as UTF-8 cannot hold it."""
    head = F.substring(text, 1, units)
    cut = F.encode(head, "UTF-16BE").substr(F.lit(1), F.lit(2 * units))
    last_unit = F.hex(cut.substr(F.lit(2 * units - 1), F.lit(2)))
    splits_pair = last_unit.between("D800", "DBFF")
    whole = F.decode(F.when(splits_pair, cut.substr(F.lit(1), F.lit(2 * units - 2))).otherwise(cut), "UTF-16BE")
    # Only text with characters outside the basic plane can be longer in units than in characters.
    return F.when(utf16_length(head) <= units, head).when(splits_pair, F.concat(whole, F.lit("�"))).otherwise(whole)


def pad_left(text: Column, width: int, fill: str = " ") -> Column:
    """Pad on the left; text that is already longer stays whole."""
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit(fill))


def pad_right(text: Column, width: int, fill: str = " ") -> Column:
    """Pad on the right; text that is already longer stays whole."""
    return F.rpad(text, F.greatest(F.lit(width), F.length(text)), F.lit(fill))


def utf16_char(code: Column) -> Column:
    """The character of one UTF-16 unit; a lone half of a pair becomes U+FFFD."""
    unit = F.pmod(code.cast("long"), F.lit(65536))
    return F.when(unit.between(0xD800, 0xDFFF), F.lit("�")).otherwise(
        F.decode(F.unhex(F.lpad(F.hex(unit), 4, "0")), "UTF-16BE")
    )
