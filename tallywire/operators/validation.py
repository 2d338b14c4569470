"""Decoding, parsing and validating raw records; routing bad ones with every reason they are bad."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywire.functions.clock import iso_timestamp
from tallywire.functions.numbers import is_finite
from tallywire.functions.strict_json import field, is_object, json_type, parse_strict
from tallywire.functions.text import utf8_text, utf16_length
from tallywire.schema import FIELDS, INVALID_JSON, REQUIRED_FIELDS, SCHEMA_INVALID

MAX_ID_UNITS = 200

# The texts of the problems.
NOT_JSON = "payload is not valid JSON"
NOT_OBJECT = "event must be a JSON object"
LONG_ID = f"eventId must be <= {MAX_ID_UNITS} characters"
BAD_TS = "ts must be an ISO-8601 timestamp"


def decode_payload(df: DataFrame, value: str = "value") -> DataFrame:
    """Add `payload`: the record value as text."""
    return df.withColumn("payload", utf8_text(F.col(value)))


def parse_payload(df: DataFrame) -> DataFrame:
    """Add `event`: the payload as VARIANT, null when it is not exactly one JSON value."""
    if "payload" not in df.columns:
        df = decode_payload(df)
    return df.withColumn("event", parse_strict(F.col("payload")))


def validate(df: DataFrame) -> DataFrame:
    """Add `reason` and `errors` (null and empty for a good record) and the columns of the reading.

    A record is judged by its own JSON types, field by field, and all problems are listed: the fields in order, then
    the length of the id, then the timestamp. Optional fields of another type count as missing.

    Objects without nesting and without any problem, which most records are, are read by one typed parse. Everything
    else - nested, ill-typed or broken - goes through VARIANT, where the type of each field can be asked for.
    """
    if "payload" not in df.columns:
        df = decode_payload(df)
    columns = df.columns
    df = df.select("*", _typed_parse().alias("_typed"))
    df = df.select("*", iso_timestamp(F.col("_typed.ts")).alias("_time"))
    df = df.select("*", _is_good().alias("_good"))
    df = df.select("*", F.when(~F.col("_good"), _examined(F.col("payload"))).alias("_slow"))

    good = F.col("_good")
    readings = [
        F.when(good, F.col(f"_typed.{name}")).otherwise(F.col(f"_slow.{column}")).alias(column)
        for name, (column, _) in FIELDS.items()
    ]
    time = F.when(good, F.col("_time")).otherwise(F.col("_slow.event_time")).alias("event_time")
    errors = F.when(good, F.array().cast("array<string>")).otherwise(F.col("_slow.errors"))
    # One row in, one row out. A filter on generated columns stays above the generator; through plain projections it
    # would be pushed to the scan, with all of the parsing and checking written into it a second time.
    verdict = F.inline(F.array(F.struct(F.col("_slow.reason").alias("reason"), errors.alias("errors"))))
    return df.select(*columns, *readings, time, verdict)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validated records as (readings, quarantine).

    Both sides scan `df`: hand in a staged table when both are wanted, so that parsing happens once.
    """
    checked = df if "reason" in df.columns else validate(df)
    return checked.where(F.col("reason").isNull()), checked.where(F.col("reason").isNotNull())


_CORRUPT = "_corrupt"

# Spark's JSON reader is more lenient than JSON by default.
_STRICT = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def _ends_once(text: Column) -> Column:
    """Whether text starts with a brace and its only closing one comes last: an object there has nothing after it."""
    before = F.octet_length(F.substring_index(text, "}", 1))
    return text.startswith("{") & (before + 1 == F.octet_length(text))


def _typed_parse() -> Column:
    fields = [
        T.StructField(name, T.DoubleType() if kind == "number" else T.StringType())
        for name, (_, kind) in FIELDS.items()
    ]
    schema = T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])
    payload = F.col("payload")
    return F.from_json(F.when(_ends_once(payload), payload), schema, _STRICT)


def _is_good() -> Column:
    """Whether the typed parse read everything there is to read and nothing is wrong with it.

    That parse takes any value for a text, so a text that could be something else is left to the slow way.
    """
    good = F.col("_time").isNotNull() & F.col(f"_typed.{_CORRUPT}").isNull()
    for name, (_, kind) in FIELDS.items():
        value = F.col(f"_typed.{name}")
        fine = is_finite(value) if kind == "number" else _only_text(value)
        good &= fine if name in REQUIRED_FIELDS else value.isNull() | fine
    return F.coalesce(good & ~_too_long(F.col("_typed.eventId")), F.lit(False))


def _only_text(value: Column) -> Column:
    """Whether a field read as text can only have been a text: it looks like no number, boolean, object or array."""
    first = F.ascii(value)
    digit_or_sign = first.between(ord("0"), ord("9")) | (first == ord("-"))
    # A pattern is only tried on the few texts that start like a number.
    number = F.when(digit_or_sign, value.rlike(r"^-?[0-9][0-9.eE+-]*$")).otherwise(F.lit(False))
    return ~value.isin("true", "false") & ~first.isin(ord("["), ord("{")) & ~number


def _examined(payload: Column) -> Column:
    """What VARIANT tells of a payload: its fields, its errors and the reason to reject it.

    One nested expression with names for its intermediate values, so that it runs as a whole or not at all.
    """
    return _let(parse_strict(payload), lambda event: _let(_shapes(event), lambda kinds: _judged(payload, event, kinds)))


def _shapes(event: Column) -> Column:
    """The JSON type of every field, in order."""
    return F.transform(F.array(*[F.schema_of_variant(field(event, name)) for name in FIELDS]), json_type)


def _judged(payload: Column, event: Column, kinds: Column) -> Column:
    values = []
    for i, (name, (column, wanted)) in enumerate(FIELDS.items()):
        target = "double" if wanted == "number" else "string"
        values.append(F.when(kinds[i] == wanted, field(event, name, target)).alias(column))
    return _let(
        F.struct(*values),
        lambda reading: _let(
            iso_timestamp(reading["ts"]),
            lambda time: _let(
                _errors(payload, event, kinds, reading, time),
                lambda errors: F.struct(
                    *[reading[column].alias(column) for column, _ in FIELDS.values()],
                    time.alias("event_time"),
                    F.when(event.isNull(), INVALID_JSON).when(F.size(errors) > 0, SCHEMA_INVALID).alias("reason"),
                    errors.alias("errors"),
                ),
            ),
        ),
    )


def _errors(payload: Column, event: Column, kinds: Column, reading: Column, time: Column) -> Column:
    problems = [
        _field_problem(name, wanted, kinds[i], reading[column])
        for i, (name, (column, wanted)) in enumerate(REQUIRED_FIELDS.items())
    ]
    problems.append(F.when(_too_long(reading["event_id"]), LONG_ID))
    problems.append(F.when(reading["ts"].isNotNull() & time.isNull(), BAD_TS))
    return (
        F.when(event.isNull(), F.array(F.lit(NOT_JSON)))
        .when(~is_object(payload), F.array(F.lit(NOT_OBJECT)))
        .otherwise(F.array_compact(F.array(*problems)))
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _field_problem(name: str, wanted: str, kind: Column, value: Column) -> Column:
    problem = F.when(kind.isNull(), f"{name} is required").when(
        kind != wanted, F.concat(F.lit(f"{name} must be a {wanted}, received "), kind)
    )
    if wanted == "number":
        problem = problem.when(~is_finite(value), f"{name} must be a finite number")
    return problem


def _too_long(text: Column) -> Column:
    """A text of half as many characters is never too long, so the units are seldom counted."""
    return (F.length(text) > MAX_ID_UNITS // 2) & (utf16_length(text) > MAX_ID_UNITS)
