"""Column functions for change-data-capture messages. Built-in expressions only, so
batch and streaming jobs share them and stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.numeric import col

# What a float literal may look like (digits may be grouped by "_").
_DIGITS = r"\d(?:_?\d)*"
_NUMBER = rf"^\s*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*$"
_SPECIAL = r"(?i)^\s*[+-]?(?:inf|infinity|nan)\s*$"
_INTEGER = r"^-?\d+$"
_BASE64 = r"^[A-Za-z0-9+/]+={0,2}$"


def parse_decimal(value: Column | str) -> Column:
    """Number text to double; NULL for anything that is not a float literal."""
    text = col(value).cast("string")
    return F.when(
        text.rlike(_NUMBER) | text.rlike(_SPECIAL), F.regexp_replace(text, "_", "").try_cast("double")
    )


def decode_decimal(value: Column | str, scale: int) -> Column:
    """Base64 big-endian two's-complement integer divided by 10^scale, as double.

    Any length: the first byte carries the sign, and the bytes' distances from the sign
    (zero, or 255 for a negative number) are folded to the magnitude, so that a padded
    number keeps its value. Exact below 2^53. Empty or invalid text gives NULL.
    """
    text = col(value)
    padded = text.rlike(_BASE64) & (F.length(text) % 4 == 0)
    digits = F.hex(F.try_to_binary(F.when(padded, text), F.lit("base64")))
    negative = F.substring(digits, 1, 1) >= "8"
    places = F.transform(F.sequence(F.lit(1), F.length(digits) - 1, F.lit(2)), lambda i: F.conv(F.substring(digits, i, F.lit(2)), 16, 10).cast("double"))
    size = F.aggregate(
        places, F.lit(0.0), lambda total, byte: total * 256 + F.when(negative, 255 - byte).otherwise(byte)
    )
    return F.when(F.length(digits) > 0, F.when(negative, -size - 1).otherwise(size)) / F.lit(float(10**scale))


def parse_amount(value: Column | str, scale: int = 2) -> Column:
    """Number text first, then the base64 form."""
    return F.coalesce(parse_decimal(value), decode_decimal(value, scale))


def parse_date(value: Column | str) -> Column:
    """ISO date text or whole days since 1970-01-01."""
    text = col(value).cast("string")
    return F.when(text.rlike(_INTEGER), F.date_from_unix_date(text.try_cast("int"))).otherwise(text.try_cast("date"))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(parse_date(later), parse_date(earlier))


def days_birth(birth: Column | str, created: Column | str) -> Column:
    """Days from application back to birth (zero or negative)."""
    return days_between(birth, created)


def days_employed(start: Column | str, created: Column | str, training_sign: bool = False) -> Column:
    """Days since employment began: positive as the stream reports it, or negative
    as the training data has it."""
    return days_between(start, created) if training_sign else days_between(created, start)


def document_flag(document_id: Column | str) -> Column:
    """1 for a non-blank document id, else 0."""
    return F.coalesce(col(document_id).rlike(r"(?U)\S"), F.lit(False)).cast("int")


_RECORD = "sk_id_curr string, value struct<sk_id_curr: string>"
_ENVELOPE = f"{_RECORD}, after struct<{_RECORD}>, before struct<{_RECORD}>"
_KEY_SCHEMA = f"payload struct<op: string, {_ENVELOPE}>, op string, {_ENVELOPE}"


def _envelope(message: Column) -> tuple[Column, Column]:
    parsed = F.from_json(message, _KEY_SCHEMA)
    return parsed, parsed["payload"]


def cdc_key(message: Column | str) -> Column:
    """Customer id of a message: plain record, or the ``after`` (else ``before``) row
    of an envelope with or without ``payload``; one more ``value`` level is allowed."""
    root, payload = _envelope(col(message))

    def key_of(level: Column) -> Column:
        after, before = level["after"], level["before"]

        def pick(record: Column) -> Column:
            return F.coalesce(record["sk_id_curr"], record["value"]["sk_id_curr"])

        return F.when(after.isNotNull(), pick(after)).when(before.isNotNull(), pick(before)).otherwise(pick(level))

    return F.when(payload.isNotNull(), key_of(payload)).otherwise(key_of(root))


def cdc_op(message: Column | str) -> Column:
    """Operation code of an envelope (c, u, d, r), NULL for a plain record."""
    root, payload = _envelope(col(message))
    return F.coalesce(payload["op"], root["op"])


def unwrap_cloudevent(message: Column | str) -> Column:
    """The ``data`` object of a CloudEvents envelope, any other message unchanged."""
    text = col(message)
    data = F.get_json_object(text, "$.data")
    return F.when(F.get_json_object(text, "$.specversion").isNotNull() & data.isNotNull(), data).otherwise(text)
