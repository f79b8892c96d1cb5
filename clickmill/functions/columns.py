"""Small column expressions shared by the operators. All of them stay inside Spark's own functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp layouts accepted in messages, besides everything Spark casts by itself.
EXTRA_TIME_FORMATS = ("yyyy/MM/dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "dd MMM yyyy HH:mm:ss", "yyyyMMdd HHmmss")

UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def hour_key(ts: Column) -> Column:
    return F.date_format(ts, "HH")


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def lenient_timestamp(text: Column, formats: Sequence[str] = EXTRA_TIME_FORMATS) -> Column:
    """Text to a timestamp of whole seconds; null when no layout fits."""
    tries = [F.try_to_timestamp(text)] + [F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats]
    return F.date_trunc("second", F.coalesce(*tries))


def canonical_uuid(text: Column) -> Column:
    """Lower-case dashed form of a UUID given with or without dashes, braces or ``urn:uuid:``; null if it is none."""
    digits = F.regexp_replace(F.lower(F.trim(text)), "urn:|uuid:|[{}-]", "")
    dashed = F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(dashed.rlike(UUID_PATTERN), dashed)


def name_uuid(*parts: Column) -> Column:
    """A UUID (version 8) made of the values: equal values give an equal id, also when a lost task is repeated."""
    cells = [F.when(part.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), part.cast("string"))) for part in parts]
    digits = F.md5(F.concat_ws("\x1f", *cells).cast("binary"))
    # version and variant have fixed places
    return F.concat(digits.substr(1, 8), F.lit("-"), digits.substr(9, 4), F.lit("-8"), digits.substr(14, 3), F.lit("-"),
                    F.translate(digits.substr(17, 1), "0123456789abcdef", "89ab89ab89ab89ab"), digits.substr(18, 3), F.lit("-"),
                    digits.substr(21, 12))


def slug(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit(" "), F.lit("-"))


def safe_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient, 0.0 when the denominator is not positive."""
    return F.round(F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0)), digits)


def in_interval(ts: Column, start: str, end: str) -> Column:
    """``start <= ts < end``."""
    return (ts >= F.lit(start).cast("timestamp")) & (ts < F.lit(end).cast("timestamp"))


def all_set(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(n).isNotNull() for n in names))
