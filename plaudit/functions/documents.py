"""Typed access to JSON values.

``from_json`` with plain types coerces (a number read as text is accepted, a quoted number may not
be), so fields are read as variants in one parse and checked against the type that JSON really held.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.functions import times

MALFORMED = "_malformed"


# First letters of the kinds of numbers: BIGINT, DOUBLE, FLOAT, DECIMAL(p,s). One look at a kind, which costs a text to make.
_NUMBERS = ("BIG", "DOU", "FLO", "DEC")


def _holds(kind: Column, dtype: T.DataType) -> Column:
    """Whether a JSON kind, as schema_of_variant names it, suits a column type."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.substring(kind, 1, 3).isin(*_NUMBERS)
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        return kind == "BIGINT"
    if isinstance(dtype, T.TimestampType):
        return F.substring(kind, 1, 3).isin(*_NUMBERS, "STR")
    return kind == dtype.simpleString().upper()


def once(value: Column) -> Column:
    """Generator that evaluates ``value`` once per row.

    A plain projection would be merged into every later use of its fields, and pushed into filters,
    so that each field parses the text again. A generator's output is never inlined.
    """
    return F.explode(F.array(value))


def apart(value: Column) -> Column:
    """``once`` as a step with code of its own.

    Steps that Spark fuses become one generated method, and the JVM only interprets methods of more than 8,000 bytes. A step
    with a higher-order function is not fused.
    """
    return F.explode(F.transform(F.array(value), lambda found: found))


def parse_object(text: Column, fields: str) -> Column:
    """One parse of a JSON object; ``fields`` is DDL. Broken input fills the malformed marker."""
    return F.from_json(
        text, f"{fields}, {MALFORMED} STRING", {"columnNameOfCorruptRecord": MALFORMED}
    )


def is_object(text: Column) -> Column:
    """Cheap shape test for what the parser lets pass: blank lines, arrays, trailing junk."""
    return F.ltrim(text).startswith("{") & F.rtrim(text).endswith("}")


def is_missing(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def bounded(number: Column, dtype: T.DataType, limit: float | None = None) -> Column:
    """The number, or null where it is not finite or its magnitude is over ``limit``; other types as they are."""
    if not isinstance(dtype, (T.FloatType, T.DoubleType)):
        return number
    most = F.lit(limit if limit is not None else 3.4e38 if isinstance(dtype, T.FloatType) else 1.7e308)
    return F.when(F.abs(number).cast("double") <= most, number)  # NaN is larger than any number


def typed(value: Column, dtype: T.DataType, limit: float | None = None) -> Column:
    """The value as ``dtype``; null when JSON held another kind or it does not fit.

    A timestamp is epoch milliseconds, as a number or as text.
    """
    if isinstance(dtype, T.TimestampType):
        result = times.from_millis(F.try_variant_get(value, "$", "bigint"))
    else:
        result = bounded(F.try_variant_get(value, "$", dtype.simpleString()), dtype, limit)
    return F.when(_holds(F.schema_of_variant(value), dtype), result)


def detail(details: Column, name: str) -> Column:
    """Value of a key in any letter case; the first one when several differ only by case."""
    matches = F.map_values(F.map_filter(details, lambda k, _: F.lower(k) == name))
    return F.get(matches, F.lit(0))


def image_urls(images: Column, key: str) -> Column:
    """Text values of one key over all images; nulls and list values are left out."""
    urls = F.transform(images, lambda image: typed(F.element_at(image, key), T.StringType()))
    return F.filter(urls, lambda url: url.isNotNull())
