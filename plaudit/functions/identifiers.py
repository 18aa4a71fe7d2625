"""Time-ordered and name-based identifiers as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MILLIS_RANGE = 1 << 48


def _variant_digit(nibble: Column) -> Column:
    """The RFC 9562 variant digit (8, 9, a or b) chosen by a hash digit."""
    return F.translate(nibble, "0123456789abcdef", "89ab" * 4)


def _uuid7(millis: Column, digest: Column) -> Column:
    """48-bit time, version 7, and 74 bits of a 32-digit hex digest."""
    time = F.lpad(F.lower(F.hex(F.pmod(millis, F.lit(_MILLIS_RANGE)))), 12, "0")
    return F.concat(
        F.substring(time, 1, 8), F.lit("-"), F.substring(time, 9, 4),
        F.lit("-7"), F.substring(digest, 1, 3),
        F.lit("-"), _variant_digit(F.substring(digest, 4, 1)), F.substring(digest, 5, 3),
        F.lit("-"), F.substring(digest, 8, 12),
    )


def uuid7_from(ts: Column, digest: Column) -> Column:
    """Same input, same id: retries, reruns and double writes agree. A null time counts as epoch."""
    return _uuid7(F.coalesce(F.unix_millis(ts), F.lit(0)), digest)


def uuid7_random() -> Column:
    """A fresh id per row with the current time; differs on every evaluation."""
    return _uuid7(F.unix_millis(F.current_timestamp()), F.md5(F.uuid()))


def name_id(kind: str, name: Column) -> Column:
    """Name-based id (md5, version 3); null for a null name."""
    digest = F.md5(F.concat(F.lit(kind + ":"), name))
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4),
        F.lit("-3"), F.substring(digest, 14, 3),
        F.lit("-"), _variant_digit(F.substring(digest, 17, 1)), F.substring(digest, 18, 3),
        F.lit("-"), F.substring(digest, 21, 12),
    )


def content_digest(*columns: Column) -> Column:
    """md5 over the columns' texts, each after its length; a null differs from any text, and no text can pass for two."""
    def part(text: Column) -> Column:
        return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.md5(F.concat(*[part(c.cast("string")) for c in columns]))
