"""Scalar column functions: numbers from text, names, keys, times and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_to_number(c: Column) -> Column:
    """Text to whole number, rounded half up; NULL when it is not a number."""
    return c.cast("string").try_cast("decimal(38,0)").try_cast("bigint")


def percent_to_number(c: Column) -> Column:
    """`"55%"` to 55."""
    return try_to_number(F.replace(c.cast("string"), F.lit("%"), F.lit("")))


def blank_to_null(c: Column) -> Column:
    """Trim spaces; nothing left is NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """First and last name with one space between, missing parts read as empty; blank is NULL."""
    blank = F.lit("")
    return blank_to_null(F.concat(F.coalesce(first, blank), F.lit(" "), F.coalesce(last, blank)))


def name_key(c: Column) -> Column:
    """Match key of a name: trimmed, lower case, only a-z, 0-9 and single spaces kept.

    The patterns take whole runs, and leave single spaces alone, so that long texts need few replacements.
    """
    kept = F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9 ]+", "")
    return F.regexp_replace(kept, " {2,}", " ")


def event_id(topic: Column, partition: Column, offset: Column) -> Column:
    """`topic:partition:offset`; NULL when any part is."""
    return F.concat(topic.cast("string"), F.lit(":"), partition.cast("string"), F.lit(":"), offset.cast("string"))


def event_time(*candidates: Column) -> Column:
    """First known time, as a zone-free timestamp."""
    return F.coalesce(*[c.cast("timestamp_ntz") for c in candidates])


def card_color(detail: Column) -> Column:
    """Card colour named in the event detail; red wins over yellow."""
    text = F.lower(detail)
    return F.when(text.like("%red%"), "red").when(text.like("%yellow%"), "yellow").otherwise("unknown")


def side_label(pos: Column) -> Column:
    """Side of the n-th line-up in a response: home, away, then `unknown_n`."""
    other = F.concat(F.lit("unknown_"), pos.cast("string"))
    return F.when(pos == 0, "home").when(pos == 1, "away").otherwise(other)


def epoch_ms_to_ntz(ms: Column) -> Column:
    """Epoch milliseconds to a zone-free UTC timestamp (the session zone is UTC)."""
    return F.timestamp_millis(ms.cast("bigint")).cast("timestamp_ntz")


def to_ntz_seconds(c: Column) -> Column:
    """Text or timestamp to a zone-free timestamp of whole seconds."""
    return F.date_trunc("second", c.cast("timestamp_ntz")).cast("timestamp_ntz")


def utf8_text(c: Column) -> Column:
    """Bytes to text; NULL stays NULL."""
    return F.decode(c, "UTF-8")


def join_ids(ids: Column, sep: str = "-") -> Column:
    """An array of ids as one delimited text."""
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), sep)
