from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.catalog import SLOT_MINUTES
from slotwise.functions.numbers import col


def slot_floor(minute_of_day: str | Column, minutes: int = SLOT_MINUTES) -> Column:
    m = col(minute_of_day)
    return (m - m % F.lit(minutes)).cast("int")


def minute_of_day(clock_text: str | Column) -> Column:
    """'HH:mm[:ss...]' -> minutes since midnight, NULL when it is not a clock."""
    part = F.regexp_extract(col(clock_text), r"^(\d{1,2}):(\d{2})", 0)
    pieces = F.split(part, ":")
    return F.when(
        part != "", F.get(pieces, F.lit(0)).cast("int") * 60 + F.get(pieces, F.lit(1)).cast("int")
    )


def slot_timestamp(ref_date: str | Column, slot: str | Column) -> Column:
    """Date + minute of day."""
    return F.timestamp_add("MINUTE", col(slot), col(ref_date).cast("timestamp"))


def parse_slot_timestamp(ref_date: str | Column, clock_text: str | Column) -> Column:
    """Date + first 8 characters of a time text; anything unparsable is NULL."""
    text = F.concat_ws(" ", col(ref_date).cast("string"), F.substring(col(clock_text), 1, 8))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def slot_text(slot: str | Column) -> Column:
    """Minute of day as HH:mm:00; 1440 prints 24:00:00, as the report does."""
    s = col(slot)
    return F.format_string("%02d:%02d:00", F.floor(s / 60).cast("int"), (s % 60).cast("int"))


def weekday(ts: str | Column) -> Column:
    """Monday = 0."""
    return F.weekday(col(ts))
