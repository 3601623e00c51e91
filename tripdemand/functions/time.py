"""Time functions: pickup parsing, 10-minute blocks, names and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripdemand.schemas import BLOCK_MINUTES

# Fixed pattern: the strict shape of ``%Y-%m-%d %H:%M:%S`` as strptime reads
# it (one or two digits for the parts after the year, any run of whitespace
# between date and time, seconds 0..59).
PICKUP_TEXT = (r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})\s+"
               r"([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})$")


def parse_pickup(text: Column) -> Column:
    """Validated wall-clock TIMESTAMP_NTZ, NULL for any malformed text.

    One regex match enforces strptime's shape; the cast to TIMESTAMP_NTZ
    (zone-free) rejects impossible values (Feb 30, hour 24, second 60).
    Only if that cast fails is the whitespace between date and time
    normalised and the cast retried (strptime accepts any run of it).
    """
    shaped = text.rlike(PICKUP_TEXT) & ~text.startswith("0000")
    return F.when(shaped, F.coalesce(
        text.try_cast("timestamp_ntz"),
        F.regexp_replace(text, r"\s+", " ").try_cast("timestamp_ntz")))


def time_block(ts: Column, block_minutes: int = BLOCK_MINUTES) -> Column:
    """Block of the day: floor((hour*60 + minute) / block_minutes); seconds ignored."""
    minute_of_day = F.hour(ts) * 60 + F.minute(ts)
    return F.floor(minute_of_day / F.lit(block_minutes)).cast("int")


def month_name(ts: Column) -> Column:
    return F.date_format(ts, "MMMM")


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def block_label(block: Column, block_minutes: int = BLOCK_MINUTES) -> Column:
    """``HH:MM`` of the block start (block 143 -> ``23:50``)."""
    minutes = block * F.lit(block_minutes)
    return F.format_string("%02d:%02d", F.floor(minutes / 60).cast("int"),
                           (minutes % 60).cast("int"))


def rebase_pickup_text(text: Column, date_text: Column) -> Column:
    """Keep the time-of-day text after the first space, put ``date_text`` before it."""
    return F.concat(date_text, F.lit(" "), F.get(F.split(text, " ", -1), F.lit(1)))
