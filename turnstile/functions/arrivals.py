"""Column-valued helpers for arrival messages.  All JVM-side expressions.

Decisions where the keyed writer's behaviour was ambiguous (stated in the
README): an unparsable, null or missing time-to-station is ``unknown`` and 0
minutes; 0 seconds is ``arriving``.  Peak buckets read the hour from the
ingestion time, not the arrival time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delay levels by seconds to the station (upper bounds inclusive).
DELAY_LEVELS = [(60, "arriving"), (300, "close"), (600, "medium")]
DELAY_BEYOND = "far"
DELAY_UNKNOWN = "unknown"

# Peak windows by hour of day, [start, end).
PEAK_WINDOWS = [(7, 10, "morning_peak"), (16, 20, "evening_peak")]
PEAK_OTHER = "off_peak"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c) -> Column:
    """Whole-number reading of a value; null when it is not an integer (e.g. 45.7, 'x')."""
    return _col(c).cast("string").try_cast("int")


def delay_level(seconds) -> Column:
    t = as_int(seconds)
    out = F.when(t.isNull(), F.lit(DELAY_UNKNOWN))
    for bound, label in DELAY_LEVELS:
        out = out.when(t <= bound, F.lit(label))
    return out.otherwise(F.lit(DELAY_BEYOND))


def hour_of(text) -> Column:
    """Hour from characters 12-13 of the text form (``yyyy-MM-dd HH`` or ``...THH``)."""
    return F.substring(_col(text).cast("string"), 12, 2).try_cast("int")


def peak_bucket(ingested) -> Column:
    h = hour_of(ingested)
    out = None
    for start, end, label in PEAK_WINDOWS:
        cond = (h >= start) & (h < end)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.coalesce(out, F.lit(PEAK_OTHER))


# Every character Python's str.isspace() accepts (built from that rule, not listed).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def clean_text(c) -> Column:
    """Null -> '', single quotes removed, surrounding whitespace stripped."""
    text = F.replace(F.coalesce(_col(c).cast("string"), F.lit("")), F.lit("'"), F.lit(""))
    return F.btrim(text, F.lit(WHITESPACE))


def _key_part(c) -> Column:
    # spaces and single quotes removed; a null part becomes ''
    return F.translate(F.coalesce(_col(c).cast("string"), F.lit("")), " '", "")


def row_key(station, line, vehicle, event_time) -> Column:
    """station#line#vehicle#time, spaces and quotes stripped from the first two."""
    return F.concat_ws("#", _key_part(station), _key_part(line),
                       F.coalesce(_col(vehicle).cast("string"), F.lit("")),
                       F.coalesce(_col(event_time).cast("string"), F.lit("")))


def minutes(seconds) -> Column:
    """Seconds -> minutes rounded to 2 decimals; 0.0 when not a whole number."""
    return F.coalesce(F.round(as_int(seconds) / F.lit(60.0).cast("double"), 2), F.lit(0.0))
