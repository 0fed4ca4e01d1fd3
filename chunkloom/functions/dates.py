"""Dates and times held as text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkloom import fixed_values as fv

_DAY_MICROS = 86_400_000_000
# Range in which a number of seconds has a calendar time: years 1 to 9999.
_FIRST_SECOND, _END_SECOND = -62_135_596_800.0, 253_402_300_800.0


def parse_compact_date(text: Column) -> Column:
    """'YYYYMMDD' (month and day may be one digit) to 'YYYY-MM-DD', null when not a date."""
    year, month, day = (F.regexp_extract(text, fv.COMPACT_DATE, i) for i in (1, 2, 3))
    # No match leaves three empty parts, which is no date either; there is no year 0.
    date = F.try_to_date(F.concat_ws("-", year, month, day))
    return F.when(year != "0000", date.cast("string"))


def has_calendar_time(seconds: Column) -> Column:
    return (seconds >= F.lit(_FIRST_SECOND)) & (seconds < F.lit(_END_SECOND))


def midpoint(start: Column, end: Column) -> Column:
    """Middle of a segment, at least the margin after its start."""
    margin = F.lit(fv.MIDPOINT_MARGIN)
    half = F.greatest(F.lit(0.0), end - start) / F.lit(2.0)
    return F.greatest(margin, start + F.greatest(margin, half))


def time_of_day(seconds: Column) -> Column:
    """UTC 'HH:MM:SS', with six decimals when the microseconds are not zero."""
    whole = seconds.cast("bigint")
    micros = whole * F.lit(1_000_000) + F.bround((seconds - whole) * F.lit(1e6)).cast("bigint")
    of_day = F.pmod(micros, F.lit(_DAY_MICROS))

    def field(unit: int, modulus: int, width: int) -> Column:
        value = F.expr("bigint(0)") + F.floor(of_day / F.lit(unit))
        return F.lpad((value % F.lit(modulus)).cast("string"), width, "0")

    clock = F.concat_ws(":", field(3_600_000_000, 24, 2), field(60_000_000, 60, 2), field(1_000_000, 60, 2))
    fraction = of_day % F.lit(1_000_000)
    tail = F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))
    return F.when(of_day.isNotNull(), F.concat(clock, F.when(fraction == 0, "").otherwise(tail)))


def since(date_text: Column, as_of: Column, days: int = fv.RECENT_DAYS) -> Column:
    """True for ISO dates on or after `as_of` minus `days`; there is no upper bound.

    ISO text sorts like the date, so the text comparison, which Parquet can use
    to skip row groups, goes along with the exact one.
    """
    start = F.date_sub(as_of, days)
    return (date_text >= F.date_format(start, "yyyy-MM-dd")) & (F.try_to_date(date_text) >= start)
