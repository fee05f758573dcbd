"""Time expressions for ISO-like request times kept as text."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date and time, then a fraction of at least one digit; what follows six digits is cut.
_ISO_WITH_FRACTION = (
    r"\A(\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2})\.([0-9]{6}|[0-9]{1,5}\z)"
)


def run_timestamp(run_ts: str | datetime | Column) -> Column:
    """The load time of a run: one value given by the caller, so that all outputs agree."""
    if isinstance(run_ts, Column):
        return run_ts
    return F.lit(str(run_ts)).cast("timestamp")


def log_date(text: Column) -> Column:
    """Calendar date of a request time, NULL for text that is no date."""
    return text.try_cast("date")


def shift_iso(text: Column, hours: int) -> Column:
    """Shift an ISO request time by whole hours; NULL for text without date, time and fraction.

    The fraction is cut to microseconds and left out when it is zero. All arithmetic is on
    zone-less timestamps, so the session time zone plays no part.
    """
    seconds = F.regexp_extract(text, _ISO_WITH_FRACTION, 1).try_cast("timestamp_ntz")
    shifted = (seconds + F.expr(f"INTERVAL '{int(hours)}' HOUR")).cast("string")
    # Whole hours leave the fraction as it is.
    fraction = F.rpad(F.regexp_extract(text, _ISO_WITH_FRACTION, 2), 6, "0")
    return F.concat(
        F.replace(shifted, F.lit(" "), F.lit("T")),
        F.replace(F.concat(F.lit("."), fraction), F.lit(".000000"), F.lit("")),
    )
