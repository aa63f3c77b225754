"""Calendar parts of a viewing time."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_parts(ts: Column, non_null: bool = False) -> dict[str, Column]:
    """Hour, day of month, month and year of ``ts``.

    Date parts of a TIMESTAMP_NTZ are typed nullable (an ANSI cast to date
    sits inside).  When ``ts`` is known non-null the parts are wrapped in a
    coalesce that can never fire; typed non-nullable, joins on them infer no
    null checks that Catalyst would push down to the scan.
    """
    parts = {
        "view_hour": F.hour(ts),
        "view_day": F.dayofmonth(ts),
        "view_month": F.month(ts),
        "view_year": F.year(ts),
    }
    if non_null:
        parts = {k: F.coalesce(v, F.lit(0)) for k, v in parts.items()}
    return parts


def is_weekend(ts: Column) -> Column:
    """Saturday or Sunday; a null time counts as a weekday (false)."""
    return F.coalesce(F.dayofweek(ts).isin(1, 7), F.lit(False))


_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def as_instant(ntz: Column) -> Column:
    """Wall-clock TIMESTAMP_NTZ -> TIMESTAMP read as UTC, whatever the session
    zone (watermarks and event-time windows need a TIMESTAMP column)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), ntz))


def as_wall_clock(instant: Column) -> Column:
    """Inverse of :func:`as_instant`."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH_NTZ))
