"""Multi-layout timestamp parsing as one Catalyst expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: accepted text layouts, tried in this order ---------------
# Each regular expression guards its parse pattern; it fixes the field widths
# and (except the last) the field ranges.  No match gives null.
TIMESTAMP_FORMATS = (
    (r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01]) (0\d|1\d|2[0-3]):([0-5]\d):([0-5]\d)$",
     "yyyy-MM-dd HH:mm:ss"),
    (r"^(0[1-9]|[12]\d|3[01])-(0[1-9]|1[0-2])-\d{4} (0\d|1\d|2[0-3]):([0-5]\d):([0-5]\d)$",
     "dd-MM-yyyy HH:mm:ss"),
    (r"^\d{4}/(0[1-9]|1[0-2])/(0[1-9]|[12]\d|3[01]) (0\d|1\d|2[0-3]):([0-5]\d):([0-5]\d)$",
     "yyyy/MM/dd HH:mm:ss"),
    (r"^(0[1-9]|[12]\d|3[01])/(0[1-9]|1[0-2])/\d{4} (0\d|1\d|2[0-3]):([0-5]\d):([0-5]\d)$",
     "dd/MM/yyyy HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$",
     "yyyy-MM-dd'T'HH:mm:ss"),
)
# --- end of fixed values -----------------------------------------------------

_FIELDS = ("yyyy", "MM", "dd", "HH", "mm", "ss")


def _iso_text(text: Column, pattern: str) -> Column:
    """Rewrite a guarded text into ``yyyy-MM-dd HH:mm:ss``.

    The guard fixes every field's width, so each field sits at the offset it
    has in the pattern; substrings are far cheaper than a second regex.
    """
    layout = pattern.replace("'", "")
    pos = {f: layout.index(f) + 1 for f in _FIELDS}
    part = lambda f: text.substr(pos[f], len(f))
    return F.concat(part("yyyy"), F.lit("-"), part("MM"), F.lit("-"), part("dd"),
                    F.lit(" "), part("HH"), F.lit(":"), part("mm"), F.lit(":"), part("ss"))


def parse_timestamp(text: Column, formats=TIMESTAMP_FORMATS) -> Column:
    """Text -> TIMESTAMP_NTZ; the first layout whose guard matches wins.

    Calendar-invalid dates that pass a guard (31 February, month 13 in the
    unguarded last layout) give null via ``try_cast``, never an error.
    The result has no zone, so it does not move with the session zone.
    """
    branch = None
    for regex, pattern in formats:
        iso = _iso_text(text, pattern)
        branch = F.when(text.rlike(regex), iso) if branch is None \
            else branch.when(text.rlike(regex), iso)
    return branch.try_cast("timestamp_ntz")
