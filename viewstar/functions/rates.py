"""Rounded rates of the KPI tables."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def engagement_rate(contacts: Column, views: Column) -> Column:
    """Contacts per view as a percentage, 2 places.

    Null, not 0, for a group without contacts: the rate is defined on a sum
    over matching rows, which is null when no row matches.
    """
    return F.round(F.nullif(contacts, F.lit(0)) / views * 100, 2)


def ratio(part: Column, whole: Column) -> Column:
    """A fraction 0..1, 2 places."""
    return F.round(part / whole, 2)
