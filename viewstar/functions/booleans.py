"""Boolean conversions that give null, not an error, on bad input."""

from pyspark.sql import Column


def text_to_boolean(text: Column) -> Column:
    """``y/yes/t/true/1`` -> true, ``n/no/f/false/0`` -> false, else null."""
    return text.try_cast("boolean")


def flag_to_boolean(flag: Column) -> Column:
    """TINYINT flag -> boolean (0 false, other true, null stays null)."""
    return flag.cast("boolean")
