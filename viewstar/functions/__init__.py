"""Column-expression builders (pure JVM built-ins, codegen friendly)."""

from viewstar.functions.booleans import text_to_boolean, flag_to_boolean
from viewstar.functions.calendar import is_weekend, time_parts
from viewstar.functions.rates import engagement_rate, ratio
from viewstar.functions.timestamps import TIMESTAMP_FORMATS, parse_timestamp

__all__ = [
    "TIMESTAMP_FORMATS", "parse_timestamp", "text_to_boolean", "flag_to_boolean",
    "time_parts", "is_weekend", "engagement_rate", "ratio",
]
