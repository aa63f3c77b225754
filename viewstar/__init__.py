"""viewstar: listing-engagement analytics on Spark.

Raw viewing events and listing tables are cleaned with a small set of
Spark-native quality operators, joined into a star model and rolled up
into engagement KPI tables.  Everything is expressed with DataFrame /
SQL built-ins so Catalyst plans it; no Python UDF sits on the hot path.
"""

from viewstar.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
